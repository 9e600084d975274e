"""Regression: linear models from moments, tree ensembles with model search.

All linear models, with every penalty and fold, are solved from one table of
moments (counts, sums and cross products per fold). The data is read once for the
means and once for the products, whether there is one fit or five hundred.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..runtime import scratch_path
from . import forest
from .evaluate import r2_of

DEEPEST = 30  # Spark's limit on tree depth


def bucket_of(keys: list[str], buckets: int, seed: int = 0) -> Column:
    """Reproducible bucket of a row key."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def split_random(df: DataFrame, keys: list[str], percent: int = 75, seed: int = 0) -> DataFrame:
    """``is_train`` = 1 for about `percent` of the rows, decided by the key alone."""
    return df.withColumn("is_train", (bucket_of(keys, 100, seed) < percent).cast("int"))


@dataclass
class Moments:
    """Sums over rows of (1, x, y) products, moved to the overall means."""

    features: list[str]
    shift: np.ndarray
    tables: dict[int, np.ndarray]

    def total(self, without: int | None = None) -> np.ndarray:
        return sum(t for fold, t in self.tables.items() if fold != without)


def collect_moments(df: DataFrame, features: list[str], label: str, fold: Column | None = None) -> Moments:
    """Moments per fold. Every task multiplies its own batches and sends one small
    matrix per fold. Rows with a null feature or label are left out."""
    cols = [*features, label]
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)],
                     (F.lit(0) if fold is None else fold).cast("int").alias("fold")).dropna()
    means = data.agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(len(cols))]).first()
    if means[0] is None:
        raise ValueError("no rows without nulls to fit on")
    shift = np.array([means[i] for i in range(len(cols))])
    names, size = [f"c{i}" for i in range(len(cols))], len(cols) + 1

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            x = np.column_stack([np.ones(len(pdf)), pdf[names].to_numpy() - shift])
            folds = pdf["fold"].to_numpy()
            for f in np.unique(folds):
                part = x[folds == f]
                sums[int(f)] = sums.get(int(f), 0) + part.T @ part
        for f, m in sums.items():
            yield pd.DataFrame({"fold": np.full(size * size, f, "int32"),
                                "at": np.arange(size * size, dtype="int32"), "cell": m.ravel()})

    cells = data.mapInPandas(products, "fold int, at int, cell double")
    sums = cells.groupBy("fold", "at").agg(F.sum("cell").alias("cell")).collect()
    tables: dict[int, np.ndarray] = {}
    for row in sums:
        tables.setdefault(row["fold"], np.zeros(size * size))[row["at"]] = row["cell"]
    return Moments(features, shift, {f: t.reshape(size, size) for f, t in tables.items()})


@dataclass
class LinearModel:
    """Coefficients; predicting is a plain column expression."""

    features: list[str]
    coefficients: np.ndarray
    intercept: float
    penalty: float = 0.0
    scores: dict[float, float] = field(default_factory=dict)

    def prediction(self) -> Column:
        terms = F.lit(float(self.intercept))
        for name, c in zip(self.features, self.coefficients):
            if c:
                terms = terms + F.col(name).cast("double") * float(c)
        return terms

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.prediction())


def _centred(table: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, float]:
    """n, means, X'X and X'y about the means of these rows."""
    n, sums = table[0, 0], table[0, 1:]
    cross = table[1:, 1:] - np.outer(sums, sums) / n
    return n, sums / n, cross[:-1, :-1], cross[:-1, -1], cross[-1, -1]


def _solve(table: np.ndarray, penalty: float, kind: str) -> np.ndarray:
    _, _, xx, xy, _ = _centred(table)
    if kind == "ols":
        return np.linalg.lstsq(xx, xy, rcond=None)[0]
    if kind == "ridge":
        return np.linalg.solve(xx + penalty * np.eye(len(xy)), xy)
    return _lasso(table, [penalty])[0]


#: A feature is left out where the others explain all but this part of its variance.
DEPENDENT = 1e-9


def _lasso(table: np.ndarray, penalties: list[float]) -> np.ndarray:
    """Minimum of (1/2n)|y - Xb|² + penalty |b| for each penalty, by (penalty, feature).

    Follows the exact solution as the penalty falls from where it is zero (homotopy, as in
    least angle regression): between two knots the same features are in with the same
    signs, and their coefficients solve one linear system. A knot is where a feature comes
    in (its correlation with the residual reaches the penalty) or goes out (its coefficient
    reaches zero). A feature that depends
    linearly on those that are in stays out. A result that misses the optimality conditions is an error."""
    n, _, xx, xy, _ = _centred(table)
    usable = np.diag(xx) > 0
    scale = np.sqrt(np.where(usable, np.diag(xx) / n, 1.0))
    # In units of each feature's deviation: beta times scale, and the penalty is `at * weight`.
    gram, target, weight = xx / n / np.outer(scale, scale), np.where(usable, xy / n / scale, 0.0), 1.0 / scale
    order = sorted(set(penalties), reverse=True)
    found: dict[float, np.ndarray] = {}
    active: list[int] = []
    signs = np.zeros(len(xy))
    barred: set[int] = set()  # depend on the active ones
    dependent: set[int] = set()  # ever did
    moved = (-1, 0.0)  # the feature of the last knot and its sign: on the piece that begins there it can't turn back

    def pieces() -> tuple[np.ndarray, np.ndarray]:
        """beta = whole + at * slope until the next knot."""
        whole, slope = np.zeros(len(xy)), np.zeros(len(xy))
        if active:
            both = np.column_stack([target[active], -weight[active] * signs[active]])
            whole[active], slope[active] = np.linalg.solve(gram[np.ix_(active, active)], both).T
        return whole, slope

    penalty = np.inf
    while True:
        whole, slope = pieces()
        base, lean = target - gram @ whole, -gram @ slope
        knot, event = 0.0, None
        for j in np.flatnonzero(usable):
            if j in active:
                at = -whole[j] / slope[j] if slope[j] and j != moved[0] else -1.0
                if knot < at < penalty:
                    knot, event = at, ("out", j, 0.0)
            elif j not in barred:
                for sign in (1.0, -1.0):  # sign * (base + at * lean) = at * weight
                    steep = weight[j] - sign * lean[j]
                    at = sign * base[j] / steep if abs(steep) > 1e-14 * weight[j] else -1.0
                    if knot < at <= penalty and (j, sign) != moved:
                        knot, event = at, ("in", j, sign)
        while order and order[0] >= knot:
            found[order[0]] = whole + order[0] * slope
            order.pop(0)
        if event is None or not order:
            break
        kind, j, sign = event
        if kind == "out":
            active.remove(j)
            moved = j, signs[j]
            barred.clear()
        else:
            inside = gram[np.ix_(active, active)]
            rest = 1.0 - gram[j, active] @ np.linalg.solve(inside, gram[active, j]) if active else 1.0
            if rest <= DEPENDENT:
                barred.add(j)
                dependent.add(j)
                continue
            active.append(j)
            moved = j, sign
        signs[j], penalty = sign, knot
    for at, beta in found.items():
        steep = target - gram @ beta
        loose = 1e-6 * at * weight + 1e-7 * np.abs(target).max(initial=0.0)
        wrong = np.where(beta != 0, np.abs(steep - at * weight * np.sign(beta)), np.abs(steep) - at * weight) > loose
        wrong[list(dependent)] = False
        if wrong[usable].any():
            raise ArithmeticError(f"lasso has no stable solution at penalty {at}")
    return np.array([found[p] / scale for p in penalties]).reshape(len(penalties), len(xy))


def _model(moments: Moments, table: np.ndarray, beta: np.ndarray, penalty: float) -> LinearModel:
    _, mean, *_ = _centred(table)
    centre = moments.shift + mean
    return LinearModel(moments.features, beta, float(centre[-1] - centre[:-1] @ beta), penalty)


def _error(table: np.ndarray, held_out: np.ndarray, beta: np.ndarray) -> float:
    """Squared error of a model fitted on `table` over the rows of `held_out`, per row."""
    _, mean, *_ = _centred(table)
    intercept = mean[-1] - mean[:-1] @ beta
    v = np.concatenate([[-intercept], -beta, [1.0]])
    return float(v @ held_out @ v) / held_out[0, 0]


def fit_ols(df: DataFrame, features: list[str], label: str) -> LinearModel:
    """Ordinary least squares with intercept."""
    moments = collect_moments(df, features, label)
    table = moments.total()
    return _model(moments, table, _solve(table, 0.0, "ols"), 0.0)


def fit_lasso(df: DataFrame, features: list[str], label: str, penalties: list[float]) -> list[LinearModel]:
    """A model per penalty, all points of one path."""
    moments = collect_moments(df, features, label)
    table = moments.total()
    return [_model(moments, table, beta, p) for p, beta in zip(penalties, _lasso(table, penalties))]


def _fit_cv(df: DataFrame, features: list[str], label: str, penalties: list[float], kind: str,
            keys: list[str], folds: int, seed: int) -> LinearModel:
    moments = collect_moments(df, features, label, bucket_of(keys, folds, seed))
    scores: dict[float, list[float]] = {p: [] for p in penalties}
    for fold, held_out in moments.tables.items():
        table = moments.total(without=fold)
        betas = (_lasso(table, penalties) if kind == "lasso"
                 else [_solve(table, p, kind) for p in penalties])
        for p, beta in zip(penalties, betas):
            scores[p].append(_error(table, held_out, beta))
    means = {p: float(np.mean(s)) for p, s in scores.items()}
    best = min(penalties, key=lambda p: (means[p], -p))
    table = moments.total()
    model = _model(moments, table, _solve(table, best, kind), best)
    model.scores = means
    return model


def fit_ridge_cv(df: DataFrame, features: list[str], label: str, keys: list[str],
                 penalties: list[float] = (0.1, 1.0, 10.0), folds: int = 5, seed: int = 0) -> LinearModel:
    """Ridge with the penalty of least cross-validated error."""
    return _fit_cv(df, features, label, list(penalties), "ridge", keys, folds, seed)


def log_penalties(n: int = 100) -> list[float]:
    return [float(p) for p in 10 ** np.linspace(-1, -4, n)]


def fit_lasso_cv(df: DataFrame, features: list[str], label: str, keys: list[str],
                 penalties: list[float] | None = None, folds: int = 5, seed: int = 0) -> LinearModel:
    """Lasso with the penalty of least cross-validated error."""
    return _fit_cv(df, features, label, penalties or log_penalties(), "lasso", keys, folds, seed)


def select_by_lasso(model: LinearModel, least: float = 1e-5) -> list[str]:
    """Features with a coefficient that is not negligible."""
    return [f for f, c in zip(model.features, model.coefficients) if abs(c) > least]


# ---- trees and search -------------------------------------------------------------------

def assemble(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Vector of features and double label next to the other columns; rows with
    nulls in either are dropped, as no tree takes them."""
    ready = df.dropna(subset=[*features, label]).withColumn("label", F.col(label).cast("double"))
    return VectorAssembler(inputCols=features, outputCol="features").transform(ready)


def tree_params(min_samples_split: int, max_leaf_nodes: int) -> dict:
    """Spark has no leaf limit: the depth that holds that many leaves stands in, and
    half the split size as least rows per leaf."""
    depth = max(1, int(np.ceil(np.log2(max_leaf_nodes))))
    return {"maxDepth": min(depth, DEEPEST), "minInstancesPerNode": max(1, min_samples_split // 2)}


def forest_params(n_estimators: int, max_depth: int | None = None, max_features: str = "auto",
                  min_samples_split: int = 2, min_samples_leaf: int = 1) -> dict:
    return {"numTrees": n_estimators, "maxDepth": min(max_depth or DEEPEST, DEEPEST),
            "featureSubsetStrategy": {"auto": "all"}.get(max_features, max_features),
            "minInstancesPerNode": max(min_samples_leaf, min_samples_split // 2, 1)}


def decision_tree(seed: int = 42) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(seed=seed)


def random_forest(seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(seed=seed)


def extra_trees(seed: int = 42) -> RandomForestRegressor:
    """Approximation: whole sample per tree, a third of the features per split. Spark
    still looks for the best threshold where extra trees draw it at random."""
    return RandomForestRegressor(seed=seed, bootstrap=False, featureSubsetStrategy="onethird")


def product_grid(**choices: list) -> list[dict]:
    rows: list[dict] = [{}]
    for name, values in choices.items():
        rows = [{**row, name: v} for row in rows for v in values]
    return rows


# fixed values: the search spaces
TREE_SPACE = product_grid(min_samples_split=list(range(2, 10)),
                          max_leaf_nodes=[*range(2, 11), *range(20, 201, 10)])
FOREST_SPACE = product_grid(n_estimators=[5, 10, 20, 50, 100, 200, 300, 400, 500, 501],
                            max_depth=list(range(150, 501, 50)), max_features=["auto", "sqrt"])
EXTRA_SPACE = product_grid(max_depth=[int(d) for d in np.linspace(20, 100, 8)] + [None],
                           n_estimators=[int(n) for n in np.linspace(10, 4000, 8)],
                           min_samples_split=[2, 4, 6], min_samples_leaf=[1, 2, 3])


@dataclass
class Searched:
    model: Model | forest.ForestModel
    best: dict
    validation_r2: float
    train_r2: float
    results: list[tuple[dict, float]]


def grid_search(estimator: Estimator, grid: list[dict], df: DataFrame, keys: list[str], folds: int = 5,
                seed: int = 0, parallelism: int = 4) -> Searched:
    """k-fold search over Spark parameter maps. Folds come from the row key, so every
    candidate sees the same ones in every run."""
    data = df.withColumn("fold", bucket_of(keys, folds, seed)).persist()
    maps, seen = [], []
    for params in grid:
        if params not in seen:
            seen.append(params)
            maps.append({estimator.getParam(n): v for n, v in params.items()})
    evaluator = RegressionEvaluator(metricName="r2")
    try:
        found = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
                               numFolds=folds, foldCol="fold", parallelism=parallelism).fit(data)
        at = int(np.argmax(found.avgMetrics))
        return Searched(found.bestModel, seen[at], float(found.avgMetrics[at]),
                        float(evaluator.evaluate(found.bestModel.transform(data))),
                        list(zip(seen, [float(m) for m in found.avgMetrics])))
    finally:
        data.unpersist()


IN_ONE_TASK = 20_000  # rows that a task may hold to grow trees over


def _few_rows(estimator: Estimator, df: DataFrame, fold: Column) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Features, labels and folds, if they are few enough for trees that are grown within a task."""
    if not isinstance(estimator, (DecisionTreeRegressor, RandomForestRegressor)) or df.count() > IN_ONE_TASK:
        return None
    rows = df.select(vector_to_array("features").alias("x"), "label", fold.alias("fold")).toPandas()
    return (np.array(rows["x"].tolist(), float).reshape(len(rows), -1), rows["label"].to_numpy(float), rows["fold"].to_numpy(int))


def _growth(estimator: DecisionTreeRegressor | RandomForestRegressor, params: dict) -> tuple[forest.Growth, int]:
    whole = estimator.copy({estimator.getParam(n): v for n, v in params.items()})
    if isinstance(whole, DecisionTreeRegressor):
        return forest.Growth(whole.getMaxDepth(), whole.getMinInstancesPerNode(), "all", False, whole.getSeed()), 1
    return forest.Growth(whole.getMaxDepth(), whole.getMinInstancesPerNode(), whole.getFeatureSubsetStrategy(),
                         whole.getBootstrap(), whole.getSeed()), whole.getNumTrees()


def fit_trees(estimator: DecisionTreeRegressor | RandomForestRegressor, params: dict, df: DataFrame) -> Model | forest.ForestModel:
    """A tree or forest with these parameters: by tasks that hold the whole table, or by Spark where it is large."""
    few = _few_rows(estimator, df, F.lit(0))
    if few is None:
        return estimator.copy({estimator.getParam(n): v for n, v in params.items()}).fit(df)
    return forest.fit(df.sparkSession, *few[:2], *_growth(estimator, params))


def random_search(estimator: Estimator, space: list[dict], df: DataFrame, keys: list[str],
                  n_iter: int = 10, seed: int = 42, folds: int = 5, **kwargs) -> Searched:
    """`grid_search` over a seeded sample of the space. Forests over few rows are grown within
    tasks, all candidates and folds at once."""
    grid = random.Random(seed).sample(space, min(n_iter, len(space)))
    few = _few_rows(estimator, df, bucket_of(keys, folds))
    if few is None:
        return grid_search(estimator, grid, df, keys, folds, **kwargs)
    x, y, fold = few
    grid = [params for i, params in enumerate(grid) if params not in grid[:i]]
    found = forest.held_out_predictions(df.sparkSession, x, y, fold, folds, [_growth(estimator, params) for params in grid])
    scores = [float(np.mean([_r2(y[fold == k], held_out) for k, held_out in enumerate(each)])) for each in found]
    at = int(np.argmax(scores))
    model = fit_trees(estimator, grid[at], df)
    return Searched(model, grid[at], scores[at], float(RegressionEvaluator(metricName="r2").evaluate(model.transform(df))),
                    list(zip(grid, scores)))


def _r2(label: np.ndarray, prediction: np.ndarray) -> float:
    return 1 - ((label - prediction) ** 2).sum() / ((label - label.mean()) ** 2).sum()


def _cut_predictions(model: Model, depths: list[int]) -> list[Column]:
    """Prediction of a tree as if it had stopped growing at each depth. Splits are chosen
    level by level, so a tree of less depth is the top of a deeper one, and the model's
    table of nodes has a prediction for inner nodes too."""
    spark = SparkSession.active()
    path = scratch_path(spark, "tree")
    model.write().save(path)
    nodes = {r["id"]: r for r in spark.read.parquet(f"{path}/data").collect()}  # at most 2^(depth + 1)
    values = vector_to_array("features")

    def grow(at: int, left: int) -> Column:
        node = nodes[at]
        if left == 0 or node["leftChild"] < 0:
            return F.lit(node["prediction"])
        goes_left = F.get(values, F.lit(node["split"]["featureIndex"])) <= node["split"]["leftCategoriesOrThreshold"][0]
        return F.when(goes_left, grow(node["leftChild"], left - 1)).otherwise(grow(node["rightChild"], left - 1))

    return [grow(0, d) for d in depths]


def fit_tree_cv(df: DataFrame, keys: list[str], space: list[dict] = TREE_SPACE, folds: int = 5,
                seed: int = 0, parallelism: int = 4) -> Searched:
    """k-fold search over trees. Candidates that differ in depth alone share a fit per fold:
    the deepest is grown, and all depths are scored on the held-out fold in one pass. Over few
    rows all of them are grown by one job. Features have to be continuous."""
    mapped = [tree_params(**p) for p in space]
    maps = [p for i, p in enumerate(mapped) if p not in mapped[:i]]
    leaves = sorted({p["minInstancesPerNode"] for p in maps})
    depths_of = {least: [p["maxDepth"] for p in maps if p["minInstancesPerNode"] == least] for least in leaves}
    data = df.withColumn("fold", bucket_of(keys, folds, seed)).persist()

    def scores(job: tuple[int, int]) -> list[float]:
        least, fold = job
        depths = depths_of[least]
        tree = decision_tree().setMaxDepth(max(depths)).setMinInstancesPerNode(least)
        cut = _cut_predictions(tree.fit(data.where(F.col("fold") != fold)), depths)
        held_out = data.where(F.col("fold") == fold).select("label", *[c.alias(f"p{i}") for i, c in enumerate(cut)])
        return list(held_out.agg(*[r2_of("label", f"p{i}").alias(f"r{i}") for i in range(len(cut))]).first())

    try:
        jobs = [(least, fold) for least in leaves for fold in range(folds)]
        few = _few_rows(decision_tree(), data, F.col("fold"))
        if few is None:
            with ThreadPool(parallelism) as pool:
                found = dict(zip(jobs, pool.map(inheritable_thread_target(df.sparkSession)(scores), jobs)))
        else:
            x, y, fold_of = few
            growths = [_growth(decision_tree(), {"maxDepth": max(depths_of[least]), "minInstancesPerNode": least})[0] for least in leaves]
            held_out = forest.held_out_depths(df.sparkSession, x, y, fold_of, folds, [(g, depths_of[least]) for g, least in zip(growths, leaves)])
            found = {(least, fold): [_r2(y[fold_of == fold], values) for values in held_out[i][fold]]
                     for i, least in enumerate(leaves) for fold in range(folds)}
        results = []
        for least in leaves:
            same = [p for p in maps if p["minInstancesPerNode"] == least]
            means = np.mean([found[least, fold] for fold in range(folds)], axis=0)
            results += list(zip(same, map(float, means)))
        results.sort(key=lambda r: maps.index(r[0]))
        best, r2 = max(results, key=lambda r: r[1])
        model = fit_trees(decision_tree(), best, data)
        return Searched(model, best, r2, float(RegressionEvaluator(metricName="r2").evaluate(model.transform(data))), results)
    finally:
        data.unpersist()


def fit_forest_search(df: DataFrame, keys: list[str], space: list[dict] = FOREST_SPACE,
                      n_iter: int = 10, **kwargs) -> Searched:
    return random_search(random_forest(), [forest_params(**p) for p in space], df, keys, n_iter, **kwargs)


def fit_extra_trees(df: DataFrame, keys: list[str], space: list[dict] = EXTRA_SPACE,
                    n_iter: int = 10, **kwargs) -> Searched:
    mapped = [{**forest_params(**p), "featureSubsetStrategy": "onethird"} for p in space]
    return random_search(extra_trees(), mapped, df, keys, n_iter, **kwargs)


def metric_row(df: DataFrame, approach: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One leaderboard row."""
    return df.agg(r2_of(label, prediction).alias("accuracy")).select(
        F.lit(approach).alias("approach"), "accuracy")
