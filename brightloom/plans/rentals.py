"""Four rounds of models: two ways to treat nulls times two ways to choose features."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, functions as F

from ..operators import models as M
from ..operators.evaluate import leaderboard
from ..operators.prepare import impute_median, impute_mode, select_by_corr
from ..operators.rows import null_count_filter
from ..runtime import durable


@dataclass
class Experiment:
    """What to run. `features` turns a cleaned table into numeric columns; `is_test`
    marks the chronological hold-out, which no round may learn from."""

    label: str
    keys: list[str]
    numeric: list[str]
    categorical: list[str]
    features: Callable[[DataFrame], DataFrame]
    is_test: Column
    linear: tuple[str, ...] = ("ols", "ridge", "lasso")
    trees: tuple[str, ...] = ("tree", "forest", "extra")
    tree_options: dict | None = None
    fit_on: str = "train"


def clean(df: DataFrame, spec: Experiment, nulls: str) -> DataFrame:
    """Drop rows with nulls, or fill them from the training rows (``fit_on='all'``
    uses every row)."""
    if nulls == "drop":
        return null_count_filter(df, 1, "<")
    fit_on = ~spec.is_test if spec.fit_on == "train" else None
    filled = impute_median(df, spec.numeric, fit_on)
    for column in spec.categorical:
        filled = impute_mode(filled, column, fit_on)
    return filled


def fit_linear(kind: str, train: DataFrame, features: list[str], label: str, keys: list[str]) -> M.LinearModel:
    if kind == "ols":
        return M.fit_ols(train, features, label)
    fit = M.fit_ridge_cv if kind == "ridge" else M.fit_lasso_cv
    return fit(train, features, label, keys)


def fit_trees(kind: str, train: DataFrame, features: list[str], label: str, keys: list[str],
              options: dict) -> M.Searched:
    fit = {"tree": M.fit_tree_cv, "forest": M.fit_forest_search, "extra": M.fit_extra_trees}[kind]
    return fit(M.assemble(train, features, label), keys, **options.get(kind, {}))


LINEAR = ("ols", "ridge", "lasso")


@dataclass
class Fitted:
    """A model of one family with what it takes to use it."""

    approach: str
    kind: str
    features: list[str]
    label: str
    model: object

    def score(self, rows: DataFrame, model: object | None = None) -> DataFrame:
        """One leaderboard row: R² over `rows`."""
        model = model or self.model
        if self.kind in LINEAR:
            scored = model.transform(rows.withColumn("label", F.col(self.label).cast("double")))
        else:
            scored = model.transform(M.assemble(rows, self.features, self.label))
        return M.metric_row(scored, self.approach)

    def refitted(self, rows: DataFrame, keys: list[str]) -> object:
        """The same kind of model with the same parameters on other rows."""
        if self.kind in LINEAR:
            if self.kind == "lasso":
                return M.fit_lasso(rows, self.features, self.label, [self.model.penalty])[0]
            return (M.fit_ols(rows, self.features, self.label) if self.kind == "ols"
                    else M.fit_ridge_cv(rows, self.features, self.label, keys, [self.model.penalty]))
        estimator = {"tree": M.decision_tree, "forest": M.random_forest, "extra": M.extra_trees}[self.kind]()
        return M.fit_trees(estimator, self.model.best, M.assemble(rows, self.features, self.label))


SCORES = "approach string, accuracy double"


def at_once(df: DataFrame, fn: Callable, jobs: list) -> list:
    """`fn` of every job. The fits of an experiment don't wait for each other, so a few of them
    share the executors; each takes memory of the driver."""
    with ThreadPool(max(1, min(len(jobs), 2))) as pool:
        return pool.map(inheritable_thread_target(df.sparkSession)(fn), jobs, 1)


def select_model(train: DataFrame, validation: DataFrame, features: list[str], label: str,
                 keys: list[str], candidates: tuple[str, ...], options: dict | None = None,
                 name: str = "") -> tuple[DataFrame, dict[str, Fitted]]:
    """Fit every model family on the same rows; leaderboard rows and the models by approach."""
    def fit(kind: str) -> tuple[Fitted, list[tuple]]:
        model = (fit_linear(kind, train, features, label, keys) if kind in LINEAR
                 else fit_trees(kind, train, features, label, keys, options or {}))
        one = Fitted(f"{name} {kind}".strip(), kind, features, label, model)
        return one, one.score(validation, model if kind in LINEAR else model.model).collect()

    done = at_once(train, fit, list(candidates))
    scores = train.sparkSession.createDataFrame([tuple(r) for _, rows in done for r in rows], SCORES)
    return leaderboard(scores, "accuracy", "approach"), {one.approach: one for one, _ in done}


@dataclass
class Results:
    """`board`: all models by their score on validation rows. `final`: the best ones,
    fitted again on all rows before the hold-out and scored on the hold-out. `models`:
    those, by approach."""

    board: DataFrame
    final: DataFrame
    models: dict[str, object]


def run_experiment(df: DataFrame, spec: Experiment, rounds=(("drop", "corr"), ("impute", "corr"),
                                                            ("drop", "lasso"), ("impute", "lasso")),
                   finalists: int = 3) -> Results:
    """All rounds, then the final test of the best. Rounds that treat nulls alike share one
    feature table, written once, so that fits start from its rows and not from all the steps
    that led to them. No round sees a row of the hold-out."""
    spark, source = df.sparkSession, df.persist()
    treatments = list(dict.fromkeys(nulls for nulls, _ in rounds))
    past: dict[str, DataFrame] = {}
    try:
        tables = dict(zip(treatments, at_once(df, lambda nulls: durable(spec.features(clean(source, spec, nulls))), treatments)))
        past = {nulls: M.split_random(table.where(~spec.is_test), spec.keys).persist() for nulls, table in tables.items()}

        def run_round(job: tuple[str, str]) -> tuple[list[tuple], dict[str, Fitted]]:
            nulls, chosen = job
            train, validation = past[nulls].where("is_train = 1"), past[nulls].where("is_train = 0")
            skip = {*spec.keys, spec.label, "is_train"}
            names = [n for n, kind in train.dtypes
                     if n not in skip and kind in ("int", "bigint", "double", "float", "smallint")]
            features = (select_by_corr(train, names, spec.label) if chosen == "corr"
                        else M.select_by_lasso(M.fit_lasso_cv(train, names, spec.label, spec.keys)))
            board, models = select_model(train, validation, features, spec.label, spec.keys,
                                         (*spec.linear, *spec.trees), spec.tree_options, f"{nulls} {chosen}")
            return [tuple(r) for r in board.collect()], models

        done = at_once(df, run_round, list(rounds))
        fitted = {name: (one, tables[nulls]) for (nulls, _), (_, models) in zip(rounds, done) for name, one in models.items()}
        board = leaderboard(spark.createDataFrame([r for rows, _ in done for r in rows], SCORES), "accuracy", "approach")

        def test(approach: str) -> tuple[object, list[tuple]]:
            one, table = fitted[approach]
            model = one.refitted(table.where(~spec.is_test), spec.keys)
            return model, [tuple(r) for r in one.score(table.where(spec.is_test), model).collect()]

        best = [row["approach"] for row in board.limit(finalists).collect()]
        tested = at_once(df, test, best)
        final = spark.createDataFrame([r for _, rows in tested for r in rows], SCORES)
        return Results(board, leaderboard(final, "accuracy", "approach"), {name: model for name, (model, _) in zip(best, tested)})
    finally:
        for kept in (source, *past.values()):
            kept.unpersist()
