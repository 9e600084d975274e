"""The model experiment: all rounds, and the best models on rows that no round has seen."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightloom.operators import models as M
from brightloom.plans.rentals import Experiment, run_experiment


def test_finalists_are_fitted_again_and_scored_on_the_hold_out(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        a, b = rng.normal(), rng.normal()
        y = 3 * a - 2 * b + (5.0 if i >= 300 else 0.0) + 0.01 * rng.normal()  # the hold-out lies higher
        rows.append((i, None if i % 50 == 0 else float(a), float(b), "x" if i % 3 else "y", float(y)))
    df = spark.createDataFrame(rows, "id long, a double, b double, kind string, y double")
    spec = Experiment(label="y", keys=["id"], numeric=["a", "b"], categorical=["kind"], features=lambda t: t.drop("kind"),
                      is_test=F.col("id") >= 300, linear=("ols", "lasso"), trees=("tree",),
                      tree_options={"tree": {"space": M.product_grid(min_samples_split=[2], max_leaf_nodes=[8]), "folds": 2}})
    got = run_experiment(df, spec, rounds=(("drop", "corr"), ("impute", "lasso")), finalists=2)
    board = [(r.approach, r.accuracy) for r in got.board.collect()]
    assert len(board) == 6 and board == sorted(board, key=lambda r: (-r[1], r[0])) and board[0][1] > 0.99
    final = {r.approach: r.accuracy for r in got.final.collect()}
    assert set(final) == set(got.models) == {name for name, _ in board[:2]}
    test = df.where("id >= 300").dropna()
    for name, model in got.models.items():
        rows = test.collect()
        pred = [r.p for r in model.transform(test, "p").collect()]
        y = np.array([r.y for r in rows])
        want = 1 - ((y - pred) ** 2).sum() / ((y - y.mean()) ** 2).sum()
        if name.startswith("drop"):
            assert final[name] == pytest.approx(want) and final[name] < board[0][1]


def test_depths_of_one_tree_score_like_trees_of_their_own(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b), float(np.sin(3 * a) + (b > 0) * a + 0.1 * rng.normal())) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = M.assemble(spark.createDataFrame(rows, "id long, a double, b double, y double"), ["a", "b"], "y")
    space = M.product_grid(min_samples_split=[2, 8], max_leaf_nodes=[2, 8, 32])
    quick = M.fit_tree_cv(df, ["id"], space, folds=2)
    plain = M.grid_search(M.decision_tree(), [M.tree_params(**p) for p in space], df, ["id"], folds=2)
    assert [p for p, _ in quick.results] == [p for p, _ in plain.results]
    assert [r for _, r in quick.results] == pytest.approx([r for _, r in plain.results])
    assert quick.best == plain.best and quick.train_r2 == pytest.approx(plain.train_r2)


def test_rounds_share_a_written_feature_table(spark):
    """One table per treatment of nulls, and a plan of a few lines below every fit."""
    rows = [(i, None if i % 20 == 0 else float(i % 7), float(i % 5), "x", float(3 * (i % 7) - i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, a double, b double, kind string, y double")
    built = []

    def features(table):
        built.append(table)
        return table.drop("kind")

    spec = Experiment(label="y", keys=["id"], numeric=["a", "b"], categorical=["kind"], features=features,
                      is_test=F.col("id") >= 90, linear=("ols", "ridge", "lasso"), trees=())
    got = run_experiment(df, spec, finalists=1)
    assert len(built) == 2 and got.board.count() == 12 and got.final.count() == 1
    assert {r.approach.rsplit(" ", 1)[0] for r in got.board.collect()} == {"drop corr", "impute corr", "drop lasso", "impute lasso"}


def test_registered_experiment_searches_the_whole_spaces(spark, monkeypatch):
    """Nothing that the query passes makes the operators' own search spaces smaller."""
    from brightloom.plans import rentals
    from catalog import modelling

    specs, searched = [], {}
    monkeypatch.setattr(modelling, "hourly", lambda t: None)
    monkeypatch.setattr(modelling, "run_experiment", lambda df, spec: specs.append(spec))
    modelling.experiment(None)
    spec, = specs
    monkeypatch.setattr(M, "random_search", lambda estimator, space, df, keys, n_iter=10, folds=5: searched.update({kind: (len(space), n_iter, folds)}))
    monkeypatch.setattr(M, "fit_tree_cv", lambda df, keys, space=M.TREE_SPACE, folds=5: searched.update({kind: (len(space), folds)}))
    df = spark.createDataFrame([(1, 1.0, 1.0)], "id long, a double, y double")
    for kind in spec.trees:
        rentals.fit_trees(kind, df, ["a"], "y", ["id"], spec.tree_options or {})
    assert searched == {"tree": (224, 5), "forest": (160, 10, 5), "extra": (648, 10, 5)}
    assert spec.linear == ("ols", "ridge", "lasso") and spec.trees == ("tree", "forest", "extra")


def test_trees_grown_within_a_task_are_those_of_spark(spark, monkeypatch):
    """Without chance, a tree of each is the same; with it, forests are as good on held-out rows."""
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=500), rng.normal(size=500), rng.integers(0, 5, 500)])
    y = np.sin(2 * x[:, 0]) + x[:, 1] * (x[:, 2] > 2) + 0.1 * rng.normal(size=500)
    rows = [(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = M.assemble(spark.createDataFrame(rows, "id long, a double, b double, c double, y double"), ["a", "b", "c"], "y")
    one = M.random_forest().setBootstrap(False)
    params = {"numTrees": 1, "maxDepth": 6, "featureSubsetStrategy": "all", "minInstancesPerNode": 4}
    plain = M.decision_tree().setMaxDepth(6).setMinInstancesPerNode(4).fit(df)
    got, want = [[r.prediction for r in m.transform(df).orderBy("id").collect()] for m in (M.fit_trees(one, params, df), plain)]
    assert got == pytest.approx(want)

    monkeypatch.setattr(M, "IN_ONE_TASK", 0)
    far = M.fit_tree_cv(df, ["id"], folds=3)
    monkeypatch.undo()
    near = M.fit_tree_cv(df, ["id"], folds=3)
    assert near.best == far.best and near.train_r2 == pytest.approx(far.train_r2) and [p for p, _ in near.results] == [p for p, _ in far.results]
    assert [r for _, r in near.results] == pytest.approx([r for _, r in far.results])

    space = M.product_grid(n_estimators=[20, 5], max_depth=[20], max_features=["sqrt"], min_samples_leaf=[2])
    for found, estimator in ((M.fit_forest_search(df, ["id"], space, folds=3), M.random_forest()), (M.fit_extra_trees(df, ["id"], space, folds=3), M.extra_trees())):
        slow = M.grid_search(estimator, [p for p, _ in found.results], df, ["id"], folds=3)
        assert [r for _, r in found.results] == pytest.approx([r for _, r in slow.results], abs=0.08)
        assert found.train_r2 > found.validation_r2 and found.best in [p for p, _ in found.results]


def test_a_forest_is_the_beginning_of_a_larger_one(spark):
    from brightloom.operators import forest

    rng = np.random.default_rng(3)
    x, y, fold = rng.normal(size=(90, 4)), rng.normal(size=90), np.arange(90) % 3
    growth = forest.Growth(30, 1, "sqrt", True, 42)
    both = forest.held_out_predictions(spark, x, y, fold, 3, [(growth, 37), (growth, 7)])
    for n, got in zip((37, 7), both):
        alone, = forest.held_out_predictions(spark, x, y, fold, 3, [(growth, n)])
        model = forest.fit(spark, x[fold != 1], y[fold != 1], growth, n)
        bins = forest._binned(x[fold == 1], model.cuts)
        assert np.allclose(got[1], alone[1]) and np.allclose(got[1], sum(t.trees().predict(bins) for t in model.parts.value) / n)
