import numpy as np
import pytest
from pyspark.sql import functions as F

from brightloom.operators import models as M, prepare as P, sarima as A, series as S


def long_series(spark, values, key="s"):
    return spark.createDataFrame([(key, i + 1, float(v)) for i, v in enumerate(values)], "k string, t int, y double")


def test_seasonal_and_first_difference_of_trend_plus_pattern_is_zero(spark):
    y = [t + [3, 1, 4, 1][t % 4] for t in range(1, 13)]
    w = [r.w for r in S.difference(long_series(spark, y), ["k"], 1, 1, 4).collect()]
    assert len(w) == 7 and w == pytest.approx([0] * 7)


def test_acf_and_box_test(spark):
    acf = S.acf(long_series(spark, [1, 2, 3, 4]), ["k"], 1)
    assert acf.first().r == pytest.approx(0.25)
    row = S.box_test(acf, ["k"], [1]).first()
    assert row.statistic == pytest.approx(0.25) and row.p_value == pytest.approx(0.6171, abs=1e-4)


def test_chi_square_tail_against_tables(spark):
    for x, df, p in [(18.307, 10, 0.05), (24.996, 15, 0.05), (43.773, 30, 0.05), (3.841, 1, 0.05), (5.991, 2, 0.05)]:
        assert spark.range(1).select(S.chi2_tail(F.lit(x), df)).first()[0] == pytest.approx(p, abs=2e-5)


def test_pacf_of_an_autoregression_cuts_off(spark):
    rng = np.random.default_rng(0)
    y = [0.0]
    for e in rng.normal(size=3000):
        y.append(0.6 * y[-1] + e)
    rows = S.pacf(S.acf(long_series(spark, y), ["k"], 5), ["k"]).orderBy("lag").collect()
    assert rows[0].partial == pytest.approx(0.6, abs=0.05)
    assert max(abs(r.partial) for r in rows[1:]) < 0.06


def seasonal_ar(n, phi=0.5, s=4, seed=5):
    rng = np.random.default_rng(seed)
    w = np.zeros(n)
    for t in range(n):
        w[t] = (phi * w[t - s] if t >= s else 0) + rng.normal()
    u = np.cumsum(w)
    for t in range(s, n):
        u[t] += u[t - s]
    return u


def test_closed_form_and_solver_recover_the_coefficient(spark):
    y = seasonal_ar(2000)
    df = long_series(spark, y)
    frames = spark.createDataFrame([("s", "whole", 1, h, 1, 1996, 1996 + h) for h in (1, 2, 3, 4)],
                                   "k string, scheme string, origin int, horizon int, lo int, hi int, target int")
    fits = S.seasonal_ar1(df, frames, ["k"], 4).orderBy("horizon").collect()
    assert fits[0].coefficient == pytest.approx(0.5, abs=0.05)
    spec = A.Sarima("M4", (0, 1, 0), (1, 1, 0), 4)
    model = A.fit_one(y[:1996], spec)
    assert model.params[0] == pytest.approx(fits[0].coefficient, abs=0.005)
    assert [r.pred for r in fits] == pytest.approx(list(A.forecast_one(model, 4)), rel=1e-3)
    assert fits[3].actual == pytest.approx(y[1999])


def test_moving_average_fits(spark):
    rng = np.random.default_rng(2)
    e = rng.normal(size=380)
    w = e.copy()
    w[1:] += 0.4 * e[:-1]
    y = np.cumsum(w)
    both = [A.fit_one(y, A.Sarima("m", (0, 1, 1), (0, 0, 0)), exact=x).params[0] for x in (True, False)]
    assert both == pytest.approx([0.4, 0.4], abs=0.12) and both[0] == pytest.approx(both[1], abs=0.02)


def test_backtests_share_fits_and_rolling_with_full_window_is_recursive(spark):
    df = long_series(spark, seasonal_ar(60)).union(long_series(spark, seasonal_ar(60, seed=9), "z"))
    sizes = df.groupBy("k").agg(F.max("t").alias("n"))
    frames = S.backtest_frames(sizes, 5, 4, "recursive")
    spec = A.Sarima("M4", (0, 1, 0), (1, 1, 0), 4)
    got = A.backtest_sarima(df, frames, ["k"], [spec]).toPandas()
    assert len(got) == 2 * 5 * 4 and got["pred"].notna().all()
    exact = S.seasonal_ar1(df, frames, ["k"], 4).toPandas()
    merged = got.merge(exact, on=["k", "origin", "horizon"])
    assert np.corrcoef(merged["pred_x"], merged["pred_y"])[0, 1] > 0.999
    assert (merged["actual_x"] == merged["actual_y"]).all()
    rolling = S.backtest_frames(sizes, 5, 4, "rolling").where("origin = 1").drop("scheme")
    assert rolling.exceptAll(frames.where("origin = 1").drop("scheme")).count() == 0


def test_a_series_too_short_reports_its_problem(spark):
    fits = A.fit_sarima(long_series(spark, [1, 2, 3, 4, 5]), ["k"], [A.Sarima("M", (3, 1, 0), (1, 1, 0), 4)])
    assert "too few" in fits.first().problem


def test_shapiro_published_example():
    w, p = A.shapiro_one(np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236.0]))
    assert w == pytest.approx(0.7888, abs=1e-4) and p == pytest.approx(0.0067, abs=1e-4)


def test_to_series_fills_gaps(spark):
    df = spark.sql("SELECT 'a' AS k, timestamp'2024-01-01' AS ts, 1 AS v UNION ALL SELECT 'a', timestamp'2024-03-05', 2 "
                   "UNION ALL SELECT 'b', timestamp'2024-02-01', 5")
    got = [(r.k, r.t, r.y) for r in S.to_series(df, ["k"], "ts", "v", "month").orderBy("k", "t").collect()]
    assert got == [("a", 1, 1.0), ("a", 2, 0.0), ("a", 3, 2.0), ("b", 1, 0.0), ("b", 2, 5.0), ("b", 3, 0.0)]


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3))
    y = 5 + 2 * x[:, 0] - 3 * x[:, 1] + rng.normal(scale=0.1, size=400)
    return spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
                                 "id long, a double, b double, c double, y double").repartition(3).persist()


def test_linear_models_recover_coefficients(linear):
    for model in (M.fit_ols(linear, ["a", "b", "c"], "y"), M.fit_ridge_cv(linear, ["a", "b", "c"], "y", ["id"]),
                  M.fit_lasso_cv(linear, ["a", "b", "c"], "y", ["id"])):
        assert [model.intercept, *model.coefficients] == pytest.approx([5, 2, -3, 0], abs=0.03)
    data = linear.toPandas()
    x = np.column_stack([np.ones(len(data)), data[["a", "b", "c"]]])
    want = np.linalg.lstsq(x, data["y"], rcond=None)[0]
    ols = M.fit_ols(linear, ["a", "b", "c"], "y")
    assert [ols.intercept, *ols.coefficients] == pytest.approx(list(want), rel=1e-9)
    strong = M.fit_lasso_cv(linear, ["a", "b", "c"], "y", ["id"], penalties=[0.05])
    assert M.select_by_lasso(strong) == ["a", "b"]


def test_lasso_score_is_the_held_out_error(linear):
    model = M.fit_lasso_cv(linear, ["a", "b"], "y", ["id"], penalties=[0.01], folds=2)
    errors = []
    for fold in (0, 1):
        marked = linear.withColumn("f", M.bucket_of(["id"], 2))
        moments = M.collect_moments(marked.where(F.col("f") != fold), ["a", "b"], "y")
        table = moments.total()
        part = M._model(moments, table, M._solve(table, 0.01, "lasso"), 0.01)
        scored = part.transform(marked.where(F.col("f") == fold))
        errors.append(scored.agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0])
    assert model.scores[0.01] == pytest.approx(np.mean(errors), rel=1e-6)


def test_imputation_and_scaling(spark):
    df = spark.createDataFrame([(1.0, "b"), (None, "a"), (3.0, "a"), (10.0, "b"), (None, None)], "v double, c string")
    assert [r.v for r in P.impute_median(df, ["v"]).collect()] == [1, 3, 3, 10, 3]
    assert P.mode_of(df, "c") == "a"
    only = P.impute_median(df, ["v"], fit_on=F.col("c") == "b").collect()
    assert only[1].v == 5.5
    four = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "v double")
    assert [r.v for r in P.standard_scale(four, ["v"]).collect()] == pytest.approx(
        list((np.arange(1, 5) - 2.5) / np.sqrt(1.25)))
    assert [r.v for r in P.robust_scale(four, ["v"]).collect()] == pytest.approx(list((np.arange(1, 5) - 2.5) / 1.5))
    hot = P.one_hot(df, "c")
    assert hot.columns == ["v", "c_a", "c_b"] and tuple(hot.collect()[4])[1:] == (0, 0)


def test_correlation_selection_keeps_the_feature_closer_to_the_target(linear):
    wide = linear.withColumn("twin", F.col("b") + 0.3 * F.col("c"))
    assert P.select_by_corr(wide, ["a", "b", "c", "twin"], "y") == ["b", "a"]


def test_tree_parameters_stay_in_spark_limits():
    assert M.tree_params(9, 110) == {"maxDepth": 7, "minInstancesPerNode": 4}
    assert M.forest_params(500, 500, "auto")["maxDepth"] == 30
    assert M.forest_params(10, None, "sqrt")["featureSubsetStrategy"] == "sqrt"


def test_grid_search_prefers_the_deeper_tree(spark):
    df = spark.createDataFrame([(i, float(i % 10), float((i % 10) ** 2)) for i in range(200)], "id long, x double, y double")
    found = M.grid_search(M.decision_tree(), [{"maxDepth": 1}, {"maxDepth": 4}], M.assemble(df, ["x"], "y"), ["id"], folds=2)
    assert found.best == {"maxDepth": 4} and found.validation_r2 > 0.95 and found.train_r2 > 0.95


def _table(x, y):
    m = np.column_stack([np.ones(len(y)), x - x.mean(axis=0), y - y.mean()])
    return m.T @ m


@pytest.mark.parametrize("seed", range(12))
def test_lasso_meets_the_optimality_conditions_at_every_penalty(seed):
    rng = np.random.default_rng(seed)
    n, k = 80, int(rng.integers(1, 12))
    x = rng.normal(size=(n, k)) * 10 ** rng.uniform(-2, 3, k)
    if seed % 3 == 0:
        x = x + x.sum(axis=1, keepdims=True)
    if seed % 4 == 0:
        x[:, 0] = 7.0  # constant
    y = x @ (rng.normal(size=k) * (rng.random(k) < 0.5)) + rng.normal(size=n)
    penalties = [*(10 ** np.linspace(2, -4, 40)), 0.0]
    xc, yc = x - x.mean(axis=0), y - y.mean()
    for p, beta in zip(penalties, M._lasso(_table(x, y), penalties)):
        steep = xc.T @ (yc - xc @ beta) / n
        slack = 1e-6 * np.abs(xc.T @ yc / n).max()
        assert (np.abs(steep) <= p + slack).all()
        assert np.abs(steep - p * np.sign(beta))[beta != 0].max(initial=0.0) <= slack


def test_lasso_of_nearly_equal_features_reaches_the_end_of_its_path():
    rng = np.random.default_rng(0)
    a = rng.normal(size=500)
    b = a + 1e-3 * rng.normal(size=500)
    betas = M._lasso(_table(np.column_stack([a, b]), 2.63 * a - 1.63 * b), [1e-5, 1e-9, 0.0])
    assert betas[0] == pytest.approx([1.0, 0.0], abs=1e-3)  # too close to tell at this penalty
    assert betas[2] == pytest.approx([2.63, -1.63], abs=1e-6)
    same = M._lasso(_table(np.column_stack([a, a, 2 * a]), 3 * a), [0.1, 1e-5])
    assert (same @ [1, 1, 2]) == pytest.approx([3.0, 3.0], abs=0.06)
