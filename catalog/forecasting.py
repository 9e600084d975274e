"""Time series: transforms, fits, backtests, diagnostics."""

from pyspark.sql import functions as F

from brightloom.operators import sarima as M, series as S
from brightloom.operators.evaluate import error_frame
from brightloom.plans.earnings import MODELS, both_schemes, compare_models

from . import entry
from .sequences import ACF, LAGS, MONTHLY, SERIES, frames, frames_sql, months, quarters


@entry("y01_log_series", f"""
    SELECT nation, t, round(ln(y), 6) AS log_y, round(exp(ln(y)), 2) AS back FROM ({SERIES}) WHERE y > 0""")
def _(t):
    series = quarters(t)
    logged = S.log_series(series).where(F.col("y").isNotNull())
    back = S.exp_series(logged).select("nation", "t", F.round("y", 2).alias("back"))
    return logged.select("nation", "t", F.round("y", 6).alias("log_y")).join(back, ["nation", "t"])


@entry("y02_quarterly_series", f"SELECT nation, t, round(y, 2) AS y FROM ({SERIES})")
def _(t):
    return quarters(t).select("nation", "t", F.round("y", 2).alias("y"))


HOURLY = """
    SELECT event_type, CAST(date_diff('hour', (SELECT date_trunc('hour', min(ts)) FROM events), h) + 1 AS INTEGER) AS t,
           strftime(h, '%Y-%m-%d %H') AS hour, CAST(coalesce(n, 0) AS DOUBLE) AS y
    FROM (SELECT DISTINCT event_type FROM events) CROSS JOIN
      (SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM events), (SELECT date_trunc('hour', max(ts)) FROM events), INTERVAL 1 HOUR)) AS h)
      LEFT JOIN (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY ALL) USING (event_type, h)"""


def hourly(t):
    return S.to_series(t.events, ["event_type"], "ts", F.lit(1), "hour")


@entry("y02_hourly_series", HOURLY)
def _(t):
    return hourly(t).select("event_type", "t", F.date_format("ts", "yyyy-MM-dd HH").alias("hour"), "y")


@entry("y03_sarima_fits")
def _(t):
    return M.fit_sarima(quarters(t), ["nation"], MODELS)


@entry("y03_model_comparison")
def _(t):
    return compare_models(quarters(t), ["nation"], MODELS, n_test=8)


def ar1_sql(frames, series=MONTHLY, s=12):
    return f"""
    WITH s AS ({series}), u AS (SELECT *, y - lag(y, {s}) OVER (PARTITION BY nation ORDER BY t) AS u FROM s),
    w AS (SELECT *, u - lag(u) OVER (PARTITION BY nation ORDER BY t) AS w FROM u),
    p AS (SELECT *, lag(w, {s}) OVER (PARTITION BY nation ORDER BY t) AS ws FROM w),
    f AS ({frames}),
    c AS (SELECT nation, scheme, origin, horizon, lo, hi, target, sum(w * ws) / sum(ws * ws) AS coefficient
          FROM f JOIN p USING (nation) WHERE t BETWEEN lo + {2 * s + 1} AND hi GROUP BY ALL)
    SELECT c.*, g.y AS actual, a.y + e.u + coefficient * (a.u - b.u) AS pred FROM c
      JOIN p a ON a.nation = c.nation AND a.t = hi + horizon - {s} JOIN p e ON e.nation = c.nation AND e.t = hi
      JOIN p b ON b.nation = c.nation AND b.t = hi - {s} LEFT JOIN p g ON g.nation = c.nation AND g.t = target"""


WHOLE = f"""SELECT nation, 1 AS origin, CAST(h AS INTEGER) AS horizon, 'whole' AS scheme, 1 AS lo, CAST(n AS INTEGER) AS hi, CAST(n + h AS INTEGER) AS target
    FROM (SELECT nation, max(t) AS n FROM ({SERIES}) GROUP BY 1), range(1, 5) r(h)"""


def whole_series(series, horizons=4):
    """One frame per series and horizon that trains on everything."""
    return series.groupBy("nation").agg(F.max("t").alias("hi")).select(
        "nation", F.lit("whole").alias("scheme"), F.lit(1).alias("origin"),
        F.explode(F.sequence(F.lit(1), F.lit(horizons))).alias("horizon"), F.lit(1).alias("lo"), "hi"
    ).withColumn("target", F.col("hi") + F.col("horizon"))


@entry("y04_seasonal_ar_fit", f"""
    SELECT DISTINCT nation, round(coefficient, 6) AS coefficient FROM ({ar1_sql(WHOLE, SERIES, 4)})""")
def _(t):
    series = quarters(t)
    fits = S.seasonal_ar1(series, whole_series(series, 1), ["nation"], 4)
    return fits.select("nation", F.round("coefficient", 6).alias("coefficient"))


@entry("y05_point_forecasts", f"""
    SELECT nation, horizon, target, round(pred, 2) AS pred FROM ({ar1_sql(WHOLE, SERIES, 4)})""")
def _(t):
    series = quarters(t)
    return (S.seasonal_ar1(series, whole_series(series), ["nation"], 4)
            .select("nation", "horizon", "target", F.round("pred", 2).alias("pred")))


def backtest(t, scheme):
    series = months(t)
    chosen = frames(series).where(F.col("scheme") == scheme)
    return S.seasonal_ar1(series, chosen, ["nation"], 12)


for _name, _scheme in [("y06_recursive_backtest", "recursive"), ("y07_rolling_backtest", "rolling")]:
    @entry(_name, f"""
        SELECT nation, origin, horizon, lo, hi, target, round(coefficient, 6) AS coefficient, round(actual, 2) AS actual, round(pred, 2) AS pred
        FROM ({ar1_sql(frames_sql(25, 4, [_scheme]))})""")
    def _(t, scheme=_scheme):
        return backtest(t, scheme).select(
            "nation", "origin", "horizon", "lo", "hi", "target", F.round("coefficient", 6).alias("coefficient"),
            F.round("actual", 2).alias("actual"), F.round("pred", 2).alias("pred"))


TESTED = (10, 15, 20, 30)


def _chi2_sql(m):
    """Upper tail of chi-square at q with m degrees of freedom."""
    first = 0 if m % 2 == 0 else 0.5
    terms = " + ".join(f"exp({i + first} * ln(q / 2) - lgamma({i + first + 1}))" for i in range(m // 2))
    if m % 2 == 0:
        return f"exp(-q / 2) * ({terms})"
    error = ("exp(-q / 2) * sqrt(q / 2) * list_sum(list_transform(range(0, 200), lambda n: "
             "exp(n * ln(q) + n * ln(2) + lgamma(n + 1) - lgamma(2 * n + 2)))) * 2 / sqrt(pi())")
    return f"1 - {error} + exp(-q / 2) * ({terms})"


@entry("y08_box_test", " UNION ALL ".join(f"""
    SELECT nation, {m} AS lags, round(q, 6) AS statistic, round({_chi2_sql(m)}, 6) + 0.0 AS p_value
    FROM (SELECT nation, any_value(n) * sum(r * r) FILTER (lag <= {m}) AS q FROM ({ACF}) GROUP BY 1)""" for m in TESTED))
def _(t):
    tests = S.box_test(S.acf(months(t), ["nation"], LAGS), ["nation"], list(TESTED))
    return tests.withColumns({c: F.round(c, 6) + 0.0 for c in ("statistic", "p_value")})


@entry("y08_residual_diagnostics")
def _(t):
    residuals = M.sarima_residuals(quarters(t), ["nation"], MODELS)
    keys = ["nation", "model"]
    return S.box_test(S.acf(residuals, keys, 15), keys, [10, 15], "ljung-box")


@entry("y09_jarque_bera", """
    SELECT event_type, n, round(jb, 4) AS statistic, round(exp(-jb / 2), 6) AS p_value FROM (
      SELECT event_type, n, n / 6 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4) AS jb FROM (
        SELECT event_type, count(*) AS n, avg(pow(y - m, 2)) AS m2, avg(pow(y - m, 3)) AS m3, avg(pow(y - m, 4)) AS m4
        FROM (SELECT event_type, y, avg(y) OVER (PARTITION BY event_type) AS m FROM (""" + HOURLY + """)) GROUP BY 1))""")
def _(t):
    jb = S.jarque_bera(hourly(t), ["event_type"])
    return jb.select("event_type", "n", F.round("statistic", 4).alias("statistic"), F.round("p_value", 6).alias("p_value"))


@entry("y09_shapiro_wilk")
def _(t):
    return M.shapiro_wilk(hourly(t), ["event_type"])


@entry("y10_forecast_report", f"""
    WITH r AS ({ar1_sql(frames_sql(25, 4))}),
    e AS (SELECT nation, scheme, horizon, min(target) AS first, avg(abs((actual - pred) / nullif(actual, 0))) * 100 AS mape, avg(pow(actual - pred, 2)) AS msfe FROM r GROUP BY ALL)
    SELECT nation, scheme, horizon, t, round(s.y, 2) AS actual, round(s.y, 2) AS pred, round(mape, 4) AS mape, round(msfe / 1e6, 2) AS msfe_millions
    FROM e JOIN ({MONTHLY}) s USING (nation) WHERE t < first
    UNION ALL SELECT nation, scheme, horizon, target, round(actual, 2), round(pred, 2), round(mape, 4), round(msfe / 1e6, 2) FROM r JOIN e USING (nation, scheme, horizon)""")
def _(t):
    series = months(t)
    results = S.seasonal_ar1(series, frames(series), ["nation"], 12)
    report = S.forecast_report(series, results, ["nation"], 25)
    return report.select("nation", "scheme", "horizon", "t", F.round("actual", 2).alias("actual"),
                         F.round("pred", 2).alias("pred"), F.round("mape", 4).alias("mape"),
                         F.round(F.col("msfe") / 1e6, 2).alias("msfe_millions"))


@entry("y11_error_frame", f"""
    WITH r AS ({ar1_sql(frames_sql(25, 4))}) SELECT horizon, """ + ", ".join(f"""
      round(avg(abs((actual - pred) / nullif(actual, 0))) FILTER (scheme = '{s}') * 100, 4) AS "MAPE_{s}_M4",
      round(avg(pow(actual - pred, 2)) FILTER (scheme = '{s}') / 1e6, 2) AS "MSFE_{s}_M4" """ for s in ("recursive", "rolling"))
       + " FROM r GROUP BY horizon")
def _(t):
    series = months(t)
    results = (S.seasonal_ar1(series, both_schemes(series, ["nation"], 25, 4), ["nation"], 12)
               .withColumn("model", F.lit("M4")))
    frame = error_frame(results, "horizon", "model", "scheme", "actual", "pred", [("M4", "recursive"), ("M4", "rolling")])
    return frame.select("horizon", *[F.round(F.col(c) / (1 if c.startswith("MAPE") else 1e6),
                                             4 if c.startswith("MAPE") else 2).alias(c) for c in frame.columns[1:]])
