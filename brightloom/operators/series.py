"""Many time series in long form: rows (keys…, t, y) with t = 1, 2, … explicit.

A series is as long as the calendar it was resampled to, never as long as the
raw facts, so per-series windows and groups are bounded by the calendar.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .relations import attach

PERIODS = {"hour": "1 hour", "day": "1 day", "month": "1 month", "quarter": "3 months"}


def to_series(df: DataFrame, keys: list[str], ts: str, value: Column | str, freq: str,
              how=F.sum) -> DataFrame:
    """Raw facts to one regular series per key over the common calendar; periods
    without facts are 0. Returns (keys…, t, ts, y)."""
    v = F.col(value) if isinstance(value, str) else value
    sums = (df.select(*keys, F.date_trunc(freq, ts).alias("_ts"), v.alias("_v"))
            .groupBy(*keys, "_ts").agg(how("_v").alias("_y")))
    span = df.agg(F.date_trunc(freq, F.min(ts)).alias("a"), F.date_trunc(freq, F.max(ts)).alias("b"))
    first, last = span.first()
    periods = F.sequence(F.lit(first), F.lit(last), F.expr(f"interval {PERIODS[freq]}"))
    kind = sums.schema["_ts"].dataType
    grid = (df.select(*keys).distinct()
            .select(*keys, F.posexplode(periods).alias("_i", "ts"))
            .withColumn("ts", F.col("ts").cast(kind)))
    filled = grid.join(sums.withColumnRenamed("_ts", "ts"), [*keys, "ts"], "left")
    return filled.select(*keys, (F.col("_i") + 1).alias("t"), "ts",
                         F.coalesce("_y", F.lit(0)).cast("double").alias("y"))


def log_series(df: DataFrame, y: str = "y") -> DataFrame:
    """Natural log; values that are not positive become null."""
    return df.withColumn(y, F.when(F.col(y) > 0, F.ln(y)))


def exp_series(df: DataFrame, y: str = "y") -> DataFrame:
    return df.withColumn(y, F.exp(y))


def lag_polynomial(d: int, D: int, s: int) -> dict[int, float]:
    """Coefficients of (1 - B)^d (1 - B^s)^D by lag."""
    poly = np.array([1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    for _ in range(D):
        poly = np.convolve(poly, [1.0] + [0.0] * (s - 1) + [-1.0])
    return {lag: float(c) for lag, c in enumerate(poly) if c}


def difference(df: DataFrame, keys: list[str], d: int = 1, D: int = 0, s: int = 1,
               y: str = "y", out: str = "w") -> DataFrame:
    """Ordinary and seasonal differences composed, as (keys…, t, out).

    Every value adds its share to the positions it takes part in, and the shares
    meet in one aggregation keyed by (keys, t): no ordered window, so it does not
    matter how long a series is. Positions without their full history are dropped."""
    poly = lag_polynomial(d, D, s)
    shares = F.array(*[F.struct((F.col("t") + lag).alias("t"), (F.col(y) * c).alias("part"))
                       for lag, c in poly.items()])
    parts = df.select(*keys, F.explode(shares).alias("_s")).select(*keys, "_s.t", "_s.part")
    summed = parts.groupBy(*keys, "t").agg(F.sum("part").alias(out), F.count("part").alias("_n"))
    return summed.where(F.col("_n") == len(poly)).drop("_n")


def acf(df: DataFrame, keys: list[str], nlags: int, y: str = "y") -> DataFrame:
    """Autocorrelation at lags 1..nlags as (keys…, lag, r, n)."""
    mean = df.groupBy(*keys).agg(F.avg(y).alias("_m"), F.count(y).alias("n"))
    centred = (attach(df.where(F.col(y).isNotNull()), mean, keys)
               .select(*keys, "t", "n", (F.col(y) - F.col("_m")).alias("_x")))
    lagged = (centred.select(*keys, F.col("t").alias("_t"), F.col("_x").alias("_past"),
                             F.explode(F.sequence(F.lit(1), F.lit(nlags))).alias("lag"))
              .withColumn("t", F.col("_t") + F.col("lag")).drop("_t"))
    products = (lagged.join(centred, [*keys, "t"]).groupBy(*keys, "lag")
                .agg(F.sum(F.col("_past") * F.col("_x")).alias("_c")))
    power = centred.groupBy(*keys).agg(F.sum(F.col("_x") * F.col("_x")).alias("_c0"),
                                       F.first("n").alias("n"))
    return (attach(products, power, keys).where(F.col("_c0") > 0)
            .select(*keys, "lag", (F.col("_c") / F.col("_c0")).alias("r"), "n"))


def pacf(acf_table: DataFrame, keys: list[str]) -> DataFrame:
    """Partial autocorrelation from `acf` rows by the Durbin-Levinson recursion; a
    group is one series with one row per lag."""
    schema = T.StructType([acf_table.schema[k] for k in keys]
                          + [T.StructField("lag", T.IntegerType()), T.StructField("partial", T.DoubleType())])

    def recursion(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        r = pdf["r"].to_numpy()
        partial = np.zeros(len(r))
        phi = np.zeros(0)
        for k in range(len(r)):
            past = r[:k][::-1]
            bottom = 1.0 - phi @ r[:k]
            last = (r[k] - phi @ past) / bottom if bottom else 0.0
            phi = np.append(phi - last * phi[::-1], last)
            partial[k] = last
        return pdf.assign(lag=pdf["lag"].astype("int32"), partial=partial)[[*keys, "lag", "partial"]]

    return acf_table.groupBy(*keys).applyInPandas(recursion, schema)


def chi2_tail(x: Column, df: int) -> Column:
    """Upper tail of the chi-square distribution as a closed expression: a finite
    sum for an even number of degrees, the normal tail plus a finite sum for odd."""
    half = x / 2
    if df % 2 == 0:
        total, term = F.lit(1.0), F.lit(1.0)
        for i in range(1, df // 2):
            term = F.pow(half, F.lit(float(i))) / math.gamma(i + 1)
            total = total + term
        return F.exp(-half) * total
    total = F.lit(0.0)
    for i in range(1, (df - 1) // 2 + 1):
        total = total + F.pow(half, F.lit(i - 0.5)) / math.gamma(i + 0.5)
    return normal_tail(F.sqrt(x)) * 2 + F.exp(-half) * total


def normal_tail(z: Column) -> Column:
    """1 - Φ(z) for z >= 0. Up to 5 from the series of the error function, whose terms are
    all positive; beyond, from its continued fraction."""
    x = z / math.sqrt(2.0)
    step = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(state: Column, n: Column) -> Column:
        term = state["term"] * 2 * x * x / (2 * n + 1)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(120)), step, add, lambda state: state["total"])
    near = 0.5 - F.exp(-x * x) * x * series / math.sqrt(math.pi)
    fraction = F.aggregate(F.sequence(F.lit(60), F.lit(1)), z, lambda rest, n: z + n / rest)
    far = F.exp(-z * z / 2) / fraction / math.sqrt(2 * math.pi)
    return F.when(z < 5, near).otherwise(far)


def box_test(acf_table: DataFrame, keys: list[str], lags: list[int], kind: str = "box-pierce") -> DataFrame:
    """White-noise test on `acf` rows: Q and p per series and number of lags.
    ``box-pierce``: n Σ r²; ``ljung-box``: n (n + 2) Σ r² / (n - lag)."""
    n = F.col("n")
    term = (n * F.col("r") * F.col("r") if kind == "box-pierce"
            else n * (n + 2) * F.col("r") * F.col("r") / (n - F.col("lag")))
    sums = acf_table.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("lag") <= m, term)).alias(f"q{m}") for m in lags])
    rows = F.array(*[F.struct(F.lit(m).alias("lags"), F.col(f"q{m}").alias("statistic"),
                              chi2_tail(F.col(f"q{m}"), m).alias("p_value")) for m in lags])
    return sums.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")


def jarque_bera(df: DataFrame, keys: list[str], y: str = "y") -> DataFrame:
    """Skewness and kurtosis test, one aggregation at any size. Two degrees of
    freedom make the p-value exp(-JB / 2)."""
    stats = df.groupBy(*keys).agg(F.count(y).alias("n"), F.skewness(y).alias("skew"),
                                  F.kurtosis(y).alias("kurt"))
    jb = F.col("n") / 6 * (F.col("skew") * F.col("skew") + F.col("kurt") * F.col("kurt") / 4)
    return stats.withColumn("statistic", jb).withColumn("p_value", F.exp(-F.col("statistic") / 2))


def backtest_frames(sizes: DataFrame, n_test: int, horizons: int, scheme: str, n: str = "n") -> DataFrame:
    """Training ranges of a backtest: per series, origin i and horizon h the rows
    ``lo..hi`` and the position `target` to predict. ``recursive`` starts at 1,
    ``rolling`` at i; both end h steps before the target."""
    estimation = F.col(n) - n_test
    return (sizes.withColumn("origin", F.explode(F.sequence(F.lit(1), F.lit(n_test))))
            .withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizons))))
            .withColumn("scheme", F.lit(scheme))
            .withColumn("lo", F.lit(1) if scheme == "recursive" else F.col("origin"))
            .withColumn("hi", (estimation - F.col("horizon") + F.col("origin")).cast("int"))
            .withColumn("target", (estimation + F.col("origin")).cast("int"))
            .drop(n))


def training_rows(series: DataFrame, frames: DataFrame, keys: list[str]) -> DataFrame:
    """Series rows of every frame."""
    return frames.join(series, keys).where(F.col("t").between(F.col("lo"), F.col("hi")))


FRAME = ["scheme", "origin", "horizon", "lo", "hi", "target"]


def seasonal_ar1(series: DataFrame, frames: DataFrame, keys: list[str], s: int) -> DataFrame:
    """Closed-form fit and forecast of (0,1,0)(1,1,0)s for every frame.

    With u = y_t - y_{t-s} and w its first difference, the coefficient is the
    least-squares slope of w on w lagged by s inside the frame, and the forecast
    for h <= s is y_{T+h-s} + u_T + coefficient (u_{T+h-s} - u_{T-s}). Sums over a
    frame are differences of running sums, so every frame needs seven values of its
    series, fetched by one equi-join."""
    u = difference(series, keys, 0, 1, s, out="u")
    w = difference(series, keys, 1, 1, s)
    lagged = w.select(*keys, (F.col("t") + s).alias("t"), F.col("w").alias("w_s"))
    running = Window.partitionBy(*keys).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    state = (series.select(*keys, "t", "y").join(u, [*keys, "t"], "left")
             .join(w, [*keys, "t"], "left").join(lagged, [*keys, "t"], "left")
             .withColumn("cross", F.sum(F.coalesce(F.col("w") * F.col("w_s"), F.lit(0.0))).over(running))
             .withColumn("power", F.sum(F.when(F.col("w").isNotNull(), F.col("w_s") * F.col("w_s"))
                                        .otherwise(0.0)).over(running))
             .select(*keys, "t", "y", "u", F.coalesce("cross", F.lit(0.0)).alias("cross"),
                     F.coalesce("power", F.lit(0.0)).alias("power")))
    hi, lo, h = F.col("hi"), F.col("lo"), F.col("horizon")
    spots = {"end": hi, "start": lo + 2 * s, "season": hi + h - s, "before": hi - s, "goal": F.col("target")}
    wanted = frames.select(*keys, *FRAME, F.explode(F.array(*[
        F.struct(F.lit(name).alias("spot"), at.alias("t")) for name, at in spots.items()])).alias("_w"))
    found = wanted.select(*keys, *FRAME, "_w.spot", "_w.t").join(state, [*keys, "t"])
    pick = lambda spot, value: F.max(F.when(F.col("spot") == spot, F.col(value)))
    fit = found.groupBy(*keys, *FRAME).agg(
        F.try_divide(pick("end", "cross") - pick("start", "cross"),
                     pick("end", "power") - pick("start", "power")).alias("coefficient"),
        pick("season", "y").alias("_y"), pick("end", "u").alias("_u"),
        (pick("season", "u") - pick("before", "u")).alias("_du"),
        pick("goal", "y").alias("actual"))
    return (fit.withColumn("pred", F.col("_y") + F.col("_u") + F.col("coefficient") * F.col("_du"))
            .drop("_y", "_u", "_du"))


def forecast_report(actual: DataFrame, predicted: DataFrame, keys: list[str], n_test: int) -> DataFrame:
    """Actual next to the forecast of every horizon (history before the test range,
    predictions in it), long form with the MAPE and MSFE of the horizon."""
    from .evaluate import mape_of, msfe_of
    group = [*keys, "scheme", "horizon"]
    errors = predicted.groupBy(*group).agg(mape_of("actual", "pred").alias("mape"),
                                           msfe_of("actual", "pred").alias("msfe"))
    ahead = predicted.select(*group, F.col("target").alias("t"), "actual", "pred")
    limits = predicted.groupBy(*group).agg(F.min("target").alias("_first"))
    history = (limits.join(actual.select(*keys, "t", "y"), keys).where(F.col("t") < F.col("_first"))
               .select(*group, "t", F.col("y").alias("actual"), F.col("y").alias("pred")))
    return history.unionByName(ahead).join(errors, group)
