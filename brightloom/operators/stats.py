"""Aggregation, reshaping and descriptive statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .ordering import quantiles_wide
from .relations import attach


def group_size(df: DataFrame, keys: list[str], out: str = "size") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def rank_entities(df: DataFrame, key: str, score: str, limit: int | None = None) -> DataFrame:
    """Rows and mean score per entity, best first, ties by key."""
    ranked = (df.groupBy(key).agg(F.count(F.lit(1)).alias("reviews"), F.avg(score).alias("score"))
              .orderBy(F.desc("score"), F.asc(key)))
    return ranked if limit is None else ranked.limit(limit)


def numeric_columns(df: DataFrame, skip: list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def group_mean(df: DataFrame, keys: list[str], cols: list[str] | None = None) -> DataFrame:
    """Mean of every numeric column per group."""
    cols = cols or numeric_columns(df, keys)
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def pivot_count(df: DataFrame, rows: list[str], column: str, values: list) -> DataFrame:
    """Group sizes with one column per value; absent combinations are 0."""
    return df.groupBy(*rows).agg(*[F.count_if(F.col(column) == v).alias(str(v)) for v in values])


def melt(df: DataFrame, ids: list[str], cols: list[str]) -> DataFrame:
    """Wide to long: (ids, variable, value)."""
    if ids:
        return df.unpivot(ids, [F.col(c).cast("double").alias(c) for c in cols], "variable", "value")
    return _stack(df, {c: {"value": F.col(c).cast("double")} for c in cols})


def _stack(row: DataFrame, entries: dict[str, dict[str, Column]], keep: list[str] = (),
           name: str = "variable") -> DataFrame:
    """Turn the named column groups of each row into rows."""
    structs = [F.struct(F.lit(label).alias(name), *[c.alias(n) for n, c in cols.items()])
               for label, cols in entries.items()]
    fields = [name, *next(iter(entries.values()))]
    return (row.select(*keep, F.explode(F.array(*structs)).alias("_e"))
            .select(*keep, *[F.col(f"_e.{f}").alias(f) for f in fields]))


def describe(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """count, mean, sample std, min, quartiles and max, one row per column. The
    moments are one aggregation. Quartiles are exact; `approximate` takes them from
    the same pass with bounded memory."""
    moments = []
    for c in cols:
        v = F.col(c).cast("double")
        moments += [F.count(v).alias(f"{c}|count"), F.avg(v).alias(f"{c}|mean"),
                    F.stddev_samp(v).alias(f"{c}|std"), F.min(v).alias(f"{c}|min"),
                    F.max(v).alias(f"{c}|max")]
        if approximate:
            moments.append(F.percentile_approx(v, [0.25, 0.5, 0.75], 10000).alias(f"{c}|q"))
    wide = df.agg(*moments)
    stats = ["count", "mean", "std", "min", "max"]
    entries = {c: {s: F.col(f"`{c}|{s}`") for s in stats} for c in cols}
    if approximate:
        for c in cols:
            entries[c].update({n: F.get(F.col(f"`{c}|q`"), F.lit(i))
                               for i, n in enumerate(["p25", "p50", "p75"])})
        return _stack(wide, entries)
    quartiles = quantiles_wide(df, cols, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return _stack(wide, entries).join(quartiles, "variable", "left")


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Number of nulls per column, one pass."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _stack(wide, {c: {"nulls": F.col(c)} for c in cols})


def dtypes(df: DataFrame) -> DataFrame:
    """Schema as rows."""
    rows = [(i, n, kind) for i, (n, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def _pairs_by_products(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every task multiplies its batches as matrices and sends one column-by-column table
    of sums; values are shifted by the means for accuracy. NaN counts as missing."""
    double = [F.col(c).cast("double") for c in cols]
    data = df.select(*[F.when(~F.isnan(c), c).alias(f"c{i}") for i, c in enumerate(double)])
    means = data.agg(*[F.avg(c) for c in data.columns]).first()
    shift = np.array([m if m is not None else 0.0 for m in means])
    names, size = data.columns, len(cols)

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((6, size, size))
        for pdf in batches:
            x = pdf[names].to_numpy(float) - shift
            known = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            square = x * x
            sums += np.stack([known.T @ known, x.T @ known, known.T @ x,
                              square.T @ known, known.T @ square, x.T @ x])
        yield pd.DataFrame({"at": np.arange(sums.size, dtype="int32"), "cell": sums.ravel()})

    cells = (data.mapInPandas(products, "at int, cell double")
             .groupBy("at").agg(F.sum("cell").alias("cell")))
    plane, pair = F.floor(F.col("at") / (size * size)), F.col("at") % (size * size)
    sums = cells.groupBy(pair.alias("pair")).agg(*[
        F.sum(F.when(plane == i, F.col("cell"))).alias(n)
        for i, n in enumerate(["n", "sa", "sb", "saa", "sbb", "sab"])])
    i, j = F.floor(F.col("pair") / size), F.col("pair") % size
    covariance = F.col("sab") - F.try_divide(F.col("sa") * F.col("sb"), F.col("n"))
    power = ((F.col("saa") - F.try_divide(F.col("sa") * F.col("sa"), F.col("n")))
             * (F.col("sbb") - F.try_divide(F.col("sb") * F.col("sb"), F.col("n"))))
    label = lambda at: F.element_at(F.array(*[F.lit(c) for c in cols]), (at + 1).cast("int"))
    return (sums.where(i < j)
            .select(label(i).alias("a"), label(j).alias("b"),
                    F.when(power > 0, F.try_divide(covariance, F.sqrt(power))).alias("r")))


def corr_matrix(df: DataFrame, cols: list[str], triangle: str = "full") -> DataFrame:
    """Pearson correlations over pairwise complete rows as (a, b, r). `triangle` is
    full, lower or upper (both without the diagonal). Every pair is computed once, all
    in one pass of matrix products; nulls and NaN are missing, at any width."""
    upper = _pairs_by_products(df, cols)
    if triangle == "upper":
        return upper
    if triangle == "lower":
        return upper.select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    both = F.array(F.struct("a", "b", "r"),
                   F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "a string, b string, r double")
    return upper.select(F.explode(both).alias("p")).select("p.*").unionByName(diagonal)


def group_corr(df: DataFrame, key: str, cols: list[str], triangle: str = "full") -> DataFrame:
    """Correlation of the group means."""
    return corr_matrix(group_mean(df, [key], cols), cols, triangle)


def histogram(df: DataFrame, column: str, bins: int, by: list[str] = ()) -> DataFrame:
    """Counts in `bins` equal bins between minimum and maximum (of each `by` group),
    empty bins included. The top edge belongs to the last bin; a constant column
    gets a range of one around its value."""
    by = list(by)
    v = F.col(column).cast("double")
    data = df.select(*by, v.alias("_v")).where(F.col("_v").isNotNull())
    span = (data.groupBy(*by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
            .withColumns({"_lo": F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")),
                          "_hi": F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi"))}))
    width = (F.col("_hi") - F.col("_lo")) / bins
    placed = attach(data, span, by).withColumn(
        "bin", F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int"))
    counts = placed.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    frame = span.select(*by, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    counted = counts.withColumnsRenamed({c: f"_c_{c}" for c in [*by, "bin"]})
    match = reduce(lambda a, b: a & b,
                   [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in [*by, "bin"]])
    return frame.join(counted, match, "left").select(
        *by, "bin", (F.col("_lo") + F.col("bin") * width).alias("left_edge"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("count"))


def density_histogram(df: DataFrame, column: str, bins: int, by: list[str] = ()) -> DataFrame:
    """`histogram` scaled to area 1."""
    counts = histogram(df, column, bins, by)
    totals = counts.groupBy(*by).agg(F.sum("count").alias("_total"))
    return (attach(counts, totals, list(by))
            .withColumn("density", F.col("count")
                        / (F.col("_total") * (F.col("right_edge") - F.col("left_edge"))))
            .drop("_total"))


def normal_curve(df: DataFrame, column: str, by: list[str] = (), points: int = 100) -> DataFrame:
    """Normal density with the data's mean and sample deviation on an even grid over
    mean ± 3 deviations."""
    stats = df.groupBy(*by).agg(F.avg(column).alias("mu"), F.stddev_samp(column).alias("sigma"))
    grid = stats.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("mu") - 3 * F.col("sigma") + F.col("i") * (6 * F.col("sigma") / (points - 1))
    z = F.try_divide(F.col("x") - F.col("mu"), F.col("sigma"))
    return (grid.withColumn("x", x)
            .withColumn("density", F.try_divide(F.exp(-z * z / 2), F.col("sigma") * math.sqrt(2 * math.pi)))
            .drop("mu", "sigma"))


MOMENTS = 8  # of the values in a cell; what they leave out is below 1e-12 of a kernel
CELLS_PER_BANDWIDTH, REACH = 8, 9  # a kernel is below 1e-17 of its peak beyond 9 bandwidths


def kde(df: DataFrame, cols: list[str], points: int = 100, bandwidth: str = "scott") -> DataFrame:
    """Gaussian kernel density per column on an even grid reaching 3 bandwidths past the
    data. `bandwidth`: ``scott`` (sd n^-1/5) or ``nrd0`` (0.9 min(sd, iqr/1.34) n^-1/5).
    A constant column has no density and gives no rows; nulls and NaN are left out.

    Values are gathered in cells of an eighth of a bandwidth, occupied ones only. A cell
    keeps its moments d^k / k! (d: distance from its middle in bandwidths), and the kernel
    sum over it is a series in Hermite polynomials, He_k(z) phi(z) times moment k. Cells
    follow the bandwidth, so neither many rows nor a far outlier blur the result, and each
    meets only the points of the grid within 9 bandwidths."""
    values = [F.when(~F.isnan(v), v) for v in (F.col(c).cast("double") for c in cols)]
    long = _stack(df, {c: {"value": v} for c, v in zip(cols, values)}).where(F.col("value").isNotNull())
    stats = long.groupBy("variable").agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count("value").alias("_n"),
        F.stddev_samp("value").alias("_sd"))
    if bandwidth == "nrd0":
        quart = quantiles_wide(df, cols, {"_q1": 0.25, "_q3": 0.75})
        stats = stats.join(quart, "variable")
        spread = F.least(F.col("_sd"), (F.col("_q3") - F.col("_q1")) / 1.34)
        bw = 0.9 * F.when(spread > 0, spread).otherwise(F.col("_sd")) * F.pow("_n", F.lit(-0.2))
    else:
        bw = F.col("_sd") * F.pow("_n", F.lit(-0.2))
    stats = stats.select("variable", "_lo", "_hi", "_n", bw.alias("_bw")).where("_bw > 0")

    away = (F.col("value") - F.col("_lo")) / F.col("_bw")  # in bandwidths
    cell = F.floor(away * CELLS_PER_BANDWIDTH)
    middle = (F.col("_cell") + 0.5) / CELLS_PER_BANDWIDTH
    power, sums = F.lit(1.0), []
    for k in range(MOMENTS):
        sums.append(F.sum(power).alias(f"_m{k}"))
        power = power * F.col("_d") / (k + 1)
    keys = ["variable", "_lo", "_hi", "_n", "_bw", "_cell"]
    cells = (attach(long, stats, ["variable"]).withColumns({"_away": away, "_cell": cell})
             .withColumn("_d", F.col("_away") - middle).groupBy(*keys).agg(*sums))

    step = ((F.col("_hi") - F.col("_lo")) / F.col("_bw") + 6) / (points - 1)
    near = lambda side: (middle + 3 + side * REACH) / step
    reached = cells.where(F.ceil(near(-1)) <= F.lit(points - 1)).withColumn("i", F.explode(F.sequence(
        F.greatest(F.ceil(near(-1)), F.lit(0)), F.least(F.floor(near(1)), F.lit(points - 1))))).withColumn("i", F.col("i").cast("int"))
    z = F.col("_z")
    hermite = [F.lit(1.0), z]
    for k in range(1, MOMENTS - 1):
        hermite.append(z * hermite[k] - k * hermite[k - 1])
    reached = reached.withColumn("_z", F.col("i") * step - 3 - middle)
    series = sum((h * F.col(f"_m{k}") for k, h in enumerate(hermite)), F.lit(0.0))
    found = reached.groupBy("variable", "i").agg(F.sum(F.exp(-z * z / 2) * series).alias("_sum"))
    start, stop = F.col("_lo") - 3 * F.col("_bw"), F.col("_hi") + 3 * F.col("_bw")
    grid = stats.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return grid.join(found, ["variable", "i"], "left").select(
        "variable", "i", (start + F.col("i") * (stop - start) / (points - 1)).alias("x"),
        (F.coalesce("_sum", F.lit(0.0)) / (F.col("_n") * F.col("_bw") * math.sqrt(2 * math.pi))).alias("density"))


def box_stats(df: DataFrame, column: str, by: list[str] = ()) -> DataFrame:
    """Quartiles, whiskers at the outermost values within 1.5 interquartile ranges,
    and the number of values beyond, per group."""
    by = list(by)
    data = df.where(F.col(column).isNotNull())
    quart = quantiles_wide(data, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, by).drop("variable")
    v = F.col(column).cast("double")
    low = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    high = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = (v >= low) & (v <= high)
    joined = attach(data.select(*by, column), quart, by)
    return joined.groupBy(*by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))
