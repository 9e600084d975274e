"""Feature preparation: imputation, encoding, scaling, calendar features, selection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import date_parts, diff_flag, interaction, season
from .ordering import quantiles_wide
from .relations import flag_interval
from .stats import corr_matrix

def _fit_rows(df: DataFrame, fit_on: Column | None) -> DataFrame:
    return df if fit_on is None else df.where(fit_on)


def medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Exact medians; one number per column comes to the driver."""
    rows = quantiles_wide(df, cols, {"median": 0.5}).collect()
    return {r["variable"]: r["median"] for r in rows}


def impute_median(df: DataFrame, cols: list[str], fit_on: Column | None = None) -> DataFrame:
    """Fill nulls with the median of the rows where `fit_on` holds (all by default)."""
    fills = medians(_fit_rows(df, fit_on), cols)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(fills.get(c))) for c in cols})


def mode_of(df: DataFrame, column: str):
    """Most frequent value, the smallest of several."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    row = counts.agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias("mode")).first()
    return row["mode"]


def impute_mode(df: DataFrame, column: str, fit_on: Column | None = None) -> DataFrame:
    """Fill nulls with the mode."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(mode_of(_fit_rows(df, fit_on), column))))


def categories(df: DataFrame, column: str) -> list:
    """Sorted distinct values, all of them: each becomes a column."""
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def one_hot(df: DataFrame, column: str, values: list | None = None) -> DataFrame:
    """0/1 columns ``<column>_<value>`` in place of the column. Null and unknown
    values have 0 everywhere."""
    values = categories(df, column) if values is None else values
    flags = {f"{column}_{v}": F.when(F.col(column) == v, 1).otherwise(0) for v in values}
    return df.withColumns(flags).drop(column)


@dataclass
class Preprocessing:
    """What to do with which columns; all others pass through."""

    median: list[str] = field(default_factory=list)
    mode: list[str] = field(default_factory=list)
    onehot: dict[str, list | None] = field(default_factory=dict)
    standard: list[str] = field(default_factory=list)
    robust: list[str] = field(default_factory=list)


def preprocess(df: DataFrame, spec: Preprocessing, fit_on: Column | None = None) -> DataFrame:
    """Impute, then scale, then encode."""
    if spec.median:
        df = impute_median(df, spec.median, fit_on)
    for column in spec.mode:
        df = impute_mode(df, column, fit_on)
    if spec.standard:
        df = standard_scale(df, spec.standard, fit_on)
    if spec.robust:
        df = robust_scale(df, spec.robust, fit_on)
    for column, values in spec.onehot.items():
        df = one_hot(df, column, values)
    return df


def standard_scale(df: DataFrame, cols: list[str], fit_on: Column | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column is only centred."""
    row = _fit_rows(df, fit_on).agg(
        *[F.avg(c).alias(f"{c}|m") for c in cols], *[F.stddev_pop(c).alias(f"{c}|s") for c in cols]).first()
    return df.withColumns({c: (F.col(c) - row[f"{c}|m"]) / (row[f"{c}|s"] or 1.0) for c in cols})


def robust_scale(df: DataFrame, cols: list[str], fit_on: Column | None = None) -> DataFrame:
    """(x - median) / (third - first quartile)."""
    rows = quantiles_wide(_fit_rows(df, fit_on), cols, {"q1": 0.25, "q2": 0.5, "q3": 0.75}).collect()
    by = {r["variable"]: r for r in rows}
    return df.withColumns({c: (F.col(c) - by[c]["q2"]) / ((by[c]["q3"] - by[c]["q1"]) or 1.0) for c in cols})


def calendar_features(df: DataFrame, date: str, hour: str, bounds: DataFrame, bound_date: str,
                      low: str, high: str, real: str, felt: str, weather: str,
                      levels: list[str], wind: str, gate: float = 0.25,
                      drop: list[str] = ()) -> DataFrame:
    """Date parts, season, daylight by a joined table of bounds, the feeling flag and
    the weather-wind interaction; categories become 0/1 columns, raw columns go."""
    dated = df.withColumns({**date_parts(date)})
    dated = dated.withColumn("season", season("month"))
    lit = flag_interval(dated, bounds, date, bound_date, hour, low, high, "daylight")
    rich = lit.withColumns({
        "feeling": diff_flag(real, felt),
        "wind_influence": interaction(weather, levels, wind, gate)})
    rich = one_hot(rich, weather, levels)
    rich = one_hot(rich, "season", ["winter", "spring", "summer", "autumn"])
    rich = one_hot(rich, "feeling", ["feels_warmer", "feels_colder"])
    return rich.drop(*drop, date, felt, low, high, bound_date)


def select_by_corr(df: DataFrame, features: list[str], target: str, least: float = 0.1,
                   most: float = 0.5) -> list[str]:
    """Features whose correlation with the target reaches `least`; of two that
    correlate above `most` with each other the one closer to the target stays.
    Strongest first, ties by name."""
    rows = corr_matrix(df, [*features, target], "upper").collect()
    r = {frozenset((row["a"], row["b"])): abs(row["r"]) for row in rows if row["r"] is not None}
    toward = lambda f: r.get(frozenset((f, target)), 0.0)
    kept: list[str] = []
    for f in sorted(features, key=lambda f: (-toward(f), f)):
        if toward(f) >= least and all(r.get(frozenset((f, k)), 0.0) <= most for k in kept):
            kept.append(f)
    return kept
