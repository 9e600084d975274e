"""Column selection, filters, ordering and top-k."""

from __future__ import annotations

import functools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .ordering import number_rows


def select_numeric(df: DataFrame) -> DataFrame:
    """Keep the numeric columns."""
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])


def with_const(df: DataFrame, **values) -> DataFrame:
    """Add literal columns."""
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def null_count_filter(df: DataFrame, k: int, op: str = ">") -> DataFrame:
    """Rows whose number of null columns compares to `k` as asked (``>`` or ``<``)."""
    nulls = sum((F.col(f"`{c}`").isNull().cast("int") for c in df.columns), F.lit(0))
    if op not in (">", "<"):
        raise ValueError("op must be '>' or '<'")
    return df.where(nulls > k if op == ">" else nulls < k)


def facet_filter(df: DataFrame, choices: dict) -> DataFrame:
    """Conjunction of equalities."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in choices.items()],
                           F.lit(True)))


def range_filter(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Closed range; an open end is None."""
    if low is not None:
        df = df.where(F.col(column) >= F.lit(low))
    if high is not None:
        df = df.where(F.col(column) <= F.lit(high))
    return df


def isin_filter(df: DataFrame, column: str, values: list | DataFrame, everything="ALL") -> DataFrame:
    """Membership; the `everything` marker switches the filter off. A list is a filter of
    the scan, a DataFrame (values in its first column) a semi-join."""
    if isinstance(values, DataFrame):
        allowed = values.select(F.col(values.columns[0]).alias("_allowed"))
        return df.join(allowed, F.col(column) == F.col("_allowed"), "left_semi")
    if everything in values:
        return df
    return df.where(F.col(column).isin(list(values)))


def facet_values(df: DataFrame, child: str, parents: dict) -> DataFrame:
    """Distinct values of `child` under the chosen parent values."""
    return facet_filter(df, parents).select(child).distinct()


def top_k(df: DataFrame, by: list[Column | str], k: int) -> DataFrame:
    """First k rows in the given order. End `by` with a unique key, so ties are
    broken the same way every time. Plans to TakeOrderedAndProject."""
    return df.orderBy(*by).limit(k)


def top_k_per_group(df: DataFrame, group: list[str], by: list[Column], k: int,
                    rank: str = "rank") -> DataFrame:
    """First k rows of every group. Spark cuts to k per group before the shuffle
    (WindowGroupLimit), so a hot group sends at most k rows per task."""
    w = Window.partitionBy(*group).orderBy(*by)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def number_then_filter(df: DataFrame, order: list[str], keep: Column, by: list[str] = (),
                       out: str = "row_no") -> DataFrame:
    """Number all rows first, then drop the flagged ones: numbers of dropped rows
    stay unused."""
    return number_rows(df, order, out, by).where(keep)


def date_limit_flag(df: DataFrame, group: list[str], date: str, low=None, high=None) -> DataFrame:
    """Per group: newest and oldest date, and 1 where the newest is past `high` or
    the oldest before `low`."""
    spans = df.groupBy(*group).agg(F.max(date).alias("newest"), F.min(date).alias("oldest"))
    reached = F.lit(False)
    if high is not None:
        reached = reached | (F.col("newest") > F.lit(high))
    if low is not None:
        reached = reached | (F.col("oldest") < F.lit(low))
    return spans.withColumn("limit_reached", reached.cast("int"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Append by column name; missing columns become null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
