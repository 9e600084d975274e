"""Counting tokens over a stream. Every function takes a batch table just as well."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.strings import has_hash, split_single_space


def tokens_stream(df: DataFrame, text: str = "value", keep: list[str] = (), hash_only: bool = False,
                  drop_empty: bool = False) -> DataFrame:
    """One row per token of a line (single-space split), optionally only those with ``#``."""
    words = df.select(*keep, F.explode(split_single_space(text)).alias("word"))
    if hash_only:
        words = words.where(has_hash("word"))
    return words.where("word <> ''") if drop_empty else words


def running_counts(tokens: DataFrame, key: str = "word", out: str = "total") -> DataFrame:
    """Total per key over everything seen. Complete mode emits every key each batch;
    update mode only the changed ones, which suits large key spaces. Each task
    counts its own part of the batch first, so a hot key is no hot task."""
    return tokens.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def with_late(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as timestamp, with rows later than `delay` to be dropped."""
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def windowed_counts(tokens: DataFrame, ts: str, size: str, slide: str | None = None,
                    key: str = "word", out: str = "n") -> DataFrame:
    """Counts per event-time window, tumbling without `slide`."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (tokens.groupBy(w.alias("window"), key).agg(F.count(F.lit(1)).alias(out)))


_UNITS = {"millisecond": 1, "second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}


def _milliseconds(duration: str) -> int:
    """Length of a duration such as ``10 minutes`` or ``1 hour 30 minutes``."""
    parts = duration.lower().removeprefix("interval ").split()
    return sum(int(n) * _UNITS[unit.rstrip("s")] for n, unit in zip(parts[::2], parts[1::2], strict=True))


def pane_counts(tokens: DataFrame, ts: str, size: str, slide: str, key: str = "word",
                out: str = "n") -> DataFrame:
    """Sliding counts by way of panes: count once per pane, then add panes to their
    windows. A pane is as long as the greatest common divisor of size and slide, so every
    window is made of whole panes. The direct form copies every row into size / slide
    windows before it aggregates; here only the counts per (pane, key) are copied. As a
    stream this chains two aggregations, so it needs a watermark and append mode."""
    pane = math.gcd(_milliseconds(size), _milliseconds(slide))
    panes = windowed_counts(tokens, ts, f"{pane} milliseconds", None, key, "_pane")
    whole = F.window(F.window_time("window"), size, slide)
    return (panes.groupBy(whole.alias("window"), key).agg(F.sum("_pane").alias(out)))


def window_bounds(df: DataFrame) -> DataFrame:
    """Window struct to two columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def top_of(df: DataFrame, value: Column | str, key: str, k: int = 10) -> DataFrame:
    """Top k of a batch, ties by key."""
    value = F.col(value) if isinstance(value, str) else value
    return df.orderBy(value.desc(), F.asc(key)).limit(k)
