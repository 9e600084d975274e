"""Decode and filter event lines; the same code on batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def decode_events(df: DataFrame, schema: T.StructType, column: str = "value",
                  required: str | None = None) -> DataFrame:
    """Parse a JSON column into top-level columns. Lines that do not parse, or
    lack the `required` field, are dropped."""
    keep = [c for c in df.columns if c != column]
    parsed = df.withColumn("_event", F.from_json(column, schema, {"mode": "PERMISSIVE"}))
    required = required or schema.fieldNames()[0]
    return (parsed.where(F.col("_event").isNotNull() & F.col(f"_event.{required}").isNotNull())
            .select(*keep, *[F.col(f"_event.{n}").alias(n) for n in schema.fieldNames()]))


def filter_events(df: DataFrame, lang: str | None = None, track: str | None = None,
                  bbox: tuple[float, float, float, float] | None = None,
                  lang_col: str = "lang", text_col: str = "text",
                  x_col: str = "lon", y_col: str = "lat") -> DataFrame:
    """Language equality, and a keyword or a (west, south, east, north) box; an
    event passes when either of the two given ones holds."""
    if lang is not None:
        df = df.where(F.col(lang_col) == lang)
    any_of = []
    if track is not None:
        any_of.append(F.lower(F.col(text_col)).contains(track.lower()))
    if bbox is not None:
        west, south, east, north = bbox
        any_of.append(F.col(x_col).between(west, east) & F.col(y_col).between(south, north))
    if any_of:
        either = any_of[0]
        for condition in any_of[1:]:
            either = either | condition
        df = df.where(either)
    return df
