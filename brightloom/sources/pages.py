"""Fields out of stored web pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.strings import remove_literal, strip_chars


@dataclass(frozen=True)
class Field:
    """One field of a block: the `nth` match of `pattern`, group 1.

    `remove` deletes a marker, `strip` trims characters from both ends,
    `default` replaces a missing field (null otherwise)."""

    name: str
    pattern: str
    nth: int = 0
    remove: str | None = None
    strip: str | None = None
    default: str | None = None


def extract_blocks(pages: DataFrame, pattern: str, html: str = "html",
                   out: str = "block") -> DataFrame:
    """One row per match of `pattern` (group 1), numbered from 0 within the page.
    A page is one row, so the numbering needs no shuffle."""
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, F.posexplode(
        F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias("block_no", out))


def _field(source: Column, spec: Field) -> Column:
    value = F.get(F.regexp_extract_all(source, F.lit(spec.pattern), F.lit(1)), F.lit(spec.nth))
    if spec.remove:
        value = remove_literal(value, spec.remove)
    if spec.strip:
        value = strip_chars(value, spec.strip)
    if spec.default is not None:
        value = F.coalesce(value, F.lit(spec.default))
    return value


def extract_fields(df: DataFrame, source: str, fields: list[Field]) -> DataFrame:
    """Add every field in one projection."""
    return df.withColumns({f.name: _field(F.col(source), f) for f in fields})
