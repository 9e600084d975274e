"""Expressions over numeric array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scale_by(vec: Column | str, divisor: float = 255.0) -> Column:
    return F.transform(_col(vec), lambda x: x.cast("double") / divisor)


def to_unit_range(vec: Column | str, centre: float = 127.5) -> Column:
    """(x - centre) / centre, so 0..2*centre becomes -1..1."""
    return F.transform(_col(vec), lambda x: (x.cast("double") - centre) / centre)


def from_unit_range(vec: Column | str) -> Column:
    """(x + 1) / 2, so -1..1 becomes 0..1."""
    return F.transform(_col(vec), lambda x: (x.cast("double") + 1) / 2)


def _sum(vec: Column, fn=lambda x: x) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + fn(x.cast("double")))


def display_bytes(vec: Column | str, spread: float = 64.0, centre: float = 128.0) -> Column:
    """Standardise (population deviation), spread, move to the centre, clip to 0..255
    and cut to integers. A constant vector has no deviation and gives null."""
    v = _col(vec)
    mean = _sum(v) / F.size(v)
    std = F.sqrt(_sum(v, lambda x: x * x) / F.size(v) - mean * mean)
    stats = F.when(F.size(v) > 0, F.struct(mean.alias("m"), std.alias("s")))
    # one-element transform binds the statistics once per row
    boxed = F.transform(F.array(stats), lambda s: F.when(s["s"] > 1e-9, F.transform(
        v, lambda x: F.least(F.greatest((x.cast("double") - s["m"]) / s["s"] * spread + centre,
                                        F.lit(0.0)), F.lit(255.0)).cast("int"))))
    return F.get(boxed, F.lit(0))


def product(a: Column | str, b: Column | str) -> Column:
    """Elementwise product."""
    return F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))


def append_channel(vec: Column | str, extra: Column | str) -> Column:
    """Concatenate further values (another vector or a label array)."""
    return F.concat(_col(vec), _col(extra))
