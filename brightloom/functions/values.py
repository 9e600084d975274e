"""Numeric, conditional and calendar expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_map(conditions: list[Column], values: list, default=0) -> Column:
    """First condition that holds gives its value; none gives `default`."""
    expr = None
    for cond, value in zip(conditions, values, strict=True):
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default)


def if_else(condition: Column, yes, no) -> Column:
    """Two-way choice; a null condition counts as false."""
    return F.when(condition, yes).otherwise(no)


def row_mean(cols: list[str], rounded: bool = False) -> Column:
    """Mean of the non-null columns of a row, null if all are null; optionally
    rounded half to even."""
    total = sum((F.coalesce(_col(c).cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    present = sum((_col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    mean = F.when(present > 0, total / present)
    return F.bround(mean, 0) if rounded else mean


def threshold_label(value: Column | str, threshold: float) -> Column:
    """0 below the threshold, else 1. Null compares as not below, so it gives 1;
    drop nulls first as the flow does."""
    return F.when(_col(value) < threshold, 0).otherwise(1)


def bin_score(value: Column | str, edges: list[float] = (0.0, 0.3, 0.6, 0.9)) -> Column:
    """Right-closed bins numbered from 1; null gives 0 like every unmatched value."""
    v = _col(value)
    expr = F.when(v <= edges[0], 1)
    for i, (low, high) in enumerate(zip(edges, edges[1:]), start=2):
        expr = expr.when((v > low) & (v <= high), i)
    return expr.when(v > edges[-1], len(edges) + 1).otherwise(0)


def overall_score(polarities: list[Column | str], subjectivities: list[Column | str]) -> Column:
    """Sum of polarities damped by mean subjectivity."""
    pol = sum((_col(p) for p in polarities[1:]), _col(polarities[0]))
    sub = sum((_col(s) for s in subjectivities[1:]), _col(subjectivities[0]))
    return pol * (1 - sub / len(subjectivities))


def ordinal(value: Column | str, levels: list[str]) -> Column:
    """1-based position in `levels`, 0 for anything else."""
    v = _col(value)
    return case_map([v == level for level in levels], list(range(1, len(levels) + 1)))


def interaction(value: Column | str, levels: list[str], gate: Column | str,
                threshold: float = 0.25) -> Column:
    """Ordinal severity times a 0/1 gate."""
    return ordinal(value, levels) * if_else(_col(gate) >= threshold, 1, 0)


def diff_flag(a: Column | str, b: Column | str, yes="feels_warmer", no="feels_colder") -> Column:
    """`yes` where a - b >= 0, `no` otherwise, nulls included."""
    return if_else(_col(a) - _col(b) >= 0, yes, no)


def within_interval(value: Column | str, low: Column | str, high: Column | str) -> Column:
    """1 inside the closed interval, 0 outside or with a null bound."""
    v = _col(value)
    return if_else((v >= _col(low)) & (v <= _col(high)), 1, 0)


def parse_timestamp(text: Column | str, formats: list[str]) -> Column:
    """First pattern that parses; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(_col(text), F.lit(f)) for f in formats])


def date_parts(date: Column | str) -> dict[str, Column]:
    """Year, quarter, month and weekday with Monday = 0."""
    d = _col(date)
    return {"year": F.year(d), "quarter": F.quarter(d), "month": F.month(d),
            "dayofweek": F.weekday(d)}


def season(month: Column | str) -> Column:
    m = _col(month)
    return case_map([(m == 12) | (m < 3), (m > 2) & (m <= 5), (m > 5) & (m <= 8),
                     (m > 8) & (m <= 11)],
                    ["winter", "spring", "summer", "autumn"], default="0")


def log_grid(start: float, stop: float, n: int) -> Column:
    """``10 ** linspace(start, stop, n)`` as an array."""
    step = (stop - start) / (n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.pow(F.lit(10.0), F.lit(start) + i * F.lit(step)))


def int_grid(start: float, stop: float, n: int) -> Column:
    """``linspace`` cut to integers as an array."""
    step = (stop - start) / (n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: (F.lit(float(start)) + i * F.lit(step)).cast("int"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with `value` computed once, also where lambdas in `use` refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
