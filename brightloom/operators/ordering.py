"""Ranks, running totals and quantiles that never put one group into one task.

A plain ``Window.partitionBy(key)`` sends a whole key to one task, and a window
without a partition sends the whole table there. Everything here works on
*slices* instead: ranges of the order (group, key) between splitters that a
sample of the rows gives. A row finds its slice by comparing itself with the
splitters, so every plan that reads the rows agrees on it and nothing is written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import durable
from .relations import attach

SAMPLED = 64  # sampled rows per slice; slices come out even within about a third
IN_ONE_SORT = 20_000  # rows of a slice that a single sort may take

Order = list[Column | str]


def _directed(order: Order) -> list[tuple[Column, bool]]:
    """(column, ascending); names that start with ``-`` are descending."""
    return [(F.col(c.removeprefix("-")), not c.startswith("-")) if isinstance(c, str) else (c, True) for c in order]


def _sorted_by(order: Order) -> list[Column]:
    return [c.asc_nulls_first() if up else c.desc_nulls_last() for c, up in _directed(order)]


def _before(left: list[Column], right: list[Column], ascending: list[bool]) -> Column:
    """Whether `left` comes before `right`: nulls first if ascending, last if not."""
    result = F.lit(False)
    for a, b, up in reversed(list(zip(left, right, ascending, strict=True))):
        less = (a.isNull() & b.isNotNull()) | (a < b) if up else (b.isNull() & a.isNotNull()) | (a > b)
        result = F.coalesce(less, F.lit(False)) | (a.eqNullSafe(b) & result)
    return result


class Slices:
    """Ranges of `df` in `order`, about equally large. Splitters are rows sampled by the
    hash of their key: SAMPLED per slice are sorted, one of so many is kept and becomes a
    literal. Rows with equal keys share a slice."""

    def __init__(self, df: DataFrame, order: Order, slices: int | None = None, rows: int | None = None):
        self.keys = [c for c, _ in _directed(order)]
        self.ascending = [up for _, up in _directed(order)]
        self.count = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = df.count() if rows is None else rows
        one_of = max(1, rows // (SAMPLED * self.count))
        named = df.select(*[c.alias(f"_k{i}") for i, c in enumerate(self.keys)])
        names = named.columns
        self.types = dict(named.dtypes)
        sample = named.where(F.pmod(F.xxhash64(F.lit(17), *names), F.lit(one_of)) == 0)
        by = [F.col(n).asc_nulls_first() if up else F.col(n).desc_nulls_last() for n, up in zip(names, self.ascending)]
        n = sample.count()
        step = max(1, -(-n // self.count))
        picked = sample.withColumn("_at", F.row_number().over(Window.orderBy(*by))).where(F.col("_at") % step == 0)
        self.splitters = [tuple(r[c] for c in names) for r in picked.orderBy("_at").collect()]

    def of_row(self) -> Column:
        """The slice of a row: how many splitters don't come after it, by bisection."""
        if not self.splitters:
            return F.lit(0)
        rows = F.array(*[F.struct(*[F.lit(v).cast(self.types[f"_k{i}"]).alias(f"_k{i}") for i, v in enumerate(s)])
                         for s in self.splitters])
        size = len(self.splitters)
        steps = [1 << b for b in reversed(range(size.bit_length()))]

        def advance(done: Column, step: Column) -> Column:
            at = F.get(rows, done + step - 1)
            after = _before(self.keys, [at[f"_k{i}"] for i in range(len(self.keys))], self.ascending)
            return F.when((done + step <= size) & ~after, done + step).otherwise(done)

        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def prefix_sum(df: DataFrame, order: Order, out: str, weight: str | None = None,
               by: list[str] = (), slices: int | None = None) -> DataFrame:
    """Add ``out``: the running total of ``weight`` (1 per row if None) in
    ``order``, restarting in every ``by`` group. ``order`` has to be unique
    within a group for the result to be reproducible.

    A slice needs from outside only what its first group has in earlier slices, one
    number per slice. The rows are shuffled once, by group and slice."""
    by = list(by)
    cut = Slices(df, [*by, *order], slices)
    sliced = df.withColumn("_slice", cut.of_row())
    amount = F.col(weight) if weight else F.lit(1)
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = (sliced.groupBy(*by, "_slice").agg(F.sum(amount).alias("_in_slice"))
             .withColumn("_base", F.sum("_in_slice").over(earlier))
             .where(F.col("_base").isNotNull()).drop("_in_slice"))
    within = (Window.partitionBy(*by, "_slice").orderBy(*_sorted_by(order))
              .rowsBetween(Window.unboundedPreceding, 0))
    local = sliced.withColumn("_local", F.sum(amount).over(within))
    on = [F.col(k).eqNullSafe(F.col(f"_b{k}")) for k in [*by, "_slice"]]
    bases = F.broadcast(bases.withColumnsRenamed({k: f"_b{k}" for k in [*by, "_slice"]}))  # a row per splitter at most
    return (local.join(bases, reduce(lambda a, b: a & b, on), "left")
            .withColumn(out, F.coalesce("_base", F.lit(0)) + F.col("_local"))
            .select(*df.columns, out))


def number_rows(df: DataFrame, order: Order, out: str = "row_no",
                by: list[str] = (), slices: int | None = None) -> DataFrame:
    """1-based row number in ``order``, per ``by`` group or over the whole table."""
    return prefix_sum(df, order, out, None, by, slices)


def nth_key(df: DataFrame, order: Order, n: int) -> list | None:
    """The key of the n-th row in ``order``, None if there are fewer. The rows of each slice
    are counted, then only those of the slice that holds the n-th are read again, until
    they are few enough to sort."""
    keys = df.select(*[c.alias(f"_k{i}") for i, (c, _) in enumerate(_directed(order))])
    names = [f"_k{i}" for i in range(len(keys.columns))]
    named = [n if up else f"-{n}" for n, (_, up) in zip(names, _directed(order))]
    rows = keys.count()
    if not 1 <= n <= rows:
        return None
    while rows > IN_ONE_SORT:
        cut = Slices(keys, named, rows=rows).of_row()
        sizes = keys.groupBy(cut.alias("s")).count().orderBy("s").collect()
        for size in sizes:
            if n <= size["count"]:
                break
            n -= size["count"]
        if size["count"] == rows:  # only equal keys can't be told apart
            break
        keys, rows = keys.where(cut == size["s"]), size["count"]
    row = keys.orderBy(*_sorted_by(named)).offset(n - 1).limit(1).first()
    return list(row)


def _up_to(df: DataFrame, order: Order, n: int) -> Column:
    """Whether a row is among the first n in ``order``."""
    if n <= 0:
        return F.lit(False)
    key = nth_key(df, order, n)
    if key is None:
        return F.lit(True)
    columns = [c for c, _ in _directed(order)]
    kinds = [t for _, t in df.select(*[c.alias(f"_k{i}") for i, c in enumerate(columns)]).dtypes]
    bound = [F.lit(v).cast(t) for v, t in zip(key, kinds)]
    return ~_before(bound, columns, [up for _, up in _directed(order)])


BINS = 4096  # of one round of a selection


def _counted(v: Column) -> Column:
    return F.when(~F.isnan(v), v)


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    by: list[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles, one row per (group, variable, prob); nulls and NaN
    are left out.

    Selection by radix: a quantile is the value at one or two places of the order. Each
    round counts the values of all columns and groups by bins of the ranges that still
    hold such a place, takes the bin in which it lies, and goes on between the least and
    the greatest value there, until they are the same. A bin is a power of two and one of
    4,096 equal parts of its range: after the powers at most 52 bits remain, so there are
    at most seven rounds whatever the values. Every round is one pass over the columns that
    shuffles counts of bins only; what it writes has a row per place."""
    by, probs = list(by), [float(p) for p in probs]
    keys = [*by, "variable"]
    values = [_counted(F.col(c).cast("double")) for c in cols]
    data = df.select(*[F.col(k) for k in by], F.array(*values).alias("_values"))
    facts = data.groupBy(*by).agg(*[f(F.get("_values", F.lit(i))).alias(f"_{n}{i}") for i in range(len(cols))
                                    for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))])
    asked = []
    for i in range(len(cols)):
        for p in probs:
            spot = F.lit(p) * (F.col(f"_n{i}") - 1)
            asked += [F.struct(F.lit(i).alias("at"), F.lit(p).alias("prob"), (spot - F.floor(spot)).alias("part"),
                               side(spot).cast("long").alias("spot"), side(spot).cast("long").alias("place"),
                               F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi")) for side in (F.floor, F.ceil)]
    # A place counts from 0 within the range lo to hi, its spot within the whole column.
    places = durable(facts.select(*by, F.explode(F.array_distinct(F.array(*asked))).alias("_p")).select(*by, "_p.*")
                     .where("lo is not null"))
    while not places.where("lo < hi").isEmpty():
        places = durable(_narrowed(data, places, by))
    ends = places.groupBy(*by, "at", "prob").agg(
        F.min_by("lo", "spot").alias("_low"), F.max_by("lo", "spot").alias("_high"), F.max("part").alias("_part"))
    step = F.when(F.col("_part") > 0, (F.col("_high") - F.col("_low")) * F.col("_part")).otherwise(0.0)
    return ends.select(*by, F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("at") + 1).alias("variable"), "prob",
                       (F.col("_low") + step).alias("value")).select(*keys, "prob", "value")


def _narrowed(data: DataFrame, places: DataFrame, by: list[str]) -> DataFrame:
    """One round: each place with the range of the bin that holds it."""
    open_ = places.where("lo < hi")
    ranges = open_.groupBy(*by).agg(F.array_distinct(F.collect_list(F.struct("at", "lo", "hi"))).alias("_r")).select(
        *by, *[F.col(f"_r.{c}").alias(f"_{c}") for c in ("at", "lo", "hi")])
    marked = attach(data, ranges, by)
    value = lambda r: F.get("_values", r["_at"])
    held = F.filter(F.arrays_zip("_at", "_lo", "_hi"), lambda r: (value(r) >= r["_lo"]) & (value(r) <= r["_hi"]))
    rows = marked.select(*by, F.explode(F.transform(held, lambda r: F.struct(
        r["_at"].alias("at"), r["_lo"].alias("lo"), r["_hi"].alias("hi"), value(r).alias("v")))).alias("_e")).select(*by, "_e.*")
    infinite = float("inf")
    scale = F.when(F.greatest(F.abs("lo"), F.abs("hi")) > 1, 0.5).otherwise(1.0)  # no range of finite ends is infinite
    v, lo, hi = F.col("v") * scale, F.col("lo") * scale, F.col("hi") * scale
    power = (F.when(F.abs("v") == infinite, 3000.0).when(F.col("v") == 0, 0.0).otherwise(F.floor(F.log2(F.abs("v"))) + 1100.0)
             * F.signum("v")).cast("int")
    part = F.when((F.abs("lo") < infinite) & (F.abs("hi") < infinite),
                  F.least(F.floor((v - lo) / (hi - lo) * BINS), F.lit(BINS - 1))).otherwise(0).cast("int")
    bins = rows.groupBy(*by, "at", "lo", power.alias("_power"), part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("v").alias("_min"), F.max("v").alias("_max"))
    upto = Window.partitionBy(*by, "at", "lo").orderBy("_power", "_part").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("_upto", F.sum("_n").over(upto)).withColumnsRenamed({k: f"_b{k}" for k in [*by, "at", "lo"]})
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_b{k}")) for k in [*by, "at", "lo"]])
    inside = (F.col("place") >= F.col("_upto") - F.col("_n")) & (F.col("place") < F.col("_upto"))
    found = open_.join(bins, match & inside).select(
        *by, "at", "prob", "part", "spot", (F.col("place") - F.col("_upto") + F.col("_n")).alias("place"),
        F.col("_min").alias("lo"), F.col("_max").alias("hi"))
    return places.where("lo = hi").unionByName(found)


def quantiles_wide(df: DataFrame, cols: list[str], probs: dict[str, float],
                   by: list[str] = ()) -> DataFrame:
    """`exact_quantiles` with one named column per probability."""
    by = list(by)
    long = exact_quantiles(df, cols, list(probs.values()), by)
    picks = [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
             for name, p in probs.items()]
    return long.groupBy(*by, "variable").agg(*picks)


def holdout_tail(df: DataFrame, order: Order, n_test: int) -> DataFrame:
    """Chronological hold-out: ``is_test`` is 1 on the last ``n_test`` rows. Rows are
    compared with the key of the last but ``n_test``-th, so nothing is sorted or moved."""
    backwards = [c[1:] if c.startswith("-") else f"-{c}" for c in order]
    return df.withColumn("is_test", _up_to(df, backwards, n_test).cast("int"))


def split_ordered(df: DataFrame, order: Order, fraction: float) -> DataFrame:
    """First ``round(fraction * n)`` rows in ``order`` are train (``is_train`` = 1);
    halves round to even."""
    return df.withColumn("is_train", _up_to(df, order, int(round(fraction * df.count()))).cast("int"))


def thin_by_root(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Keep index ``i`` of a group when ``round(2 * sqrt(i))`` exceeds the one
    of the last kept index, and always the last row: many early rows, few late."""
    numbered = number_rows(df, order, "_row", by)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    idx = F.col("_row") - 1
    step = lambda i: F.bround(2 * F.sqrt(i.cast("double")))
    return (attach(numbered, sizes, by)
            .where((idx == 0) | (step(idx) > step(F.greatest(idx - 1, F.lit(0))))
                   | (F.col("_row") == F.col("_size")))
            .withColumn("frame_index", idx)
            .drop("_size", "_row"))


def shuffle_batches(df: DataFrame, key: list[str], batch_size: int, seed: int = 0) -> DataFrame:
    """Reproducible shuffle: order by a seeded hash of the row key, then number
    the batches."""
    mixed = df.withColumn("_mix", F.xxhash64(F.lit(seed), *[F.col(k) for k in key]))
    numbered = number_rows(mixed, ["_mix", *key], "_row")
    return (numbered.withColumn("batch_id", F.floor((F.col("_row") - 1) / batch_size).cast("long"))
            .drop("_mix", "_row"))
