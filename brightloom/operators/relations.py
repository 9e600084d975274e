"""Joins and set operations.

No join here is forced to broadcast: Spark broadcasts a side when its size is
under ``spark.sql.autoBroadcastJoinThreshold`` (checked again at run time by
AQE) and shuffles otherwise. Joins on keys known to be hot, such as words, go
through `salted_join`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.values import within_interval
from ..runtime import durable

SALTS = 16


def join_on(left: DataFrame, right: DataFrame, left_key: list[str], right_key: list[str],
            how: str = "inner") -> DataFrame:
    """Equi-join on differently named keys; both key columns stay."""
    pairs = [left[a] == right[b] for a, b in zip(left_key, right_key, strict=True)]
    return left.join(right, reduce(lambda a, b: a & b, pairs), how)


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """Equi-join that spreads every key of `left` over `salts` partitions and
    repeats the smaller `right` that often. `how` is inner, left, left_semi or
    left_anti; a one-sided split cannot keep unmatched rows of `right`."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted join does not support {how}")
    rest = [c for c in left.columns if c not in on] or on
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")


BROADCAST_BYTES = 16 * 1024 * 1024  # of a written table; some five times that in memory


def written_bytes(table: DataFrame) -> int:
    """Size of the files of a table that ``durable`` wrote, empty ones left out."""
    files = table.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]


def sized_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys that may be hot. `right` is computed once and measured: a small one
    is broadcast, so `left` stays where it is; for a larger one hot keys are spread by salt."""
    right = durable(right)
    if written_bytes(right) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, how)


PAIRS_PER_TASK = 4_000_000


def block_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner equi-join whose result may be much larger than its sides. The rows of each key
    are counted on both sides; tasks follow the number of pairs, not the size of a side. A
    small `right` is broadcast to parts of `left`; otherwise a key's rows are cut into
    blocks on both sides and every block meets every other, about PAIRS_PER_TASK at most."""
    right = durable(right)
    counts = durable(left.groupBy(*on).agg(F.count(F.lit(1)).alias("_l"))
                     .join(right.groupBy(*on).agg(F.count(F.lit(1)).alias("_r")), on))
    pairs = counts.agg(F.coalesce(F.sum(F.col("_l").cast("double") * F.col("_r")), F.lit(0.0))).first()[0]
    usual = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, min(int(pairs // PAIRS_PER_TASK), 100_000))
    if written_bytes(right) <= BROADCAST_BYTES:
        return (left.repartition(parts) if pairs > PAIRS_PER_TASK else left).join(F.broadcast(right), on)
    side = int(PAIRS_PER_TASK ** 0.5)
    blocks = [F.ceil(F.col(c) / side).cast("int").alias(c) for c in ("_l", "_r")]
    cells = counts.select(*on, *blocks)

    met = [*on, "_l_at", "_r_at"]

    def cut(df: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64(*df.columns), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return (attach(df, cells, on).withColumns({f"{own}_at": block, f"{other}_at": every}).drop("_l", "_r")
                .repartition(parts, *met))

    return cut(left, "_l", "_r").join(cut(right, "_r", "_l"), met).drop("_l_at", "_r_at")


def attach(facts: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Put one row of statistics per group next to every fact row; null is a group.

    `small` is computed once and measured. Up to BROADCAST_BYTES it is broadcast, so
    the facts are not shuffled; beyond that the facts are spread by salt."""
    small = durable(small)
    if not on:
        row = small.first()
        return facts.withColumns({c: F.lit(row[c]) for c in small.columns})
    renamed = small.withColumnsRenamed({k: f"_on_{k}" for k in on})
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in on])
    if written_bytes(small) <= BROADCAST_BYTES:
        joined = facts.join(F.broadcast(renamed), match)
    else:
        spread = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS)).cast("int"))
        copies = renamed.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = spread.join(copies, match & (F.col("_salt") == F.col("_copy"))).drop("_salt", "_copy")
    return joined.drop(*[f"_on_{k}" for k in on])


def flag_interval(facts: DataFrame, bounds: DataFrame, fact_key: str, bound_key: str,
                  value: str, low: str, high: str, out: str) -> DataFrame:
    """Left join of bounds, then 1 inside ``[low, high]`` and 0 outside or unmatched."""
    joined = join_on(facts, bounds, [fact_key], [bound_key], "left")
    return joined.withColumn(out, within_interval(value, low, high))


def interval_join(points: DataFrame, intervals: DataFrame, value: str, low: str, high: str,
                  on: list[str] = (), width: float = 1.0) -> DataFrame:
    """Pairs of a point and each closed interval that holds it, both sides' columns side
    by side (keys in `on` once). Any number of intervals may share a key and overlap.

    An interval goes to the level at which a cell, `width` doubled as often as needed, is
    at least as long as it is, so it lies in one or two cells however long it is. A point
    goes to its cell of every level that intervals use, which are few. Then keys, level
    and cell are joined by equality and the ends are tested exactly. Tasks follow the number
    of pairs that share a cell, so no busy cell and no small table is one task. Nulls and NaN match
    nothing; an interval that ends before it begins is empty. `width` affects only speed:
    about the length of the shorter intervals is best."""
    on = list(on)
    v, lo, hi = (F.col(c).cast("double") for c in (value, low, high))
    log = F.log2((hi - lo) / width)
    level = F.when(hi - lo <= width, 0).otherwise(F.ceil(log)).cast("int")
    size = F.lit(float(width)) * F.pow(F.lit(2.0), F.col("_level"))
    usable = (lo <= hi) & ~F.isnan(hi)
    sides = (intervals.where(F.coalesce(usable, F.lit(False))).withColumn("_level", level)
             .withColumn("_cells", F.array_distinct(F.array(F.floor(lo / size), F.floor(hi / size))))
             .withColumn("_cell", F.explode("_cells")).drop("_cells"))
    sides = durable(sides)
    levels = sorted(r[0] for r in sides.select("_level").distinct().collect())  # at most one per power of two
    known = points.where(v.isNotNull() & ~F.isnan(v))
    placed = known.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>"))).withColumn(
        "_cell", F.floor(v / size))
    joined = block_join(placed, sides, [*on, "_level", "_cell"])
    return joined.where((v >= lo) & (v <= hi)).drop("_level", "_cell")


def remove_listed(tokens: DataFrame, stop: list[str] | DataFrame, column: str = "word") -> DataFrame:
    """Tokens that a word list lacks; nulls stay. A list is a filter where the tokens
    are, a table an anti-join with hot words spread."""
    if isinstance(stop, DataFrame):
        return sized_join(tokens, stop.select(F.col(stop.columns[0]).alias(column)), [column], "left_anti")
    return tokens.where(~F.coalesce(F.col(column).isin(list(stop)), F.lit(False)))


def match_terms(postings: DataFrame, terms: list[str] | DataFrame, column: str = "term") -> DataFrame:
    """Postings of the wanted terms. A short list becomes a pushed-down filter."""
    if isinstance(terms, DataFrame):
        wanted = terms.select(F.col(terms.columns[0]).alias(column)).distinct()
        return sized_join(postings, wanted, [column], "left_semi")
    return postings.where(F.col(column).isin(list(terms)))


def docs_with_all(postings: DataFrame, terms: list[str], doc: str = "doc_id",
                  column: str = "term") -> DataFrame:
    """Documents that hold every term."""
    wanted = list(dict.fromkeys(terms))
    found = match_terms(postings, wanted, column).select(doc, column).distinct()
    return (found.groupBy(doc).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") == len(wanted)).select(doc))


def phrase_match(positions: DataFrame, terms: list[str], doc: str = "doc_id",
                 column: str = "term", pos: str = "pos") -> DataFrame:
    """Documents where the terms stand next to each other in order.

    Position minus offset is the start of the phrase, so a document matches when
    one start is reached by every offset. A term may occur twice in the phrase,
    hence the offsets of a term are an array."""
    if not terms:
        return positions.select(doc).where(F.lit(False))
    offsets: dict[str, list[int]] = {}
    for i, term in enumerate(terms):
        offsets.setdefault(term, []).append(i)
    lookup = F.create_map(*[x for term, at in offsets.items()
                            for x in (F.lit(term), F.array(*[F.lit(i) for i in at]))])
    starts = (positions.where(F.col(column).isin(list(offsets)))
              .select(doc, pos, F.explode(lookup[F.col(column)]).alias("_offset"))
              .select(doc, (F.col(pos) - F.col("_offset")).alias("_start"), "_offset")
              .distinct())
    return (starts.groupBy(doc, "_start").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") == len(terms)).select(doc).distinct())


def align(frames: dict[str, DataFrame], keys: list[str], value: str) -> DataFrame:
    """Put the same value of several tables side by side, matched on explicit keys."""
    sides = [df.select(*keys, F.col(value).alias(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.join(b, keys, "full"), sides)


def splice(actual: DataFrame, predicted: DataFrame, t: str, value: str, prediction: str,
           last_known: int, keys: list[str] = ()) -> DataFrame:
    """History up to `last_known`, predictions after it."""
    history = actual.where(F.col(t) <= last_known).select(*keys, t, F.col(value))
    ahead = predicted.where(F.col(t) > last_known).select(*keys, t, F.col(prediction).alias(value))
    return history.unionByName(ahead)
