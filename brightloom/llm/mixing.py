"""Mixing sources by temperature: an exponent on their token shares, then block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from brightloom.runtime import durable

#: Exponents are multiples of 1 / STEPS.
STEPS = 10_000
#: Exponents tried in one pass over the sources.
AT_ONCE = 16
#: Rows of a source to a block, about.
BLOCK_ROWS = 4_096


def _hash(*parts: Column | str) -> Column:
    """First 13 hexadecimal digits of an MD5, so that any engine can repeat the order."""
    return F.substring(F.md5(F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])), 1, 13)


def count_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _figures(seen: DataFrame, whole: int, most: int, sources: int, steps: list[int]) -> dict[int, tuple[float, float]]:
    """Entropy over that of equal weights, and the passes through the least source, by exponent."""
    tried = seen.select((F.col("source_tokens") / whole).alias("share"), F.explode(F.array(*map(F.lit, steps))).alias("k"))
    p = F.pow("share", F.col("k") / STEPS)
    found = tried.groupBy("k").agg(F.sum(p).alias("z"), F.sum(p * F.log(p)).alias("e"), F.min("share").alias("least")).collect()
    return {r["k"]: ((math.log(r["z"]) - r["e"] / r["z"]) / math.log(sources) if sources > 1 else 1.0,
                     (most / whole / r["least"]) ** (1 - r["k"] / STEPS)) for r in found}


def _bisect(figures, holds) -> tuple[int, int]:
    """Neighbouring steps (low, high) between which `holds` becomes true; it stays so.

    Each pass over the sources tries AT_ONCE exponents, four halvings in one."""
    low, high = -1, STEPS + 1
    while high - low > 1:
        tried = sorted({low + max(1, (high - low) * i // (AT_ONCE + 1)) for i in range(1, AT_ONCE + 1)})
        tried = [k for k in tried if low < k < high]
        found = figures(tried)
        good = [k for k in tried if holds(*found[k])]
        high = min(good, default=high)
        low = max((k for k in tried if k < high), default=low)
    return low, high


def source_weights(docs: DataFrame, source: str = "source", tokens: str = "tokens", target_entropy: float | None = None,
                   max_passes: float | None = None, budget: int | None = None) -> DataFrame:
    """Per source: source, source_tokens, rows, exponent, weight and passes.

    Weights are the sources' token shares to a common exponent, from 0 (equal weights) to 1
    (shares as they are), normalised. `target_entropy` takes the greatest exponent whose
    entropy, over that of equal weights, reaches it; `max_passes` the least at which no
    source is gone through more often while the largest is gone through once. If both are
    given and conflict, the limit wins. `passes` turn the weights into `budget` tokens, by
    default as many as give every source at least one pass.

    Null is a source of its own. Sources without tokens get no weight and one pass, or none
    under a budget. No rows give no rows."""
    totals = durable(docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.coalesce(F.col(tokens), F.lit(0))).cast("long").alias("source_tokens"), F.count("*").alias("rows")))
    seen = totals.where("source_tokens > 0")
    all_of, most, sources = seen.agg(F.sum("source_tokens"), F.max("source_tokens"), F.count("*")).first()
    exponent = STEPS
    if sources:
        figures = lambda steps: _figures(seen, all_of, most, sources, steps)
        if target_entropy is not None:
            exponent = max(0, _bisect(figures, lambda entropy, _: entropy < target_entropy)[0])
        if max_passes is not None:
            least = min(_bisect(figures, lambda _, passes: passes <= max_passes)[1], STEPS)
            exponent = least if target_entropy is None else max(exponent, least)
    a = F.lit(exponent / STEPS)
    size = F.col("source_tokens")
    norm = seen.agg(F.sum(F.pow(size / F.lit(all_of), a))).first()[0]
    weight = F.pow(size / F.lit(all_of), a) / F.lit(norm)
    passes = F.pow(F.lit(most) / size, 1 - a) if budget is None else weight * F.lit(budget) / size
    return totals.select("source", "source_tokens", "rows", a.alias("exponent"),
                         F.when(size > 0, weight).otherwise(0.0).alias("weight"),
                         F.when(size > 0, passes).otherwise(1.0 if budget is None else 0.0).alias("passes"))


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", tokens: Column | None = None,
        seed: str = "mix", **target) -> DataFrame:
    """The rows of `docs`, once for each pass they take part in, with pass_no, block,
    progress and mix_tokens added (columns of these names are replaced).

    ``source_weights`` gives each source its passes (arguments as there). A source is
    dealt to blocks of about BLOCK_ROWS rows by a hash of the id. Each pass visits the blocks in
    an order of its own. Whole passes take all blocks; the last takes blocks as long as
    the source's budget lasts, and of the block where it ends the rows, in hashed order,
    that still fit. `progress` says how far into its source's share a block begins:
    sorted by it, every beginning of the result is mixed by the weights.

    `tokens` defaults to the words of column text. Null sources are a source, null ids
    one id; repeated rows are rows of their own. No rows give no rows. No step gathers a source in
    one task: windows run over the blocks of a source, and the rows of one block."""
    tokens = count_words(F.col("text")) if tokens is None else tokens
    own = [c for c in docs.columns if c not in ("pass_no", "block", "progress", "mix_tokens")]
    rows = docs.select(F.struct(*own).alias("_row"), F.col(id_col).cast("string").alias("_id"),
                       F.col(source).alias("_source"), tokens.cast("long").alias("_tokens"))
    weights = durable(source_weights(rows, "_source", "_tokens", **target))
    dealt = _deal(rows, weights, seed)
    light = durable(dealt.select("_source", "_block", "_tokens"))
    visits = durable(_visits(light, weights, seed))
    joined = dealt.join(visits, (F.col("_source").eqNullSafe(F.col("source"))) & (F.col("_block") == F.col("block")))
    out = [F.col("_row.*"), "pass_no", "block", "progress", F.col("_tokens").alias("mix_tokens")]
    whole = joined.where("room >= block_tokens").select(*out)
    order = Window.partitionBy("source", "block", "pass_no").orderBy(
        _hash(F.lit(seed), F.col("pass_no").cast("string"), F.coalesce("_id", F.lit(""))), "_tokens")
    partly = (joined.where("room < block_tokens")
              .withColumn("_sum", F.sum("_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .where("_sum <= room").select(*out))
    return whole.unionByName(partly)


def _deal(rows: DataFrame, weights: DataFrame, seed: str) -> DataFrame:
    """The rows with their source's block number."""
    blocks = weights.select(F.col("source").alias("_name"), F.expr(f"int(ceil(rows / {BLOCK_ROWS}))").alias("_blocks"))
    number = F.conv(_hash(F.lit(seed), F.lit("block"), F.coalesce("_id", F.lit(""))), 16, 10).cast("long")
    return rows.join(blocks, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name").withColumn(
        "_block", F.pmod(number, F.col("_blocks")).cast("int"))


def _visits(light: DataFrame, weights: DataFrame, seed: str) -> DataFrame:
    """(source, block, pass_no, block_tokens, room, progress) of all visits that may take rows."""
    blocks = light.groupBy(F.col("_source").alias("source"), F.col("_block").alias("block")).agg(
        F.sum("_tokens").alias("block_tokens"))
    named = weights.select(F.col("source").alias("name"), "source_tokens", "passes")
    visits = blocks.join(named, F.col("source").eqNullSafe(F.col("name"))).withColumn(
        "pass_no", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.round("passes", 9)) - 1, F.lit(0)).cast("int"))))
    order = Window.partitionBy("source", "pass_no").orderBy(
        _hash(F.lit(seed), F.coalesce("source", F.lit("")), F.col("pass_no").cast("string"), F.col("block").cast("string")), "block")
    before = F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("block_tokens")
    share = F.least(F.lit(1.0), F.round("passes", 9) - F.col("pass_no"))
    room = F.floor(share * F.col("source_tokens")) - F.col("before")
    progress = F.when(F.col("source_tokens") > 0, (F.col("pass_no") + F.col("before") / F.col("source_tokens")) / F.col("passes")).otherwise(0.0)
    return visits.withColumn("before", before).select(
        "source", "block", "pass_no", "block_tokens", room.alias("room"), progress.alias("progress")).where(
        "room > 0 or (room = 0 and block_tokens = 0)")
