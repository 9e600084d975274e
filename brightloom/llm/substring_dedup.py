"""Repeated passages: winnowed seeds, extended both ways to maximal repeats."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brightloom.runtime import durable

from .common import arrow_pass, as_long, forget, only, texts_of, window_hashes, word_hashes

LENGTH = 35
SEED_WORDS = 8
_LOW = np.uint64(0xFFFFFFFF)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` entries."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:len(x) - size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def seeds(h: np.ndarray, length: int = LENGTH, words: int = SEED_WORDS) -> tuple[np.ndarray, ...]:
    """Winnowed seeds of one text's word hashes: seed, span, first window, last window less first.

    The seed of a window of `length` words is its run of `words` words with the least
    hash, the last one on ties, so equal windows choose the same seed at the same
    place. Neighbouring windows mostly share their seed; they are one row. `span`
    identifies the seed's whole surroundings: all windows that chose it."""
    n = len(h) - length + 1
    if n <= 0:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int32, np.int32))
    g = window_hashes(h, words)
    order = (g & ~_LOW) | (_LOW - np.arange(len(g), dtype=np.uint64))
    place = (_LOW - (_least(order, length - words + 1) & _LOW)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], n] - 1
    v = window_hashes(h, length, seed=1)
    shape = ((last - first) * 64 + place[first] - first).astype(np.uint64)
    span = (v[first] * np.uint64(0x9E3779B97F4A7C15)) ^ (v[last] + shape * np.uint64(0xC2B2AE3D27D4EB4F))
    return g[place[first]], span, first.astype(np.int32), (last - first).astype(np.int32)


def _seed_rows(length: int, words: int):
    def rows(batch: pa.RecordBatch) -> dict | None:
        parts = [seeds(word_hashes(t.split()), length, words) for t in texts_of(batch)]
        if not parts:
            return None
        of = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        joined = [np.concatenate(x) for x in zip(*parts, strict=True)]
        keys = {c: batch.column(c).to_numpy()[of] for c in ("k1", "k2")}
        return {**keys, "seed": as_long(joined[0]), "span": as_long(joined[1]), "first": joined[2], "more": joined[3]}

    return rows


def _window_rows(length: int):
    """The windows of the seeds in `todo`, each with two hashes."""

    def rows(batch: pa.RecordBatch) -> dict | None:
        out: dict[str, list] = {c: [] for c in ("k1", "k2", "v1", "v2", "first", "ask")}
        for text, todo, k1, k2 in zip(texts_of(batch), batch.column("todo").to_pylist(), batch.column("k1").to_pylist(),
                                      batch.column("k2").to_pylist(), strict=True):
            h = word_hashes(text.split())
            at = np.concatenate([np.arange(x["first"], x["first"] + x["more"] + 1) for x in todo])
            out["ask"].append(np.concatenate([np.full(x["more"] + 1, x["ask"]) for x in todo]))
            out["first"].append(at)
            out["v1"].append(window_hashes(h, length, seed=2)[at])
            out["v2"].append(window_hashes(h, length, seed=3)[at])
            out["k1"].append(np.full(len(at), k1, np.int64))
            out["k2"].append(np.full(len(at), k2, np.int64))
        if not out["k1"]:
            return None
        flat = {c: np.concatenate(x) for c, x in out.items()}
        return {**flat, "v1": as_long(flat["v1"]), "v2": as_long(flat["v2"])}

    return rows


def _cut(length: int):
    """Merge confirmed windows to maximal repeats and take their words out."""

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "repeats", "kept")}
        for text, found in zip(texts_of(batch), batch.column("found").to_pylist(), strict=True):
            words = text.split()
            repeats, gone = [], 0
            for first, last in sorted((x["first"], x["first"] + x["more"] + length) for x in found or ()):
                if repeats and first <= repeats[-1][1]:
                    repeats[-1][1] = max(repeats[-1][1], last)
                else:
                    repeats.append([first, last])
            kept, at = [], 0
            for first, last in repeats:
                kept += words[at:first]
                gone, at = gone + last - first, last
            out["n_words"].append(len(words))
            out["n_removed"].append(gone)
            out["repeats"].append([{"first": a, "last": b} for a, b in repeats])
            out["kept"].append(b" ".join(kept + words[at:]).decode())
        return {"k1": batch.column("k1"), "k2": batch.column("k2"), **out}

    return rows


def text_keys(docs: DataFrame, text_col: str = "text", names: tuple[str, str] = ("k1", "k2")) -> DataFrame:
    """`docs` with two columns that together are a 128-bit key of the text; null texts count as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(names[0], F.xxhash64(text)).withColumn(names[1], F.xxhash64(F.lit("second"), text))


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH,
                    seed_words: int = SEED_WORDS) -> DataFrame:
    """One row per distinct text (keys k1, k2 of ``text_keys``): n_words, n_removed, repeats, kept.

    A window of `length` words is repeated if its word sequence also starts anywhere
    else, in any row or in the same text. `repeats` lists the maximal runs of words
    covered by such windows, as word numbers [first, last); `kept` are the other words,
    joined by one space. All windows are judged on the input.

    Texts join on winnowed seeds. A seed whose whole surroundings occur twice confirms
    all its windows in one row. Where surroundings differ, one text of each kind is
    extended window by window to both sides, and equal windows are counted. So a passage
    in a third of all rows costs one row per place. Counts are written before they are
    joined, so both sides of each join are dealt anew and Spark can split a hot seed.

    Null and wordless texts have no words and keep the empty text; texts shorter than
    `length` words are kept whole. Repeated rows repeat each other's windows and lose all
    words if they have `length` of them. Columns besides the text are ignored. No rows
    give no rows. Seeds and windows are compared by 128 bits of hashes."""
    base = text_keys(only(docs, **{text_col: "text"}))
    found = durable(arrow_pass(base, _seed_rows(length, seed_words),
                               "k1 long, k2 long, seed long, span long, first int, more int"))
    shared = durable(found.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"))
    places = durable(found.join(shared, "seed"))
    for used in (found, shared):
        forget(used)

    spans = durable(places.groupBy("seed", "span").agg(
        F.count("*").alias("n"), F.min(F.xxhash64("k1", "k2", "first")).alias("pick")))
    kinds = durable(spans.groupBy("seed").agg(F.count("*").alias("kinds")))
    marked = durable(spans.join(kinds, "seed").where("n > 1 or kinds > 1"))
    judged = durable(
        places.join(marked, ["seed", "span"])
        .select("k1", "k2", "first", "more", (F.col("n") > 1).alias("whole"),
                ((F.col("kinds") > 1) & ((F.col("n") == 1) | (F.col("pick") == F.xxhash64("k1", "k2", "first")))).alias("extend"))
        .distinct())
    for used in (places, spans, kinds, marked):
        forget(used)
    texts = base.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    todo = judged.where("extend").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("first", "more", (~F.col("whole")).alias("ask"))).alias("todo"))
    windows = durable(arrow_pass(texts.join(todo, ["k1", "k2"]), _window_rows(length),
                                 "k1 long, k2 long, v1 long, v2 long, first int, ask boolean"))
    twice = durable(windows.groupBy("v1", "v2").agg(
        F.sum(F.when(F.col("ask"), 1).otherwise(2)).alias("n")).where("n > 1").select("v1", "v2"))
    extended = durable(windows.where("ask").join(twice, ["v1", "v2"]).select("k1", "k2", "first", F.lit(0).alias("more")))
    for used in (windows, twice):
        forget(used)
    confirmed = (judged.where("whole").select("k1", "k2", "first", "more").union(extended)
                 .groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "more")).alias("found")))
    return arrow_pass(
        texts.join(confirmed, ["k1", "k2"], "left"), _cut(length),
        "k1 long, k2 long, n_words long, n_removed long, repeats array<struct<first:int,last:int>>, kept string")
