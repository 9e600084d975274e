"""Language-model scores by context-tree weighting over binary-decomposed bytes."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from brightloom.runtime import durable

from .common import ROWS, arrow_pass, as_long, fold_of, forget, only, texts_of, word_hashes

DEPTH = 5
#: No byte of UTF-8: stands before a text, as context, and after it, as its end.
EDGE = 0xFF
#: Most frequent keys and words that every worker holds. Others are looked up by a join.
HELD = 1 << 20
#: Distinct keys a counting task holds before it merges them.
MERGE = 3_000_000
BYTES, WORDS = 0, 1
_END_WORD = np.uint64(0x1D8AF066F5D3C2B1)


def _keys(words: list[bytes]) -> np.ndarray:
    """Of each byte of a text and of its end: the byte, and above it its DEPTH predecessors."""
    raw = np.frombuffer(bytes([EDGE]) * DEPTH + b" ".join(words) + bytes([EDGE]), np.uint8).astype(np.int64)
    n = len(raw) - DEPTH
    keys = raw[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        keys |= raw[DEPTH - back:DEPTH - back + n] << (8 * back)
    return keys


def _tokens(words: list[bytes]) -> np.ndarray:
    return np.append(word_hashes(words), _END_WORD).view(np.int64)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its counts; the parts are ascending and not empty."""
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts[order], first)


def _count(batches):
    """Training counts of all keys and words; those of other rows come with a count of 0.
    A worker holds the keys of ROWS texts one by one, those of more as distinct keys."""
    parts: dict[int, list] = {BYTES: [], WORDS: []}
    for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
        learn = batch.column("learn").to_pylist()
        per: dict[tuple[int, bool], list] = {}
        for text, train in zip(texts_of(batch), learn, strict=True):
            words = text.lower().split()
            per.setdefault((BYTES, train), []).append(_keys(words))
            per.setdefault((WORDS, train), []).append(_tokens(words))
        for (kind, train), arrays in per.items():
            keys, counts = np.unique(np.concatenate(arrays), return_counts=True)
            parts[kind].append((keys, counts * train))
            if sum(len(k) for k, _ in parts[kind]) > MERGE:
                parts[kind] = [_merged(parts[kind])]
    for kind, found in parts.items():
        if found:
            keys, counts = _merged(found)
            for i in range(0, len(keys), 200_000):
                k = keys[i:i + 200_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(counts[i:i + 200_000])],
                    names=["kind", "key", "n"])


def _log_gamma(x: Column) -> Column:
    """ln Γ(x) for x > 0: Stirling's series at x + 7, brought down again."""
    y = x + 7
    product = x
    for i in range(1, 7):
        product = product * (x + i)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _kt(a: Column, b: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones."""
    a, b = a.cast("double"), b.cast("double")
    return F.when(a + b == 0, 0.0).otherwise(_log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - math.log(math.pi))


def _bits() -> Column:
    """The eight binary decisions of a key's byte: node (the bits before, after a leading 1) and bit."""
    return F.explode(F.array(*[F.struct(
        (F.lit(1 << i) + F.shiftright(F.col("key").bitwiseAND(F.lit(255)), 8 - i)).cast("int").alias("node"),
        F.shiftright("key", 7 - i).bitwiseAND(F.lit(1)).cast("int").alias("bit")) for i in range(8)]))


def key_scores(counts: DataFrame) -> DataFrame:
    """(key, n, value), written: the natural log of the probability of each key's byte after its context.

    Each context of each length up to DEPTH has a binary tree of its own over the next
    byte. From the longest contexts up, a node's probability is the mean of its own KT
    estimate and of the product of the contexts one byte longer; down again this gives
    each length its posterior weight, and a bit's probability is the mixture of the KT
    predictions of all lengths. Contexts without training counts predict evenly.

    The predictions are written before the keys look them up, and replace the trees: their
    shuffle files and those of the look-up are not on disk together."""
    steps = counts.select("key", "n", _bits().alias("x")).select(
        F.shiftright("key", 8).alias("context"), F.col("x.node").alias("node"), "x.bit", "n")
    level = durable(steps.groupBy("context", "node").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("a"), F.sum(F.col("n") * F.col("bit")).alias("b"))
        .withColumn("own", _kt(F.col("a"), F.col("b"))).withColumn("mixed", F.col("own")))
    levels = [level]
    for depth in range(DEPTH - 1, -1, -1):
        mask = (1 << 8 * depth) - 1
        up = level.groupBy(F.col("context").bitwiseAND(F.lit(mask)).alias("context"), "node").agg(
            F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("mixed").alias("below")).withColumn("own", _kt(F.col("a"), F.col("b")))
        high, low = F.greatest("own", "below"), F.least("own", "below")
        level = durable(up.withColumn("mixed", high + F.log1p(F.exp(low - high)) - math.log(2)).drop("below"))
        levels.append(level)
    path = None
    for depth, level in enumerate(reversed(levels)):
        stop = F.exp(F.col("own") - F.col("mixed")) / 2 if depth < DEPTH else F.lit(1.0)
        here = level.select("context", "node", stop.alias("stop"), ((F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1)).alias("one"))
        if path is None:
            path = here.select("context", "node", (F.col("stop") * F.col("one")).alias("p"), (1 - F.col("stop")).alias("rest"))
            continue
        mask = (1 << 8 * (depth - 1)) - 1
        path = (here.withColumn("parent", F.col("context").bitwiseAND(F.lit(mask)))
                .join(path.select(F.col("context").alias("parent"), "node", "p", "rest"), ["parent", "node"])
                .select("context", "node", (F.col("p") + F.col("rest") * F.col("stop") * F.col("one")).alias("p"),
                        (F.col("rest") * (1 - F.col("stop"))).alias("rest")))
    path = durable(path.select("context", "node", "p"))
    for level in levels:
        forget(level)
    p = F.when(F.col("bit") == 1, F.col("p")).otherwise(1 - F.col("p"))
    wanted = counts.select("key", "n", _bits().alias("x")).select(
        "key", "n", F.shiftright("key", 8).alias("context"), F.col("x.node").alias("node"), "x.bit")
    values = durable(wanted.join(path, ["context", "node"]).groupBy("key").agg(
        F.first("n").alias("n"), F.sum(F.log(p)).alias("value")))
    forget(path)
    return values


@dataclass
class LanguageModel:
    """`values`: (kind, key, n, value) of every key and word of the corpus, from written tables.
    `held`: the most frequent of them as hash tables, of bounded size, on every worker."""

    values: DataFrame
    held: Broadcast
    train_tokens: int
    distinct: int


def _hash_table(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Open addressing with linear probing; slots that hold no key have value NaN."""
    size = 1 << max(4, int(2 * max(1, len(keys)) - 1).bit_length())
    slot_key = np.zeros(size, np.int64)
    slots = [np.full(size, np.nan, v.dtype) for v in values]
    free = np.ones(size, bool)
    at = _slot(keys, size)
    todo = np.arange(len(keys))
    while len(todo):
        ok = free[at[todo]]
        _, first = np.unique(at[todo], return_index=True)
        take = np.zeros(len(todo), bool)
        take[first] = True
        won = todo[ok & take]
        slot_key[at[won]] = keys[won]
        free[at[won]] = False
        for slot, v in zip(slots, values, strict=True):
            slot[at[won]] = v[won]
        todo = todo[~(ok & take)]
        at[todo] = (at[todo] + 1) & (size - 1)
    return (slot_key, *slots)


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    x = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - int(size).bit_length() + 1)).astype(np.int64)


def _look_up(table: tuple[np.ndarray, ...], keys: np.ndarray) -> np.ndarray:
    """Values of the keys; NaN for those that the table doesn't hold."""
    slot_key, slot = table
    size = len(slot_key)
    at = _slot(keys, size)
    out = slot[at]
    wrong = np.flatnonzero((slot_key[at] != keys) & ~np.isnan(out))
    while len(wrong):
        at[wrong] = (at[wrong] + 1) & (size - 1)
        out[wrong] = slot[at[wrong]]
        wrong = wrong[(slot_key[at[wrong]] != keys[wrong]) & ~np.isnan(out[wrong])]
    return out


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
                       left_out: int = 1, held: int = HELD) -> LanguageModel:
    """Learn from all rows whose id's crc32 modulo `folds` is not `left_out` (null ids teach nothing).

    Keys and words of all rows are listed, so that every later look-up finds its value.
    Each worker gets at most `held` of either kind, those with the highest counts."""
    rows = only(docs, **{id_col: "doc_id", text_col: "text"}).select(
        "text", F.coalesce(fold_of(F.col("doc_id"), folds) != left_out, F.lit(False)).alias("learn"))
    counts = durable(rows.mapInArrow(_count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    words = counts.where(F.col("kind") == WORDS)
    total, distinct = words.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    scores = key_scores(counts.where(F.col("kind") == BYTES).select("key", "n"))
    values = scores.select(F.lit(BYTES).alias("kind"), "key", "n", "value").unionByName(
        words.select("kind", "key", "n", F.col("n").cast("double").alias("value")))
    tables = {}
    bucket = F.floor(4 * F.log2(F.col("n") + 1))
    sizes = values.groupBy("kind", bucket.alias("bucket")).count().collect()
    for kind in (BYTES, WORDS):
        least, room = math.inf, held
        for row in sorted((r for r in sizes if r["kind"] == kind), key=lambda r: -r["bucket"]):
            room -= row["count"]
            if room < 0:
                break
            least = row["bucket"]
        kept = values.where((F.col("kind") == kind) & (bucket >= F.lit(least))).select("key", "value").toArrow()
        tables[kind] = (kept.column("key").to_numpy(), kept.column("value").to_numpy().astype(np.float64 if kind == WORDS else np.float32))
    return LanguageModel(values, docs.sparkSession.sparkContext.broadcast(tables), total or 0, distinct or 0)


def score_texts(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
                left_out: int = 1) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.

    A text is its words, A-Z lowered, joined by one space, and an end. `score` is the
    log10 of the probability that the context trees give to its bytes and its end,
    `bits_per_byte` its code length over their number. `base_score` is that of a
    smoothed unigram model over the words and the end.

    Null and wordless texts consist of the end. Null ids are not held out; repeated rows
    score alike; other columns are ignored; no rows give no rows."""
    total, distinct, held = model.train_tokens, model.distinct, model.held
    scale = total + 0.5 * (distinct + 1)
    made: dict[int, tuple[np.ndarray, ...]] = {}

    def run(batch: pa.RecordBatch) -> dict:
        if not made:
            made.update({kind: _hash_table(*table) for kind, table in held.value.items()})
        out: dict[str, list] = {c: [] for c in ("n_tokens", "n_bytes", "n_known", "base", "log", "rare_keys", "rare_words")}
        for text in texts_of(batch):
            words = text.lower().split()
            keys, tokens = _keys(words), _tokens(words)
            value, count = _look_up(made[BYTES], keys), _look_up(made[WORDS], tokens)
            here, known = ~np.isnan(value), ~np.isnan(count)
            out["n_tokens"].append(len(tokens))
            out["n_bytes"].append(len(keys))
            out["n_known"].append(int((count[known] > 0).sum()))
            out["base"].append(float(np.log10((count[known] + 0.5) / scale).sum()))
            out["log"].append(float(value[here].sum(dtype=np.float64)))
            out["rare_keys"].append(keys[~here])
            out["rare_words"].append(tokens[~known])
        return {"doc_id": batch.column("doc_id"), **out}

    rows = only(docs, **{id_col: "doc_id", text_col: "text"}).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = durable(arrow_pass(
        rows, run, "doc_id long, n_tokens long, n_bytes long, n_known long, base double, log double, "
        "rare_keys array<long>, rare_words array<long>").withColumn("row", F.monotonically_increasing_id()))
    rare = first.select("row", F.lit(BYTES).alias("kind"), F.explode("rare_keys").alias("key")).unionByName(
        first.select("row", F.lit(WORDS).alias("kind"), F.explode("rare_words").alias("key"))).groupBy("row", "kind", "key").agg(
        F.count("*").alias("times"))
    word = F.col("kind") == WORDS
    more = rare.join(model.values.select("kind", "key", "value"), ["kind", "key"]).groupBy("row").agg(
        F.sum(F.when(word & (F.col("value") > 0), F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.when(word, F.col("times") * F.log10((F.col("value") + 0.5) / F.lit(scale))).otherwise(0.0)).alias("base_more"),
        F.sum(F.when(word, 0.0).otherwise(F.col("times") * F.col("value"))).alias("log_more"))
    log = F.col("log") + F.coalesce("log_more", F.lit(0.0))
    return first.drop("rare_keys", "rare_words").join(more, "row", "left").select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id"), folds) == left_out, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", F.lit(0.0))).alias("base_score"), (log / math.log(10)).alias("score"),
        (-log / math.log(2) / F.col("n_bytes")).alias("bits_per_byte"))
