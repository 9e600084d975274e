"""Packing token pieces into sequences: large ones matched, small ones best-fit."""

from __future__ import annotations

import bisect
import json
import zlib
from array import array
from collections import ChainMap

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from brightloom.runtime import durable

from .common import arrow_pass, only, texts_of

CAPACITY = 2048
END = 0
#: Words, and pieces of words, whose ids a worker remembers: about 200 bytes each.
REMEMBERED = 1_000_000
#: Groups that the pieces of one length are numbered in.
GROUPS = 256


#: Words of these letters and signs alone have no composed forms, case rules or blanks to mind.
PLAIN = regex.compile(r"[!-~\u00a1-\u012f\u0131-\u024f]+")


def _byte_letters() -> list[str]:
    """A letter for each byte: printable ones of Latin-1 stand for themselves, the others
    follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class _Encoder:
    """Ids of whole texts, word by word.

    The tokenizer lowers letters and works on each space-separated word by itself, so a
    word is encoded once and looked up from then on; with REMEMBERED words known, others
    are encoded for their batch only. Where the tokenizer's file says that it cuts words by
    a pattern into pieces of byte letters, plain words are cut here by that pattern and only
    pieces not met before go through its merges; all other words go through the tokenizer,
    those of a batch together."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.cut = self._pattern()
        self.letters = _byte_letters()

    def _pattern(self):
        """The pattern that cuts words, None where the file describes something else."""
        parts = json.loads(self.tokenizer.to_str())
        try:
            normal = [x["type"] for x in parts["normalizer"]["normalizers"]]
            split, level = parts["pre_tokenizer"]["pretokenizers"]
            alike = (normal == ["NFC", "Replace", "Lowercase"] and parts["model"]["type"] == "BPE" and split["type"] == "Split"
                     and split["behavior"] == "Removed" and split["invert"] and level["type"] == "ByteLevel"
                     and not level["add_prefix_space"] and not level["use_regex"])
            return regex.compile(split["pattern"]["Regex"]).findall if alike else None
        except (KeyError, TypeError, ValueError):
            return None

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            spelt = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(spelt)]).tobytes()
            if len(self.pieces) < REMEMBERED:
                self.pieces[piece] = ids
        return ids

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        fresh, whole = {}, []
        for word in words:
            text = word.decode()
            if self.cut is None or "<|" in text or not PLAIN.fullmatch(text):
                whole.append(word)
            else:
                fresh[word] = b"".join([self._piece(p) for p in self.cut(text.lower())])
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in whole], add_special_tokens=False)
        fresh.update((w, array("I", e.ids).tobytes()) for w, e in zip(whole, encoded, strict=True))
        return fresh

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        # The tokenizer lowers letters itself, but only after it has looked for special tokens
        # and composed letters with the marks (U+0300 to U+036F) behind them.
        split = [(text if b"<|" in text or b"\xcc" in text or b"\xcd" in text else text.lower()).split() for text in texts]
        fresh = self._learn(list({w for words in split for w in words}.difference(self.known)))
        if len(self.known) + len(fresh) <= REMEMBERED:
            self.known.update(fresh)
            find = self.known.__getitem__
        else:
            find = ChainMap(fresh, self.known).__getitem__
        return [b"".join(map(find, words)) for words in split]


_encoders: dict[str, _Encoder] = {}


def tokenize(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
             capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids (little-endian 32-bit).

    A document is the ids of its whole text and then END; null is the empty text. Only
    documents longer than `capacity` are cut. `tokenizer` is a file of a tokenizer that
    splits on white space before anything else."""
    end = np.array([END], "<u4").tobytes()

    def pieces(batch: pa.RecordBatch) -> dict:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = _Encoder(tokenizer)
        encoder = _encoders[tokenizer]
        out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids")}
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch)), strict=True):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                for name, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, part), strict=True):
                    out[name].append(value)
        return out

    return arrow_pass(only(docs, **{id_col: "doc_id", text_col: "text"}), pieces,
                      "doc_id long, piece int, start long, length long, ids binary")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """How so many pieces of each length go into as few sequences as the method gives.

    Returns runs (length, first rank, pieces, first sequence, per sequence, offset):
    piece number r of a length lies in sequence first_sequence + (r - first_rank) //
    per_sequence, behind the run's other pieces there.

    Lengths above a third of the capacity fit at most two to a sequence; from the
    longest on, each takes the longest partner that still fits. Smaller lengths then
    go, from the longest on, to the fullest sequence that still holds them. Equal
    sequences are handled together as ranges of numbers, so the work and the size of the
    plan depend on the capacity and not on the number of pieces."""
    left = {n: c for n, c in sorted(counts.items()) if c > 0}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[list[int]]] = {}
    sequences = 0

    def place(length: int, pieces: int, first: int, per: int, offset: int) -> None:
        runs.append((length, used[length], pieces, first, per, offset))
        used[length] += pieces
        left[length] -= pieces

    def opened(gap: int, first: int, count: int) -> None:
        if gap and count:
            gaps.setdefault(gap, []).append([first, count])

    large = [n for n in left if 3 * n > capacity]
    while large:
        n = large[-1]
        if not left[n]:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - n) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        partner = large[at] if at >= 0 else None
        if partner == n:
            pairs = left[n] // 2
            if pairs:
                place(n, 2 * pairs, sequences, 2, 0)
                opened(capacity - 2 * n, sequences, pairs)
                sequences += pairs
                continue
            lower = [x for x in large[:at] if left[x]]
            partner = lower[-1] if lower else None
        pairs = min(left[n], left[partner]) if partner else left[n]
        place(n, pairs, sequences, 1, 0)
        if partner:
            place(partner, pairs, sequences, 1, n)
        opened(capacity - n - (partner or 0), sequences, pairs)
        sequences += pairs

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for gap in sorted(g for g in gaps if g >= n):
            per = gap // n
            while left[n] and gaps[gap]:
                first, count = gaps[gap].pop()
                full = min(count, left[n] // per)
                if full:
                    place(n, full * per, first, per, capacity - gap)
                    opened(gap - per * n, first, full)
                if full < count:
                    some = left[n]
                    if some:
                        place(n, some, first + full, some, capacity - gap)
                        opened(gap - some * n, first + full, 1)
                    rest = count - full - (1 if some else 0)
                    if rest:
                        gaps[gap].append([first + full + (1 if some else 0), rest])
            if not left[n]:
                break
        if left[n]:
            per = capacity // n
            full, some = divmod(left[n], per)
            if full:
                place(n, full * per, sequences, per, 0)
                opened(capacity - per * n, sequences, full)
            if some:
                place(n, some, sequences + full, some, 0)
                opened(capacity - some * n, sequences + full, 1)
            sequences += full + (1 if some else 0)
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (any columns, with a long `length` from 1 to `capacity`) and sequence_id,
    sequence_offset: gapless from 0 in each sequence.

    The driver sees one count per length, at most `capacity` numbers. Pieces of a length
    are numbered within GROUPS hash groups, so a length that a third of all pieces have
    is no single task. `pieces` must be deterministic, best a written table.

    No rows give no rows; a null length or one outside 1 to `capacity` is an error.
    Equal pieces are told apart by their number only, and are interchangeable."""
    spark = pieces.sparkSession
    bad = ~F.coalesce(F.col("length").between(1, capacity), F.lit(False))
    counts = pieces.groupBy("length").agg(F.count("*").alias("n"), F.max(bad).alias("bad")).collect()
    if any(row["bad"] for row in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    runs = plan({row["length"]: row["n"] for row in counts}, capacity)
    by_length: dict[int, list] = {}
    for run in sorted(runs):
        by_length.setdefault(run[0], []).append(run[1:])
    shared = spark.sparkContext.broadcast({n: np.array(x, np.int64) for n, x in by_length.items()})

    names = pieces.columns
    row = F.struct(*[F.col(c) for c in names])
    keyed = pieces.select(F.col("length").alias("_n"), F.pmod(F.xxhash64(*names), F.lit(GROUPS)).cast("int").alias("_g"),
                          row.alias("_row"))
    sizes = keyed.groupBy("_n", "_g").agg(F.count("*").alias("_c"))
    before = sizes.select("_n", "_g", F.expr(
        "sum(_c) OVER (PARTITION BY _n ORDER BY _g) - _c").alias("_before"))
    numbered = keyed.withColumn("_r", F.expr("row_number() OVER (PARTITION BY _n, _g ORDER BY _g)")).join(
        before, ["_n", "_g"]).select("_row", "_n", (F.col("_r") + F.col("_before") - 1).alias("_rank"))

    def places(batch: pa.RecordBatch) -> dict:
        n, rank = batch.column("_n").to_numpy(), batch.column("_rank").to_numpy()
        sequence, offset = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        for length in np.unique(n):
            at = np.flatnonzero(n == length)
            first_rank, _, first, per, start = shared.value[int(length)].T
            run = np.searchsorted(first_rank, rank[at], "right") - 1
            within = rank[at] - first_rank[run]
            sequence[at] = first[run] + within // per[run]
            offset[at] = start[run] + within % per[run] * length
        return {"_row": batch.column("_row"), "_sequence": sequence, "_offset": offset}

    kind = keyed.schema["_row"].dataType.simpleString()
    placed = arrow_pass(numbered, places, f"_row {kind}, _sequence long, _offset long")
    return placed.select("_row.*", F.col("_sequence").alias("sequence_id"), F.col("_offset").alias("sequence_offset"))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents and their places: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset. See ``tokenize`` and ``pack``; the ids themselves are
    left out here and can be had by joining ``tokenize`` on (doc_id, piece).

    Null ids and repeated rows are packed like any other row."""

    cut = tokenize(docs, tokenizer, id_col, text_col, capacity)
    light = durable(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return pack(light, capacity).withColumnRenamed("sequence_offset", "offset")


def crc32_of(ids: bytes) -> int:
    """What ``ids_crc32`` holds."""
    return zlib.crc32(ids)
