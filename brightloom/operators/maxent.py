"""Maximum-entropy classification of feature bags by generalised iterative scaling."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StructField, StructType

from ..runtime import durable, forget_path, give_back, scratch_path, written
from .ordering import number_rows

TOGETHER = 1_500_000  # entries that a task sorts at once
RANGES = 2  # of keys, for each shuffle partition: what a task sorts at once when they meet
BLOCK = 65_536  # documents whose sums make one row
HISTORY = 64 * 1024 * 1024  # bytes of probabilities that a task gets for the weights


@dataclass(frozen=True)
class MaxentModel:
    """`weights`: (_feature, _class, _w) with a weight per label, null where a feature was never
    seen with it, and the number of the class of features that were fitted as one; read from the
    training features when asked for. `slack`: the weight of what is missing to `most` features.
    `dealt`: (part, kind, cells), the weights by ranges of the features' keys."""

    doc: str
    labels: list
    weights: DataFrame
    slack: float
    most: int
    dealt: DataFrame
    own: np.ndarray
    parts: int

    def predict(self, features: DataFrame) -> DataFrame:
        """(doc, prediction, probability) for the documents of a (doc, feature, value) table;
        features that training never saw play no part."""
        n = len(self.labels)
        totals = _totals(self.dealt, _packed(_keyed(features, self.doc), self.doc, self.parts), self.doc, self.own, self.parts)
        sums = totals.groupBy(self.doc).agg(*[F.sum(c).alias(c) for c in totals.columns if c != self.doc])
        missing = [F.greatest(F.lit(self.most) - F.col(f"_k{i}"), F.lit(0.0)) for i in range(n)]
        logs = [F.col(f"_t{i}") + self.slack * missing[i] for i in range(n)]
        top = F.greatest(*logs) if n > 1 else logs[0]
        powers = F.array(*[F.exp(x - top) for x in logs])
        scored = sums.select(self.doc, powers.alias("_e")).withColumn("_all", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x))
        best = F.array_max(F.transform("_e", lambda x, i: F.struct((x / F.col("_all")).alias("p"), (-i).alias("at"))))
        kinds = F.array(*[F.lit(label) for label in self.labels])
        return scored.withColumn("_b", best).select(
            self.doc, F.element_at(kinds, 1 - F.col("_b.at")).alias("prediction"), F.col("_b.p").alias("probability"))


def _value() -> Column:
    """Rounded to nine places; what needs no rounding is not rounded, which takes long."""
    value = F.col("value").cast("double")
    return F.when(value.isin(0.0, 1.0), value).otherwise(F.round(value, 9))


def _keyed(features: DataFrame, doc: str) -> DataFrame:
    """A feature with its value is a property that a document has or has not. It is known by 64
    bits of a hash: among a hundred million properties two share them about once in 4,000 times."""
    return features.select(doc, F.xxhash64("feature", _value()).alias("_key"))


# ---- columns of numbers in few bytes ----

def _pack(*columns: np.ndarray) -> bytes:
    """Numbers from 0 in as many bytes each as the largest of their column takes."""
    out = []
    for column in columns:
        width = max(1, (int(column.max()).bit_length() + 7) // 8) if len(column) else 1
        out += [np.array([len(column), width], "<i8").tobytes(),
                column.astype("<u8").view("u1").reshape(-1, 8)[:, :width].tobytes()]
    return b"".join(out)


def _unpack(cells: pa.Buffer | bytes) -> list[np.ndarray]:
    out, at, end = [], 0, memoryview(cells).nbytes
    while at < end:
        size, width = map(int, np.frombuffer(cells, "<i8", 2, at))
        wide = np.zeros((size, 8), "u1")
        wide[:, :width] = np.frombuffer(cells, "u1", size * width, at + 16).reshape(size, width)
        out.append(wide.reshape(-1).view("<u8"))
        at += 16 + size * width
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences, which are shorter."""
    return np.diff(keys, prepend=np.uint64(0))


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of the keys, in their order."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grouped(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the number of documents of each, and those in order."""
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    del order
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(new, append=len(keys))
    keys = keys[new]
    pairs = np.repeat(np.arange(len(new), dtype="uint64") << np.uint64(32), counts)
    pairs |= docs.astype("uint64", copy=False)
    pairs.sort()
    once = np.append(True, pairs[1:] != pairs[:-1])
    if not once.all():
        pairs = pairs[once]
        counts = np.bincount((pairs >> np.uint64(32)).view("int64"), minlength=len(new))
    return keys, counts, (pairs & np.uint64(0xFFFFFFFF)).astype("uint32")


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def _by_part(rows: DataFrame, tasks: int, schema: StructType | str, fn: Callable[[int, list[dict]], Iterator[dict]]) -> DataFrame:
    """Rows that `fn` makes of all rows of a part."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)

    def made(part: int, held: list[dict]) -> Iterator[pa.RecordBatch]:
        for out in fn(part, held):
            yield pa.RecordBatch.from_arrays([out[f.name].cast(f.type) if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                                              for f in target], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for i, at in enumerate(batch.column("part").to_pylist()):
                if at != part and held:
                    yield from made(part, held)
                    held = []
                part = at
                held.append({name: batch.column(name)[i] for name in batch.schema.names})
        if held:
            yield from made(part, held)
        del held
        give_back()

    return rows.repartitionById(tasks, F.col("part")).sortWithinPartitions("part").mapInArrow(run, schema)


def _packed(entries: DataFrame, doc: str, parts: int, known: pa.Array | None = None) -> DataFrame:
    """(part, kind, docs, cells): a task's (doc, _key) by ranges of the keys. Documents are places in
    `known`, others are left out; without that they are places in `docs`."""
    schema = StructType([StructField("part", IntegerType()), StructField("kind", IntegerType()),
                         StructField("docs", ArrayType(entries.schema[doc].dataType)), StructField("cells", BinaryType())])

    def packed(docs: list[pa.Array], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        coded = pa.chunked_array(docs).combine_chunks().dictionary_encode()
        kinds, at, key = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.concatenate(keys).view("uint64")
        if known is not None:
            place = pc.fill_null(pc.index_in(kinds, value_set=known), -1).to_numpy()
            at = place[at]
            key, at = key[at >= 0], at[at >= 0]
        if not len(key):
            return
        key, counts, at = _grouped(key, at)
        ends, uptos = np.searchsorted(_part_of(key, parts), np.arange(parts + 1)), np.append(0, np.cumsum(counts))
        for part in range(parts):
            a, b = ends[part], ends[part + 1]
            if a < b:
                cells = _pack(_steps(key[a:b]), counts[a:b], at[uptos[a]:uptos[b]])
                listed = pa.array([[]], pa.list_(kinds.type)) if known is not None else pa.ListArray.from_arrays([0, len(kinds)], kinds)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([2], pa.int32()), listed, pa.array([cells])], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, keys, size = [], [], 0
        for batch in batches:
            docs.append(batch.column(0))
            keys.append(batch.column(1).to_numpy())
            size += batch.num_rows
            if size >= TOGETHER:
                yield from packed(docs, keys)
                docs, keys, size = [], [], 0
        if size:
            yield from packed(docs, keys)
        del docs, keys
        give_back()

    return entries.where(F.col(doc).isNotNull()).mapInArrow(run, schema)


def _merged(cells: list[bytes], shift: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_grouped` of packed entries; `shift` has the places for each one's documents."""
    keys, docs = [], []
    for i, cell in enumerate(cells):
        steps, counts, at = _unpack(cell)
        keys.append(np.repeat(np.cumsum(steps), counts.view("int64")))
        docs.append((at if shift is None else shift[i][at.view("int64")]).astype("uint32"))
    return _grouped(np.concatenate(keys), np.concatenate(docs))


def _totals(dealt: DataFrame, asked: DataFrame, doc: str, own: np.ndarray, parts: int) -> DataFrame:
    """(doc, _t0, …, _k0, …): what the known features of a part add to each label, and how many have a weight."""
    n = own.shape[1]
    kind = asked.schema["docs"].dataType.elementType
    names = [f"_{c}{i}" for c in "tk" for i in range(n)]
    schema = StructType([StructField(doc, kind), *[StructField(name, DoubleType()) for name in names]])

    def scored(part: int, rows: list[dict]) -> Iterator[dict]:
        asks = [r for r in rows if r["kind"].as_py() == 2]
        if not asks:
            return
        keys, weights = [np.zeros(0, "uint64")], [np.zeros((0, n))]
        for r in rows:
            if r["kind"].as_py() == 0:
                steps, at = _unpack(r["cells"].as_buffer())
                keys.append(np.cumsum(steps))
                weights.append(own[at.view("int64")])
            elif r["kind"].as_py() == 1:
                steps, bits = _unpack(r["cells"].as_buffer())
                keys.append(np.cumsum(steps))
                weights.append(bits.view("float64").reshape(-1, n))
        every, w = np.concatenate(keys), np.concatenate(weights)
        order = np.argsort(every)
        every, w = every[order], w[order]
        coded = pa.chunked_array([r["docs"].values for r in asks]).combine_chunks().dictionary_encode()
        sizes = [len(r["docs"].values) for r in asks]
        places = np.split(coded.indices.to_numpy(zero_copy_only=False), np.cumsum(sizes)[:-1])
        key, counts, at = _merged([r["cells"].as_buffer() for r in asks], places)
        found = np.searchsorted(every, key)
        hit = found < len(every)
        hit[hit] = every[found[hit]] == key[hit]
        mine = np.full((len(key), n), np.nan)
        mine[hit] = w[found[hit]]
        of, at = np.repeat(np.arange(len(key)), counts), at.astype("int64")
        on = hit[of]
        mine, at, size = mine[of[on]], at[on], len(coded.dictionary)
        yield {doc: coded.dictionary, **{f"_t{i}": np.bincount(at, np.nan_to_num(mine[:, i]), size) for i in range(n)},
               **{f"_k{i}": np.bincount(at, (~np.isnan(mine[:, i])).astype(float), size) for i in range(n)}}

    no_docs = F.lit(None).cast(ArrayType(kind)).alias("docs")
    return _by_part(dealt.select("part", "kind", no_docs, "cells").unionByName(asked), -(-parts // RANGES), schema, scored)


def _divided(entries: DataFrame, tasks: int) -> DataFrame:
    """(part, kind, cells): by ranges of the keys those of one document (kind 0: keys, documents), and
    those of more by their documents (kind 1: keys, counts, documents)."""
    def divide(part: int, rows: list[dict]) -> Iterator[dict]:
        keys, counts, docs = _merged([r["cells"].as_buffer() for r in rows])
        single = counts == 1
        first = _starts(counts)
        yield {"part": [part], "kind": [0], "cells": [_pack(_steps(keys[single]), docs[first[single]])]}
        keys, docs, counts = keys[~single], docs[np.repeat(~single, counts)], counts[~single]
        if len(keys):
            to = _part_of(np.add.reduceat(_mixed(docs.astype("uint64"), 1), _starts(counts)), tasks)
            order = np.argsort(to, kind="stable")
            ends, first = np.searchsorted(to[order], np.arange(tasks + 1)), _starts(counts)
            for other in range(tasks):
                some = order[ends[other]:ends[other + 1]]
                if len(some):
                    yield {"part": [other], "kind": [1], "cells": [_pack(_steps(keys[some]), counts[some], docs[_ranges(first[some], counts[some])])]}

    return _by_part(entries, tasks, "part int, kind int, cells binary", divide)


def _ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All places of ranges, one after the other."""
    return np.repeat(first - _starts(counts), counts) + np.arange(counts.sum())


def _classed(shared: DataFrame, tasks: int, at: np.ndarray, n: int) -> DataFrame:
    """(part, cells, names): the classes of features with the same documents: for each its number of
    features, of documents, and of documents with each label, then the documents; the features' keys and classes."""
    def classes(part: int, rows: list[dict]) -> Iterator[dict]:
        unpacked = [_unpack(r["cells"].as_buffer()) for r in rows]
        keys = np.concatenate([np.cumsum(steps) for steps, _, _ in unpacked])
        counts = np.concatenate([c for _, c, _ in unpacked]).view("int64")
        docs = np.concatenate([d for _, _, d in unpacked]).view("int64")
        first, wide = _starts(counts), docs.view("uint64")
        sums = [np.add.reduceat(_mixed(wide, seed), first) for seed in (1, 2)]
        order = np.lexsort([keys, *sums, counts])
        marks = np.stack([counts.astype("uint64"), *sums])[:, order]
        new = np.flatnonzero(np.append(True, (marks[:, 1:] != marks[:, :-1]).any(0)))
        same = np.diff(new, append=len(order))
        chosen = order[new]
        held, docs = counts[chosen], docs[_ranges(first[chosen], counts[chosen])]
        seen = [np.add.reduceat((at[docs] == i).astype("int64"), _starts(held)) for i in range(n)]
        of = np.empty(len(order), "int64")
        of[order] = np.repeat(np.arange(len(new)), same)
        by_key = np.argsort(keys)
        yield {"part": [part], "cells": [_pack(same, held, docs, *seen)], "names": [_pack(_steps(keys[by_key]), of[by_key])]}

    return _by_part(shared, tasks, "part int, cells binary, names binary", classes)


def _sums(matrix: DataFrame, chances: np.ndarray | None, size: int, n: int) -> np.ndarray:
    """By document and label, summed over its shared features: the logarithm of observed over
    expected count, or without `chances` the number of features that were seen with the label."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, size))
        for batch in batches:
            for cells in batch.column(0):
                same, held, docs, *seen = [c.view("int64") for c in _unpack(cells.as_buffer())]
                for i in range(n):
                    moved = (seen[i] > 0).astype(float) if chances is None else _moved(seen[i], chances[i], docs, held)
                    total[i] += np.bincount(docs, np.repeat(moved * same, held), size)
        give_back()
        for first in range(0, size, BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([first // BLOCK], pa.int32()), pa.array([total[:, first:first + BLOCK].tobytes()])], names=["part", "cells"])

    def meet(part: int, rows: list[dict]) -> Iterator[dict]:
        yield {"part": [part], "cells": [sum(np.frombuffer(r["cells"].as_buffer()) for r in rows).tobytes()]}

    cores = matrix.sparkSession.sparkContext.defaultParallelism  # each adds up its classes before anything moves
    tasks = matrix.select("cells").coalesce(cores).mapInArrow(add, "part int, cells binary")
    blocks = -(-size // BLOCK)
    found = durable(_by_part(tasks, blocks, "part int, cells binary", meet)).collect()
    out = [np.zeros((n, min(BLOCK, size - k * BLOCK))) for k in range(blocks)]
    for row in found:
        out[row["part"]] = np.frombuffer(row["cells"]).reshape(n, -1)
    return np.concatenate(out, axis=1)


def _moved(seen: np.ndarray, chances: np.ndarray, docs: np.ndarray, held: np.ndarray) -> np.ndarray:
    expected = np.add.reduceat(chances[docs], _starts(held))
    return np.log(np.divide(seen, expected, out=np.ones(len(held)), where=seen > 0))


def _weighted(matrix: DataFrame, history: list[np.ndarray], most: int, n: int, parts: int) -> DataFrame:
    """(part, kind, cells): keys of shared features with their weights, by ranges of the keys. A few
    rounds' probabilities at a time go to the tasks, so weights come in as many rows as that takes."""
    each = max(1, HISTORY // max(1, history[0].nbytes)) if history else 1

    def weigh(some: list[np.ndarray]) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for cells, names in zip(batch.column(0), batch.column(1)):
                    _, held, docs, *seen = [c.view("int64") for c in _unpack(cells.as_buffer())]
                    w = np.zeros((len(held), n))
                    for i in range(n):
                        for chances in some:
                            w[:, i] += _moved(seen[i], chances[i], docs, held) / most
                        w[seen[i] == 0, i] = np.nan
                    steps, of = _unpack(names.as_buffer())
                    keys, of = np.cumsum(steps), of.astype("int64")
                    ends = np.searchsorted(_part_of(keys, parts), np.arange(parts + 1))
                    for part in range(parts):
                        a, b = ends[part], ends[part + 1]
                        if a < b:
                            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([_pack(_steps(keys[a:b]), w[of[a:b]].reshape(-1).view("uint64"))])], names=["part", "cells"])
            give_back()

        return run

    def meet(part: int, rows: list[dict]) -> Iterator[dict]:
        unpacked = [_unpack(r["cells"].as_buffer()) for r in rows]
        keys, of = np.unique(np.concatenate([np.cumsum(steps) for steps, _ in unpacked]), return_inverse=True)
        w = np.concatenate([bits.view("float64").reshape(-1, n) for _, bits in unpacked])
        total = np.stack([np.bincount(of, w[:, i], len(keys)) for i in range(n)], axis=1)
        yield {"part": [part], "kind": [1], "cells": [_pack(_steps(keys), total.reshape(-1).view("uint64"))]}

    chunks = [history[k:k + each] for k in range(0, len(history), each)] or [[]]
    rows = None
    for some in chunks:
        one = matrix.select("cells", "names").mapInArrow(weigh(some), "part int, cells binary")
        rows = one if rows is None else rows.unionByName(one)
    return _by_part(rows, -(-parts // RANGES), "part int, kind int, cells binary", meet)


def _rows_of(dealt: DataFrame, own: np.ndarray) -> DataFrame:
    """(_key, _w) of every feature."""
    n = own.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                steps, rest = _unpack(cells.as_buffer())
                w = rest.view("float64").reshape(-1, n) if kind else own[rest.view("int64")]
                flat = pa.array(w.reshape(-1), mask=np.isnan(w.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(np.cumsum(steps).view("int64")), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(w) + 1) * n, pa.int32()), flat)], names=["_key", "_w"])

    return dealt.select("kind", "cells").mapInArrow(run, "_key long, _w array<double>")


def _owners(single: DataFrame, size: int) -> DataFrame:
    """(_doc, _first, _m): by document the least key and the number of the features that it has alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, least = np.zeros(size, "int64"), np.full(size, np.iinfo("int64").max)
        for batch in batches:
            for cells in batch.column(0):
                steps, docs = _unpack(cells.as_buffer())
                count += np.bincount(docs.view("int64"), minlength=size)
                np.minimum.at(least, docs.view("int64"), np.cumsum(steps).view("int64"))
        there = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(least[there]), pa.array(count[there])], names=["_doc", "_first", "_m"])

    cores = single.sparkSession.sparkContext.defaultParallelism
    return (single.select("cells").coalesce(cores).mapInArrow(run, "_doc long, _first long, _m long")
            .groupBy("_doc").agg(F.min("_first").alias("_first"), F.sum("_m").alias("_m")))


def _firsts(names: DataFrame, each: bool) -> DataFrame:
    """(_key, _first): shared features with the least key of their class, all of them or those themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells in batch.column(0):
                steps, of = _unpack(cells.as_buffer())
                keys, of = np.cumsum(steps).view("int64"), of.view("int64")
                least = np.full(of.max() + 1, np.iinfo("int64").max)
                np.minimum.at(least, of, keys)
                keys, firsts = (keys, least[of]) if each else (least, least)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(firsts)], names=["_key", "_first"])

    return names.mapInArrow(run, "_key long, _first long")


def _alone(single: DataFrame) -> DataFrame:
    """(_key, _doc) of the features that one document has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells in batch.column(0):
                steps, docs = _unpack(cells.as_buffer())
                yield pa.RecordBatch.from_arrays([pa.array(np.cumsum(steps).view("int64")), pa.array(docs.view("int64"))], names=["_key", "_doc"])

    return single.select("cells").mapInArrow(run, "_key long, _doc long")


def fit_maxent(features: DataFrame, labels: DataFrame, doc: str, label: str = "label", rounds: int = 25) -> MaxentModel:
    """Fit on the documents that both (doc, feature, value) and (doc, label) know.

    Features of just the same documents have the same counts, so the same weight in every
    round: they are fitted as one, which counts as often as there are such features. That
    takes the many that one document has alone, and what copies share. Documents of shared
    features are compared by their number and two 64-bit sums of hashes.

    Entries are dealt once by their feature's key, so that the documents of each feature
    meet, and the shared ones once more by those documents, so that classes meet. The tasks
    pack them as columns of few bytes a number: what is dealt is some 7 bytes an entry. A
    round reads the classes with the probabilities of all documents: these add up to the
    expected count of each class and label, and the logarithm of observed over expected
    count, divided by the largest number of features of a document, moves the sums of the
    class's documents. Nothing but these sums moves, from each core for each document. The
    weights are made at the end, from the probabilities of all rounds. Pairs of feature and
    label that never occur have no weight. The labels, which have to be few, and for each
    document its key and the probabilities of every round are on the driver."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc).isNotNull()).select(doc, F.col(label).alias("_label"))
    kinds = sorted(r[0] for r in known.select("_label").distinct().limit(1001).collect())
    if not 1 <= len(kinds) <= 1000:
        raise ValueError("labels have to be between 1 and 1,000 kinds")
    n = len(kinds)
    tasks = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = RANGES * tasks
    place = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("_label")).cast("int") - 1
    listed = known.select(doc, place.alias("_at")).distinct().toArrow()
    docs, at = listed.column(0).combine_chunks(), listed.column(1).to_numpy().astype("int64")
    if pc.count_distinct(docs).as_py() < len(docs):
        raise ValueError("a document has more than one label")
    size, every = len(docs), np.arange(len(docs))

    spark, entries, met = features.sparkSession, scratch_path(features.sparkSession, "table"), scratch_path(features.sparkSession, "table")
    written(_divided(_packed(_keyed(features, doc), doc, parts, docs), tasks), entries, ["kind"])
    single, shared = [spark.read.schema("part int, cells binary, kind int").parquet(entries).where(F.col("kind") == k) for k in (0, 1)]
    written(_classed(shared.select("part", "cells"), tasks, at, n), met)
    forget_path(spark, f"{entries}/kind=1")
    matrix = spark.read.schema("part int, cells binary, names binary").parquet(met)
    members = durable(matrix.select("names"))
    owners = durable(_owners(single, size))
    classes = owners.select("_first").unionByName(_firsts(members, False).select("_first"))
    numbered = number_rows(classes, ["_first"], "_class")
    own = np.zeros(size)
    counted = owners.select("_doc", "_m").toArrow()
    own[counted.column(0).to_numpy()] = counted.column(1).to_numpy()

    held = _sums(matrix, None, size, n)
    held[at, every] += own
    there = held[at, every] > 0
    if not there.any():
        raise ValueError("no document has both features and a label")
    most = int(held[:, there].max())
    missing, total, slack = np.maximum(most - held, 0) * there, np.zeros((n, size)), 0.0
    history, lone = [], np.zeros(size)
    for _ in range(rounds):
        logs = total + slack * missing
        powers = np.exp(logs - logs.max(0))
        chances = powers / powers.sum(0)
        moved = -np.log(chances[at, every]) / most  # of features that their document has alone
        total += _sums(matrix, chances, size, n) / most
        total[at, every] += own * moved
        lone += moved
        history.append(chances)
        observed, expected = missing[at, every].sum(), (missing * chances).sum()
        if observed and expected:
            slack += math.log(observed / expected) / most
    own_weights = np.full((size, n), np.nan)
    own_weights[every, at] = lone
    dealt = durable(_weighted(matrix, history, most, n, parts)).unionByName(single)
    forget_path(spark, met)
    names = features.select(F.concat("feature", F.lit("="), _value().cast("string")).alias("_feature"), F.xxhash64("feature", _value()).alias("_key")).distinct()
    first = _alone(single).join(owners, "_doc").select("_key", "_first").unionByName(_firsts(members, True))
    weights = (names.join(_rows_of(dealt, own_weights), "_key").join(first, "_key").join(numbered, "_first").select("_feature", "_class", "_w"))
    return MaxentModel(doc, kinds, weights, slack, most, dealt, own_weights, parts)
