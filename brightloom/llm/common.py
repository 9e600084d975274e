"""What the operators share: word and window hashes, Arrow passes, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from brightloom.runtime import shared_folder

WORD = r"[^\x20\x09-\x0D]+"
#: Hashed words a worker remembers; beyond it words are hashed anew each time.
REMEMBERED = 300_000
#: Rows that are worked on at once, whatever the size of Arrow batches.
ROWS = 1_000
ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


_known = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def window_hashes(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of `width` entries of h, in order; none if h is shorter.

    Runs of 1, 2, 4, ... entries are built from their halves and joined to `width`."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    salt = np.uint64(seed * 2 + 1)
    power, size, result, done = h, 1, None, 0
    rest = width
    while rest:
        if rest & 1:
            part = power[done:done + n]
            result = part if result is None else _join(result, part, salt)
            done += size
        rest >>= 1
        if rest:
            power = _join(power[:len(power) - size], power[size:], salt)
            size *= 2
    return result.copy() if result is h else result


def _join(left: np.ndarray, right: np.ndarray, salt: np.uint64) -> np.ndarray:
    x = (left ^ (left >> np.uint64(29))) * (ODD ^ (salt << np.uint64(1)))
    x += right
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def arrow_pass(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str, at_once: int = ROWS) -> DataFrame:
    """``fn`` on each Arrow batch, `at_once` rows at most; the dict of columns it returns becomes rows of `schema`."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, at_once):
                out = fn(whole.slice(at, at_once))
                if out is not None:
                    yield pa.RecordBatch.from_arrays([_typed(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def _typed(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts as UTF-8, null as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def as_long(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def fold_of(key: Column, folds: int = 5) -> Column:
    """crc32 of the id's decimal text, modulo `folds`."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns, under new names; others, whatever their names, are left out."""
    return df.select(*[df[old].alias(new) for old, new in columns.items()])


def forget(df: DataFrame) -> None:
    """Delete a scratch table that no later plan reads. Only paths that ``durable`` made,
    whether the shared folder is given as a path or as a URI of any form."""
    spark = df.sparkSession
    java = spark._jvm
    plain = lambda uri: java.org.apache.hadoop.fs.Path(uri).toUri().getPath()
    base = plain(shared_folder(spark))
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = java.org.apache.hadoop.fs.Path(java.java.net.URI(file))
        if path.toUri().getPath().startswith(f"{base}/table-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def grouped_pass(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], dict | None], schema: str) -> DataFrame:
    """``fn`` on each group of equal `keys`. The groups of a partition stream through one
    Python worker after a sort, so small groups cost no call into Spark each. Groups must
    be of bounded size; key columns must be longs or ints without nulls."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def bounds(table: pa.Table) -> np.ndarray:
        changed = np.zeros(len(table), bool)
        for k in keys:
            v = table.column(k).to_numpy()
            changed[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(changed)

    def emit(table: pa.Table, ends: list[int]):
        start = 0
        for end in ends:
            out = fn(table.slice(start, end - start))
            start = end
            if out is not None:
                yield pa.RecordBatch.from_arrays([_typed(out[f.name], f.type) for f in target], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            if not len(table):
                continue
            ends = bounds(table).tolist()
            yield from emit(table, ends)
            rest = table.slice(ends[-1]) if ends else table
        if rest is not None and len(rest):
            yield from emit(rest, [len(rest)])

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
