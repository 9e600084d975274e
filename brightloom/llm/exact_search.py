"""Exact top-k inner products over blocks of vectors, pruned by bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brightloom.runtime import durable

from .common import arrow_pass, grouped_pass, only

SCALE = 1024
#: Vectors of a block, at most about.
BLOCK = 512
#: Blocks that a query is scored against before bounds decide, and queries of one pair of a group and a block.
FIRST, GROUP = 2, 256


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cells): the components as floor(SCALE * x) in 64-bit integers.

    Rows with a null id, a null vector, or a null or non-finite component are left out."""
    rows = only(vectors, **{id_col: "vec_id", vector_col: "vector"}).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector")).where(
        "vec_id is not null and vector is not null and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return rows.select("vec_id", F.expr(f"transform(vector, x -> bigint(floor({SCALE}D * x)))").alias("cells"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) and flat.num_chunks else flat
    return flat.flatten().to_numpy().reshape(len(column), -1)


def _bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Greatest score that any vector between low and high can have, per query and block."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def _best(group: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k highest scores of each group, ties to the smaller id."""
    order = np.lexsort((ids, -scores, group))
    g = group[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    rank = np.arange(len(g)) - np.repeat(first, np.diff(np.r_[first, len(g)]))
    order = order[rank < k]
    return group[order], ids[order], scores[order]


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
          block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, the
    `k` highest integer inner products with all other rows, ties to the smaller id.

    Vectors are dealt to blocks with others that point the same way: a block is a range
    of the order by sign pattern of the widest components and id. A block keeps the least
    and greatest value of each component, its forward index is its matrix. From those
    extremes each query bounds every block. It is scored against its FIRST best-bounded
    blocks, and then against just those whose bound reaches its k-th score so far, so
    the result is exact.

    Left out are the rows that ``quantised`` leaves out; all vectors must have the
    same length. Rows that repeat an id count each. Fewer than k candidates give
    fewer rows, no rows none."""
    cells = durable(quantised(vectors, id_col, vector_col))
    lengths = cells.agg(F.min(F.size("cells")), F.max(F.size("cells")), F.count("*")).first()
    if lengths[2] and lengths[0] != lengths[1]:
        raise ValueError("vectors differ in length")
    parts = max(1, -(-lengths[2] // block))
    width = min(16, lengths[1] or 1)
    sign = F.expr(f"aggregate(slice(cells, 1, {width}), 0L, (s, x) -> s * 2 + if(x >= 0, 1, 0))")
    ranged = cells.withColumn("sign", sign).repartitionByRange(parts, "sign", "vec_id")
    blocks = durable(ranged.select(F.spark_partition_id().alias("part"), "vec_id", "cells"))

    def summary(group: pa.Table) -> dict:
        m = _matrix(group.column("cells"))
        return {"part": [group.column("part")[0].as_py()], "low": [m.min(axis=0)], "high": [m.max(axis=0)],
                "ids": [group.column("vec_id").to_numpy().tobytes()], "matrix": [m.astype(np.int64).tobytes()]}

    stored = durable(grouped_pass(blocks, ["part"], summary,
                                  "part int, low array<long>, high array<long>, ids binary, matrix binary"))
    extremes = stored.select("part", "low", "high")
    queries = cells.where(F.col("vec_id") % every == 0).withColumn(
        "bunch", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-lengths[2] // (every * GROUP))))).cast("int"))
    # A bunch of queries meets the extremes of all blocks: a stated query set against all rows, in blocks.
    bunches = queries.groupBy("bunch").agg(F.collect_list(F.struct("vec_id", "cells")).alias("q"))
    slabs = extremes.groupBy(F.floor(F.col("part") / 4096).alias("slab")).agg(
        F.collect_list(F.struct("part", "low", "high")).alias("b"))

    def bound(batch: pa.RecordBatch) -> dict | None:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for q, b in zip(batch.column("q").to_pylist(), batch.column("b").to_pylist(), strict=True):
            m = np.array([x["cells"] for x in q], np.float64)
            limit = _bounds(m, np.array([x["low"] for x in b], np.float64), np.array([x["high"] for x in b], np.float64))
            ids, part = np.array([x["vec_id"] for x in q]), np.array([x["part"] for x in b])
            out.append((np.repeat(ids, len(part)), np.tile(part, len(ids)), limit.ravel()))
        if not out:
            return None
        ids, part, limit = (np.concatenate(x) for x in zip(*out, strict=True))
        return {"query_id": ids, "part": part, "bound": limit.astype(np.int64)}

    limits = durable(arrow_pass(bunches.join(slabs), bound, "query_id long, part int, bound long"))
    ranked = limits.withColumn("place", F.expr("row_number() OVER (PARTITION BY query_id ORDER BY bound DESC, part)"))
    named = queries.select(F.col("vec_id").alias("query_id"), "cells").dropDuplicates(["query_id"])

    def score(pairs: DataFrame) -> DataFrame:
        asked = pairs.select("query_id", "part").join(named, "query_id")
        bunched = asked.withColumn("bunch", F.pmod(F.xxhash64("query_id"), F.lit(64))).groupBy("part", "bunch").agg(
            F.collect_list(F.struct("query_id", "cells")).alias("q"))

        def run(batch: pa.RecordBatch) -> dict | None:
            out = []
            for q, ids, matrix in zip(*(batch.column(c).to_pylist() for c in ("q", "ids", "matrix")), strict=True):
                ids = np.frombuffer(ids, np.int64)
                m = np.frombuffer(matrix, np.int64).reshape(len(ids), -1)
                asked = np.array([x["query_id"] for x in q])
                s = np.array([x["cells"] for x in q], np.int64) @ m.T
                group, vec = np.repeat(asked, len(ids)), np.tile(ids, len(asked))
                other = group != vec
                out.append(_best(group[other], vec[other], s.ravel()[other], k))
            if not out:
                return None
            group, vec, s = (np.concatenate(x) for x in zip(*out, strict=True))
            return {"query_id": group, "vec_id": vec, "score": s}

        return arrow_pass(bunched.join(stored.select("part", "ids", "matrix"), "part"), run,
                          "query_id long, vec_id long, score long")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.expr(
            "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)")).where(F.col("rank") <= k)

    first = durable(best(score(ranked.where(F.col("place") <= FIRST))))
    reached = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    rest = ranked.where(F.col("place") > FIRST).join(reached, "query_id", "left").where("kth is null or bound >= kth")
    both = first.drop("rank").unionByName(score(rest))
    return best(both).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
