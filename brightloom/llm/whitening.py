"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brightloom.runtime import durable

from .common import arrow_pass, forget, only

SCALE, SHIFT = 1024, 100_000
#: Entries of this size and more have no exact integer in a double.
LARGEST = 2.0 ** 40
#: A singular value below this part of the largest is rounding.
NEGLIGIBLE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """n rows with sums S and centre S/n = base + rest; unit components as columns and
    the eigenvalues of the covariance, falling; `trace` of the covariance."""
    n: int
    sums: np.ndarray
    base: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, cells: np.ndarray) -> np.ndarray:
        return (cells - self.base).astype(np.float64) - self.rest

    def whitened(self, cells: np.ndarray) -> np.ndarray:
        return self.centred(cells) @ self.components / np.sqrt(self.values)

    def deviations(self, cells: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 per row; None where 64 bits can't hold it."""
        away = self.n * cells - self.sums
        exact = (away * away).sum(axis=1).tolist()
        for i in np.flatnonzero(self.n ** 2 * np.square(self.centred(cells)).sum(axis=1) > 2.0 ** 62):
            exact[i] = sum((self.n * x - s) ** 2 for x, s in zip(cells[i].tolist(), self.sums.tolist(), strict=True))
            exact[i] = exact[i] if exact[i] < 2 ** 63 else None
        return exact


def integer_blocks(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(ids, width, cells): up to 1,000 rows each, the integers floor(1024 c) + 100000 as
    one row-major matrix of 64-bit numbers, so that later passes decode nothing."""
    rows = only(vectors, **{id_col: "vec_id", vector_col: "vector"}).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector")).where(
        f"vector is not null and size(vector) > 0 and forall(vector, x -> x is not null and abs(x) < {LARGEST}D)")
    cells = rows.select("vec_id", F.expr(f"transform(vector, x -> bigint(floor({SCALE}D * x)) + {SHIFT}L)").alias("cells"))

    def pack(batch: pa.RecordBatch) -> dict | None:
        if not batch.num_rows:
            return None
        column = batch.column("cells")
        widths = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy()
        if (widths != widths[0]).any():
            raise ValueError("vectors differ in length")
        return {"ids": [batch.column("vec_id").to_pylist()], "width": [int(widths[0])], "cells": [flat.astype("<i8").tobytes()]}

    return arrow_pass(cells, pack, "ids array<long>, width int, cells binary")


def _matrix(content: bytes, width: int) -> np.ndarray:
    return np.frombuffer(content, "<i8").reshape(-1, width)


def _totals(blocks: DataFrame, width: int, fn: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum of ``fn(matrix)`` over all blocks: summed within a task, then by Spark, cell by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for content in batch.column("cells"):
                part = fn(_matrix(content.as_py(), width))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["at", "cell"])

    rows = blocks.select("cells").mapInArrow(run, f"at int, cell {kind}").groupBy("at").agg(F.sum("cell").alias("cell")).collect()
    out = np.zeros(len(rows), np.int64 if kind == "long" else np.float64)
    for r in rows:
        out[r["at"]] = r["cell"]
    return out


class _Lanczos:
    """State of the bidiagonalisation: X V = U R with orthonormal columns, R upper
    bidiagonal up to rounding. Everything here is as wide as a vector or as the number
    of steps. The left vectors are as long as the table, so they are never stored: a
    task gets its rows of U from its rows of X as (X V) R^-1."""

    def __init__(self, blocks: DataFrame, model: Whitening):
        width = len(model.sums)
        self.blocks, self.model, self.width = blocks, model, width
        self.V, self.R, self.A = np.empty((width, 0)), np.empty((0, 0)), np.empty((width, 0))
        self.random = np.random.default_rng(0)
        self.scale = np.sqrt(model.n * model.trace)

    def _left(self, v: np.ndarray, c: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """For p = X v - U c: the square of its length, U'p and X'p, in one pass."""
        V, R, model = self.V, self.R, self.model
        k = V.shape[1]

        def part(cells: np.ndarray) -> np.ndarray:
            x = model.centred(cells)
            p = x @ v
            if not k:
                return np.concatenate([[p @ p], p @ x])
            u = np.linalg.solve(R.T, (x @ V).T).T
            p -= u @ c
            return np.concatenate([[p @ p], u.T @ p, p @ x])

        total = _totals(self.blocks, self.width, part)
        return float(total[0]), total[1:k + 1], total[k + 1:]

    def _off(self, w: np.ndarray) -> np.ndarray:
        """w without its part along V, twice for the sake of rounding."""
        for _ in range(2):
            w = w - self.V @ (self.V.T @ w)
        return w

    def fresh(self) -> np.ndarray | None:
        """A unit vector of X's row space off all of V; None if nothing is left there."""
        r = self._off(self.random.normal(size=self.width))
        saved, self.V, self.R, self.A = (self.V, self.R, self.A), self.V[:, :0], self.R[:0, :0], self.A[:, :0]
        _, _, y = self._left(r / (np.linalg.norm(r) or 1.0), np.empty(0))
        self.V, self.R, self.A = saved
        y = self._off(y)
        size = np.linalg.norm(y)
        return None if size <= NEGLIGIBLE * self.scale ** 2 else self._off(y / size)

    def step(self, v: np.ndarray, beta: float) -> tuple[np.ndarray, float]:
        """Take in v: u = Xv less all earlier u, then X'u less all v gives the next v and
        its length."""
        v = v / np.linalg.norm(v)
        k = self.V.shape[1]
        c = np.zeros(k)
        if k:
            c[-1] = beta
        while True:
            square, g, back = self._left(v, c)
            c = c + g
            left = square - g @ g
            if left >= 0.5 * square:
                break  # else rounding is as large as what is left: again, from the start
            if square <= (NEGLIGIBLE * self.scale) ** 2:
                break
        alpha = np.sqrt(max(left, 0.0))
        a = (back - self.A @ g) / (alpha or 1.0)
        R = np.zeros((k + 1, k + 1))
        R[:k, :k], R[:k, k], R[k, k] = self.R, c, alpha
        self.R, self.V, self.A = R, np.column_stack([self.V, v]), np.column_stack([self.A, a])
        w = self._off(a - alpha * v)
        return w, float(np.linalg.norm(w))

    def solve(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Right vectors, singular values, and the last entries of the left vectors."""
        left, s, right = np.linalg.svd(self.R)
        return self.V @ right.T, s, left[-1]


def fit_whitening(blocks: DataFrame, components: int = 8) -> Whitening | None:
    """The leading components over all blocks of ``integer_blocks``; None without rows.

    Steps end when the wanted components have settled and neither the next one found nor
    the variance not yet seen could hold a larger one, at the latest after as many steps
    as a vector has entries. A step is one pass over the blocks."""
    first = blocks.agg(F.min("width"), F.max("width"), F.sum(F.size("ids"))).first()
    if not first[2]:
        return None
    if first[0] != first[1]:
        raise ValueError("vectors differ in length")
    width, n = first[0], first[2]
    sums = _totals(blocks, width, lambda m: m.sum(axis=0), "long")
    base = sums // n
    rest = (sums - base * n) / n
    empty = Whitening(n, sums, base, rest, np.empty((width, 0)), np.empty(0), 0.0)
    squares = _totals(blocks, width, lambda m: np.square(empty.centred(m)).sum(axis=0))
    trace = float(squares.sum() / n)
    start = Whitening(n, sums, base, rest, np.empty((width, 0)), np.empty(0), trace)
    if trace == 0:
        return start
    state = _Lanczos(blocks, start)
    v, beta = state.fresh(), 0.0
    while v is not None:
        w, beta = state.step(v, beta)
        k = state.V.shape[1]
        if k == width:
            break
        if k > components:
            _, s, last = state.solve()
            e = s * s / n
            unseen = max(trace - e.sum(), 0.0)
            settled = beta * np.abs(last[:components]).max() <= 1e-14 * s[0]
            if settled and e[components] + unseen < e[components - 1]:
                break
        if beta <= NEGLIGIBLE * state.scale:
            v, beta = state.fresh(), 0.0
        else:
            v = w / beta
    vectors, s, _ = state.solve()
    real = (s > NEGLIGIBLE * s[0])[:components]
    vectors, s = vectors[:, :components][:, real], s[:components][real]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(s))])
    return Whitening(n, sums, base, rest, vectors * signs, s * s / n, trace)


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    k, width = len(model.values), len(model.sums)
    mean = _totals(blocks, width, lambda m: model.whitened(m).sum(axis=0)) / model.n

    def products(cells: np.ndarray) -> np.ndarray:
        w = model.whitened(cells) - mean
        return (w.T @ w).ravel()

    return float(np.abs(_totals(blocks, width, products).reshape(k, k) / model.n - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): each row's
    coordinates along the leading components of all rows, with unit variance.

    Entries count as floor(1024 c) + 100000. Rows whose vector is null or empty or holds
    a null, a non-finite entry or one of 2^40 or more are left out. All vectors must have
    the same length. Rows that repeat an id, or have none, count each. A deviation that
    64 bits can't hold is null. Components without variance (below 1e-12 of the largest
    deviation) don't exist: equal rows give none, nor does an empty table. The sign of a
    component makes its largest entry positive."""
    blocks = durable(integer_blocks(vectors, id_col, vector_col))
    model = fit_whitening(blocks, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        forget(blocks)
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(blocks, model)
    k, width = len(model.values), len(model.sums)
    explained = model.values / model.trace

    def rows(batch: pa.RecordBatch) -> dict:
        ids, away, white = [], [], []
        for r in batch.to_pylist():
            cells = _matrix(r["cells"], width)
            ids += r["ids"]
            away += model.deviations(cells)
            white.append(model.whitened(cells))
        white, m = np.concatenate(white), len(ids)
        take = np.repeat(np.arange(m), k)
        return {"vec_id": pa.array(ids, pa.int64()).take(pa.array(take)), "component": np.tile(np.arange(1, k + 1), m),
                "n": np.full(m * k, model.n), "deviation": pa.array(away, pa.int64()).take(pa.array(take)),
                "whitened": white.ravel(), "explained": np.tile(explained, m), "identity_error": np.full(m * k, error)}

    return arrow_pass(blocks.select("ids", "cells"), rows, schema, at_once=16)
