"""Forests over a table that fits one task: every task holds the table and grows some of the trees.

Spark's own forests deal out the rows and grow all trees together, a job per level, which is
right for many rows and takes most of its time in the driver for few. Trees are grown here by
the same rules: up to MAX_BINS bins per feature with Spark's thresholds, at every node the
split of a random subset of features with the greatest reduction of the variance, leaves of
`min_leaf` draws at least. A tree's draws and subsets follow from the seed, its number and its
rows alone, so a forest is the beginning of any larger one with the same other parameters,
wherever its trees are grown.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

MAX_BINS = 32
ITEMS = 200_000  # rows times trees that are grown together
SHARES = 16  # of a forest, at most so many tasks


@dataclass(frozen=True)
class Growth:
    """What trees of one forest have in common."""

    max_depth: int
    min_leaf: int
    subset: str
    bootstrap: bool
    seed: int

    def features(self, p: int) -> int:
        """How many of `p` features a node looks at."""
        return {"all": p, "sqrt": math.ceil(math.sqrt(p)), "onethird": math.ceil(p / 3)}[self.subset]


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 mixed bits of each number (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(*parts: np.ndarray | int) -> np.ndarray:
    mixed = np.zeros(1, "uint64")
    for part in parts:
        mixed = _mixed(mixed + np.asarray(part).astype("uint64") + np.uint64(0x9E3779B97F4A7C15))
    return mixed


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


def _draws(growth: Growth, trees: np.ndarray, rows: int) -> np.ndarray:
    """How often each tree takes each row."""
    if not growth.bootstrap:
        return np.ones((len(trees), rows))
    mixed = _hashed(growth.seed, 1, trees[:, None], np.arange(rows)[None, :])
    return np.searchsorted(_POISSON, (mixed >> np.uint64(11)) * 2.0**-53).astype(float)


def thresholds(values: np.ndarray) -> np.ndarray:
    """Where a feature may be split: between all its values, or between about equal parts of the rows."""
    kinds, counts = np.unique(values, return_counts=True)
    middles = (kinds[1:] + kinds[:-1]) / 2
    bins = min(MAX_BINS, len(values))
    if len(middles) < bins:
        return middles
    stride, upto = len(values) / bins, np.cumsum(counts)
    kept, target = [], stride
    for i in range(1, len(kinds)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            kept.append(middles[i - 1])
            target += stride
    return np.array(kept)


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """By feature and row, how many thresholds lie below the value."""
    return np.array([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], "int64").reshape(len(cuts), len(x))


@dataclass
class Trees:
    """Nodes of many trees: the first ones are the roots. `left`: the child for values up to
    the threshold of that place, the other child follows it; -1 at a leaf."""

    feature: np.ndarray
    place: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: int

    def predict(self, bins: np.ndarray, depth: int | None = None) -> np.ndarray:
        """Sum of all trees' predictions for each row, as if they had stopped growing at `depth`:
        splits are chosen level by level, so a tree of less depth is the top of a deeper one."""
        rows = bins.shape[1]
        total, step = np.zeros(rows), max(1, ITEMS // max(1, rows))
        for first in range(0, self.roots, step):
            at = np.repeat(np.arange(first, min(first + step, self.roots)), rows)
            row = np.tile(np.arange(rows), min(step, self.roots - first))
            for level in count():
                if not len(at):
                    break
                left = self.left[at]
                ended = (left < 0) | (level == depth)
                total += np.bincount(row[ended], self.value[at[ended]], rows)
                at, row, left = at[~ended], row[~ended], left[~ended]
                at = left + (bins[self.feature[at], row] > self.place[at])
        return total


def _variance(w: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Variance from the sums of weights, values and squares, rounded as Spark does: that decides between equal splits."""
    w = np.maximum(w, 1)
    return (q - s * s / w) / w


def grow(bins: np.ndarray, kinds: list[int], y: np.ndarray, growth: Growth, trees: np.ndarray) -> Trees:
    """The trees of these numbers over rows with `bins` by feature and row, all grown level by
    level together. `kinds`: number of bins of each feature."""
    p, rows = bins.shape
    drawn = _draws(growth, trees, rows)
    tree, row = np.nonzero(drawn)
    weight = drawn[tree, row]
    node = tree  # of each item among the nodes of the level
    tree_of, path = trees.astype("uint64"), np.ones(len(trees), "uint64")
    subset = growth.features(p)
    made: list[list[np.ndarray]] = []
    begin = 0  # number of the level's first node
    for depth in range(growth.max_depth + 1):
        n = len(tree_of)
        if not n:
            break
        wy = weight * y[row]
        wyy = wy * y[row]
        w, s, q = (np.bincount(node, v, n) for v in (weight, wy, wyy))
        spread = _variance(w, s, q)
        feature, place, left = np.full(n, -1, "int16"), np.zeros(n, "int16"), np.full(n, -1, "int32")
        value = np.divide(s, w, out=np.full(n, y.mean()), where=w > 0)
        made.append([feature, place, left, value])
        open_ = (w >= 2 * growth.min_leaf) & (w > 1) & (spread > 1e-16 + 1e-14 * q)
        if depth == growth.max_depth or not open_.any():
            break
        if subset < p:
            ranks = _hashed(growth.seed, 2, tree_of[:, None], path[:, None], np.arange(p)[None, :])
            looked = np.argpartition(ranks, subset - 1, axis=1)[:, :subset]
            mask = np.zeros((n, p), bool)
            np.put_along_axis(mask, looked, True, axis=1)
            mask &= open_[:, None]
        else:
            mask = np.repeat(open_[:, None], p, axis=1)
        best = 1e-14 * spread
        for f in range(p):
            here = np.flatnonzero(mask[:, f])
            if kinds[f] < 2 or not len(here):
                continue
            number = np.full(n, -1)
            number[here] = np.arange(len(here)) * kinds[f]
            cell = number[node]
            there = np.flatnonzero(cell >= 0)
            cell = cell[there] + bins[f, row[there]]
            size = len(here) * kinds[f]
            upto = [np.bincount(cell, v[there], size).reshape(-1, kinds[f]).cumsum(1) for v in (weight, wy, wyy)]
            left_ = [u[:, :-1] for u in upto]
            right = [u[:, -1:] - u[:, :-1] for u in upto]
            least = max(growth.min_leaf, 1)
            whole = upto[0][:, -1:]
            gain = spread[here, None] - left_[0] / whole * _variance(*left_) - right[0] / whole * _variance(*right)
            gain[(left_[0] < least) | (right[0] < least)] = -np.inf
            at = gain.argmax(1)
            top = gain[np.arange(len(here)), at]
            better = top > best[here]
            to = here[better]
            best[to], feature[to], place[to] = top[better], f, at[better]
        split = np.flatnonzero(feature >= 0)
        left[split] = begin + n + 2 * np.arange(len(split))
        child = np.full(n, -1)
        child[split] = 2 * np.arange(len(split))
        node_child = child[node]
        on = node_child >= 0
        row, weight, node, node_child = row[on], weight[on], node[on], node_child[on]
        node = node_child + (bins[feature[node], row] > place[node])
        tree_of = np.repeat(tree_of[split], 2)
        path = np.repeat(path[split] * np.uint64(2), 2)
        path[1::2] += np.uint64(1)
        begin += n
    return Trees(*[np.concatenate(parts) for parts in zip(*made)], len(trees))


def _blocks(first: int, last: int, rows: int) -> Iterator[np.ndarray]:
    step = max(1, ITEMS // max(1, rows))
    for at in range(first, last, step):
        yield np.arange(at, min(at + step, last))


def _in_order(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows by their values, so that their order in a table plays no part."""
    return np.lexsort([*x.T, y])


def _deal(spark, jobs: list[tuple], fn, schema: str) -> list:
    """Rows that `fn` makes of each job (a list of numbers), the longest jobs dealt evenly."""
    table = spark.createDataFrame([(list(map(int, j)),) for j in jobs], "job array<long>")
    parts = min(len(jobs), 2 * spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for job in batch["job"]:
                yield fn(*job)

    return table.repartition(parts).mapInPandas(run, schema).collect()


def _shares(sizes: list[int]) -> list[tuple[int, int]]:
    """Parts of the largest forest; each size is the end of one."""
    most = max(sizes)
    ends = sorted({*sizes, *range(-(-most // SHARES), most, -(-most // SHARES))})
    return list(zip([0, *ends], ends))


def held_out_predictions(spark, x: np.ndarray, y: np.ndarray, fold: np.ndarray, folds: int,
                         forests: list[tuple[Growth, int]]) -> list[list[np.ndarray]]:
    """By forest (growth, number of trees) and fold: the mean of the trees grown on the other
    folds, for the rows of the fold. Forests with the same growth share their first trees."""
    growths = list(dict.fromkeys(g for g, _ in forests))
    shares = {g: _shares([n for other, n in forests if other == g]) for g in growths}
    jobs = [(i, k, a, b) for i, g in enumerate(growths) for k in range(folds) for a, b in shares[g]]

    def grown(i: int, k: int, a: int, b: int) -> pd.DataFrame:
        there = np.flatnonzero(fold != k)
        there = there[_in_order(x[there], y[there])]
        cuts = [thresholds(x[there, f]) for f in range(x.shape[1])]
        bins, asked = _binned(x[there], cuts), _binned(x[fold == k], cuts)
        total = np.zeros(asked.shape[1])
        for block in _blocks(a, b, len(there)):
            total += grow(bins, [len(c) + 1 for c in cuts], y[there], growths[i], block).predict(asked)
        return pd.DataFrame({"at": [i], "fold": [k], "upto": [b], "total": [total.tolist()]})

    sums = {(r["at"], r["fold"], r["upto"]): np.array(r["total"])
            for r in _deal(spark, jobs, grown, "at int, fold int, upto int, total array<double>")}
    return [[sum(sums[growths.index(g), k, b] for _, b in shares[g] if b <= n) / n for k in range(folds)] for g, n in forests]


def held_out_depths(spark, x: np.ndarray, y: np.ndarray, fold: np.ndarray, folds: int,
                    trees: list[tuple[Growth, list[int]]]) -> list[list[list[np.ndarray]]]:
    """By tree, fold and depth: predictions for the rows of the fold of a tree grown on the others."""
    def grown(i: int, k: int) -> pd.DataFrame:
        growth, depths = trees[i]
        there = np.flatnonzero(fold != k)
        there = there[_in_order(x[there], y[there])]
        cuts = [thresholds(x[there, f]) for f in range(x.shape[1])]
        tree = grow(_binned(x[there], cuts), [len(c) + 1 for c in cuts], y[there], growth, np.arange(1))
        asked = _binned(x[fold == k], cuts)
        return pd.DataFrame({"at": i, "fold": k, "depth": depths, "values": [tree.predict(asked, d).tolist() for d in depths]})

    jobs = [(i, k) for i in range(len(trees)) for k in range(folds)]
    found = {(r["at"], r["fold"], r["depth"]): np.array(r["values"])
             for r in _deal(spark, jobs, grown, "at int, fold int, depth int, values array<double>")}
    return [[[found[i, k, d] for d in depths] for k in range(folds)] for i, (_, depths) in enumerate(trees)]


@dataclass(frozen=True)
class Packed:
    """`Trees` in a third of the space: values of leaves only, and children follow from the
    number of splits before a node."""

    roots: int
    feature: bytes
    place: bytes
    value: bytes

    @staticmethod
    def of(trees: Trees) -> Packed:
        leaf = trees.left < 0
        return Packed(trees.roots, trees.feature.tobytes(), trees.place[~leaf].astype("int8").tobytes(), trees.value[leaf].tobytes())

    def trees(self) -> Trees:
        feature = np.frombuffer(self.feature, "int16")
        split = feature >= 0
        place, left, value = np.zeros(len(split), "int8"), np.full(len(split), -1, "int32"), np.zeros(len(split))
        place[split], value[~split] = np.frombuffer(self.place, "int8"), np.frombuffer(self.value)
        left[split] = self.roots + 2 * np.arange(split.sum())
        return Trees(feature, place, left, value, self.roots)


class ForestModel:
    """A forest as node tables and thresholds; `transform` adds ``prediction``. The nodes are
    in a broadcast, of which the driver's Python keeps no copy."""

    def __init__(self, spark, cuts: list[np.ndarray], parts: list[Packed], trees: int):
        self.cuts, self.trees = cuts, trees
        self.parts = spark.sparkContext.broadcast(parts)

    def transform(self, df: DataFrame) -> DataFrame:
        cuts, trees, parts = self.cuts, self.trees, self.parts

        @F.pandas_udf("double")
        def predicted(features: pd.Series) -> pd.Series:
            bins = _binned(np.array(features.tolist(), float).reshape(len(features), len(cuts)), cuts)
            return pd.Series(sum((part.trees().predict(bins) for part in parts.value), np.zeros(len(features))) / trees)

        return df.withColumn("prediction", predicted(vector_to_array("features")))


def fit(spark, x: np.ndarray, y: np.ndarray, growth: Growth, trees: int) -> ForestModel:
    order = _in_order(x, y)
    x, y = x[order], y[order]
    cuts = [thresholds(x[:, f]) for f in range(x.shape[1])]

    def grown(a: int, b: int) -> pd.DataFrame:
        bins = _binned(x, cuts)
        parts = [Packed.of(grow(bins, [len(c) + 1 for c in cuts], y, growth, block)) for block in _blocks(a, b, len(y))]
        return pd.DataFrame([{"first": a, "block": i, **vars(part)} for i, part in enumerate(parts)])

    rows = _deal(spark, _shares([trees]), grown, "first int, block int, roots int, feature binary, place binary, value binary")
    parts = [Packed(r["roots"], bytes(r["feature"]), bytes(r["place"]), bytes(r["value"]))
             for r in sorted(rows, key=lambda r: (r["first"], r["block"]))]
    return ForestModel(spark, cuts, parts, trees)
