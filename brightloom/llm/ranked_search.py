"""Ranked lexical search: branch and bound over frequency-ordered trees of documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brightloom.runtime import durable

from .common import arrow_pass, forget, only, texts_of

#: (item, term) pairs that one pass over the documents answers; they go to every task. A
#: single item with more is a pass of its own.
GROUP_PAIRS = 1 << 18
#: Documents of a tree, leaves below which a subtree is not told apart, children and items scored at once.
TREE_DOCS, LEAST_LEAVES, CHILDREN, ITEMS = 4096, 16, 256, 256
#: Scores are summed in doubles; beyond this sum they would not be exact.
EXACT = 2 ** 53

_SPACED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, A-Z lowered."""
    return text.translate(_SPACED).split()


def term_weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def gains(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score: grows with tf, falls with m."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


@dataclass
class Items:
    """Queries of one pass: their terms, numbered from 0."""
    ids: list = field(default_factory=list)
    terms: list[list[bytes]] = field(default_factory=list)
    pairs: int = 0

    def vocabulary(self) -> dict[bytes, int]:
        return {t: i for i, t in enumerate(sorted({t for terms in self.terms for t in terms}))}


def item_groups(items: DataFrame, id_col: str, text_col: str, pairs: int = GROUP_PAIRS) -> Iterator[Items]:
    """The queries in groups of at most `pairs` (item, term) pairs, one group at a time."""

    def split(batch: pa.RecordBatch) -> dict:
        return {"item_id": batch.column("item_id"), "terms": [list(dict.fromkeys(terms_of(t))) for t in texts_of(batch)]}

    rows = arrow_pass(only(items, **{id_col: "item_id", text_col: "text"}).select(F.col("item_id").cast("long"), "text"),
                      split, "item_id long, terms array<binary>")
    group = Items()
    for row in rows.toLocalIterator():
        terms = [bytes(t) for t in row["terms"]]
        if not terms:
            continue
        if group.ids and group.pairs + len(terms) > pairs:
            yield group
            group = Items()
        group.ids.append(row["item_id"])
        group.terms.append(terms)
        group.pairs += len(terms)
    if group.ids:
        yield group


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tf): per document with a term, its length and those of its terms
    that any query has."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batch: pa.RecordBatch) -> dict:
        vocabulary = known.value
        ids, lengths, terms, tfs = [], [], [], []
        for key, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
            words = terms_of(text)
            if words:
                held = [(vocabulary[w], n) for w, n in Counter(words).items() if w in vocabulary]
                ids.append(key)
                lengths.append(len(words))
                terms.append(np.array([t for t, _ in held], "<i4").tobytes())
                tfs.append(np.array([n for _, n in held], "<i4").tobytes())
        return {"doc_id": ids, "n": lengths, "terms": terms, "tf": tfs}

    return arrow_pass(only(docs, **{id_col: "doc_id", text_col: "text"}).select(F.col("doc_id").cast("long"), "text"),
                      count, "doc_id long, n long, terms binary, tf binary")


def document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term: counted within a task, summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            flat = b"".join(batch.column("terms").to_pylist())
            total += np.bincount(np.frombuffer(flat, "<i4"), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["term", "df"])

    out = np.zeros(size, np.int64)
    for row in vectors.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out


def ordered_vectors(vectors: DataFrame, order: np.ndarray, n_docs: int, total: int) -> DataFrame:
    """(doc_id, m, path, tf): each vector in order of falling document frequency. The path
    is big-endian, so that Spark's order of bytes is the order of the tree."""

    def arrange(batch: pa.RecordBatch) -> dict:
        paths, tfs = [], []
        for terms, tf in zip(batch.column("terms").to_pylist(), batch.column("tf").to_pylist(), strict=True):
            path = order[np.frombuffer(terms, "<i4")]
            by = np.argsort(path)
            paths.append(path[by].astype(">i4").tobytes())
            tfs.append(np.frombuffer(tf, "<i4")[by].tobytes())
        m = 50 + (50 * n_docs * batch.column("n").to_numpy()) // total
        return {"doc_id": batch.column("doc_id"), "m": m, "path": paths, "tf": tfs}

    return arrow_pass(vectors, arrange, "doc_id long, m long, path binary, tf binary")


@dataclass
class Node:
    """Part of a tree: its children's terms with the largest gain that any document below
    a child can have from them, as (child, term, gain). Children from `inner` on are nodes."""
    child: np.ndarray
    term: np.ndarray
    gain: np.ndarray
    leaves: list[int]
    inner: list[Node]


@dataclass
class _Part:
    """What a parent needs of a subtree while it is built."""
    leaves: list[int]
    terms: np.ndarray
    tf: np.ndarray
    m: int
    node: Node | None


class Tree:
    """A compressed trie over the frequency-ordered vectors of consecutive documents.

    Documents with equal vectors are one leaf. An inner node stands where paths part and
    keeps, over its subtree, each term's largest tf and the least m: with both, the gain
    formula bounds every document below. Subtrees of few leaves hang as leaves from their
    parent, where they are scored at once."""

    def __init__(self, ids: list[int], m: np.ndarray, paths: list[bytes], tfs: list[bytes], weight: np.ndarray, keep: int):
        self.weight, self.ids = weight, []
        self.m, self.terms, self.tf = [], [], []
        starts: list[int] = []
        last = None
        for key, mm, path, tf in sorted(zip(ids, m.tolist(), paths, tfs, strict=True), key=lambda r: (r[2], r[3], r[1], r[0])):
            if (mm, path, tf) == last:
                if len(self.ids[-1]) < keep:
                    self.ids[-1].append(key)
                continue
            starts.append(0 if last is None else _common(last[1], path))
            last = mm, path, tf
            self.ids.append([key])
            self.m.append(mm)
            self.terms.append(np.frombuffer(path, ">i4").astype(np.int64))
            self.tf.append(np.frombuffer(tf, "<i4").astype(np.int64))
        self.root = self._build(starts)

    def _leaf(self, at: int) -> _Part:
        return _Part([at], self.terms[at], self.tf[at], self.m[at], None)

    def _build(self, starts: list[int]) -> Node | None:
        """`starts`: how many terms each leaf shares with the one before it."""
        if not starts:
            return None
        open_: list[tuple[int, list[_Part]]] = [(0, [])]
        for at in range(len(starts)):
            depth = starts[at + 1] if at + 1 < len(starts) else 0
            part = self._leaf(at)
            if depth > open_[-1][0]:
                open_.append((depth, [part]))
                continue
            open_[-1][1].append(part)
            while open_[-1][0] > depth:
                part = self._join(open_.pop()[1])
                if open_[-1][0] < depth:
                    open_.append((depth, []))
                open_[-1][1].append(part)
        return self._node(open_[0][1])

    def _join(self, parts: list[_Part]) -> _Part:
        """One part from siblings; large ones keep a node."""
        terms, tf = np.concatenate([p.terms for p in parts]), np.concatenate([p.tf for p in parts])
        order = np.argsort(terms, kind="stable")
        terms, tf = terms[order], tf[order]
        first = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]][:len(terms)])
        leaves = [x for p in parts for x in p.leaves]
        node = None
        if len(leaves) >= LEAST_LEAVES or any(p.node for p in parts):
            node, leaves = self._node(parts), []
        return _Part(leaves, terms[first], np.maximum.reduceat(tf, first) if len(first) else tf, min(p.m for p in parts), node)

    def _node(self, parts: list[_Part]) -> Node:
        leaves = [x for p in parts for x in p.leaves]
        inner = [p for p in parts if p.node]
        terms = [self.terms[x] for x in leaves] + [p.terms for p in inner]
        tf = [self.tf[x] for x in leaves] + [p.tf for p in inner]
        m = np.array([self.m[x] for x in leaves] + [p.m for p in inner], np.int64)
        child = np.repeat(np.arange(len(m)), [len(t) for t in terms])
        term, tf = np.concatenate(terms), np.concatenate(tf)
        return Node(child, term, gains(self.weight[term], tf, m[child]), leaves, [p.node for p in inner])


def _common(a: bytes, b: bytes) -> int:
    """Terms that two paths share from the start."""
    x, y = np.frombuffer(a, ">i4"), np.frombuffer(b, ">i4")
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


class Search:
    """The best documents of each item so far, from one tree after another."""

    def __init__(self, item_terms: list[np.ndarray], size: int, k: int):
        self.k, n = k, len(item_terms)
        self.scores = [np.empty(0, np.int64)] * n
        self.docs = [np.empty(0, np.int64)] * n
        self.least = np.ones(n)  # below it no score is among the k best
        self.has = np.zeros((size, n), bool)
        for item, terms in enumerate(item_terms):
            self.has[terms, item] = True

    def add(self, tree: Tree) -> None:
        """Depth first: a subtree is entered with just those items whose bound reaches
        their k-th score, subtrees of larger bounds before others."""
        if tree.root is None:
            return
        for start in range(0, len(self.least), ITEMS):
            todo = [(tree.root, np.arange(start, min(start + ITEMS, len(self.least))), None)]
            while todo:
                node, items, bound = todo.pop()
                if bound is not None:
                    items = items[bound >= self.least[items]]
                if len(items):
                    todo += self._enter(tree, node, items)

    def _enter(self, tree: Tree, node: Node, items: np.ndarray) -> list[tuple[Node, np.ndarray, np.ndarray]]:
        below = []
        size = len(node.leaves) + len(node.inner)
        cuts = np.searchsorted(node.child, np.arange(0, size + CHILDREN, CHILDREN))
        for at, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            first = at * CHILDREN
            n = min(CHILDREN, size - first)
            if n <= 0:
                break
            terms, column = np.unique(node.term[a:b], return_inverse=True)
            gain = np.zeros((n, len(terms)))
            gain[node.child[a:b] - first, column] = node.gain[a:b]
            scores = gain @ self.has[np.ix_(terms, items)].astype(np.float64)
            leaves = max(0, min(n, len(node.leaves) - first))
            if leaves:
                self._take(tree, node.leaves[first:first + leaves], items, scores[:leaves])
            below += [(node.inner[first + c - len(node.leaves)], items, scores[c]) for c in range(leaves, n)]
        return sorted(below, key=lambda entry: entry[2].sum())

    def _take(self, tree: Tree, leaves: list[int], items: np.ndarray, scores: np.ndarray) -> None:
        at, leaf = np.nonzero((scores >= self.least[items]).T)
        if not len(at):
            return
        found, start = np.unique(at, return_index=True)
        for i, a, b in zip(found, start, [*start[1:], len(at)], strict=True):
            held = [tree.ids[leaves[x]] for x in leaf[a:b]]
            new = np.repeat(scores[leaf[a:b], i].astype(np.int64), [len(h) for h in held])
            self._keep(items[i], new, np.concatenate([np.array(h, np.int64) for h in held]))

    def _keep(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        scores, docs = np.concatenate([self.scores[item], scores]), np.concatenate([self.docs[item], docs])
        best = np.lexsort((docs, -scores))[:self.k]
        self.scores[item], self.docs[item] = scores[best], docs[best]
        if len(best) == self.k:
            self.least[item] = max(1, scores[best[-1]])


def _search_group(docs: DataFrame, group: Items, k: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    schema = "item int, item_id long, doc_id long, score long"
    vocabulary = group.vocabulary()
    vectors = durable(restricted_vectors(docs, vocabulary, id_col, text_col))
    n_docs, total = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        forget(vectors)
        return spark.createDataFrame([], schema)
    df = document_frequencies(vectors, len(vocabulary))
    by_frequency = np.argsort(-df, kind="stable")
    order = np.empty(len(df), np.int64)
    order[by_frequency] = np.arange(len(df))
    weight = np.array([term_weight(n_docs, int(x)) for x in df[by_frequency]], np.int64)
    if group.pairs and max(len(t) for t in group.terms) * int(weight.max()) * 1_000_000 >= EXACT:
        raise ValueError("an item has too many terms for exact scores")
    shared = spark.sparkContext.broadcast((group.ids, [order[[vocabulary[t] for t in terms]] for terms in group.terms], weight))
    parts = max(1, -(-n_docs // (4 * TREE_DOCS)))
    # A document without any of the terms has no score; one without an id has no place.
    rows = ordered_vectors(vectors, order, n_docs, total).where("doc_id is not null and length(path) > 0")
    sliced = rows.repartitionByRange(parts, "path", "doc_id").sortWithinPartitions("path", "doc_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, weight = shared.value
        state = None
        for batch in batches:
            state = state or Search(terms, len(weight), k)
            for at in range(0, batch.num_rows, TREE_DOCS):
                b = batch.slice(at, TREE_DOCS)
                state.add(Tree(b.column("doc_id").to_pylist(), b.column("m").to_numpy(), b.column("path").to_pylist(),
                               b.column("tf").to_pylist(), weight, k))
        if state is None:
            return
        counts = [len(s) for s in state.scores]
        item = np.repeat(np.arange(len(ids)), counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(ids, pa.int64()).take(pa.array(item)),
             pa.array(np.concatenate(state.docs)), pa.array(np.concatenate(state.scores))], ["item", "item_id", "doc_id", "score"])

    found = durable(sliced.mapInArrow(search, schema))
    forget(vectors)
    return found


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", query_col: str = "text", pairs: int = GROUP_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` documents of highest score above 0 for each
    item, equal scores by ascending id; exact.

    The documents' vectors, restricted to the terms of a group of items, are ordered by
    document frequency and range-partitioned, so that documents with a common beginning
    meet in one tree. A task goes through its trees one after another; what it found in
    one bounds the next. Of each task only the `k` best of an item leave it.

    Null and empty texts hold no term and count nowhere. Documents without an id count in
    the statistics and are not listed; rows that repeat an id count each. Items without a
    term, or without a document that holds one, have no rows; repeated items have their
    rows each. Other columns play no part, empty tables give no rows."""
    out = None
    for number, group in enumerate(item_groups(items, item_col, query_col, pairs)):
        found = _search_group(docs, group, k, id_col, text_col).withColumn("group", F.lit(number))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rank = F.expr("row_number() OVER (PARTITION BY `group`, item ORDER BY score DESC, doc_id)").cast("int")
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
