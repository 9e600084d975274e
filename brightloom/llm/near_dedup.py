"""Near-duplicate classes from an inverted join over MinHash coordinates."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from brightloom.runtime import durable

from .common import ODD, arrow_pass, as_long, forget, grouped_pass, only, texts_of, window_hashes, word_hashes
from .components import components

WIDTH = 5
COORDINATES = 96
#: Share of the pairs with just the similarity asked for that may agree in fewer coordinates than are called for.
MISSED = 2e-5
#: Slots of the table that estimates how common a coordinate-value pair is. Its size does not grow with the data.
SLOT_BITS = 20
#: Nodes of a list, by side, that are compared in one piece of work.
BLOCK = 2048
#: Whole sets, by side, that are compared in one piece of work: nodes and shingles, about.
CELL, CELL_SHINGLES = 1024, 1_000_000


def least_matches(percent: int) -> int:
    """Coordinates in which two sets of a similarity of `percent` hundredths agree, all but MISSED of such pairs."""
    p, below, matches = percent / 100, 0.0, 0
    while matches < COORDINATES:
        below += math.comb(COORDINATES, matches) * p ** matches * (1 - p) ** (COORDINATES - matches)
        if below > MISSED:
            break
        matches += 1
    return max(matches, 1)


_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of A-Z-lowered `text`; a shorter
    text gives one hash of all its words, a text without words none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    if len(words) < WIDTH:
        return window_hashes(h, len(words), seed=len(words))
    return np.unique(window_hashes(h, WIDTH))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each coordinate's hash over the set."""
    x = np.empty((COORDINATES, len(shingles)), np.uint64)
    np.multiply(_FACTORS[:, None], shingles[None, :], out=x)
    x += _OFFSETS[:, None]
    return (x.min(axis=1) >> np.uint64(32)).astype(np.uint32)


def _fingerprint(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _describe(batch: pa.RecordBatch) -> dict:
    """One row per document. Texts that repeat within a batch are worked on once."""
    seen: dict[bytes, tuple] = {}
    sets, sizes, signatures = [], [], []
    for text in texts_of(batch):
        got = seen.get(text)
        if got is None:
            s = shingle_set(text)
            got = (_fingerprint(s), len(s), signature(s).tobytes()) if len(s) else (None, 0, None)
            seen[text] = got
        sets.append(got[0])
        sizes.append(got[1])
        signatures.append(got[2])
    return {"doc_id": batch.column("doc_id"), "key": batch.column("key"), "set_id": sets, "n": sizes,
            "signature": signatures}


def _tokens(signatures: list[bytes]) -> np.ndarray:
    """64-bit tokens of the coordinate-value pairs, one row per signature."""
    values = np.frombuffer(b"".join(signatures), np.uint32).reshape(-1, COORDINATES).astype(np.uint64)
    x = values | (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32))
    x = (x + np.uint64(0x632BE59BD9B4E019)) * ODD
    x ^= x >> np.uint64(31)
    return x * np.uint64(0xD6E8FEB86659FD93)


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _commonness(nodes: DataFrame):
    """Estimated number of sets behind each slot, in a broadcast of fixed size."""

    def count(batches):
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_slots(_tokens(batch.column("signature").to_pylist())).ravel(),
                                     minlength=1 << SLOT_BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])

    rows = (nodes.select("signature").mapInArrow(count, "slot long, n long")
            .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())
    table = np.zeros(1 << SLOT_BITS, np.float32)
    table[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return nodes.sparkSession.sparkContext.broadcast(table)


def postings(nodes: DataFrame, least: int) -> DataFrame:
    """(token, node, n): each set posted under so many of its rarest coordinate-value pairs
    that sets which agree in `least` coordinates share one. All sets order the pairs alike,
    by estimated commonness and then token."""
    prefix = COORDINATES - least + 1
    table = _commonness(nodes)

    def post(batch):
        if not batch.num_rows:
            return None
        tokens = _tokens(batch.column("signature").to_pylist())
        order = np.lexsort((tokens, table.value[_slots(tokens)]), axis=1)[:, :prefix]
        chosen = np.take_along_axis(tokens, order, axis=1)
        repeat = lambda name: np.repeat(batch.column(name).to_numpy(), prefix)
        return {"token": as_long(chosen.ravel()), "node": repeat("node"), "n": repeat("n")}

    return arrow_pass(nodes.select("node", "n", "signature"), post, "token long, node long, n int")


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def _agreeing(least: int):
    """Of pairs with both sketches, those that agree in `least` coordinates, and in how many."""

    def run(batch: pa.RecordBatch) -> dict | None:
        if not batch.num_rows:
            return None
        left, right = (_sketches(batch.column(c)) for c in ("left", "right"))
        same = (left == right).sum(axis=1)
        keep = np.flatnonzero(same >= least)
        return {"a": batch.column("a").take(pa.array(keep)), "b": batch.column("b").take(pa.array(keep)), "same": same[keep]}

    return run


def _sketch(batch: pa.RecordBatch) -> dict:
    """The low byte of each coordinate. Sets that agree in a coordinate agree in its byte."""
    low = [np.frombuffer(x, np.uint32).astype(np.uint8).tobytes() for x in batch.column("signature").to_pylist()]
    return {"node": batch.column("node"), "sketch": low}


def _sets(batch: pa.RecordBatch) -> dict:
    sets = [shingle_set(t) for t in texts_of(batch)]
    return {"node": batch.column("node"), "n": [len(s) for s in sets], "shingles": [np.sort(s.view(np.int64)) for s in sets]}


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 85) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Rows are linked when their sets of five-word shingles have a Jaccard similarity of
    `percent` hundredths or more, confirmed on the whole sets. component_id is the least id
    a row is connected to; kept marks the rows that carry it.

    Equal sets are one node from the start, so exact copies cost nothing. Sets are posted
    under their rarest coordinate-value pairs; on a common list collisions are counted over
    all coordinates, and pairs with ``least_matches(percent)`` of them hang together. Merging
    skips what already hangs together: each member meets two leaders of its list first, and
    after that only members outside a list's largest family meet others. Then the whole sets
    of a family are compared: each with its leader's, and after that only those outside the
    largest class of linked sets with those of other classes. What is compared is cut into
    blocks on both sides, and what leaves a task are joins of families or classes, never all
    pairs, so families of any size and likeness spread over tasks and no link between
    different classes is lost.

    Null or wordless texts have the empty set, are linked with nothing and are their own
    component. A null id never names a component: a class of null ids alone gets a null
    component_id and its rows are kept. Repeated rows fall into one class. Columns
    besides id and text are ignored. No rows give no rows."""
    least = least_matches(percent)
    base = only(docs, **{id_col: "doc_id", text_col: "text"}).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.concat(F.hex(F.xxhash64("text")), F.hex(F.xxhash64(F.lit(7), "text"))).alias("key"))
    rows = durable(arrow_pass(base, _describe, "doc_id long, key string, set_id binary, n int, signature binary"))
    nodes = durable(
        rows.where("set_id is not null").groupBy("set_id")
        .agg(F.min("doc_id").alias("least"), F.min("key").alias("key"), F.first("n").alias("n"),
             F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id()))
    posts = durable(postings(nodes, least))
    lists = posts.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    live = durable(posts.join(lists, "token"))
    forget(posts)
    sketches = durable(arrow_pass(nodes.select("node", "signature"), _sketch, "node long, sketch binary"))

    pairs = durable(arrow_pass(
        _to_leaders(live).join(sketches.toDF("a", "left"), "a").join(sketches.toDF("b", "right"), "b"),
        _agreeing(least), "a long, b long, same int"))
    families = components(pairs)
    across = durable(_across(live, families, sketches, percent, least))
    if not across.isEmpty():
        wider = components(pairs.select("a", "b").union(across))
        forget(families)
        families = wider
    known = durable(_known_sets(base, nodes, families))
    closest = pairs.groupBy("a").agg(F.max_by("b", F.struct("same", "b")).alias("b")).union(across.distinct())
    links = durable(_linked_to_leaders(closest, known, percent))
    classes = components(links)
    more = durable(_linked_across(families, classes, known, percent))
    if not more.isEmpty():
        wider = components(links.union(more))
        forget(classes)
        classes = wider
    for used in (live, sketches, pairs, across, families, known, links, more):
        forget(used)
    named = (nodes.join(classes, "node", "left").select("set_id", "least", F.coalesce("root", "node").alias("root")))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = named.join(names, "root").select("set_id", "component_id")
    return (rows.select("doc_id", "n", "set_id").join(by_set, "set_id", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.expr("doc_id <=> component_id")))


def _to_leaders(live: DataFrame) -> DataFrame:
    """Each node with two leaders of each of its lists: the node with most company on its
    lists, which near copies agree on, and one chosen by hash."""
    common = live.groupBy("node").agg(F.sum("size").alias("common"))
    leaders = live.join(common, "node").groupBy("token").agg(
        F.array_distinct(F.array(F.max_by("node", F.struct("common", "node")),
                                 F.max_by("node", F.struct(F.xxhash64("node"), F.col("node"))))).alias("leaders"))
    return (live.join(leaders, "token").select(F.col("node").alias("a"), F.explode("leaders").alias("b"))
            .where("a <> b").distinct())


def _known_sets(base: DataFrame, nodes: DataFrame, families: DataFrame) -> DataFrame:
    """(node, n, shingles) of the nodes of families, read again from one text of each."""
    wanted = nodes.join(families.select("node"), "node", "left_semi").select("node", "key")
    one = base.join(wanted.select("key"), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    return arrow_pass(one.join(wanted, "key").select("node", "text"), _sets, "node long, n int, shingles array<long>")


def _both_sides(members: DataFrame, keys: list[str], least_in: int, sizes: str) -> DataFrame:
    """Blocks of the members outside the largest group of each list against blocks of all.

    `members`: (keys…, node, root, …); `sizes` is an expression over counts for the number
    of blocks. Adds x and y, the blocks of the two sides, and `left`."""
    by_root = members.groupBy(*keys, "root").agg(F.count("*").alias("size"), F.sum("weight").alias("weight"))
    mixed = by_root.groupBy(*keys).agg(
        F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("roots"),
        F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"), F.max("size").alias("main_size"),
        F.max_by("weight", F.struct("size", "root")).alias("main_weight")).where("roots > 1")
    blocks = lambda n, w: F.expr(f"int(greatest(1, ceil({n} / {least_in}D), ceil({w} / {sizes}D)))")
    mixed = mixed.select(*keys, "main", blocks("all_size", "all_weight").alias("ny"),
                         blocks("(all_size - main_size)", "(all_weight - main_weight)").alias("nx"))
    placed = members.join(mixed, keys).drop("weight")
    own = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.where("root <> main").withColumn("x", own(F.col("nx"))).withColumn("y", others("ny")).withColumn("left", F.lit(True))
    right = placed.withColumn("y", own(F.col("ny"))).withColumn("x", others("nx")).withColumn("left", F.lit(False))
    return left.unionByName(right).drop("main", "nx", "ny")


def _merged(node: np.ndarray, root: np.ndarray, left: np.ndarray, near) -> dict | None:
    """Pairs that join the groups of nodes on the left with those of others: `near(i, js)`
    says which of js node i belongs with. Groups that a pair has joined are not compared
    again, so there are fewer pairs than groups."""
    group = np.unique(root, return_inverse=True)[1]
    right, a, b = np.flatnonzero(~left), [], []
    for i in np.flatnonzero(left):
        js = right[group[right] != group[i]]
        if not len(js):
            continue
        hits = js[near(i, js)]
        for g, first in zip(*np.unique(group[hits], return_index=True), strict=True):
            a.append(node[i])
            b.append(node[hits[first]])
            group[group == g] = group[i]
    return {"a": np.minimum(a, b), "b": np.maximum(a, b)} if a else None


def _across(live: DataFrame, families: DataFrame, sketches: DataFrame, percent: int, least: int) -> DataFrame:
    """Pairs that join families: on a common list, from different families, with `least` collisions."""
    members = live.join(families, "node", "left").select(
        "token", "node", "n", F.coalesce("root", "node").alias("root"), F.lit(1).alias("weight"))
    sides = _both_sides(members, ["token"], BLOCK, "1e18").join(sketches, "node")

    def meet(group: pa.Table) -> dict | None:
        node, root, n, left = (group.column(c).to_numpy() for c in ("node", "root", "n", "left"))
        if not left.any() or left.all():
            return None
        sketch = _sketches(group.column("sketch"))

        def near(i: int, js: np.ndarray) -> np.ndarray:
            fits = np.flatnonzero(100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i]))
            return fits[(sketch[js[fits]] == sketch[i]).sum(axis=1) >= least]

        return _merged(node, root, left, near)

    return grouped_pass(sides, ["token", "x", "y"], meet, "a long, b long")


def _compared(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links between the left and right sets of each group (`keys`, node, root, left, n,
    shingles), as many as join what is linked."""

    def meet(group: pa.Table) -> dict | None:
        node, root, n, left = (group.column(c).to_numpy() for c in ("node", "root", "n", "left"))
        if not left.any() or left.all():
            return None
        sets = [s.values.to_numpy() for s in group.column("shingles")]
        right = np.flatnonzero(~left)
        flat = np.concatenate([sets[j] for j in right])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], np.repeat(right, n[right])[order]

        def near(i: int, js: np.ndarray) -> np.ndarray:
            low, high = (np.searchsorted(flat, sets[i], side) for side in ("left", "right"))
            counts = high - low
            at = np.repeat(low - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
            both = np.bincount(owner[at], minlength=len(node))[js]
            return np.flatnonzero(100 * both >= percent * (n[js] + n[i] - both))

        return _merged(node, root, left, near)

    return grouped_pass(rows, keys, meet, "a long, b long")


def _linked_to_leaders(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Links among pairs (a, b) where b leads many: a's set meets b's in groups of about CELL."""
    sizes = pairs.groupBy("b").agg(F.expr(f"int(ceil(count(*) / {CELL}D))").alias("nx"))
    dealt = pairs.join(sizes, "b").withColumn("x", F.pmod(F.xxhash64("a"), F.col("nx")).cast("int"))
    followers = dealt.select("b", "x", F.col("a").alias("node"), F.lit(False).alias("left"))
    leaders = dealt.select("b", "x", F.col("b").alias("node"), F.lit(True).alias("left")).distinct()
    rows = followers.union(leaders).withColumn("root", F.col("node")).join(known, "node")
    return _compared(rows, ["b", "x"], percent)


def _linked_across(families: DataFrame, classes: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Links between different classes of a family."""
    members = (families.select("node", F.col("root").alias("family")).join(classes, "node", "left")
               .join(known.select("node", F.col("n").alias("weight")), "node")
               .select("family", "node", F.coalesce("root", "node").alias("root"), "weight"))
    sides = _both_sides(members, ["family"], CELL, str(CELL_SHINGLES))
    return _compared(sides.join(known, "node"), ["family", "x", "y"], percent)
