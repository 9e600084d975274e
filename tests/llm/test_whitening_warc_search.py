"""Whitening, capture index and ranked search against brute force, odd rows included."""

import glob
import gzip
import hashlib
import random
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

ODD_NAMES = "cells long, ids string, width int, part string, joined long, bucket int"


def with_odd_names(df):
    return df.select("*", *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in ODD_NAMES.split(", ")])


# --- whitening ---

def brute_whitening(vectors):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:8], axes[:, ::-1][:, :8]
    total = np.square(centred).sum() / n
    real = values > 1e-9 * total
    values, axes = values[real], axes[:, real]
    return [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x], centred @ axes / np.sqrt(values), values / total


@pytest.mark.parametrize("case", ["plain", "few rows", "low rank", "repeated values", "hot row"])
def test_whitening_against_numpy(spark, case):
    from brightloom.llm.whitening import whiten

    rng = np.random.default_rng(4)
    v = {"plain": rng.normal(size=(300, 12)) * np.arange(1, 13), "few rows": rng.normal(size=(4, 9)),
         "low rank": np.floor(rng.normal(size=(200, 3)) @ rng.normal(size=(3, 10)) * 64) / 1024,
         "repeated values": np.concatenate([np.eye(10), -np.eye(10)] * 3),
         "hot row": np.concatenate([np.tile(rng.normal(size=12), (150, 1)), rng.normal(size=(200, 12))])}[case]
    df = with_odd_names(spark.createDataFrame([(i, [float(e) for e in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>"))
    got = whiten(df.repartition(5)).collect()
    deviation, white, explained = brute_whitening(v)
    k = white.shape[1]
    assert len(got) == len(v) * k and all(r.n == len(v) for r in got)
    assert {(r.vec_id, r.deviation) for r in got} == set(enumerate(deviation))
    assert max(r.identity_error for r in got) < 1e-9 and len({r.identity_error for r in got}) == 1
    by = np.zeros_like(white)
    for r in got:
        by[r.vec_id, r.component - 1] = r.whitened
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    if case == "repeated values":  # any basis of an eigenspace will do
        return
    by *= np.sign((by * white).sum(axis=0))
    assert np.abs(by - white).max() < 1e-7


def test_whitening_of_odd_rows(spark):
    from brightloom.llm.whitening import whiten

    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.5]), (1, [0.5, 1.5]), (None, [2.0, -1.0]), (7, [0.25, 0.75])]
    bad = [(2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, []), (8, [1e30, 0.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>")
    got = whiten(df).collect()
    assert Counter(r.vec_id for r in got) == {1: 4, None: 2, 7: 2} and {r.n for r in got} == {4}
    assert whiten(df.limit(0)).collect() == [] and whiten(df.where("vec_id = 1")).collect() == []
    huge = spark.createDataFrame([(i, [2.0 ** 30 * i, 1.0]) for i in range(1, 5)], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whiten(huge).collect()} == {None}
    with pytest.raises(Exception, match="differ in length"):
        whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"))


# --- archives and capture index ---

PAGE = "<html>" + "x" * 120 + "</html>"
PAGES = [(5, "http://www.B.org/z?b=2&a=1#top", PAGE), (3, "https://b.org:443/z/?a=1&b=2", PAGE), (9, "http://a.b.org/", PAGE),
         (1, "http://[bad", "short"), (2, None, "short"), (4, "http://a.b.org:8080/ü \r\nWARC-Type: x", None), (6, "http://a.b.org", ""),
         (None, "http://c.org", PAGE), (None, "http://c.org", "y" * 200), (3, "http://b.org/z", PAGE), (8, "http://q.org", "\r\n\r\nWARC/1.1\r\n" * 20),
         (10, "http://long.org", "zé" * 300_000), (11, "http://long.org", "zé" * 300_000)]


@pytest.fixture(scope="module")
def archived(spark, tmp_path_factory):
    from brightloom.llm.warc import archive_pages

    folder = str(tmp_path_factory.mktemp("warc")) + "/w"
    pages = with_odd_names(spark.createDataFrame(PAGES, "page_id long, url string, html string")).repartition(4)
    return folder, archive_pages(pages, path=folder, archive_bytes=500).collect()


def test_records_hold_or_refer_to_their_payload(archived):
    _, rows = archived
    first = {}
    for key, _, html in PAGES:
        data = (html or "").encode()
        if len(data) >= 100 and key is not None:
            first[data] = min(first.get(data, key), key)
    want = Counter()
    for key, _, html in PAGES:
        data = (html or "").encode()
        owner = first.get(data)
        revisit = owner is not None and owner != key
        want[key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", owner if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == want


def test_archives_are_read_at_their_offsets(archived):
    from brightloom.llm.warc import parse_record

    folder, rows = archived
    assert len(glob.glob(f"{folder}/part-*")) > 2
    payloads = {(k, (h or "").encode()) for k, _, h in PAGES}
    for r in rows:
        with open(f"{folder}/{r.archive}", "rb") as f:
            f.seek(r.offset)
            record = parse_record(gzip.decompress(f.read(r.length)))
        assert (record["page_id"], record["record_type"]) == (r.page_id, r.record_type)
        if r.record_type == "response":
            assert (r.page_id, record["payload"]) in payloads
    for name in glob.glob(f"{folder}/part-*"):
        assert gzip.open(name).read().count(b"WARC-Record-ID") == sum(r.archive in name for r in rows)


def test_url_keys():
    from brightloom.llm.warc import url_key

    assert url_key("http://www.B.org/z?b=2&a=1#top") == url_key("https://b.org:443/z/?a=1&b=2") == "org,b)/z?a=1&b=2"
    assert url_key("http://a.b.org:8080/") == "org,b,a:8080)/"
    assert url_key(" HTTP://[bad ") == "http://[bad" and url_key("") == ""


def test_damaged_archives_are_errors():
    from brightloom.llm.warc import _member, _members, _record, parse_record

    row = {"page_id": 1, "url": "http://a", "payload": b"abc", "captured_at": None, "payload_bytes": 3, "record_type": "response",
           "refers_to": None, "payload_digest": hashlib.sha256(b"abc").hexdigest()}
    data = _record(row)
    assert parse_record(data)["payload"] == b"abc"
    for broken in (data.replace(b"abc", b"abd"), data[:-6], b"no record"):
        with pytest.raises(ValueError):
            parse_record(broken)
    with pytest.raises(ValueError):
        list(_members(_member(data)[:-3]))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges_runs(k):
    from brightloom.llm.warc import LoserTree

    rng = random.Random(k)
    runs = [sorted((rng.randint(0, 9), i, j) for j in range(rng.choice([0, 1, 5, 30]))) for i in range(k)]
    assert list(LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_histories_of_a_hot_key_span_ranges(spark, tmp_path):
    from brightloom.llm.warc import archive_pages, merge_index, read_captures

    rng = random.Random(1)
    rows = [(i, rng.choice(["http://hot.org/"] * 6 + [f"http://s{j}.org/" for j in range(5)]), f"{i % 3}" * 150) for i in range(800)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    when = F.timestamp_seconds(F.col("page_id") % 50)
    archive_pages(pages, captured_at=when, path=str(tmp_path / "w"), archive_bytes=2000)
    got = sorted(merge_index(read_captures(spark, str(tmp_path / "w")), range_rows=40).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(800))
    keys = [(r.url_key, r.captured_at, r.page_id) for r in got]
    assert keys == sorted(keys)
    seen = Counter()
    for r in got:
        seen[r.url_key] += 1
        assert r.capture == seen[r.url_key]
    assert seen["org,hot)/"] > 300
    assert archive_pages(pages.limit(0)).collect() == []


def test_repeated_payloads_beyond_and_below_the_hot_share(spark, monkeypatch):
    from brightloom.llm import warc

    rows = [(i, "http://a", f"{i % 40 if i % 3 else 'hot'}" * 60) for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    plans = []
    for parts in (10, 0, 10 ** 6):
        monkeypatch.setattr(warc, "HOT_PARTS", parts)
        planned = warc.plan_records(pages, "page_id", "url", "html")
        plans.append(sorted((r.page_id, r.record_type, r.refers_to or -1) for r in planned.collect()))
    assert plans[0] == plans[1] == plans[2] and len(plans[0]) == 600


# --- ranked search ---

def brute_ranking(docs, items, k):
    terms = lambda t: ["".join(c.lower() if c.isascii() else c for c in w) for w in "".join(
        c if ord(c) > 127 or c.isalnum() else " " for c in t or "").split(" ") if w]
    counts = [(key, Counter(terms(t))) for key, t in docs]
    counts = [(key, c, sum(c.values())) for key, c in counts if c]
    n, total = len(counts), sum(x for _, _, x in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for key, text in items:
        scored = []
        for doc, c, length in counts:
            m = 50 + 50 * length * n // total
            s = sum(floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if s > 0 and doc is not None:
                scored.append((-s, doc))
        out += [(key, i + 1, doc, -s) for i, (s, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)] + ["Café", "Über", "X-1", "don't"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 40)))) for i in range(400)]
    docs += [(1000 + i, "w0 w1 w2 w3 W0") for i in range(150)]  # copies
    docs += [(5, docs[5][1]), (None, "w0 w1 w59"), (2000, None), (2001, ""), (2002, " -- "), (2003, "w7 " * 20_000)]
    items = [(j, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for j in range(25)]
    items += [(30, None), (31, "--"), (32, "unknown"), (3, items[3][1]), (33, "w0 w0 W0"), (None, "w1")]
    frame = with_odd_names(spark.createDataFrame(docs, "doc_id long, text string")).repartition(3)
    return docs, items, frame, with_odd_names(spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("k, pairs, sizes", [(50, 1 << 18, {}), (3, 40, {}), (7, 1 << 18, {"TREE_DOCS": 32, "LEAST_LEAVES": 3, "CHILDREN": 4, "ITEMS": 5})])
def test_ranking_against_brute_force(corpus, monkeypatch, k, pairs, sizes):
    from brightloom.llm import ranked_search as R

    for name, value in sizes.items():
        monkeypatch.setattr(R, name, value)
    docs, items, frame, queries = corpus
    got = sorted((r.item_id if r.item_id is not None else -1, r["rank"], r.doc_id, r.score)
                 for r in R.ranked_search(frame, queries, k, pairs=pairs).collect())
    assert got == brute_ranking(docs, [(-1 if key is None else key, t) for key, t in items], k)


def test_trees_prune_and_bound(monkeypatch):
    """Every bound of a subtree is at least each score below it, and some subtree is cut."""
    from brightloom.llm import ranked_search as R

    monkeypatch.setattr(R, "LEAST_LEAVES", 2)
    rng = np.random.default_rng(3)
    weight = np.arange(100, 140, dtype=np.int64)
    vectors = [np.unique(rng.integers(0, 40, rng.integers(1, 12))) for _ in range(300)]
    tfs = [rng.integers(1, 9, len(v)) for v in vectors]
    m = rng.integers(50, 500, 300)
    tree = R.Tree(list(range(300)), m, [v.astype(">i4").tobytes() for v in vectors], [t.astype("<i4").tobytes() for t in tfs], weight, 5)
    assert sorted(x for ids in tree.ids for x in ids) == list(range(300))

    def leaves(node):
        return node.leaves + [x for n in node.inner for x in leaves(n)]

    inner = 0
    todo = [tree.root]
    while todo:
        node = todo.pop()
        for c, below in enumerate(node.inner):
            at = node.child == len(node.leaves) + c
            bound = dict(zip(node.term[at].tolist(), node.gain[at].tolist()))
            for leaf in leaves(below):
                gain = R.gains(weight[tree.terms[leaf]], tree.tf[leaf], tree.m[leaf])
                assert all(bound[t] >= g for t, g in zip(tree.terms[leaf].tolist(), gain.tolist()))
            inner += 1
            todo.append(below)
    assert inner > 20
    entered = []
    search = R.Search([np.array([39, 38])], 40, 5)
    original = search._enter
    search._enter = lambda *a: entered.append(a[1]) or original(*a)
    search.add(tree)
    assert len(entered) < inner
    score = [sum(g for t, g in zip(v, R.gains(weight[v], tf, mm)) if t >= 38) for v, tf, mm in zip(vectors, tfs, m)]
    want = sorted((-s, i) for i, s in enumerate(score) if s > 0)[:5]
    assert list(zip((-search.scores[0]).tolist(), search.docs[0].tolist())) == want


def test_ranking_of_empty_tables(corpus):
    from brightloom.llm.ranked_search import ranked_search

    _, _, docs, items = corpus
    assert ranked_search(docs.limit(0), items).collect() == []
    assert ranked_search(docs, items.limit(0)).collect() == []
    assert ranked_search(docs.where("doc_id = 2001"), items).collect() == []
