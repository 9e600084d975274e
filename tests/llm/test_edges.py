"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}" for i in range(20_000))
SENTENCE = "one two three four five six seven eight nine ten eleven twelve"
PASSAGE = " ".join(f"p{i}" for i in range(60))
NAMES = "node long, k1 long, seed long, _row string, score double, label int, block int"


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with everything that may go wrong; every other column has a name that operators use."""
    texts = [None, "", " \t\n", "a", SENTENCE, SENTENCE, LONG, PASSAGE + " x y z", "q r " + PASSAGE, "loser " * 3]
    rows = [(i if i else None, t, "en", None if i % 3 == 0 else "s1", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[4], (None, SENTENCE, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    return df.select("*", *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in NAMES.split(", ")]).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(9, 0, 1), (4, 1, 0), (6, 1, None), (None, 1, 1), (9, 0, 1)], "doc_id long, quality int, toxic int")


def operators():
    import public_tokenizers

    from brightloom.llm import (language_model, license_scan, mixing, near_dedup, packing, quality_classifier, quality_rules,
                                substring_dedup, toxicity)
    path = public_tokenizers.path("word_bpe_49k.json")
    return {
        "packing": lambda d, m: packing.pack_documents(d, path),
        "classifier": lambda d, m: quality_classifier.classify_quality(d, m, ("source", "lang")),
        "substring": lambda d, m: substring_dedup.without_repeats(d),
        "license": lambda d, m: license_scan.scan_licenses(d),
        "toxicity": lambda d, m: toxicity.score_toxicity(d, toxicity.fit_toxicity(d, m)),
        "mixing": lambda d, m: mixing.mix(d, target_entropy=0.9, max_passes=2.0),
        "model": lambda d, m: language_model.score_texts(d, language_model.fit_language_model(d)),
        "near": lambda d, m: near_dedup.near_duplicates(d),
        "rules": lambda d, m: quality_rules.judge_quality(d, quality_rules.fit_field(d, m)),
    }


@pytest.mark.parametrize("name", sorted(operators()))
def test_odd_rows_and_empty_tables(odd, labels, name):
    run = operators()[name]
    got = run(odd, labels).collect()
    n = {"substring": 8}.get(name, 12)  # null and empty are one text
    if name == "packing":
        assert sum(r.piece == 0 for r in got) == 12 and max(r.length for r in got) == 2048
    elif name == "mixing":
        assert {r.text for r in got} == {r.text for r in odd.collect()}
    else:
        assert len(got) == n
    assert run(odd.limit(0), labels.limit(0)).collect() == []


def test_near_duplicates_of_odd_rows(odd):
    from brightloom.llm.near_dedup import near_duplicates

    got = near_duplicates(odd).collect()
    same = [r for r in got if r.n_shingles == 8]
    assert len(same) == 4 and {r.component_id for r in same} == {4}
    assert sorted(r.kept for r in same) == [False, False, True, True]  # the repeated row carries the id as well
    assert {r.component_id for r in got if r.n_shingles == 0} == {None, 1, 2}
    assert all(r.kept for r in got if r.n_shingles == 0)


def test_repeats_of_odd_rows(odd):
    from brightloom.llm.substring_dedup import without_repeats

    kept = {r.kept: r.n_removed for r in without_repeats(odd).collect()}
    assert kept["x y z"] == 60 and kept["q r"] == 60 and kept[SENTENCE] == 0
    assert kept[""] == 0 or kept[""] == 20_000  # the empty texts, and the long one that repeats itself


def test_top_k_with_odd_vectors(spark):
    from brightloom.llm.exact_search import top_k

    rows = [(0, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (3, [1.0, 2.0], 1), (2, None, 1), (None, [1.0, 1.0], 1),
            (4, [float("nan"), 1.0], 1), (5, [None, 1.0], 1), (6, [-3.0, 0.0005], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = [(r.query_id, r.rank, r.vec_id) for r in top_k(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3), (0, 2, 100), (0, 3, 6), (100, 1, 0), (100, 2, 3), (100, 3, 6)]
    assert top_k(df.limit(0)).collect() == []


@pytest.mark.parametrize("columns", [("k1", "k2", "_kept", "_row"), ("_k1", "_K2", "kept", "n_chars"), ()])
def test_cutting_stage_leaves_other_columns_alone(spark, columns):
    import corpus_pipeline

    rows = [(0, PASSAGE + " tail one"), (1, "head two " + PASSAGE), (2, "alone"), (3, None), (4, ""), (5, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(i).alias(c) for i, c in enumerate(columns)])
    got = {r.doc_id: r.asDict() for r in corpus_pipeline.cut_repeats(spark, df, "").collect()}
    assert {k: r["text"] for k, r in got.items()} == {0: "tail one", 1: "head two", 2: "alone", 3: None, 4: "", 5: "alone"}
    for i, c in enumerate(columns):
        if c != "n_chars":
            assert {r[c] for r in got.values()} == {i}
    if "n_chars" in columns:
        assert got[0]["n_chars"] == 8 and got[2]["n_chars"] == 3
    assert corpus_pipeline.cut_repeats(spark, df.limit(0), "").collect() == []


def test_families_of_unlinked_pages_send_no_pairs(spark):
    """Pages of one template, similarity about 0.75: they hang together and none is linked."""
    import random

    from brightloom.llm import near_dedup

    rng = random.Random(2)
    frame = [f"f{i}" for i in range(400)]
    pages = []
    for d in range(150):
        words = list(frame)
        for at in rng.sample(range(0, 400, 8), 7):
            words[at] = f"d{d}x{at}"
        pages.append((d, " ".join(words)))
    near = [(500 + i, pages[0][1] + f" end{i}") for i in range(5)]
    df = spark.createDataFrame(pages + near, "doc_id long, text string").repartition(4)
    sets = {d: set(near_dedup.shingle_set(t.encode()).tolist()) for d, t in pages + near}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    emitted = []
    original = near_dedup.durable

    def counted(table):
        table = original(table)
        if table.columns[:2] == ["a", "b"]:
            emitted.append(table.count())
        return table

    near_dedup.durable = counted
    try:
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    finally:
        near_dedup.durable = original
    assert got == {d: find(d) for d in sets}
    assert max(emitted) <= 62 * len(sets)
