import math

import pytest
from pyspark.sql import functions as F

from brightloom import runtime
from brightloom.functions import porter
from brightloom.operators import search as Q, words as W
from brightloom.operators.relations import docs_with_all, phrase_match
from brightloom.operators.stored_index import StoredIndex


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, "pay pay good"), (2, "good team"), (3, "pay team"), (4, "")],
                                 "doc_id long, text string")


@pytest.fixture(scope="module")
def tokens(docs):
    return Q.index_tokens(docs, "doc_id", "text").persist()


def test_ranked_search_keeps_both_weightings(tokens):
    index = Q.build_index(tokens)
    got = {r.doc_id: r.score for r in Q.search_ranked(index, ["pay", "good", "pay"], 4).collect()}
    idf = math.log10(4 / 2)
    first = (1 + math.log(1 + math.log(2))) * idf
    assert got == pytest.approx({1: 2 * first + idf, 2: idf, 3: 2 * idf})
    plain = {r.doc_id: r.score for r in Q.search_ranked(index, ["pay"], 4, scheme="standard").collect()}
    assert plain == pytest.approx({1: (1 + math.log(2)) * idf, 3: idf})


def test_unknown_terms_and_empty_queries_find_nothing(tokens, spark):
    index = Q.build_index(tokens)
    assert Q.search_ranked(index, ["zebra"], 4).count() == 0
    assert Q.search_ranked(index, [], 4).count() == 0
    assert Q.search_phrase(tokens, ["good", "zebra"]).count() == 0
    assert Q.search_phrase(tokens, []).count() == 0
    assert Q.query_terms(spark, "The, of a!") == []


def test_phrases(tokens):
    found = lambda words: sorted(r.doc_id for r in Q.search_phrase(tokens, words).collect())
    assert found(["good", "team"]) == [2]
    assert found(["team", "good"]) == []
    assert found(["pay", "pay"]) == [1]
    assert found(["pay"]) == sorted(r.doc_id for r in docs_with_all(tokens, ["pay"]).collect()) == [1, 3]
    assert phrase_match(tokens, ["pay", "pay", "pay"]).count() == 0


@pytest.fixture(scope="module")
def stored(spark, docs, tmp_path_factory):
    """The documents in two generations."""
    index = StoredIndex(spark, str(tmp_path_factory.mktemp("stored")), buckets=8)
    index.append(docs.where("doc_id < 3"))
    index.append(docs.where("doc_id >= 3"))
    return index


def test_stored_index_of_two_generations_searches_like_one(stored, tokens):
    index = Q.build_index(tokens)
    for words in ("pay good pay", "team", "pay zebra", "zebra", "the"):
        terms = stored.analyse(words)
        want = [(r.doc_id, pytest.approx(r.score)) for r in Q.search_ranked(index, terms, 4).collect()]
        assert [(r.doc_id, r.score) for r in stored.search(words).collect()] == want
    assert [r.doc_id for r in stored.search("pay good", scheme="standard").collect()] == [1, 2, 3]
    assert {r.term: (r.df, r.occurrences) for r in stored.statistics().collect()} == {"pay": (2, 3), "good": (2, 2), "team": (2, 2)}
    for words in ("good team", "team good", "pay pay", "pay pay pay", "pay", "pay zebra", "of"):
        want = sorted(r.doc_id for r in Q.search_phrase(tokens, stored.analyse(words)).collect())
        assert sorted(r.doc_id for r in stored.phrase(words).collect()) == want


def test_many_queries_agree_with_single_ones(stored, spark):
    queries = spark.createDataFrame([(7, "pay good pay"), (8, "team"), (9, "zebra")], "query_id long, text string")
    many = stored.search_many(queries, k=2).collect()
    assert {r.query_id for r in many} == {7, 8}
    for key, words in ((7, "pay good pay"), (8, "team")):
        got = [(r.doc_id, r.score) for r in sorted(many, key=lambda r: r["rank"]) if r.query_id == key]
        assert got == [(r.doc_id, pytest.approx(r.score)) for r in stored.search(words, 2).collect()]


def test_searches_read_only_the_buckets_of_their_terms(stored):
    files = stored.search("pay").inputFiles()
    assert files and {f.split("bucket=")[1].split("/")[0] for f in files} >= set(map(str, stored._buckets_of(["pay"])))
    plan = stored.search("pay")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "positions" not in plan


def test_a_failed_generation_is_not_seen_and_compaction_changes_nothing(stored, docs, spark, monkeypatch):
    index = StoredIndex(spark, stored.path, buckets=8)
    before = [tuple(r) for r in index.search("pay good team").collect()]

    class Torn(Exception):
        pass

    with monkeypatch.context() as patched:
        def fail(*_, **__):
            raise Torn

        patched.setattr(type(spark), "createDataFrame", fail)
        with pytest.raises(Torn):
            index.append(docs.selectExpr("doc_id + 10 AS doc_id", "text"))
    assert index.n_docs() == 4 and [tuple(r) for r in index.search("pay good team").collect()] == before
    index.compact()
    assert len(index.live()) == 1 and index.n_docs() == 4
    assert [tuple(r) for r in index.search("pay good team").collect()] == before


def test_no_index_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        StoredIndex(spark, str(tmp_path / "none")).search("pay")


def test_negation_scores_and_last_position(spark):
    tokens = spark.createDataFrame([(1, i, w) for i, w in enumerate(["x", "not", "y", "z", "not"])],
                                   "doc long, pos int, word string")
    rows = W.negation_scores(tokens, "doc").orderBy("pos").collect()
    assert [r.left for r in rows] == pytest.approx([0, 1, .9, .8, 1])
    assert [r.right for r in rows] == pytest.approx([.9, 1, .8, .9, 1])
    twice = spark.createDataFrame([(1, 0, "a"), (1, 1, "not"), (1, 2, "a"), (2, 0, "b")], "doc long, pos int, word string")
    got = {(r.doc, r.feature): r.value for r in W.negation_features(twice, "doc").collect()}
    assert got[(1, "neg_l(a)")] == pytest.approx(0.9) and got[(1, "neg_r(a)")] == 0.0
    assert got[(2, "neg_l(b)")] == 0.0


def test_ngrams_of_short_texts(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "b"]), (2, ["a"]), (3, [])], "doc long, words array<string>")
    got = {}
    for r in W.ngram_features(df, "doc", "words").collect():
        got.setdefault(r.doc, set()).add(r.feature)
    assert got == {1: {"has(a)", "has(b)", "has(a,b)", "has(b,a)", "has(a,b,a)", "has(b,a,b)"}, 2: {"has(a)"}}


def test_sentiment_without_hits_or_text_is_zero(spark):
    lexicon = spark.createDataFrame([("fine", 0.5, 0.4), ("awful", -1.0, 1.0)], "word string, polarity double, subjectivity double")
    df = spark.createDataFrame([(1, "Fine, fine. AWFUL"), (2, "nothing"), (3, None), (4, "")], "id long, text string")
    got = {r.id: (r.polarity_text, r.subjectivity_text) for r in W.sentiment(df, "id", ["text"], lexicon).collect()}
    assert got[1] == pytest.approx((0.0, 0.6)) and got[2] == got[3] == got[4] == (0.0, 0.0)


def test_word_counts(spark):
    df = spark.createDataFrame([("The cat; the CAT, a dog2dog!",), (None,)], "t string")
    got = [(r.word, r.frequency) for r in W.word_freq(df, "t", ["the"], 10).collect()]
    assert got == [("cat", 2), ("dog", 2)]
    weights = {r.word: r.weight for r in W.word_cloud_weights(df, "t", ["dog"], 5).collect()}
    assert weights == {"cat": 1.0, "the": 1.0}


def test_negations_within_the_row_equal_windows_and_move_nothing(spark):
    import random

    rng = random.Random(3)
    rows = [(i, [rng.choice(["not", "a", "b", "can't", "c", "d", "e", "f", "g", "h", "i", "j", "k"]) for _ in range(n)])
            for i, n in enumerate([0, 1, 2, 9, 30, 200, 1000])]
    df = spark.createDataFrame([*rows, (99, None)], "doc long, words array<string>")
    tokens = df.select("doc", F.posexplode("words").alias("pos", "word"))
    for fn in (W.negation_scores, W.negation_features):
        inside = fn(df, "doc", ["not"], F.col("words"))
        want = fn(tokens, "doc", ["not"])
        assert sorted(map(tuple, inside.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
        assert "Exchange" not in inside._jdf.queryExecution().executedPlan().toString()


def test_postings_within_the_row_equal_grouped_tokens(spark, tmp_path):
    rows = [(1, "one two one, Two three one"), (2, ""), (3, None), (4, "x"), (5, " ".join(f"w{'abc'[i % 3]} same" for i in range(400))),
            (6, "the and of")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = Q.index_tokens(df, "doc_id", "text").groupBy("doc_id", "term").agg(F.sort_array(F.collect_list("pos")).alias("positions"))
    got = Q.index_postings(df, "doc_id", "text")
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    twice = spark.createDataFrame([(1, "alpha beta"), (1, "beta gamma beta")], "doc_id long, text string")
    index = StoredIndex(spark, f"{tmp_path}/twice")
    index.append(twice)
    assert {r.term: (r.tf, list(r.positions)) for r in index._read("postings").collect()} == {
        "alpha": (1, [0]), "beta": (3, [0, 1, 2]), "gamma": (1, [1])}


@pytest.mark.parametrize("frequent", [0, 2, 400_000])
def test_stems_leave_the_tokens_where_they_are(spark, monkeypatch, frequent):
    monkeypatch.setattr(Q, "FREQUENT", frequent)
    monkeypatch.setattr("brightloom.operators.relations.BROADCAST_BYTES", -1)
    words = ["running", "running", "running", "connections", "connections", "connections", "skies", "generalisation"]
    tokens = spark.createDataFrame(list(enumerate(words)), "pos int, term string")
    got = Q.stem_tokens(tokens, "term", "porter")
    want = tokens.withColumn("term", porter.stem("term"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_spread_tables_come_in_parts_that_do_not_grow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runtime, "SPREAD_BYTES", 2_000)
    spark.range(3000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    docs = runtime.Tables(spark, str(tmp_path)).spread("documents", "doc_id")
    assert docs.rdd.getNumPartitions() > 50 and docs.count() == 3000
    index = Q.build_index(Q.index_tokens(docs, "doc_id", "text"))
    assert index._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_features_of_a_pass_over_texts_equal_those_of_their_words(spark):
    import random

    rng = random.Random(8)
    pieces = ["not", "of", "a1", "Zeile", "naïve", "x y", "--", "…", "don't", "é", "\x1c", "it's", "日本", "b"]
    texts = [None, "", " \t\n", "…", *("".join(rng.choice(pieces) + rng.choice([" ", "\n", "\x0b ", "", "\r\n"]) for _ in range(n)) for n in (1, 2, 5, 40, 900))]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    words = df.select("id", W.plain_tokens("text").alias("w"))
    tokens = words.select("id", F.posexplode("w").alias("pos", "word"))
    grams = words.select("id", F.explode(F.array_distinct(F.concat(*[W.ngrams(F.col("w"), k) for k in (1, 2, 3)]))).alias("g")).select(
        "id", F.concat(F.lit("has("), "g", F.lit(")")).alias("feature"), F.lit(1.0).alias("value"))
    want = grams.unionByName(W.negation_features(tokens, "id", ["not", "of"]))
    for got in (W.extract_features(df, "id", "text", 3, negations=["not", "of"]),
                W.ngram_features(words, "id", "w").unionByName(W.negation_features(words, "id", ["not", "of"], F.col("w")))):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_long_texts_are_taken_a_few_at_a_time(spark, monkeypatch):
    df = spark.createDataFrame([(i, " ".join(f"w{j % (i + 3)}" for j in range(50 * i))) for i in range(8)], "id long, text string").coalesce(1)
    want = sorted(map(tuple, W.extract_features(df, "id", "text").collect()))
    monkeypatch.setattr(W, "TOKENS", 60)
    assert sorted(map(tuple, W.extract_features(df, "id", "text").collect())) == want
