"""The operators against brute force on small tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.mark.parametrize("capacity", [9, 30, 100, 2048])
def test_plan_fills_without_gaps_and_as_well_as_best_fit(capacity):
    from brightloom.llm.packing import plan

    for seed in range(40):
        rng = random.Random(seed)
        items = [rng.randint(1, rng.choice([capacity, capacity // 2, max(1, capacity // 4)])) for _ in range(rng.randint(1, 300))]
        bins, seen = defaultdict(list), Counter()
        for length, rank, count, first, per, offset in sorted(plan(Counter(items), capacity)):
            assert rank == seen[length]
            seen[length] += count
            for r in range(count):
                bins[first + r // per].append((offset + r % per * length, length))
        assert seen == Counter(items)
        for places in bins.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= capacity
        gaps: list[int] = []
        for item in sorted(items, reverse=True):
            fit = [g for g in gaps if g >= item]
            gap = min(fit) if fit else capacity
            if fit:
                gaps.remove(gap)
            gaps.append(gap - item)
        assert len(bins) <= len(gaps) + 1


def test_pieces_are_the_tokenizer_s_ids(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    from brightloom.llm.packing import pack_documents

    path = public_tokenizers.path("word_bpe_49k.json")
    extra = spark.createDataFrame([(-1, "İstanbul ﬁn <|endoftext|>a b\x1cc d"), (-2, None)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(extra)
    tokenizer = Tokenizer.from_file(path)
    want = {}
    for r in rows.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want[r.doc_id, piece] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    got = pack_documents(rows, path).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for spots in places.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 2048


def test_lexicon_distance_against_dynamic_programming():
    from brightloom.llm.toxicity import PER_EDIT, Entry, Lexicon

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    entries = [Entry("loser", False, 2.0), Entry("disgusting", False, 3.0), Entry("scum", False, 1.5), Entry("lostra", True, 2.5)]
    lexicon, rng = Lexicon(entries), random.Random(5)
    words = [e.term for e in entries]
    for _ in range(4000):
        word = list(rng.choice(words))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "s", "o", "xy"])
        word = "".join(word)
        want = 0.0
        for e in entries:
            heads = [word[:n] for n in range(len(word) + 1)] if e.open else [word]
            d = min(distance(e.term, h) for h in heads)
            if d <= e.edits:
                want = max(want, e.weight * PER_EDIT ** d)
        assert lexicon.evidence(word) == pytest.approx(want), word


def test_quotation_counts_less_than_abuse():
    from brightloom.llm.toxicity import Entry, Lexicon, Model

    entries = (Entry("idiot", False, 5.0),)
    lexicon = Lexicon(list(entries))
    model = Model(entries, (-3.0, 2.0, 0.0))
    own, quoted, none = (float(model.score(np.array([lexicon.features(t)]))[0]) for t in (
        "you are an ldiot , really", 'the word "idiot" is from the greek', "a calm text"))
    assert own > 0.5 > quoted > none


def test_quotations_of_any_length_are_paired():
    from brightloom.llm.toxicity import QUOTED, Entry, Lexicon

    lexicon, long = Lexicon([Entry("moron", False, 5.0)]), "words and " * 9
    abuse, quoted = (5.0, 0.0), (5.0 * QUOTED, 5.0)
    for text, want in [(f'"{long}" you moron , and then "bye"', abuse), (f'"{long} moron"', quoted), (f'"moron {long}"', quoted),
                       (f"„{long} moron“ and", quoted), (f"«{long}» moron «bye»", abuse), (f"“{long}” moron “bye”", abuse),
                       (f'"{long}\nmoron" x', abuse), ('"a" “b "moron" c” d', quoted), ("moron", abuse)]:
        assert lexicon.features(text) == pytest.approx(want), text


def test_toxicity_on_held_out_rows(spark):
    from brightloom.llm.toxicity import fit_toxicity, score_toxicity

    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_toxicity(docs, fit_toxicity(docs, labels)).join(labels, "doc_id")
    held = scored.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in held}
    assert n.get((1, 1), 0) >= 0.9 * (n.get((1, 1), 0) + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * (n.get((0, 1), 0) + n.get((0, 0), 0))


def test_toxicity_lexicon_of_few_labels(spark):
    from brightloom.llm.toxicity import _telling, fit_toxicity, score_toxicity

    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_toxicity(docs, labels)
    assert {"disgusting", "loser"} <= {e.term for e in model.entries}
    assert score_toxicity(docs, model).where("predicted = 1").count() > 3
    for clean in (58, 259, 4_000):
        assert _telling({"slur": (15, 0), "word": (15, clean // 4)}, 40, clean) == ["slur"]
    assert _telling({"slur": (20, 0), "word": (400, 390)}, 4_000, 4_000) == ["slur"]


def test_mixture_weights_and_budget(spark):
    from brightloom.llm.mixing import mix, source_weights

    rows = [(i, "big" if i < 9000 else "mid" if i < 9900 else "small", 10 + i % 7) for i in range(10_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, tokens long")
    weights = {r.source: r for r in source_weights(df, target_entropy=0.8).collect()}
    share = np.array([r.source_tokens for r in weights.values()], float)
    share /= share.sum()

    def entropy(a):
        p = share ** a / (share ** a).sum()
        return -(p * np.log(p)).sum() / math.log(3)

    exponent = next(iter(weights.values())).exponent
    assert entropy(exponent) >= 0.8 > entropy(exponent + 1e-4)
    limited = {r.source: r for r in source_weights(df, target_entropy=0.8, max_passes=2.5).collect()}
    assert 2.49 < max(r.passes for r in limited.values()) <= 2.5
    got = mix(df, tokens=F.col("tokens"), max_passes=2.5).groupBy("source", "doc_id").count().collect()
    assert {r.doc_id for r in got} == set(range(10_000))
    tokens, times = dict((r[0], r[2]) for r in rows), Counter()
    for r in got:
        times[r.source] += r["count"] * tokens[r.doc_id]
    for name, r in limited.items():
        assert r.source_tokens * r.passes - 20 <= times[name] <= r.source_tokens * r.passes + 1
    small = mix(df, tokens=F.col("tokens"), max_passes=2.5, budget=30_000)
    assert 29_900 < small.agg(F.sum("mix_tokens")).first()[0] <= 30_000


def test_pipeline_drops_copies_of_a_similarity_from_80_to_85(spark):
    from brightloom.llm.near_dedup import least_matches, shingle_set
    from corpus_pipeline import one_of_each_group

    assert (least_matches(85), least_matches(80)) == (66, 59)
    rng, texts = random.Random(9), []
    for pair in range(60):
        words = [f"s{pair}_{rng.randrange(10 ** 6)}" for _ in range(300)]
        copy = list(words)
        for at in range(20, 300, 50):
            copy[at] = f"c{at}"
        texts += [" ".join(words), " ".join(copy)]
    sets = [set(shingle_set(t.encode()).tolist()) for t in texts]
    near = [(a, b) for a in range(120) for b in range(a + 1, 120) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(near) == 60 and all(len(sets[a] & sets[b]) < 0.85 * len(sets[a] | sets[b]) for a, b in near)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in one_of_each_group(spark, docs, "").collect()} == set(range(120)) - {b for _, b in near}


def test_pipeline_keeps_one_row_of_each_class_whatever_the_ids(spark):
    from corpus_pipeline import one_of_each_group

    a, b, c = (" ".join(f"{x}{i}" for i in range(200)) for x in "abc")
    rows = [(7, a), (2, a), (2, b), (None, a + " more"), (None, c), (None, c), (None, c + " more"), (3, b), (9, ""), (9, None)]
    got = one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    assert Counter((r.doc_id, r.text[:1] if r.text else r.text) for r in got.collect()) == Counter(
        [(2, "a"), (2, "b"), (None, "c"), (9, ""), (9, None)])


def test_near_copies_in_chains_are_one_class(spark):
    from brightloom.llm.near_dedup import near_duplicates, shingle_set

    rng = random.Random(3)
    texts = []
    for family in range(3):
        base = [f"v{family}_{rng.randrange(400)}" for _ in range(150)]
        for _ in range(60):
            base = list(base)
            base[rng.randrange(150)] = f"n{rng.randrange(10 ** 6)}"
            texts.append(" ".join(base))
    got = {r.doc_id: r.component_id for r in near_duplicates(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets, root = [set(shingle_set(t.encode()).tolist()) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if 100 * k >= 85 * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert got == {i: find(i) for i in range(len(texts))}


def test_viterbi_against_all_labelings():
    from itertools import product

    from brightloom.llm.quality_rules import FEATURES, Field

    rng = random.Random(8)
    for _ in range(30):
        field = Field(tuple(rng.gauss(0, 1) for _ in FEATURES), tuple(tuple(rng.gauss(0, 1) for _ in range(2)) for _ in range(2)))
        codes = [rng.randrange(1 << len(FEATURES)) for _ in range(7)]
        weight = [sum(w for i, w in enumerate(field.unary) if c >> i & 1) for c in codes]

        def worth(y):
            return sum(w for w, v in zip(weight, y, strict=True) if v) + sum(field.pairs[a][b] for a, b in zip(y, y[1:]))

        assert tuple(field.content(codes)) == max(product((False, True), repeat=7), key=worth)


def test_chain_gradient_against_differences():
    from brightloom.llm.quality_rules import _expected

    rng = np.random.default_rng(1)
    sizes, unary, pairs = np.array([4, 3, 1]), rng.normal(size=8), rng.normal(size=(2, 2))
    start = np.array([0, 4, 7])
    _, content, joint = _expected(unary, pairs, start, sizes)
    for i in range(8):
        d = np.eye(8)[i] * 1e-5
        assert (_expected(unary + d, pairs, start, sizes)[0] - _expected(unary - d, pairs, start, sizes)[0]) / 2e-5 == pytest.approx(content[i], abs=1e-6)
    d = np.array([[0, 1e-5], [0, 0]])
    assert (_expected(unary, pairs + d, start, sizes)[0] - _expected(unary, pairs - d, start, sizes)[0]) / 2e-5 == pytest.approx(joint[0, 1], abs=1e-6)


def test_quality_rules_base_and_held_out(spark):
    from brightloom.llm.quality_rules import fit_field, judge_quality, rules

    text = "# a b a b a b\nx | y\n\nx | y\n \nx | y"
    words = text.split()
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    assert rules(text.encode()) == (len(words), sum(map(len, words)), 4, 2, len(often))
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = judge_quality(docs, fit_field(docs, labels)).where("not base_failed").join(labels, "doc_id").where(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).agg(
        F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert got > 0.97


def test_quality_classifier_on_held_out(spark):
    from brightloom.llm.quality_classifier import classify_quality

    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = classify_quality(docs, labels, ("source", "lang")).where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert got > 0.97


def test_context_trees_against_recursion(spark, docs):
    from brightloom.llm.language_model import DEPTH, EDGE, fit_language_model, score_texts

    rows = [(r.doc_id, (r.text or "")[:200]) for r in docs.select("doc_id", "text").orderBy("doc_id").limit(40).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in score_texts(df, fit_language_model(df)).collect()}
    rare = {r.doc_id: r for r in score_texts(df, fit_language_model(df, held=20)).collect()}
    seen, words, n_train = defaultdict(lambda: [0, 0]), Counter(), 0

    def decisions(text):
        s = bytes([EDGE]) * DEPTH + b" ".join(text.encode().lower().split()) + bytes([EDGE])
        for j in range(DEPTH, len(s)):
            node = 1
            for k in range(7, -1, -1):
                yield s[j - DEPTH:j], node, s[j] >> k & 1
                node = 2 * node + (s[j] >> k & 1)

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            words.update([*text.encode().lower().split(), None])
            for context, node, bit in decisions(text):
                for d in range(DEPTH + 1):
                    seen[context[DEPTH - d:], node][bit] += 1
    below = defaultdict(float)
    mixed = {}
    for (context, node) in sorted(seen, key=lambda x: -len(x[0])):
        own = kt(*seen[context, node])
        mixed[context, node] = own if len(context) == DEPTH else np.logaddexp(own, below[context, node]) - math.log(2)
        if context:
            below[context[1:], node] += mixed[context, node]
    total, distinct = sum(words.values()), len(words)
    for i, text in rows:
        log = 0.0
        for context, node, bit in decisions(text):
            p = None
            for d in range(DEPTH, -1, -1):
                c = context[DEPTH - d:]
                a, b = seen.get((c, node), (0, 0))
                one = (b + 0.5) / (a + b + 1)
                stop = 0.5 * math.exp(kt(a, b) - mixed.get((c, node), 0.0)) if d < DEPTH else 1
                p = one if p is None else stop * one + (1 - stop) * p
            log += math.log(p if bit else 1 - p)
        tokens = [*text.encode().lower().split(), None]
        base = sum(math.log10((words[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        for r in (got[i], rare[i]):
            assert r.score == pytest.approx(log / math.log(10), rel=1e-5)
            assert r.base_score == pytest.approx(base, rel=1e-9)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(words[w] > 0 for w in tokens), total)


def test_licenses_in_other_spellings(spark):
    from brightloom.llm.license_scan import NOTICES, scan_licenses

    mit = next(t for name, t in NOTICES if name == "MIT" and "hereby" in t)
    texts = ["RELEASED under   the MIT licence", "Copyright (c) 2020 Someone\n" + mit.replace(". ", ".\n"), "a\nAll Rights Reserved\nb",
             "not released under the MIT license at all"]
    got = [(r.whole_license, r.licenses, r.lines) for r in scan_licenses(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == [("MIT", ["MIT"], [1]), ("MIT", ["MIT"], []), (None, ["all-rights-reserved"], [2]), (None, [], [])]


@pytest.mark.parametrize("name", ["op3_substring_dedup", "op4_license_scan", "op6_temperature_mixing", "op7_exact_top_k", "op9_minhash_near_dedup"])
def test_queries_against_duckdb(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from brightloom.llm.queries import ORACLES, QUERIES
    from tools.check_oracle import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    assert rows_of(QUERIES[name](spark, FOLDER).toPandas()) == rows_of(con.execute(ORACLES[name]).fetchdf())


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = corpus_pipeline.run(spark, FOLDER)
    kept = got.select("doc_id").distinct().count()
    assert 0 < kept < docs.count()
    fill = got.agg(F.sum("length") / F.countDistinct("sequence_id") / 2048).first()[0]
    assert fill > 0.9
