"""Iterative scaling against a plain version of it."""

import math
import random
from collections import Counter, defaultdict

import pytest

from brightloom.operators.maxent import fit_maxent
from brightloom.plans.reviews import fit_text_classifier


def brute_force(bags, labels, rounds):
    kinds = sorted(set(labels.values()))
    seen = Counter((f, labels[d]) for d, bag in bags.items() for f in bag)
    active = {(d, k): [f for f in bag if (f, k) in seen] for d, bag in bags.items() for k in kinds}
    most = max(len(a) for a in active.values())
    w, slack = dict.fromkeys(seen, 0.0), 0.0
    for _ in range(rounds):
        expected, missing, own = defaultdict(float), 0.0, 0.0
        for d in bags:
            logs = [sum(w[f, k] for f in active[d, k]) + slack * (most - len(active[d, k])) for k in kinds]
            total = sum(math.exp(x - max(logs)) for x in logs)
            for k, x in zip(kinds, logs):
                p = math.exp(x - max(logs)) / total
                for f in active[d, k]:
                    expected[f, k] += p
                missing += p * (most - len(active[d, k]))
            own += most - len(active[d, labels[d]])
        for pair in w:
            w[pair] += math.log(seen[pair] / expected[pair]) / most
        if own and missing:
            slack += math.log(own / missing) / most
    return w, slack, most, kinds


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for d in range(60):
        good = d % 3 > 0
        words = rng.choices(["fine", "team", "pay"] if good else ["awful", "late", "pay"], k=rng.randint(1, 5))
        rows += [(d, f"has({x})", 1.0) for x in set(words)] + [(d, "neg_l(pay)", round(0.1 * (d % 4), 1))]
        labels.append((d, "good" if good else "bad"))
    features = spark.createDataFrame(rows, "doc long, feature string, value double").repartition(3)
    return rows, dict(labels), features, spark.createDataFrame([*labels, (99, None), (98, "good")], "doc long, label string")


def test_weights_equal_plain_scaling(reviews):
    rows, labels, features, table = reviews
    bags = defaultdict(set)
    for d, f, v in rows:
        bags[d].add(f"{f}={v}")
    want, slack, most, kinds = brute_force(bags, labels, 5)
    model = fit_maxent(features, table, "doc", rounds=5)
    assert (model.labels, model.most) == (kinds, most) and model.slack == pytest.approx(slack)
    got = {(r["_feature"], k): w for r in model.weights.collect() for k, w in zip(kinds, r["_w"]) if w is not None}
    assert got == pytest.approx(want)


def test_predictions_are_the_likelier_label(reviews):
    rows, labels, features, table = reviews
    model = fit_maxent(features, table, "doc", rounds=8)
    got = {r["doc"]: r for r in model.predict(features).collect()}
    assert len(got) == 60 and all(0.5 <= r["probability"] <= 1 for r in got.values())
    assert sum(got[d]["prediction"] == k for d, k in labels.items()) >= 57


def test_no_label_is_an_error(reviews):
    _, _, features, table = reviews
    with pytest.raises(ValueError):
        fit_maxent(features, table.where("label is null"), "doc")
    with pytest.raises(ValueError):
        fit_maxent(features, table.where("doc = 98"), "doc")


def test_classifier_on_whole_bags(spark):
    rows = [(i, "not good at all" if i % 2 else "really good pay", i % 2) for i in range(20)] + [(20, None, 1), (21, "unheard", None)]
    texts = spark.createDataFrame(rows, "id long, text string, label int")
    model, predict = fit_text_classifier(texts, "id", "text", "label", rounds=4)
    names = {r["_feature"] for r in model.weights.collect()}
    assert {"has(good)=1.0", "has(not,good,at)=1.0", "neg_l(good)=0.9", "neg_r(good)=0.0"} <= names
    got = {r["id"]: r["prediction"] for r in predict(texts).collect()}
    assert len(got) == 22 and all(got[i] == i % 2 for i in range(20)) and got[20] is None


def test_features_of_the_same_documents_are_fitted_as_one(spark, monkeypatch):
    import brightloom.operators.maxent as maxent

    sizes = []
    numbered = maxent.number_rows
    monkeypatch.setattr(maxent, "number_rows", lambda df, *a: sizes.append(df.count()) or numbered(df, *a))
    rows = [(d, f"own{d}_{i}", 1.0) for d in range(6) for i in range(20)] + [(d, f"both{i}", 1.0) for d in (0, 1) for i in range(5)]
    rows += [(d, "all", 1.0) for d in range(6)]
    bags = defaultdict(set)
    for d, f, v in rows:
        bags[d].add(f"{f}={v}")
    labels = {d: "ab"[d % 2] for d in range(6)}
    table = spark.createDataFrame(list(labels.items()), "doc long, label string")
    model = fit_maxent(spark.createDataFrame(rows, "doc long, feature string, value double"), table, "doc", rounds=4)
    want, slack, most, kinds = brute_force(bags, labels, 4)
    got = {(r["_feature"], k): w for r in model.weights.collect() for k, w in zip(kinds, r["_w"]) if w is not None}
    assert sizes == [8] and model.most == most and model.slack == pytest.approx(slack) and got == pytest.approx(want)


def test_no_table_has_a_row_for_an_entry(spark, monkeypatch):
    """Entries are dealt as packed numbers; what a round writes follows the documents."""
    import brightloom.operators.maxent as maxent

    sizes = []
    durable = maxent.durable
    monkeypatch.setattr(maxent, "durable", lambda df: sizes.append(df.count()) or durable(df))
    entries = 60_000
    features = spark.range(entries).selectExpr("id % 300 AS doc", "concat('has(', sha(string(id div 3 * 2)), ')') AS feature", "1.0D AS value")
    labels = spark.range(300).selectExpr("id AS doc", "int(id % 2) AS label")
    model = fit_maxent(features, labels, "doc", rounds=3)
    assert sizes and max(sizes) <= 300
    assert model.weights.count() == entries // 3 and model.predict(features).count() == 300


def test_predictions_of_documents_with_other_keys_and_repeated_entries(spark):
    rows = [(f"d{i}", f"has(w{i % 7})", 1.0) for i in range(70)] + [(f"d{i}", "all", 0.3) for i in range(70)]
    features = spark.createDataFrame(rows, "doc string, feature string, value double")
    labels = spark.createDataFrame([(f"d{i}", "xyz"[i % 7 % 3]) for i in range(70)], "doc string, label string")
    model = fit_maxent(features, labels, "doc", rounds=6)
    once = {r["doc"]: (r["prediction"], round(r["probability"], 12)) for r in model.predict(features).collect()}
    twice = fit_maxent(features.union(features), labels, "doc", rounds=6)
    again = {r["doc"]: (r["prediction"], round(r["probability"], 12)) for r in twice.predict(features.union(features).repartition(5)).collect()}
    assert once == again and all(once[f"d{i}"][0] == "xyz"[i % 7 % 3] for i in range(70))
    other = model.predict(spark.createDataFrame([("q", "never", 1.0)], "doc string, feature string, value double")).collect()
    assert [(r["doc"], round(r["probability"], 9)) for r in other] == [("q", round(1 / 3, 9))]
