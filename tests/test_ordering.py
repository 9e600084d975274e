"""Sliced ranks and quantiles against plain Python, with one key holding most rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightloom.operators import ordering as O, relations, stats as A
from brightloom.operators.relations import attach, salted_join, sized_join


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    rows = [("hot" if i % 3 else f"k{i % 11}", i, float(np.round(rng.exponential(), 2))) for i in range(3000)]
    rows += [(None, 3000, 1.0), (None, 3001, 2.0)]
    return spark.createDataFrame(rows, "k string, id long, v double").persist()


def test_numbers_match_a_sort_in_every_group(skewed):
    got = O.number_rows(skewed, ["-v", "id"], by=["k"]).toPandas()
    assert len(got) == 3002
    for _, group in got.groupby("k", dropna=False):
        want = group.sort_values(["v", "id"], ascending=[False, True])
        assert list(want["row_no"]) == list(range(1, len(want) + 1))


def test_running_totals(skewed):
    got = O.prefix_sum(skewed, ["id"], "total", "v").toPandas().sort_values("id")
    assert np.allclose(got["total"], got["v"].cumsum())


@pytest.fixture(scope="module")
def lopsided(spark):
    """Nine of ten rows under one key; the order has a null and goes down in one column."""
    rng = np.random.default_rng(11)
    rows = [("hot" if i % 10 else f"k{i % 70}", None if i == 5 else int(rng.integers(0, 50)), f"r{i}", i % 7) for i in range(6000)]
    return spark.createDataFrame(rows, "k string, a int, b string, w int").repartition(6)


def _sorted_by_a(rows):
    down = sorted(rows, key=lambda r: r["b"])
    return sorted(down, key=lambda r: (r["a"] is None, -(r["a"] or 0)))


def test_running_totals_of_a_hot_key_write_nothing(lopsided, monkeypatch):
    from brightloom import runtime

    def written(df):
        raise AssertionError("wrote a table")

    monkeypatch.setattr(O, "durable", written)
    monkeypatch.setattr(runtime, "durable", written)
    got = O.prefix_sum(lopsided, ["-a", "b"], "total", "w", ["k"], slices=16)
    by = {}
    for r in got.collect():
        by.setdefault(r["k"], []).append(r)
    assert sum(map(len, by.values())) == 6000
    for rows in by.values():
        ranked = _sorted_by_a(rows)
        assert [r["total"] for r in ranked] == list(np.cumsum([r["w"] for r in ranked]))
    slices = got.select("k").groupBy("k").count().count()
    assert slices == len(by)


def test_slices_are_even_whatever_the_plan(lopsided):
    cut = O.Slices(lopsided, ["k", "-a", "b"], 16)
    once = {r["b"]: r["s"] for r in lopsided.select("b", cut.of_row().alias("s")).collect()}
    again = {r["b"]: r["s"] for r in lopsided.repartition(3, "w").select("b", cut.of_row().alias("s")).collect()}
    assert once == again
    sizes = np.bincount(list(once.values()))
    assert len(sizes) == 16 and sizes.max() < 3 * 6000 / 16


@pytest.mark.parametrize("n", [0, 1, 17, 2500, 5999, 6000, 7000])
def test_tail_and_head_by_the_nth_key(lopsided, monkeypatch, n):
    monkeypatch.setattr(O, "IN_ONE_SORT", 40)
    marked = O.holdout_tail(lopsided, ["-a", "b"], n).collect()
    ranked = _sorted_by_a(marked)
    assert [r["is_test"] for r in ranked] == [0] * (6000 - min(n, 6000)) + [1] * min(n, 6000)
    if 0 < n <= 6000:
        first = O.split_ordered(lopsided, ["-a", "b"], n / 6000).collect()
        assert [r["is_train"] for r in _sorted_by_a(first)] == [1] * n + [0] * (6000 - n)


def test_quantiles_match_linear_interpolation(skewed):
    got = O.exact_quantiles(skewed, ["v"], [0.0, 0.1, 0.5, 0.9, 1.0], ["k"]).toPandas()
    data = skewed.toPandas()
    for _, row in got.iterrows():
        same = data[data["k"].isna()] if row["k"] is None else data[data["k"] == row["k"]]
        assert row["value"] == pytest.approx(np.quantile(same["v"], row["prob"]))


def test_quantiles_of_awkward_doubles(spark):
    tiny = 5e-324
    values = [float("inf"), -float("inf"), 0.0, -0.0, 1e300, -1e300, 1.7e308, -1.7e308, tiny, 4 * tiny, 5 * tiny, 1.0, 1.0 + 2 ** -52]
    values += [2.0 ** -i for i in range(1000)] + [1 + 2.0 ** -i for i in range(52)] + [7.0] * 500
    df = spark.createDataFrame([(v, -v) for v in values] + [(None, float("nan"))], "v double, w double").repartition(3)
    n = len(values)
    probs = [0.0, *[i / (n - 1) for i in (1, 2, 300, 700, 1040, 1300, n - 2)], 1.0]
    got = {(r["variable"], r["prob"]): r["value"] for r in O.exact_quantiles(df, ["v", "w"], probs).collect()}
    for name, data in (("v", sorted(values)), ("w", sorted(-v for v in values))):
        for p in probs:
            spot = p * (n - 1)
            low, high = data[int(np.floor(spot))], data[int(np.ceil(spot))]
            assert min(low, high) <= got[name, p] <= max(low, high)


def test_quantiles_of_many_groups_and_columns(spark):
    rng = np.random.default_rng(5)
    rows = [(int(g), float(a), None if i % 5 == 0 else float(b)) for i, (g, a, b) in enumerate(
        zip(rng.integers(0, 40, 4000), rng.normal(size=4000), rng.lognormal(sigma=6, size=4000)))]
    df = spark.createDataFrame(rows, "g int, a double, b double").repartition(4)
    data = df.toPandas()
    got = O.exact_quantiles(df, ["a", "b"], [0.1, 0.5, 0.95], ["g"]).collect()
    assert len(got) == 40 * 2 * 3
    for r in got:
        assert r["value"] == pytest.approx(np.nanquantile(data[data.g == r["g"]][r["variable"]].dropna(), r["prob"]))


def test_quantiles_of_many_rows_and_heavy_ties(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.exponential(size=40_000), np.full(20_000, 0.5)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    got = {r["prob"]: r["value"] for r in O.exact_quantiles(df, ["v"], [0.001, 0.25, 0.5, 0.9]).collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantiles_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(4.0,)], "v double")
    assert {r["value"] for r in O.exact_quantiles(one, ["v"], [0.25, 0.5]).collect()} == {4.0}
    assert O.exact_quantiles(one.where("v < 0"), ["v"], [0.5]).count() == 0


def test_joins_give_the_same_rows_beyond_the_broadcast_limit(skewed, monkeypatch):
    counts = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    attached, joined = [], []
    for limit in (relations.BROADCAST_BYTES, -1):
        monkeypatch.setattr(relations, "BROADCAST_BYTES", limit)
        attached.append(attach(skewed, counts, ["k"]).orderBy("id").collect())
        joined.append(sized_join(skewed, counts, ["k"]).orderBy("id").collect())
    assert attached[0] == attached[1] and len(attached[0]) == 3002
    assert joined[0] == joined[1] and len(joined[0]) == 3000


def test_salted_join_equals_plain_join(spark, skewed):
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3)], "k string, m int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(str, skewed.join(right, ["k"], how).collect()))
        assert sorted(map(str, salted_join(skewed, right, ["k"], how).collect())) == want


def test_holdout_split_thin_and_batches(skewed):
    data = skewed.select("id", "k")
    tail = O.holdout_tail(data, ["id"], 100)
    assert tail.where("is_test = 1").agg(F.min("id"), F.count("id")).first()[:] == (2902, 100)
    assert O.split_ordered(data, ["id"], 0.7).agg(F.sum("is_train")).first()[0] == round(0.7 * 3002)
    kept = {r["frame_index"] for r in O.thin_by_root(data.where("k = 'k3'"), ["k"], ["id"]).collect()}
    n, last, want = data.where("k = 'k3'").count(), -1.0, set()
    for i in range(n):
        if round(2 * i ** 0.5) > round(last):
            want.add(i)
            last = 2 * i ** 0.5
    assert kept == want | {n - 1}
    batches = O.shuffle_batches(data, ["id"], 256, seed=1).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in batches) == [3002 - 11 * 256] + [256] * 11


def test_box_whiskers_and_outliers(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 100)], "v double")
    row = A.box_stats(df, "v").first()
    assert (row.q1, row.median, row.q3, row.whisker_low, row.whisker_high, row.outliers) == (2, 3, 4, 1, 4, 1)


def test_histogram_of_a_constant_and_total(spark, skewed):
    flat = spark.createDataFrame([(5.0,)] * 4, "v double")
    assert sum(r["count"] for r in A.histogram(flat, "v", 3).collect()) == 4
    assert A.histogram(skewed, "v", 7, ["k"]).agg(F.sum("count")).first()[0] == 3002


def test_correlation_of_pairwise_complete_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4))
    x[::7, 3] = np.nan  # half of them as null
    rows = [(*map(float, r[:3]), None if i % 14 == 0 else float(r[3]), 1.0) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, flat double")
    got = {(r.a, r.b): r.r for r in A.corr_matrix(df, [*"abcd", "flat"], "upper").collect()}
    assert len(got) == 10
    for (p, q), r in got.items():
        if "flat" in (p, q):
            assert r is None
            continue
        i, j = "abcd".index(p), "abcd".index(q)
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1])


@pytest.mark.parametrize("bandwidth", ["scott", "nrd0"])
def test_density_equals_the_kernel_sum_beside_a_far_outlier(spark, bandwidth):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(size=3000), rng.normal(8, 0.1, 500), [4000.0]])
    rows = [(float(v), 1.0) for v in values] + [(None, 1.0), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "v double, flat double")
    got = sorted(A.kde(df, ["v", "flat"], 400, bandwidth).collect(), key=lambda r: r["i"])
    assert {r["variable"] for r in got} == {"v"} and [r["i"] for r in got] == list(range(400))
    n, sd = len(values), values.std(ddof=1)
    iqr = np.subtract(*np.quantile(values, [0.75, 0.25]))
    h = n ** -0.2 * (sd if bandwidth == "scott" else 0.9 * min(sd, iqr / 1.34))
    x = np.linspace(values.min() - 3 * h, values.max() + 3 * h, 400)
    want = np.exp(-((x[:, None] - values) / h) ** 2 / 2).sum(axis=1) / (n * h * np.sqrt(2 * np.pi))
    assert np.allclose([r["x"] for r in got], x)
    assert np.abs(np.array([r["density"] for r in got]) - want).max() < 1e-9 * want.max() + 1e-15
