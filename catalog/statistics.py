"""Aggregation, reshaping and descriptive statistics."""

from pyspark.sql import functions as F

from brightloom.functions.wordlists import ENGLISH_STOP_WORDS
from brightloom.operators import evaluate as E, stats as A
from brightloom.operators.words import word_cloud_weights, word_freq

from . import entry
from .joining import STOP_SQL
from .projection import HOLES, holes

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@entry("a01_group_size", "SELECT lang, source, count(*) AS size FROM documents GROUP BY ALL")
def _(t):
    return A.group_size(t.documents, ["lang", "source"])


@entry("a02_rank_entities", """
    SELECT source, count(*) AS reviews, round(avg(n_chars), 6) AS score FROM documents GROUP BY source
    ORDER BY avg(n_chars) DESC, source LIMIT 10""")
def _(t):
    return A.rank_entities(t.documents, "source", "n_chars", 10).withColumn("score", F.round("score", 6))


@entry("a03_group_mean", """
    SELECT l_returnflag, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_extendedprice), 4) AS l_extendedprice,
           round(avg(l_discount), 6) AS l_discount, round(avg(l_tax), 6) AS l_tax FROM lineitem GROUP BY 1""")
def _(t):
    means = A.group_mean(t.lineitem, ["l_returnflag"], NUMBERS)
    return means.select("l_returnflag", *[F.round(c, 4 if c == "l_extendedprice" else 6).alias(c) for c in NUMBERS])


@entry("a04_pivot_count", """
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
           count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def _(t):
    return A.pivot_count(t.orders, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"])


@entry("a05_melt", """
    SELECT s_suppkey, 's_acctbal' AS variable, s_acctbal AS value FROM supplier
    UNION ALL SELECT s_suppkey, 's_nationkey', CAST(s_nationkey AS DOUBLE) FROM supplier""")
def _(t):
    return A.melt(t.supplier, ["s_suppkey"], ["s_acctbal", "s_nationkey"])


@entry("a06_describe", " UNION ALL ".join(f"""
    SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
           min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
           round(quantile_cont({c}, 0.75), 4) AS p75, max({c}) AS max FROM lineitem""" for c in NUMBERS))
def _(t):
    d = A.describe(t.lineitem, NUMBERS)
    return d.select("variable", "count", "min", "max",
                    *[F.round(c, 4).alias(c) for c in ("mean", "std", "p25", "p50", "p75")])


@entry("a07_null_counts", f"""
    WITH h AS ({HOLES}) SELECT 'value' AS variable, count(*) FILTER (value IS NULL) AS nulls FROM h
    UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL) FROM h
    UNION ALL SELECT 'weight', count(*) FILTER (weight IS NULL) FROM h""")
def _(t):
    return A.null_counts(holes(t), ["value", "user_id", "weight"])


@entry("a08_schema_listing")
def _(t):
    return A.dtypes(t.lineitem)


CORR = ["value", "user_id", "weight"]


def _corr_sql(source, cols, pairs):
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {source}"
                              for a, b in pairs)


@entry("a09_correlation_matrix", f"""
    WITH h AS ({HOLES}) {_corr_sql('h', CORR, [(a, b) for a in CORR for b in CORR])}""")
def _(t):
    return A.corr_matrix(holes(t), CORR).withColumn("r", F.round("r", 6))


@entry("a09_correlation_lower", _corr_sql(
    "lineitem", NUMBERS, [(b, a) for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]]))
def _(t):
    return A.corr_matrix(t.lineitem, NUMBERS, "lower").withColumn("r", F.round("r", 6))


WIDE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *NUMBERS, "late"]


@entry("a09_correlation_wide", f"""
    WITH w AS (SELECT *, CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity * l_tax END AS late FROM lineitem)
    {_corr_sql('w', None, [(a, b) for i, a in enumerate(WIDE) for b in WIDE[i + 1:]])}""")
def _(t):
    late = F.when(F.col("l_orderkey") % 5 != 0, F.col("l_quantity") * F.col("l_tax"))
    return A.corr_matrix(t.lineitem.withColumn("late", late), WIDE, "upper").withColumn("r", F.round("r", 6))


@entry("a10_correlation_of_means", f"""
    WITH m AS (SELECT l_suppkey, avg(l_quantity) AS l_quantity, avg(l_discount) AS l_discount, avg(l_tax) AS l_tax
               FROM lineitem GROUP BY 1)
    {_corr_sql('m', None, [('l_quantity', 'l_discount'), ('l_quantity', 'l_tax'), ('l_discount', 'l_tax')])}""")
def _(t):
    cols = ["l_quantity", "l_discount", "l_tax"]
    return A.group_corr(t.lineitem, "l_suppkey", cols, "upper").withColumn("r", F.round("r", 6))


HISTOGRAM = """
    WITH s AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
    c AS (SELECT event_type, CAST(least(floor((value - lo) / ((hi - lo) / 15)), 14) AS INTEGER) AS bin, count(*) AS n
          FROM events JOIN s USING (event_type) GROUP BY ALL)
    SELECT s.event_type, CAST(b AS INTEGER) AS bin, lo + b * ((hi - lo) / 15) AS left_edge,
           lo + (b + 1) * ((hi - lo) / 15) AS right_edge, coalesce(n, 0) AS count
    FROM s CROSS JOIN range(15) r(b) LEFT JOIN c ON c.event_type = s.event_type AND c.bin = b"""


@entry("a11_histogram", f"""
    SELECT event_type, bin, round(left_edge, 6) AS left_edge, round(right_edge, 6) AS right_edge, count FROM ({HISTOGRAM})""")
def _(t):
    h = A.histogram(t.events, "value", 15, ["event_type"])
    return h.withColumns({c: F.round(c, 6) for c in ("left_edge", "right_edge")})


@entry("a11_histogram_global", """
    WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
    c AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
          FROM lineitem, s GROUP BY ALL)
    SELECT CAST(b AS INTEGER) AS bin, coalesce(n, 0) AS count FROM range(50) r(b) LEFT JOIN c ON c.bin = b""")
def _(t):
    return A.histogram(t.lineitem, "l_extendedprice", 50).select("bin", "count")


@entry("a12_density_histogram", f"""
    SELECT event_type, bin, round(count / (sum(count) OVER (PARTITION BY event_type) * (right_edge - left_edge)), 8) AS density
    FROM ({HISTOGRAM})""")
def _(t):
    h = A.density_histogram(t.events, "value", 15, ["event_type"])
    return h.select("event_type", "bin", F.round("density", 8).alias("density"))


@entry("a12_normal_curve", """
    SELECT event_type, CAST(i AS INTEGER) AS i, round(mu - 3 * sd + i * (6 * sd / 99), 6) AS x,
           round(exp(-pow((mu - 3 * sd + i * (6 * sd / 99) - mu) / sd, 2) / 2) / (sd * sqrt(2 * pi())), 8) AS density
    FROM (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM events GROUP BY 1), range(100) r(i)""")
def _(t):
    c = A.normal_curve(t.events, "value", ["event_type"])
    return c.select("event_type", "i", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@entry("a13_kernel_density", """
    WITH l AS (SELECT 'l_quantity' AS variable, l_quantity AS v FROM lineitem
               UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem),
    s AS (SELECT variable, min(v) AS lo, max(v) AS hi, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS bw FROM l GROUP BY 1),
    w AS (SELECT variable, v, count(*) AS w FROM l GROUP BY ALL)
    SELECT variable, CAST(i AS INTEGER) AS i, round(any_value(lo - 3 * bw + i * (hi - lo + 6 * bw) / 99), 4) AS x,
      round(sum(w * exp(-pow((lo - 3 * bw + i * (hi - lo + 6 * bw) / 99 - v) / bw, 2) / 2)) / any_value(n * bw * sqrt(2 * pi())), 11) AS density
    FROM w JOIN s USING (variable), range(100) r(i) GROUP BY variable, i""")
def _(t):
    k = A.kde(t.lineitem, ["l_quantity", "l_extendedprice"])
    return k.select("variable", "i", F.round("x", 4).alias("x"), F.round("density", 11).alias("density"))


BOX = """
    WITH q AS (SELECT {k} AS k, quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS median, quantile_cont({v}, 0.75) AS q3
               FROM {t} GROUP BY 1)
    SELECT q.k AS {k}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
      min({v}) FILTER ({v} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
      max({v}) FILTER ({v} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
      count(*) FILTER ({v} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM {t} JOIN q ON {t}.{k} = q.k GROUP BY ALL"""


@entry("a14_box_stats", BOX.format(t="events", k="event_type", v="value"))
def _(t):
    b = A.box_stats(t.events, "value", ["event_type"])
    return b.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@entry("a14_box_stats_global", """
    WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3,
                      quantile_cont(o_totalprice, 0.5) AS median FROM orders)
    SELECT round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
      count(*) FILTER (o_totalprice NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM orders, q""")
def _(t):
    b = A.box_stats(t.orders, "o_totalprice")
    return b.select("outliers", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")])


WORDS = f"""SELECT word, count(*) AS frequency FROM (
      SELECT unnest(string_split(regexp_replace(lower(text), '[^A-Za-z]+', ' ', 'g'), ' ')) AS word FROM documents)
    WHERE length(word) > 2 AND word NOT IN {STOP_SQL} GROUP BY word ORDER BY frequency DESC, word"""


@entry("a15_word_frequency", f"{WORDS} LIMIT 100")
def _(t):
    return word_freq(t.documents, "text", ENGLISH_STOP_WORDS, 100)


@entry("a16_word_cloud", f"""
    SELECT word, frequency, round(frequency / max(frequency) OVER (), 8) AS weight FROM ({WORDS} LIMIT 20)""")
def _(t):
    return (word_cloud_weights(t.documents, "text", ENGLISH_STOP_WORDS, 20)
            .withColumn("weight", F.round("weight", 8)))


# A scored table: the order value predicted by plain arithmetic on its key.
SCORED = """SELECT o_orderpriority AS part, o_totalprice AS actual,
                   o_totalprice * (0.8 + (o_orderkey % 41) / 100.0::DOUBLE) + (o_custkey % 7) * 1000 AS pred FROM orders"""


def scored(t):
    pred = (F.col("o_totalprice") * (0.8 + (F.col("o_orderkey") % 41) / 100.0)
            + (F.col("o_custkey") % 7) * 1000)
    return t.orders.select(F.col("o_orderpriority").alias("part"), F.col("o_totalprice").alias("actual"),
                           pred.alias("pred"))


@entry("a17_mape", f"""
    SELECT part, round(avg(abs((actual - pred) / actual)) * 100, 6) AS mape FROM ({SCORED}) GROUP BY part""")
def _(t):
    return E.score(scored(t), ["part"], mape=F.round(E.mape_of("actual", "pred"), 6))


@entry("a18_msfe", f"SELECT part, round(avg(pow(actual - pred, 2)), 0) AS msfe FROM ({SCORED}) GROUP BY part")
def _(t):
    return E.score(scored(t), ["part"], msfe=F.round(E.msfe_of("actual", "pred"), 0))


@entry("a19_r2", f"""
    SELECT part, round(1 - sum(pow(actual - pred, 2)) / (count(*) * var_pop(actual)), 8) AS r2 FROM ({SCORED}) GROUP BY part""")
def _(t):
    return E.score(scored(t), ["part"], r2=F.round(E.r2_of("actual", "pred"), 8))


LABELLED = """SELECT lang, CAST(quality AS DOUBLE) AS label, (doc_id % 100) / 100.0::DOUBLE AS score,
                     (doc_id % 50) / 50.0::DOUBLE AS other FROM labels JOIN documents USING (doc_id)"""


def labelled(t):
    key = F.col("doc_id")
    return t.labels.join(t.documents.select("doc_id", "lang"), "doc_id").select(
        "lang", F.col("quality").cast("double").alias("label"), ((key % 100) / 100.0).alias("score"),
        ((key % 50) / 50.0).alias("other"))


@entry("a20_accuracy", f"""
    SELECT lang, round(avg((label = CASE WHEN score > 0.5 THEN 1 ELSE 0 END)::INT), 8) AS accuracy,
           round(avg((label = round_even(score, 0))::INT), 8) AS exact FROM ({LABELLED}) GROUP BY lang""")
def _(t):
    return E.score(labelled(t).withColumn("guess", F.bround("score", 0)), ["lang"],
                   accuracy=F.round(E.accuracy_of("label", "score", 0.5), 8),
                   exact=F.round(E.accuracy_of("label", "guess"), 8))


def _bce(y, p):
    q = f"least(greatest({p}, 1e-7), 1 - 1e-7)"
    return f"avg(-({y} * ln({q}) + (1 - {y}) * ln(1 - {q})))"


@entry("a21_log_loss", f"""
    SELECT lang, round({_bce('label', 'score')}, 6) AS loss, round({_bce('1', 'other')}, 6) AS generator,
      round({_bce('1', 'score')} + {_bce('0', 'other')}, 6) AS discriminator,
      round(avg(-(label * ln(1 / (1 + exp(-(score * 4 - 2)))) + (1 - label) * ln(1 - 1 / (1 + exp(-(score * 4 - 2)))))), 6) AS logit_loss
    FROM ({LABELLED}) GROUP BY lang""")
def _(t):
    logit = F.col("score") * 4 - 2
    return E.score(labelled(t), ["lang"], loss=F.round(E.log_loss_of("label", "score"), 6),
                   generator=F.round(E.generator_loss_of("other"), 6),
                   discriminator=F.round(E.discriminator_loss_of("score", "other"), 6),
                   logit_loss=F.round(E.log_loss_of("label", logit, from_logits=True), 6))


@entry("a22_residual_range", f"""
    SELECT part, round(min(actual - pred), 4) AS lowest, round(max(actual - pred), 4) AS highest FROM ({SCORED}) GROUP BY part""")
def _(t):
    r = E.residual_range(scored(t), "actual", "pred", ["part"])
    return r.select("part", F.round("lowest", 4).alias("lowest"), F.round("highest", 4).alias("highest"))


@entry("a22_residuals", f"SELECT actual, round(pred, 4) AS pred, round(actual - pred, 4) AS residual FROM ({SCORED})")
def _(t):
    r = E.residuals(scored(t).drop("part"), "actual", "pred")
    return r.select("actual", F.round("pred", 4).alias("pred"), F.round("residual", 4).alias("residual"))


@entry("a23_prediction_error", f"""
    SELECT part, round(regr_slope(pred, actual), 8) AS slope, round(regr_intercept(pred, actual), 4) AS intercept,
           round(1 - sum(pow(actual - pred, 2)) / (count(*) * var_pop(actual)), 8) AS r2 FROM ({SCORED}) GROUP BY part""")
def _(t):
    p = E.prediction_error(scored(t), "actual", "pred", ["part"])
    return p.select("part", F.round("slope", 8).alias("slope"), F.round("intercept", 4).alias("intercept"),
                    F.round("r2", 8).alias("r2"))


@entry("a24_leaderboard", f"""
    SELECT part AS approach, round(1 - sum(pow(actual - pred, 2)) / (count(*) * var_pop(actual)), 8) AS accuracy
    FROM ({SCORED}) GROUP BY part ORDER BY accuracy DESC, approach LIMIT 3""")
def _(t):
    board = E.score(scored(t).withColumnRenamed("part", "approach"), ["approach"],
                    accuracy=F.round(E.r2_of("actual", "pred"), 8))
    return E.leaderboard(board, "accuracy", "approach", 3)


CELLS = [("1-URGENT", "F"), ("2-HIGH", "F"), ("1-URGENT", "O"), ("2-HIGH", "O")]


@entry("a25_error_frame", "SELECT horizon, " + ", ".join(
    f"""round(avg(abs((actual - pred) / actual)) FILTER (o_orderpriority = '{m}' AND o_orderstatus = '{s}') * 100, 6) AS "MAPE_{s}_{m}",
        round(avg(pow(actual - pred, 2)) FILTER (o_orderpriority = '{m}' AND o_orderstatus = '{s}'), 0) AS "MSFE_{s}_{m}" """
    for m, s in CELLS) + """
    FROM (SELECT CAST(o_orderkey % 4 + 1 AS BIGINT) AS horizon, o_orderpriority, o_orderstatus, o_totalprice AS actual,
                 o_totalprice * (0.8 + (o_orderkey % 41) / 100.0::DOUBLE) AS pred FROM orders) GROUP BY horizon""")
def _(t):
    rows = t.orders.select((F.col("o_orderkey") % 4 + 1).alias("horizon"), "o_orderpriority", "o_orderstatus",
                           F.col("o_totalprice").alias("actual"),
                           (F.col("o_totalprice") * (0.8 + (F.col("o_orderkey") % 41) / 100.0)).alias("pred"))
    frame = E.error_frame(rows, "horizon", "o_orderpriority", "o_orderstatus", "actual", "pred", CELLS)
    return frame.select("horizon", *[F.round(F.col(f"`{c}`"), 6 if c.startswith("MAPE") else 0).alias(c)
                                     for c in frame.columns[1:]])
