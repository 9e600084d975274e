"""Projection, derived columns and filters."""

from pyspark.sql import functions as F

from brightloom.functions import values as V
from brightloom.operators import rows as R
from brightloom.operators.ordering import number_rows

from . import entry


@entry("p01_select", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(t):
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")


@entry("p02_drop", "SELECT * EXCLUDE (p_name, p_type) FROM part")
def _(t):
    return t.part.drop("p_name", "p_type")


@entry("p03_rename", """
    SELECT doc_id AS "Document", source AS "Source", lang AS "Language", n_chars FROM documents""")
def _(t):
    return (t.documents.select("doc_id", "source", "lang", "n_chars")
            .withColumnsRenamed({"doc_id": "Document", "source": "Source", "lang": "Language"}))


@entry("p04_select_numeric", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
    FROM lineitem""")
def _(t):
    return R.select_numeric(t.lineitem)


@entry("p05_constant_columns", """
    SELECT c_custkey, 'Technology' AS industry, 1 AS version FROM customer""")
def _(t):
    return R.with_const(t.customer.select("c_custkey"), industry="Technology", version=1)


@entry("p06_case_map", """
    SELECT event_id, CASE WHEN value <= 10 THEN 1 WHEN value <= 50 AND event_type = 'click' THEN 2
                          WHEN event_type = 'error' THEN 3 ELSE 0 END AS class FROM events""")
def _(t):
    v, kind = F.col("value"), F.col("event_type")
    return t.events.select("event_id", V.case_map(
        [v <= 10, (v <= 50) & (kind == "click"), kind == "error"], [1, 2, 3]).alias("class"))


@entry("p07_if_else", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'bad' ELSE 'fine' END AS state FROM events""")
def _(t):
    return t.events.select("event_id",
                           V.if_else(F.col("event_type") == "error", "bad", "fine").alias("state"))


HOLES = """SELECT event_id, event_type,
    CASE WHEN event_id % 7 <> 0 THEN value END AS value,
    CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS DOUBLE) END AS user_id,
    CASE WHEN event_id % 11 <> 0 THEN user_id * 0.5 END AS weight FROM events"""


def holes(t):
    """Events with nulls at known places."""
    key = F.col("event_id")
    return t.events.select(
        "event_id", "event_type", F.when(key % 7 != 0, F.col("value")).alias("value"),
        F.when(key % 5 != 0, F.col("user_id").cast("double")).alias("user_id"),
        F.when(key % 11 != 0, F.col("user_id") * 0.5).alias("weight"))


@entry("p08_drop_null", f"SELECT * FROM ({HOLES}) WHERE value IS NOT NULL")
def _(t):
    return holes(t).dropna(subset=["value"])


@entry("p09_null_count_filter", f"""
    WITH h AS ({HOLES}), c AS (SELECT *, (value IS NULL)::INT + (user_id IS NULL)::INT + (weight IS NULL)::INT AS n FROM h)
    SELECT * EXCLUDE n, 'many' AS part FROM c WHERE n > 1
    UNION ALL SELECT * EXCLUDE n, 'none' AS part FROM c WHERE n < 1""")
def _(t):
    h = holes(t)
    return R.union_all([R.null_count_filter(h, 1, ">").withColumn("part", F.lit("many")),
                        R.null_count_filter(h, 1, "<").withColumn("part", F.lit("none"))])


@entry("p10_facet_filter", """
    SELECT doc_id, n_chars FROM documents WHERE lang = 'en' AND source = 'src7'""")
def _(t):
    return R.facet_filter(t.documents, {"lang": "en", "source": "src7"}).select("doc_id", "n_chars")


@entry("p11_range_filter", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice BETWEEN 50000 AND 200000
      AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-06-30'""")
def _(t):
    priced = R.range_filter(t.orders, "o_totalprice", 50000, 200000)
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1997-06-30"))
    return R.range_filter(priced, "o_orderdate", low, high).select("o_orderkey", "o_totalprice")


@entry("p12_membership_filter", """
    SELECT doc_id, source, lang FROM documents WHERE source IN ('src1', 'src2', 'src3')
      AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def _(t):
    docs = R.isin_filter(t.documents, "source", ["src1", "src2", "src3"])
    docs = R.isin_filter(docs, "lang", ["en", "ALL"])
    good = t.labels.where("quality = 1").select("doc_id")
    return R.isin_filter(docs, "doc_id", good).select("doc_id", "source", "lang")


@entry("p13_facet_values", """
    SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderstatus = 'F'""")
def _(t):
    return R.facet_values(t.orders, "o_orderpriority", {"o_orderstatus": "F"})


@entry("p14_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t):
    return t.part.select("p_brand", "p_type").distinct()


@entry("p15_number_then_filter", """
    SELECT * FROM (SELECT user_id, event_id, event_type,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_no FROM events)
    WHERE event_type <> 'error'""")
def _(t):
    return (R.number_then_filter(t.events.select("user_id", "event_id", "event_type", "ts"),
                                 ["ts", "event_id"], F.col("event_type") != "error", ["user_id"])
            .drop("ts"))


@entry("p16_date_limit_flag", """
    SELECT user_id, strftime(max(ts), '%Y-%m-%d') AS newest, strftime(min(ts), '%Y-%m-%d') AS oldest,
           CAST(max(ts) > TIMESTAMP '2024-01-30 12:00:00' OR min(ts) < TIMESTAMP '2024-01-01 06:00:00' AS INTEGER)
             AS limit_reached
    FROM events GROUP BY user_id""")
def _(t):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-01 06:00:00", "2024-01-30 12:00:00"))
    return (R.date_limit_flag(t.events, ["user_id"], "ts", low, high)
            .withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("newest", "oldest")}))


@entry("p17_row_mean", f"""
    SELECT event_id, round(m, 6) AS mean, round_even(m, 0) AS stars FROM (
      SELECT event_id, CASE WHEN n > 0 THEN (coalesce(value, 0) + coalesce(user_id, 0) + coalesce(weight, 0)) / n END AS m
      FROM (SELECT *, (value IS NOT NULL)::INT + (user_id IS NOT NULL)::INT + (weight IS NOT NULL)::INT AS n
            FROM ({HOLES})))""")
def _(t):
    cols = ["value", "user_id", "weight"]
    return holes(t).select("event_id", F.round(V.row_mean(cols), 6).alias("mean"),
                           V.row_mean(cols, rounded=True).alias("stars"))


@entry("p18_threshold_label", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_quantity < 3.5 THEN 0 ELSE 1 END AS label FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             V.threshold_label("l_quantity", 3.5).alias("label"))


@entry("p19_bin_score", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(b AS VARCHAR) || ' Star' AS rank FROM (
      SELECT *, CASE WHEN l_discount * 10 <= 0 THEN 1 WHEN l_discount * 10 <= 0.3 THEN 2
                     WHEN l_discount * 10 <= 0.6 THEN 3 WHEN l_discount * 10 <= 0.9 THEN 4 ELSE 5 END AS b
      FROM lineitem)""")
def _(t):
    score = F.col("l_discount") * 10
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                             F.concat(V.bin_score(score).cast("string"), F.lit(" Star")).alias("rank"))


@entry("p20_rescale", "SELECT p_partkey, round(p_retailprice * 0.41, 4) AS price FROM part")
def _(t):
    return t.part.select("p_partkey", F.round(F.col("p_retailprice") * 0.41, 4).alias("price"))


@entry("p21_overall_score", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           round((l_discount + l_tax + l_quantity / 50) * (1 - (l_tax + l_discount + l_quantity / 100) / 3), 6) AS score
    FROM lineitem""")
def _(t):
    half = F.col("l_quantity") / 100
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(
        V.overall_score(["l_discount", "l_tax", F.col("l_quantity") / 50],
                        ["l_tax", "l_discount", half]), 6).alias("score"))


@entry("p22_interaction", """
    SELECT event_id, (CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 ELSE 0 END)
                     * (CASE WHEN value >= 25 THEN 1 ELSE 0 END) AS influence FROM events""")
def _(t):
    return t.events.select("event_id", V.interaction(
        "event_type", ["view", "click", "signup"], "value", 25).alias("influence"))


@entry("p23_difference_flag", f"""
    SELECT event_id, CASE WHEN value - weight >= 0 THEN 'feels_warmer' ELSE 'feels_colder' END AS feeling
    FROM ({HOLES})""")
def _(t):
    return holes(t).select("event_id", V.diff_flag("value", "weight").alias("feeling"))


@entry("p24_sort", """
    SELECT s_suppkey, s_acctbal, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS place
    FROM supplier ORDER BY s_acctbal DESC, s_suppkey""")
def _(t):
    return number_rows(t.supplier.select("s_suppkey", "s_acctbal"), ["-s_acctbal", "s_suppkey"], "place").orderBy("place")


@entry("p25_head", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 5")
def _(t):
    return t.events.select("event_id", "value").orderBy("event_id").limit(5)


@entry("p26_top_k", """
    SELECT user_id, count(*) AS events FROM events GROUP BY user_id ORDER BY events DESC, user_id LIMIT 10""")
def _(t):
    counts = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return R.top_k(counts, [F.desc("events"), "user_id"], 10)
