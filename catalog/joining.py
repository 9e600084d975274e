"""Joins and set operations."""

from pyspark.sql import functions as F

from brightloom.functions.wordlists import ENGLISH_STOP_WORDS
from brightloom.operators import relations as J, search as Q
from brightloom.operators.rows import union_all

from . import entry

STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + ")"

# Analysed tokens (doc_id, pos, term) of a text table, for the SQL twins.
def tokens_sql(source: str, key: str = "doc_id", stop: str = STOP_SQL) -> str:
    return rf"""
    SELECT {key}, CAST(i - 1 AS INTEGER) AS pos, term FROM (
      SELECT {key}, unnest(a) AS term, generate_subscripts(a, 1) AS i FROM (
        SELECT {key}, list_transform(list_filter(regexp_split_to_array(text, '[^\p{{L}}\p{{N}}_]+'),
          lambda w: regexp_full_match(w, '\p{{L}}+') AND length(w) > 1 AND lower(w) NOT IN {stop}),
          lambda w: lower(w)) AS a FROM {source}))"""


@entry("j01_inner_join", """
    SELECT c_custkey, c_acctbal, n_name AS country FROM customer JOIN
      (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey""")
def _(t):
    mapping = t.nation.where("n_regionkey <> 2")
    return (J.join_on(t.customer, mapping, ["c_nationkey"], ["n_nationkey"])
            .select("c_custkey", "c_acctbal", F.col("n_name").alias("country")))


SHIPPED = "SELECT l_shipdate AS day, count(*) AS shipped FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1"


@entry("j02_left_join", f"""
    SELECT o_orderkey, CAST(coalesce(shipped, -1) AS BIGINT) AS shipped FROM orders LEFT JOIN ({SHIPPED}) ON o_orderdate = day""")
def _(t):
    daily = (t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_shipdate").alias("day"))
             .agg(F.count(F.lit(1)).alias("shipped")))
    return (J.join_on(t.orders, daily, ["o_orderdate"], ["day"], "left")
            .select("o_orderkey", F.coalesce("shipped", F.lit(-1)).alias("shipped")))


@entry("j03_interval_flag", """
    WITH b AS (SELECT CAST(ts AS DATE) AS day, min(hour(ts)) AS sunrise, max(hour(ts)) AS sunset
               FROM events WHERE event_type = 'purchase' AND day(ts) % 5 <> 0 GROUP BY 1)
    SELECT event_id, CASE WHEN hour(ts) BETWEEN sunrise AND sunset THEN 1 ELSE 0 END AS daylight
    FROM events LEFT JOIN b ON CAST(ts AS DATE) = day""")
def _(t):
    bounds = (t.events.where((F.col("event_type") == "purchase") & (F.dayofmonth("ts") % 5 != 0))
              .groupBy(F.to_date("ts").alias("Date"))
              .agg(F.min(F.hour("ts")).alias("Sunrise"), F.max(F.hour("ts")).alias("Sunset")))
    facts = t.events.select("event_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hr"))
    return (J.flag_interval(facts, bounds, "day", "Date", "hr", "Sunrise", "Sunset", "daylight")
            .select("event_id", "daylight"))


@entry("j03_interval_join", """
    SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey
      AND c_acctbal BETWEEN s_acctbal - 300 AND s_acctbal + 900""")
def _(t):
    """Customers whose balance lies in the band around a supplier of their nation."""
    bands = t.supplier.select(F.col("s_nationkey").alias("nation"), "s_suppkey", (F.col("s_acctbal") - 300).alias("low"),
                              (F.col("s_acctbal") + 900).alias("high"))
    points = t.customer.select(F.col("c_nationkey").alias("nation"), "c_custkey", "c_acctbal")
    return J.interval_join(points, bands, "c_acctbal", "low", "high", ["nation"], 1000.0).select("c_custkey", "s_suppkey")


@entry("j04_remove_listed", f"""
    SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS word FROM documents)
    WHERE word NOT IN {STOP_SQL} AND word NOT IN (SELECT lower(p_name) FROM part UNION ALL SELECT lang FROM documents)
    GROUP BY ALL""")
def _(t):
    words = t.documents.select("doc_id", F.explode(F.split(F.lower("text"), " ")).alias("word"))
    kept = J.remove_listed(words, ENGLISH_STOP_WORDS)
    listed = t.part.select(F.lower("p_name").alias("w")).union(t.documents.select("lang"))
    kept = J.remove_listed(kept, listed.distinct())
    return kept.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


def tokens(t):
    return Q.index_tokens(t.spread("documents", "doc_id"), "doc_id", "text")


@entry("j05_match_terms", f"""
    WITH tok AS ({tokens_sql('documents')}), q AS ({tokens_sql('benchmark', 'item_id')})
    SELECT term, doc_id, count(*) AS tf FROM tok WHERE term IN (SELECT term FROM q) GROUP BY ALL""")
def _(t):
    wanted = Q.index_tokens(t.benchmark, "item_id", "text").select("term")
    return (J.match_terms(Q.build_index(tokens(t)), wanted).select("term", "doc_id", "tf"))


@entry("j06_docs_with_all", f"""
    SELECT doc_id FROM ({tokens_sql('documents')}) WHERE term IN ('thon', 'est', 'leaux', 'ndre')
    GROUP BY doc_id HAVING count(DISTINCT term) = 4
    UNION SELECT doc_id FROM ({tokens_sql('documents')}) WHERE term IN ('er', 'th') GROUP BY doc_id HAVING count(DISTINCT term) = 2""")
def _(t):
    tok = tokens(t)
    return (J.docs_with_all(tok, ["thon", "est", "leaux", "ndre"])
            .union(J.docs_with_all(tok, ["er", "th", "er"])).distinct())


PHRASE = ["de", "la"]


@entry("j07_phrase_match", f"""
    WITH tok AS ({tokens_sql('documents')})
    SELECT DISTINCT a.doc_id FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
    WHERE a.term = '{PHRASE[0]}' AND b.term = '{PHRASE[1]}'""")
def _(t):
    return J.phrase_match(tokens(t), PHRASE)


@entry("j08_union", """
    SELECT c_custkey AS key, c_acctbal AS balance, 'customer' AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier""")
def _(t):
    return union_all([
        t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"),
                          F.lit("customer").alias("kind")),
        t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"),
                          F.col("s_suppkey").alias("key"))])


MONTHS = """SELECT CAST(date_diff('month', TIMESTAMP '1995-01-01', date_trunc('month', o_orderdate)) AS INTEGER) AS m,
                   round(sum(o_totalprice), 2) AS y FROM orders GROUP BY 1"""


def months(t):
    month = ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1).alias("m")
    return t.orders.groupBy(month).agg(F.round(F.sum("o_totalprice"), 2).alias("y"))


@entry("j09_align", f"""
    WITH a AS ({MONTHS}), l1 AS (SELECT m + 1 AS m, y FROM a), l12 AS (SELECT m + 12 AS m, y FROM a)
    SELECT m, a.y AS actual, l1.y AS naive, l12.y AS seasonal FROM a FULL JOIN l1 USING (m) FULL JOIN l12 USING (m)""")
def _(t):
    a = months(t)
    return J.align({"actual": a, "naive": a.select((F.col("m") + 1).alias("m"), "y"),
                    "seasonal": a.select((F.col("m") + 12).alias("m"), "y")}, ["m"], "y")


@entry("j10_splice", f"""
    WITH a AS ({MONTHS}) SELECT m, y FROM a WHERE m <= 60
    UNION ALL SELECT m + 12, y FROM a WHERE m + 12 > 60""")
def _(t):
    a = months(t)
    ahead = a.select((F.col("m") + 12).alias("m"), F.col("y").alias("pred"))
    return J.splice(a, ahead, "m", "y", "pred", 60)
