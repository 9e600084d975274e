"""Window-shaped operators."""

from pyspark.sql import functions as F

from brightloom.operators import ordering as O, series as S, words as W
from brightloom.operators.search import positions_of
from brightloom.runtime import Tables

from . import entry


@entry("w01_row_index", """
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS row_no FROM events""")
def _(t):
    return O.number_rows(t.events.select("event_id", "event_type", "ts"), ["ts", "event_id"],
                         by=["event_type"]).drop("ts")


@entry("w02_token_positions", """
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, word FROM (
      SELECT doc_id, unnest(a) AS word, generate_subscripts(a, 1) AS i FROM (SELECT doc_id, string_split(text, ' ') AS a FROM documents))""")
def _(t):
    return positions_of(t.documents, ["doc_id"], F.split("text", " "), "word")


NEGATIONS = ["not", "of", "que", "un", "er"]
CLEAN = """
    SELECT doc_id, unnest(a) AS word, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS pos FROM (
      SELECT doc_id, list_filter(list_transform(regexp_split_to_array({text}, '[ \\t\\n\\r\\f\\v]+'),
        lambda w: regexp_replace(w, '[^A-Za-z0-9]+', '', 'g')), lambda w: w <> '') AS a FROM {table})"""
NEGATION_SQL = f"""
    WITH w AS ({CLEAN.format(text='lower(text)', table='documents')}),
    f AS (SELECT *, CASE WHEN word IN ('not', 'of', 'que', 'un', 'er') OR contains(word, 'n''t') THEN pos END AS hit FROM w)
    SELECT doc_id, pos, word,
      greatest(0, coalesce(1 - 0.1::DOUBLE * (pos - last_value(hit IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 0)) AS l,
      greatest(0, coalesce(1 - 0.1::DOUBLE * (first_value(hit IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - pos), 0)) AS r FROM f"""


@entry("w03_negation_proximity", f"""
    SELECT doc_id, pos, word, round(l, 6) AS "left", round(r, 6) AS "right" FROM ({NEGATION_SQL})""")
def _(t):
    docs = t.spread("documents", "doc_id")
    scores = W.negation_scores(docs, "doc_id", NEGATIONS, W.plain_tokens(F.lower("text")))
    return scores.withColumns({c: F.round(c, 6) for c in ("left", "right")})


QUARTERS = """
    SELECT c_nationkey AS nation, (year(o_orderdate) - 1995) * 4 + quarter(o_orderdate) AS t, sum(o_totalprice) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""
# regular series: every nation in every quarter, gaps 0
SERIES = f"""
    SELECT nation, CAST(t AS INTEGER) AS t, CAST(coalesce(total, 0) AS DOUBLE) AS y FROM (SELECT DISTINCT nation FROM ({QUARTERS}))
    CROSS JOIN (SELECT unnest(range(1, (SELECT max(t) + 1 FROM ({QUARTERS})))) AS t) LEFT JOIN ({QUARTERS}) USING (nation, t)"""


# by month, where the method needs more points than 27 quarters give: 80 of them
MONTHS = QUARTERS.replace("* 4 + quarter(", "* 12 + month(")
MONTHLY = SERIES.replace(QUARTERS, MONTHS)


def months(t: Tables):
    facts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return S.to_series(facts.withColumnRenamed("c_nationkey", "nation"), ["nation"], "o_orderdate",
                       "o_totalprice", "month")


def quarters(t: Tables):
    facts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return S.to_series(facts.withColumnRenamed("c_nationkey", "nation"), ["nation"], "o_orderdate",
                       "o_totalprice", "quarter")


def _difference_sql(d, big_d, s):
    y = "y"
    inner = f"SELECT nation, t, y FROM ({SERIES})"
    for lag in [1] * d + [s] * big_d:
        inner = f"""SELECT nation, t, y - lag(y, {lag}) OVER (PARTITION BY nation ORDER BY t) AS {y} FROM ({inner})"""
    return f"SELECT nation, t, round(y, 2) AS w FROM ({inner}) WHERE y IS NOT NULL"


for _d, _D in [(1, 1), (0, 2)]:
    @entry(f"w04_difference_{_d}_{_D}", _difference_sql(_d, _D, 4))
    def _(t, d=_d, D=_D):
        return S.difference(quarters(t), ["nation"], d, D, 4).withColumn("w", F.round("w", 2))


LAGS = 40
ACF = f"""
    SELECT a.nation, CAST(k AS INTEGER) AS lag, sum(a.x * b.x) / any_value(c0) AS r, any_value(n) AS n FROM
      (SELECT nation, t, y - avg(y) OVER (PARTITION BY nation) AS x FROM ({MONTHLY})) a, range(1, {LAGS + 1}) g(k),
      (SELECT nation, t, y - avg(y) OVER (PARTITION BY nation) AS x FROM ({MONTHLY})) b,
      (SELECT nation, count(*) AS n, var_pop(y) * count(*) AS c0 FROM ({MONTHLY}) GROUP BY 1) c
    WHERE a.nation = b.nation AND b.t = a.t + k AND c.nation = a.nation GROUP BY a.nation, k"""


@entry("w05_autocorrelation", f"SELECT nation, lag, round(r, 6) AS r, n FROM ({ACF})")
def _(t):
    return S.acf(months(t), ["nation"], LAGS).withColumn("r", F.round("r", 6))


@entry("w06_partial_autocorrelation", f"""
    WITH RECURSIVE r AS (SELECT nation, list(r ORDER BY lag) AS r FROM ({ACF}) GROUP BY 1),
    p AS (SELECT nation, 1 AS lag, r[1] AS partial, [r[1]] AS phi, r FROM r UNION ALL
      SELECT nation, lag + 1, last, list_append(list_transform(phi, lambda x, i: x - last * phi[lag - i + 1]), last), r FROM (
        SELECT *, (r[lag + 1] - list_dot_product(phi, list_reverse(r[1:lag]))) / (1 - list_dot_product(phi, r[1:lag])) AS last FROM p WHERE lag < {LAGS}))
    SELECT nation, CAST(lag AS INTEGER) AS lag, round(partial, 5) + 0.0 AS partial FROM p""")
def _(t):
    partial = S.pacf(S.acf(months(t), ["nation"], LAGS), ["nation"])
    return partial.withColumn("partial", F.round("partial", 5) + 0.0)


def frames_sql(n_test, horizons, schemes=("recursive", "rolling")):
    return " UNION ALL ".join(f"""
    SELECT nation, CAST(i AS INTEGER) AS origin, CAST(h AS INTEGER) AS horizon, '{s}' AS scheme,
      CAST({'1' if s == 'recursive' else 'i'} AS INTEGER) AS lo, CAST(n - {n_test} - h + i AS INTEGER) AS hi,
      CAST(n - {n_test} + i AS INTEGER) AS target
    FROM (SELECT nation, max(t) AS n FROM ({MONTHLY}) GROUP BY 1), range(1, {n_test + 1}) a(i), range(1, {horizons + 1}) b(h)"""
                             for s in schemes)


def frames(series, n_test=25, horizons=4):
    sizes = series.groupBy("nation").agg(F.max("t").alias("n"))
    return S.backtest_frames(sizes, n_test, horizons, "recursive").unionByName(
        S.backtest_frames(sizes, n_test, horizons, "rolling"))


@entry("w07_backtest_frames", f"""
    SELECT f.*, x.n_rows, x.total FROM ({frames_sql(25, 4)}) f JOIN (
      SELECT nation, scheme, origin, horizon, count(*) AS n_rows, round(sum(y), 2) AS total
      FROM ({frames_sql(25, 4)}) JOIN ({MONTHLY}) USING (nation) WHERE t BETWEEN lo AND hi GROUP BY ALL) x
      USING (nation, scheme, origin, horizon)""")
def _(t):
    series = months(t)
    rows = S.training_rows(series, frames(series), ["nation"])
    return rows.groupBy("nation", *S.FRAME).agg(F.count(F.lit(1)).alias("n_rows"),
                                                F.round(F.sum("y"), 2).alias("total"))


@entry("w08_holdout_tail", """
    SELECT event_id, CAST(row_number() OVER (ORDER BY ts DESC, event_id DESC) <= 2110 AS INTEGER) AS is_test FROM events""")
def _(t):
    return O.holdout_tail(t.events.select("event_id", "ts"), ["ts", "event_id"], 2110).drop("ts")


@entry("w09_ordered_split", """
    SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) <= (SELECT round_even(0.7::DOUBLE * count(*), 0) FROM orders) AS INTEGER) AS is_train
    FROM orders""")
def _(t):
    return O.split_ordered(t.orders.select("o_orderkey"), ["o_orderkey"], 0.7)


@entry("w10_thin_by_root", """
    SELECT user_id, event_id, i AS frame_index FROM (
      SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i,
             count(*) OVER (PARTITION BY user_id) AS n FROM events)
    WHERE i = 0 OR i = n - 1 OR round_even(2 * sqrt(i), 0) > round_even(2 * sqrt(i - 1), 0)""")
def _(t):
    return O.thin_by_root(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")
