"""Scalar functions over the given tables."""

from pyspark.sql import functions as F

from brightloom.functions import strings as S, values as V, vectors as X

from . import entry

# A tenure sentence built from the order row, so every branch occurs.
TENURE_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE
      (CASE o_orderstatus WHEN 'F' THEN 'I have worked ' ELSE 'I work ' END)
      || (CASE WHEN o_orderpriority LIKE '1%' THEN 'Full-Time ' WHEN o_orderpriority LIKE '2%' THEN 'part-time ' ELSE '' END)
      || (CASE o_orderkey % 4 WHEN 0 THEN 'for more than ' WHEN 1 THEN 'for less than ' ELSE 'for ' END)
      || (CASE WHEN o_orderkey % 5 = 0 THEN 'a year' ELSE CAST(o_orderkey % 9 AS VARCHAR) || ' years' END) END AS tenure
    FROM orders"""


def tenure(t):
    key, prio = F.col("o_orderkey"), F.col("o_orderpriority")
    text = F.concat(
        F.when(F.col("o_orderstatus") == "F", "I have worked ").otherwise("I work "),
        F.when(prio.startswith("1"), "Full-Time ").when(prio.startswith("2"), "part-time ").otherwise(""),
        F.when(key % 4 == 0, "for more than ").when(key % 4 == 1, "for less than ").otherwise("for "),
        F.when(key % 5 == 0, "a year").otherwise(F.concat((key % 9).cast("string"), F.lit(" years"))))
    return t.orders.select("o_orderkey", F.when(key % 13 != 0, text).alias("tenure"))


@entry("f02_split_single_space", """
    SELECT doc_id, len(string_split(text, ' ')) AS words,
           len(list_filter(string_split(text, ' '), lambda x: x = '')) AS empty_words FROM documents""")
def _(t):
    words = S.split_single_space("text")
    return t.documents.select("doc_id", F.size(words).cast("long").alias("words"),
                              F.size(F.filter(words, lambda w: w == "")).cast("long").alias("empty_words"))


@entry("f03_split_whitespace", r"""
    SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda x: x <> '')) AS words FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.size(S.split_whitespace("text")).cast("long").alias("words"))


@entry("f04_split_non_word", r"""
    SELECT doc_id, i - 1 AS pos, w AS word FROM (
      SELECT doc_id, unnest(a) AS w, generate_subscripts(a, 1) AS i FROM (
        SELECT doc_id, regexp_split_to_array(text, '[^\p{L}\p{N}_]+') AS a FROM documents))""")
def _(t):
    return (t.documents.select("doc_id", F.posexplode(S.split_non_word("text")).alias("pos", "word"))
            .withColumn("pos", F.col("pos").cast("long")))


@entry("f05_nth_part", """
    SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS level, string_split(o_orderpriority, '-')[2] AS name,
           string_split(o_orderpriority, '-')[3] AS third FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", *[S.nth_part("o_orderpriority", "-", i).alias(n)
                                           for i, n in enumerate(["level", "name", "third"])])


@entry("f06_strip_chars", """
    SELECT page_id, trim(url, 'htps:/') AS bare, trim('  "' || url || '" ', ' "') AS unquoted FROM pages""")
def _(t):
    quoted = F.concat(F.lit('  "'), F.col("url"), F.lit('" '))
    return t.pages.select("page_id", S.strip_chars("url", "htps:/").alias("bare"),
                          S.strip_chars(quoted, ' "').alias("unquoted"))


@entry("f07_remove_literal", "SELECT doc_id, trim(replace(text, 'the', ''), chr(10) || ' ') AS text FROM documents")
def _(t):
    return t.documents.select("doc_id", S.strip_chars(S.remove_literal("text", "the"), "\n ").alias("text"))


@entry("f08_parenthesised_count", """
    SELECT event_id, CASE WHEN event_id % 6 = 0 THEN '0' WHEN event_id % 6 = 1 THEN substr(props, 1, length(props) - 1)
                     ELSE CAST(user_id AS VARCHAR) END AS helpful FROM events""")
def _(t):
    key = F.col("event_id")
    text = (F.when(key % 6 == 0, None).when(key % 6 == 1, F.col("props"))
            .otherwise(F.concat(F.lit("Helpful ("), F.col("user_id").cast("string"), F.lit(")"))))
    return t.events.select("event_id", S.parenthesised_count(text).alias("helpful"))


@entry("f09_recommendation_lines", """
    WITH b AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN ['Recommends', 'Positive Outlook', 'Approves of CEO']
        WHEN 1 THEN ['Recommends', 'No opinion of CEO'] WHEN 2 THEN ['Recommends', 'Neutral Outlook']
        ELSE [event_type] END AS l FROM events)
    SELECT event_id, l[1] AS recommends,
      CASE WHEN len(l) IN (2, 3) AND NOT contains(l[2], 'CEO') THEN l[2] END AS outlook,
      CASE WHEN len(l) = 3 THEN l[3] WHEN len(l) = 2 AND contains(l[2], 'CEO') THEN l[2] END AS ceo_approval FROM b""")
def _(t):
    kind = F.col("event_id") % 4
    block = (F.when(kind == 0, "Recommends\nPositive Outlook\nApproves of CEO")
             .when(kind == 1, "Recommends\nNo opinion of CEO")
             .when(kind == 2, "Recommends\nNeutral Outlook").otherwise(F.col("event_type")))
    parts = S.recommendation_lines(F.col("block"))
    return (t.events.select("event_id", block.alias("block"))
            .select("event_id", *[c.alias(n) for n, c in parts.items()]))


@entry("f10_regex_replace", """
    SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9]+', '', 'g') AS squeezed,
           regexp_replace(text, '[^A-Za-z]+', ' ', 'g') AS letters FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.regexp_replace("text", "[^A-Za-z0-9]+", "").alias("squeezed"),
                              F.regexp_replace("text", "[^A-Za-z]+", " ").alias("letters"))


@entry("f11_case_fold", "SELECT c_custkey, lower(c_name) AS low, upper(c_name) AS up FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.lower("c_name").alias("low"), F.upper("c_name").alias("up"))


@entry("f12_contains_ignoring_case", f"""
    SELECT o_orderkey, CAST(coalesce(contains(lower(tenure), 'full-time'), false) AS INTEGER) AS full_time,
           CAST(coalesce(contains(lower(tenure), 'worked'), false) AS INTEGER) AS worked FROM ({TENURE_SQL})""")
def _(t):
    return tenure(t).select("o_orderkey", S.contains_ci("tenure", "full-time").cast("int").alias("full_time"),
                            S.contains_ci("tenure", "worked").cast("int").alias("worked"))


@entry("f13_hash_tokens", """
    SELECT word, count(*) AS uses FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    WHERE contains(word, '#') GROUP BY word""")
def _(t):
    words = t.documents.select(F.explode(S.split_single_space("text")).alias("word"))
    return words.where(S.has_hash("word")).groupBy("word").agg(F.count(F.lit(1)).alias("uses"))


@entry("f14_token_tests", r"""
    SELECT word, CAST(regexp_full_match(word, '\p{L}+') AS INTEGER) AS alphabetic,
           CAST(regexp_full_match(word, '[0-9]+') AS INTEGER) AS digits
    FROM (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM documents)""")
def _(t):
    words = t.documents.select(F.explode(S.split_single_space("text")).alias("word")).distinct()
    return words.select("word", S.is_alphabetic("word").cast("int").alias("alphabetic"),
                        S.is_digits("word").cast("int").alias("digits"))


@entry("f15_joined_length", """
    SELECT p_partkey, CASE WHEN p_partkey % 6 <> 0 THEN (length(p_name) + length(p_type)) / 100 END AS length FROM part""")
def _(t):
    name = F.when(F.col("p_partkey") % 6 != 0, F.col("p_name"))
    return t.part.select("p_partkey", S.joined_length(name, "p_type", per=100.0).alias("length"))


@entry("f16_concatenate", """
    SELECT p_partkey, 'PROS: ' || p_name || ' CONS: ' || CASE WHEN p_partkey % 6 <> 0 THEN p_type END AS both_texts FROM part""")
def _(t):
    cons = F.when(F.col("p_partkey") % 6 != 0, F.col("p_type"))
    return t.part.select("p_partkey",
                         S.labelled_concat("PROS: ", F.col("p_name"), " CONS: ", cons).alias("both_texts"))


@entry("f17_number_suffix", "SELECT p_partkey, CAST(p_size AS VARCHAR) || ' Star' AS stars FROM part")
def _(t):
    return t.part.select("p_partkey", S.with_suffix("p_size", " Star").alias("stars"))


@entry("f18_prefix", "SELECT doc_id, substr(text, 1, 24) AS start FROM documents")
def _(t):
    return t.documents.select("doc_id", F.substring("text", 1, 24).alias("start"))


@entry("f19_tenure_years", f"""
    SELECT o_orderkey, CASE WHEN tenure IS NULL THEN NULL ELSE
      (CASE WHEN contains(tenure, 'a year') THEN 1.0::DOUBLE
            ELSE coalesce(list_sum(list_transform(list_filter(string_split(tenure, ' '), lambda x: regexp_full_match(x, '[0-9]+')),
                                         lambda x: CAST(x AS DOUBLE))), 0) END)
      + (CASE WHEN contains(tenure, 'more') THEN 0.5::DOUBLE WHEN contains(tenure, 'less') THEN -0.5 ELSE 0 END) END AS years
    FROM ({TENURE_SQL})""")
def _(t):
    return tenure(t).select("o_orderkey", S.tenure_years("tenure").alias("years"))


@entry("f20_employment", f"""
    SELECT o_orderkey, CASE WHEN tenure IS NULL THEN NULL WHEN contains(lower(tenure), 'worked') THEN 'ex' ELSE 'current' END AS status,
      CASE WHEN contains(lower(tenure), 'full-time') THEN 'full-time' WHEN contains(lower(tenure), 'part-time') THEN 'part-time'
           WHEN tenure IS NOT NULL THEN 'unknown' END AS emptype FROM ({TENURE_SQL})""")
def _(t):
    return tenure(t).select("o_orderkey", S.employment_status("tenure").alias("status"),
                            S.employment_type("tenure").alias("emptype"))


@entry("f21_parse_dates", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders""")
def _(t):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    text = (F.when(key % 4 == 0, F.date_format(day, "yyyyMMdd"))
            .when(key % 4 == 1, F.date_format(day, "yyyy-MM-dd"))
            .when(key % 4 == 2, F.concat(F.date_format(day, "EEE MMM dd yyyy HH:mm:ss"), F.lit(" GMT+0100 (CET)")))
            .otherwise("not a date"))
    dated = t.orders.select("o_orderkey", text.alias("text"))
    # drop the weekday name and everything from GMT on before parsing
    clean = F.btrim(F.regexp_replace(S.nth_part("text", "GMT", 0), "^[A-Z][a-z]{2} ", ""))
    parsed = V.parse_timestamp(clean, ["yyyyMMdd", "yyyy-MM-dd", "MMM dd yyyy HH:mm:ss"])
    return dated.select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd").alias("parsed"))


@entry("f22_date_parts", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
           CAST(month(o_orderdate) AS INTEGER) AS month, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dayofweek FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in V.date_parts("o_orderdate").items()])


@entry("f23_season", """
    SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) <= 5 THEN 'spring'
                            WHEN month(o_orderdate) <= 8 THEN 'summer' ELSE 'autumn' END AS season FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", V.season(F.month("o_orderdate")).alias("season"))


@entry("f24_arithmetic", """
    SELECT event_id, round(ln(value), 6) AS ln, round(exp(value / 100), 6) AS exp, round(sqrt(value), 6) AS sqrt,
           round(abs(value - 50), 6) AS abs, round(pow(value, 1.5), 4) AS pow, round_even(value, 0) AS rounded FROM events""")
def _(t):
    v = F.col("value")
    return t.events.select("event_id", F.round(F.ln(v), 6).alias("ln"), F.round(F.exp(v / 100), 6).alias("exp"),
                           F.round(F.sqrt(v), 6).alias("sqrt"), F.round(F.abs(v - 50), 6).alias("abs"),
                           F.round(F.pow(v, F.lit(1.5)), 4).alias("pow"), F.bround(v, 0).alias("rounded"))


@entry("f25_grids", """
    SELECT o_orderpriority, step, round(a * avg_price, 6) AS scaled, depth FROM
      (SELECT o_orderpriority, avg(o_totalprice) AS avg_price FROM orders GROUP BY 1),
      (SELECT CAST(i AS INTEGER) AS step, pow(10, -1 + i * (-3.0::DOUBLE / 99)) AS a,
              CAST(trunc(10 + i * (3990.0::DOUBLE / 99)) AS INTEGER) AS depth FROM range(100) r(i))""")
def _(t):
    means = t.orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("avg_price"))
    grids = F.arrays_zip(V.log_grid(-1, -4, 100).alias("a"), V.int_grid(10, 4000, 100).alias("depth"))
    return (means.select("*", F.posexplode(grids).alias("step", "g"))
            .select("o_orderpriority", "step", F.round(F.col("g.a") * F.col("avg_price"), 6).alias("scaled"),
                    F.col("g.depth").alias("depth")))


def _long(df, key, arr, name):
    return df.select(key, F.posexplode(arr).alias("i", name))


EMB = """SELECT vec_id, CAST(i - 1 AS INTEGER) AS i, x FROM (
    SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)"""


@entry("f26_vector_rescale", f"""
    SELECT vec_id, i, round(x / 255, 8) AS scaled, round((x - 127.5) / 127.5, 8) AS unit, round((x + 1) / 2, 8) AS inverse
    FROM ({EMB})""")
def _(t):
    zipped = F.arrays_zip(X.scale_by("embedding").alias("scaled"), X.to_unit_range("embedding").alias("unit"),
                          X.from_unit_range("embedding").alias("inverse"))
    return (_long(t.embeddings, "vec_id", zipped, "v")
            .select("vec_id", "i", *[F.round(f"v.{n}", 8).alias(n) for n in ("scaled", "unit", "inverse")]))


@entry("f27_vector_display_bytes", f"""
    WITH e AS ({EMB}), s AS (SELECT vec_id, avg(x) AS m, stddev_pop(x) AS sd FROM e GROUP BY vec_id)
    SELECT vec_id, i, CAST(trunc(least(greatest((x - m) / sd * 64 + 128, 0), 255)) AS INTEGER) AS byte
    FROM e JOIN s USING (vec_id)""")
def _(t):
    return _long(t.embeddings, "vec_id", X.display_bytes("embedding"), "byte")


@entry("f28_shuffle_batches", """
    SELECT batch AS batch_id, least(256, n - batch * 256) AS rows_in_batch FROM
      (SELECT count(*) AS n FROM events), LATERAL (SELECT unnest(range((n + 255) // 256)) AS batch)""")
def _(t):
    from brightloom.operators.ordering import shuffle_batches
    return (shuffle_batches(t.events.select("event_id"), ["event_id"], 256, seed=42)
            .groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows_in_batch")))


@entry("f29_vector_product", f"""
    WITH e AS ({EMB}), c AS (SELECT label, min(vec_id) AS first_id FROM embeddings GROUP BY label)
    SELECT e.vec_id, e.i, round(e.x * f.x, 8) AS x FROM e JOIN embeddings m USING (vec_id)
    JOIN c ON c.label = m.label JOIN e f ON f.vec_id = c.first_id AND f.i = e.i""")
def _(t):
    per_label = t.embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("label_vec"))
    joined = t.embeddings.join(per_label, "label")
    return (_long(joined, "vec_id", X.product("embedding", "label_vec"), "x")
            .withColumn("x", F.round("x", 8)))


@entry("f30_vector_append", """
    SELECT vec_id, CAST(len(embedding) + 1 AS INTEGER) AS width, CAST(label AS DOUBLE) AS last_value FROM embeddings""")
def _(t):
    both = X.append_channel("embedding", F.array(F.col("label").cast("float")))
    return t.embeddings.select("vec_id", F.size(both).alias("width"),
                               F.element_at(both, -1).cast("double").alias("last_value"))
