"""Scans, sources and sinks."""

from pyspark.sql import functions as F, types as T

from brightloom.functions.strings import entity_from_path
from brightloom.runtime import scratch_path
from brightloom.sources.events import decode_events, filter_events
from brightloom.sources.files import read_csv, read_many, scan_labelled_dir, write_csv
from brightloom.sources.pages import Field, extract_blocks, extract_fields

from . import entry

CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


@entry("s01_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = scratch_path(t.spark, "customer-csv")
    write_csv(t.customer, path)
    return read_csv(t.spark, path, CUSTOMER, index_col="c_custkey")


@entry("s02_decimal_comma_scan",
       "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m%d') AS day FROM orders")
def _(t):
    path = scratch_path(t.spark, "orders-csv")
    write_csv(t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        F.translate(F.col("o_totalprice").cast("string"), ".", ",").alias("o_totalprice")),
        path, sep=";")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()),
                           T.StructField("day", T.StringType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    return read_csv(t.spark, path, schema, sep=";", decimal=",")


@entry("s03_many_files_scan", """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS segment_folder FROM customer""")
def _(t):
    path = scratch_path(t.spark, "segments-csv")
    (t.customer.withColumn("segment", F.col("c_mktsegment")).drop("c_mktsegment")
     .write.partitionBy("segment").csv(path, header=True))
    schema = T.StructType(CUSTOMER.fields[:4])
    return (read_many(t.spark, f"{path}/segment=*/*.csv", schema)
            .withColumn("segment_folder", F.regexp_extract("file_name", "segment=([^/]+)/", 1))
            .drop("file_name"))


EVENT = T.StructType([T.StructField("k", T.LongType())])


@entry("s06_decode_events", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM events WHERE event_id % 7 <> 0""")
def _(t):
    lines = t.events.select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit("{broken"))
                            .otherwise(F.col("props")).alias("value"))
    return decode_events(lines, EVENT)


@entry("s07_filter_events", """
    SELECT doc_id, lang, n_chars FROM documents
    WHERE lang = 'en' AND (contains(lower(text), 'that')
                           OR (n_chars BETWEEN 100 AND 400 AND doc_id BETWEEN 10 AND 500))""")
def _(t):
    return (filter_events(t.documents, lang="en", track="That", bbox=(100, 10, 400, 500),
                          x_col="n_chars", y_col="doc_id")
            .select("doc_id", "lang", "n_chars"))


@entry("s08_labelled_directory", """
    SELECT DISTINCT CASE WHEN vec_id % 4 = 0 THEN 'validation' ELSE 'train' END AS split,
           CAST(label AS VARCHAR) AS class, CAST(1 AS BIGINT) AS files
    FROM embeddings""")
def _(t):
    root = scratch_path(t.spark, "labelled")
    (t.embeddings
     .select(F.when(F.col("vec_id") % 4 == 0, "validation").otherwise("train").alias("split"),
             F.col("label").alias("class"), F.to_json(F.struct("embedding")).alias("value"))
     .repartition("split", "class").write.partitionBy("split", "class").text(root))
    return (scan_labelled_dir(t.spark, root, "*.txt").groupBy("split", "class")
            .agg(F.count(F.lit(1)).alias("files")))


@entry("s09_csv_sink", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS orders FROM orders GROUP BY ALL""")
def _(t):
    path = scratch_path(t.spark, "status-csv")
    write_csv(t.orders.groupBy("o_orderstatus", "o_orderpriority")
              .agg(F.count(F.lit(1)).alias("orders")), path)
    schema = T.StructType([T.StructField("o_orderstatus", T.StringType()),
                           T.StructField("o_orderpriority", T.StringType()),
                           T.StructField("orders", T.LongType())])
    return read_csv(t.spark, path, schema)


@entry("s11_page_blocks", r"""
    SELECT page_id, CAST(i - 1 AS INTEGER) AS block_no, block FROM (
      SELECT page_id, unnest(b) AS block, generate_subscripts(b, 1) AS i FROM (
        SELECT page_id, regexp_extract_all(html, '(?s)<(?:p|li)>(.*?)</(?:p|li)>', 1) AS b FROM pages))""")
def _(t):
    return extract_blocks(t.pages.select("page_id", "html"), r"(?s)<(?:p|li)>(.*?)</(?:p|li)>")


PAGE_FIELDS = [
    Field("lang", r'<html lang="([a-z]+)"'),
    Field("title", r"(?s)<title>(.*?)</title>", strip='."'),
    Field("heading", r"(?s)<h1>(.*?)</h1>", remove="the"),
    Field("second_link", r'<a href="([^"]*)"', nth=1),
    Field("caption", r"(?s)<figcaption>(.*?)</figcaption>"),
    Field("shares", r"shares=([0-9]+)", default="0"),
]


@entry("s12_page_fields", r"""
    SELECT page_id,
      regexp_extract_all(html, '<html lang="([a-z]+)"', 1)[1] AS lang,
      trim(regexp_extract_all(html, '(?s)<title>(.*?)</title>', 1)[1], '."') AS title,
      replace(regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1)[1], 'the', '') AS heading,
      regexp_extract_all(html, '<a href="([^"]*)"', 1)[2] AS second_link,
      regexp_extract_all(html, '(?s)<figcaption>(.*?)</figcaption>', 1)[1] AS caption,
      coalesce(regexp_extract_all(html, 'shares=([0-9]+)', 1)[1], '0') AS shares
    FROM pages""")
def _(t):
    return extract_fields(t.pages, "html", PAGE_FIELDS).drop("html", "url")


@entry("f01_entity_from_path", """
    SELECT page_id, upper(regexp_extract(url, '([^/\\\\]+)\\.[^./\\\\]*$', 1)) AS entity,
           upper(regexp_extract('C:\\data\\' || page_id || '.x.txt', '([^/\\\\]+)\\.[^./\\\\]*$', 1)) AS file_entity
    FROM pages""")
def _(t):
    return t.pages.select("page_id", entity_from_path("url").alias("entity"),
                          entity_from_path(F.concat(F.lit("C:\\data\\"), F.col("page_id").cast("string"),
                                                    F.lit(".x.txt"))).alias("file_entity"))
