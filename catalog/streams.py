"""Streaming operators, each run over the table as a file stream."""

from pyspark.sql import Window, functions as F

from brightloom.functions.strings import split_single_space
from brightloom.operators.rows import top_k
from brightloom.runtime import scratch_path
from brightloom.streaming import counts as C, sinks as K
from brightloom.streaming.progress import ProgressLog
from brightloom.streaming.sources import read_lines_stream

from . import entry

DAY = "%Y-%m-%d %H:%M:%S"
WORDS = "SELECT unnest(string_split(text, ' ')) AS word FROM documents"
TAGS = f"SELECT word, count(*) AS total FROM ({WORDS}) WHERE contains(word, '#') GROUP BY word"


def stream(t, name):
    """A table as a stream, be it one parquet file or a folder of them. As a pattern its path
    may be either; Spark takes a plain path for a folder."""
    return read_lines_stream(t.spark, "parquet", f"{t.folder}/{name}.parque[t]", schema=getattr(t, name).schema,
                             basePath=t.folder)


def finish(t, df, mode, wrap=lambda sink: sink):
    path = scratch_path(t.spark, "stream-out")
    K.run_available(df, wrap(K.parquet_batches(path)), mode)
    return path


@entry("r04_top_words", f"""
    SELECT word, count(*) AS total FROM ({WORDS}) WHERE word <> '' GROUP BY word ORDER BY total DESC, word LIMIT 10""")
def _(t):
    words = C.tokens_stream(t.documents, "text", drop_empty=True)
    return top_k(C.running_counts(words), [F.desc("total"), "word"], 10)


@entry("s04_line_stream", f"SELECT word, count(*) AS total FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word")
def _(t):
    path = scratch_path(t.spark, "lines")
    t.part.select("p_name").write.text(path)
    lines = read_lines_stream(t.spark, "text", path)
    return K.last_batch(t.spark, finish(t, C.running_counts(C.tokens_stream(lines)), "complete"))


@entry("r02_stream_tokens", f"SELECT word, count(*) AS n FROM ({WORDS}) WHERE contains(word, '#') GROUP BY word")
def _(t):
    tokens = C.tokens_stream(stream(t, "documents"), "text", hash_only=True)
    out = K.read_batches(t.spark, finish(t, tokens, "append"))
    return out.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@entry("r03_running_counts", TAGS)
def _(t):
    totals = C.running_counts(C.tokens_stream(stream(t, "documents"), "text", hash_only=True))
    return K.last_batch(t.spark, finish(t, totals, "complete"))


@entry("r03_running_counts_update", f"SELECT word, count(*) AS total FROM ({WORDS}) GROUP BY word")
def _(t):
    totals = C.running_counts(C.tokens_stream(stream(t, "documents"), "text"))
    return K.merged_updates(t.spark, finish(t, totals, "update"), ["word"])


@entry("r04_streaming_top_k", f"SELECT * FROM ({TAGS}) ORDER BY total DESC, word LIMIT 10")
def _(t):
    totals = C.running_counts(C.tokens_stream(stream(t, "documents"), "text", hash_only=True))
    best = lambda sink: lambda batch, n: sink(C.top_of(batch, "total", "word"), n)
    return K.last_batch(t.spark, finish(t, totals, "complete", best))


WINDOWS = """
    SELECT strftime(start, '{f}') AS window_start, strftime(start + INTERVAL 600 SECOND, '{f}') AS window_end, event_type AS word, count(*) AS n
    FROM (SELECT event_type, ts, time_bucket(INTERVAL 30 SECOND, ts) - INTERVAL 30 SECOND * k AS start FROM events, range(20) r(k))
    WHERE {where} GROUP BY ALL"""


def bounds_as_text(df):
    bounds = C.window_bounds(df)
    return bounds.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


def typed_events(df):
    return df.select("ts", F.col("event_type").alias("word"))


@entry("r05_sliding_counts", WINDOWS.format(f=DAY, where="true"))
def _(t):
    return bounds_as_text(C.pane_counts(typed_events(t.events), "ts", "600 seconds", "30 seconds"))


@entry("r05_sliding_counts_stream", WINDOWS.format(
    f=DAY, where="start + INTERVAL 600 SECOND <= (SELECT max(ts) - INTERVAL 60 SECOND FROM events)"))
def _(t):
    timed = C.with_late(typed_events(stream(t, "events")), "ts", "60 seconds")
    panes = C.pane_counts(timed, "ts", "600 seconds", "30 seconds")
    return K.read_batches(t.spark, finish(t, bounds_as_text(panes), "append")).drop("batch_id")


TUMBLING = """
    SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '{f}') AS window_start,
           strftime(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR, '{f}') AS window_end, event_type AS word, count(*) AS n
    FROM events WHERE {where} GROUP BY ALL"""


@entry("r06_tumbling_counts", TUMBLING.format(f=DAY, where="true"))
def _(t):
    timed = typed_events(stream(t, "events"))
    hourly = C.windowed_counts(timed, "ts", "1 hour")
    return K.last_batch(t.spark, finish(t, bounds_as_text(hourly), "complete"))


def arrivals(t, table, part, parts=3):
    """The table's rows in a folder, one delivery after another: calling the function that
    comes with the folder writes the next one, those with `part` equal to its number."""
    folder = scratch_path(t.spark, "arrivals")
    rows = getattr(t, table)
    left = iter(range(parts))

    def deliver():
        rows.where(part == next(left)).write.mode("append").parquet(folder)

    return folder, rows.schema, deliver


@entry("r07_recovery", TAGS)
def _(t):
    """Three starts from one checkpoint, each with input that the last one had not seen."""
    folder, schema, deliver = arrivals(t, "documents", F.col("doc_id") % 3)
    path, progress = scratch_path(t.spark, "stream-out"), None
    for _ in range(3):
        deliver()
        lines = read_lines_stream(t.spark, "parquet", folder, schema=schema)
        totals = C.running_counts(C.tokens_stream(lines, "text", hash_only=True))
        progress = K.run_available(totals, K.parquet_batches(path), "update", progress)
    return K.merged_updates(t.spark, path, ["word"])


@entry("r01_trigger", "SELECT count(*) AS lines, true AS several_batches, true AS on_schedule FROM documents")
def _(t):
    """A query with a trigger every two seconds, watched by a listener while input arrives."""
    folder, schema, deliver = arrivals(t, "documents", F.col("doc_id") % 3)
    deliver()
    lines = read_lines_stream(t.spark, "parquet", folder, schema=schema).select("doc_id")
    with ProgressLog(t.spark) as log:
        query = K.foreach_batch_sink(lines, K.parquet_batches(scratch_path(t.spark, "stream-out")),
                                     scratch_path(t.spark, "progress"), "append", every="2 seconds")
        try:
            for _ in range(2):
                query.processAllAvailable()
                deliver()
            query.processAllAvailable()
        finally:
            query.stop()
        log.settle(query)
    batches = log.table().where("event = 'progress' and input_rows > 0").withColumn(
        "gap", F.col("at").cast("double") - F.lag("at").over(Window.partitionBy("query").orderBy("batch_id")).cast("double"))
    return batches.agg(F.sum("input_rows").alias("lines"), (F.count(F.lit(1)) >= 3).alias("several_batches"),
                       (F.min("gap") >= 1.5).alias("on_schedule"))


FAILED = f"SELECT word, count(*) AS total FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents WHERE doc_id % 3 <> 1) GROUP BY word"


@entry("r09_failing_batch", f"""
    SELECT 'batches' AS what, 3 AS n UNION ALL SELECT 'failures', 1
    UNION ALL SELECT 'tokens of the others', sum(total)::BIGINT FROM ({FAILED})""")
def _(t):
    """The sink fails at the second of three batches; it is counted, the others are kept."""
    folder, schema, deliver = arrivals(t, "documents", F.col("doc_id") % 3)
    path, progress = scratch_path(t.spark, "stream-out"), None
    write = K.parquet_batches(path)

    def sink(batch, number):
        if number == 1:
            raise OSError("the sink is full")
        write(batch, number)

    guarded, outcome = K.safe_batch(sink, reraise=False)
    for _ in range(3):
        deliver()
        tokens = C.tokens_stream(read_lines_stream(t.spark, "parquet", folder, schema=schema), "text")
        progress = K.run_available(tokens, guarded, "append", progress)
    kept = K.read_batches(t.spark, path).count()
    return t.spark.createDataFrame([("batches", outcome.batches), ("failures", outcome.failures), ("tokens of the others", kept)],
                                   "what string, n long")


@entry("r08_batch_sql", f"""
    SELECT word AS hashtag, total AS hashtag_count FROM ({TAGS}) ORDER BY total DESC, word LIMIT 10""")
def _(t):
    totals = C.running_counts(C.tokens_stream(stream(t, "documents"), "text", hash_only=True))
    statement = """SELECT word AS hashtag, total AS hashtag_count FROM hashtags
                   ORDER BY hashtag_count DESC, hashtag LIMIT 10"""
    return K.last_batch(t.spark, finish(t, totals, "complete",
                                        lambda sink: K.batch_sql("hashtags", statement, sink)))


@entry("s10_guarded_batches", "SELECT event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(t):
    sums = stream(t, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total"))
    return K.last_batch(t.spark, finish(t, sums, "complete", lambda sink: K.safe_batch(sink)[0]))


@entry("r10_empty_batches", """
    SELECT 'all' AS part, count(*) AS tokens FROM (SELECT unnest(string_split(text, ' ')) FROM documents)
    UNION ALL SELECT 'none', 0""")
def _(t):
    out = []
    for part, keep in [("all", F.lit(True)), ("none", F.lit(False))]:
        lines = stream(t, "documents").where(keep).select(F.size(split_single_space("text")).alias("n"))
        path = finish(t, lines, "append")
        out.append(t.spark.read.schema(lines.schema).parquet(f"{path}/*").select(
            F.lit(part).alias("part"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")))
    return out[0].union(out[1])


# Four deliveries of eight days each; every tenth event comes one delivery too late.
DELIVERY = "least(3, floor(date_diff('second', (SELECT min(ts) FROM events), ts) / 691200)::BIGINT + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END)"


@entry("r11_late_data", f"""
    WITH e AS (SELECT *, {DELIVERY} AS delivery, time_bucket(INTERVAL 1 HOUR, ts) AS start FROM events),
    m AS (SELECT delivery, max(ts) AS newest FROM e GROUP BY 1),
    w AS (SELECT delivery, (SELECT max(newest) - INTERVAL 2 HOUR FROM m b WHERE b.delivery < a.delivery) AS mark FROM m a)
    SELECT strftime(start, '{DAY}') AS window_start, strftime(start + INTERVAL 1 HOUR, '{DAY}') AS window_end, event_type AS word, count(*) AS n
    FROM e JOIN w USING (delivery) WHERE (mark IS NULL OR start + INTERVAL 1 HOUR > mark)
      AND start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events) GROUP BY ALL""")
def _(t):
    """Hourly counts over four deliveries; rows behind the watermark of the last one are dropped."""
    first = t.events.agg(F.min("ts")).first()[0]
    seconds = F.timestamp_diff("SECOND", F.lit(first), F.col("ts"))
    late = (F.col("event_id") % 10 == 0).cast("long")
    folder, schema, deliver = arrivals(t, "events", F.least(F.lit(3), F.floor(seconds / 691200) + late), 4)
    path, progress = scratch_path(t.spark, "stream-out"), None
    for _ in range(4):
        deliver()
        timed = C.with_late(typed_events(read_lines_stream(t.spark, "parquet", folder, schema=schema)), "ts", "2 hours")
        hourly = C.windowed_counts(timed, "ts", "1 hour")
        progress = K.run_available(bounds_as_text(hourly), K.parquet_batches(path), "append", progress)
    return K.read_batches(t.spark, path).drop("batch_id")
