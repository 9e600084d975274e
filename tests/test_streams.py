import datetime as dt

import pytest
from pyspark.sql import functions as F

from brightloom.streaming import counts as C, sinks as K
from brightloom.streaming.sources import read_lines_stream

LINES = [["#a #b #a", "a  #a"], ["", "#b x"], ["#c"]]


@pytest.fixture
def lines(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    for i, batch in enumerate(LINES):
        (folder / f"{i}.txt").write_text("\n".join(batch) + "\n")
    return str(folder)


def totals(spark, lines, **kwargs):
    return C.running_counts(C.tokens_stream(read_lines_stream(spark, "text", lines, files_per_batch=1), **kwargs))


def as_dict(df):
    return {r.word: r.total for r in df.collect()}


def test_stream_equals_batch_in_both_modes(spark, lines, tmp_path):
    want = as_dict(C.running_counts(C.tokens_stream(spark.read.text(lines))))
    assert want["#a"] == 3 and want["#b"] == 2 and want[""] == 2
    K.run_available(totals(spark, lines), K.parquet_batches(f"{tmp_path}/c"), "complete")
    assert as_dict(K.last_batch(spark, f"{tmp_path}/c")) == want
    K.run_available(totals(spark, lines), K.parquet_batches(f"{tmp_path}/u"), "update")
    assert K.read_batches(spark, f"{tmp_path}/u").select("batch_id").distinct().count() == 3
    assert as_dict(K.merged_updates(spark, f"{tmp_path}/u", ["word"])) == want


def test_restart_goes_on_from_the_checkpoint(spark, lines, tmp_path):
    import pathlib
    out = f"{tmp_path}/out"
    progress = K.run_available(totals(spark, lines, hash_only=True), K.parquet_batches(out), "complete")
    (pathlib.Path(lines) / "9.txt").write_text("#a #z\n")
    K.run_available(totals(spark, lines, hash_only=True), K.parquet_batches(out), "complete", progress)
    assert as_dict(K.last_batch(spark, out)) == {"#a": 4, "#b": 2, "#c": 1, "#z": 1}


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "word string, total long")
    assert [r.word for r in C.top_of(df, "total", "word", 2).collect()] == ["c", "a"]


def test_panes_equal_direct_windows(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=17 * i), f"w{i % 3}") for i in range(200)]
    df = spark.createDataFrame(rows, "ts timestamp, word string")
    direct = C.windowed_counts(df, "ts", "600 seconds", "30 seconds")
    panes = C.pane_counts(df, "ts", "600 seconds", "30 seconds")
    assert sorted(map(str, C.window_bounds(direct).collect())) == sorted(map(str, C.window_bounds(panes).collect()))


def test_late_rows_beyond_the_delay_are_dropped(spark, tmp_path):
    source = tmp_path / "events"
    at = lambda minute: dt.datetime(2024, 1, 1, 0, minute)
    for i, minutes in enumerate([[0, 30], [25, 5], [59]]):  # 25 is within the delay, 5 is not
        spark.createDataFrame([(at(m), "x") for m in minutes], "ts timestamp, word string").coalesce(1) \
            .write.mode("append").parquet(str(source))
        schema = spark.read.parquet(str(source)).schema
        stream = read_lines_stream(spark, "parquet", str(source), schema=schema)
        counted = C.windowed_counts(C.with_late(stream, "ts", "10 minutes"), "ts", "10 minutes")
        K.run_available(C.window_bounds(counted), K.parquet_batches(f"{tmp_path}/out"), "append", f"{tmp_path}/progress")
    got = {r.window_start.minute: r.n for r in K.read_batches(spark, f"{tmp_path}/out").collect()}
    assert got == {0: 1, 20: 1, 30: 1}


def test_failing_batches_are_counted(spark, lines, tmp_path):
    def broken(batch, n):
        if n == 1:
            raise ValueError("no")
        K.parquet_batches(f"{tmp_path}/out")(batch, n)

    guarded, seen = K.safe_batch(broken, reraise=False)
    K.run_available(totals(spark, lines), guarded, "complete")
    assert (seen.batches, seen.failures) == (3, 1) and "no" in seen.errors[0]
    guarded, seen = K.safe_batch(broken)
    with pytest.raises(Exception, match="no"):
        K.run_available(totals(spark, lines), guarded, "complete")


def test_batch_sql_and_empty_batches(spark, lines, tmp_path):
    sql = "SELECT word AS hashtag, total FROM tags ORDER BY total DESC, hashtag LIMIT 1"
    K.run_available(totals(spark, lines, hash_only=True), K.batch_sql("tags", sql, K.parquet_batches(f"{tmp_path}/s")), "complete")
    assert [r.hashtag for r in K.last_batch(spark, f"{tmp_path}/s").collect()] == ["#a"]
    none = totals(spark, lines).where("total > 1000")
    K.run_available(none, K.parquet_batches(f"{tmp_path}/n"), "complete")
    assert K.last_batch(spark, f"{tmp_path}/n").count() == 0


def test_processing_time_trigger(spark, lines, tmp_path):
    query = K.foreach_batch_sink(totals(spark, lines), K.parquet_batches(f"{tmp_path}/t"), f"{tmp_path}/p", "complete", "2 seconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert as_dict(K.last_batch(spark, f"{tmp_path}/t"))["#a"] == 3


def test_source_kinds(spark):
    with pytest.raises(ValueError):
        read_lines_stream(spark, "carrier pigeon")


def test_panes_equal_direct_windows_when_the_slide_does_not_divide_the_size(spark):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(start + dt.timedelta(seconds=5 * i), "w") for i in range(25)], "ts timestamp, word string")
    direct = C.windowed_counts(df, "ts", "50 seconds", "30 seconds")
    panes = C.pane_counts(df, "ts", "50 seconds", "30 seconds")
    assert sorted(map(str, C.window_bounds(direct).collect())) == sorted(map(str, C.window_bounds(panes).collect()))


def test_log_records_batches_late_rows_and_failures(spark, tmp_path):
    from brightloom.streaming.progress import ProgressLog

    folder, out, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    folder.mkdir()
    start = dt.datetime(2024, 1, 1)

    def counts():
        rows = read_lines_stream(spark, "parquet", str(folder), schema=spark.createDataFrame([], "ts timestamp, word string").schema)
        return C.window_bounds(C.windowed_counts(C.with_late(rows, "ts", "1 hour"), "ts", "1 hour"))

    def deliver(hours):
        spark.createDataFrame([(start + dt.timedelta(hours=h), "a") for h in hours], "ts timestamp, word string").write.mode("append").parquet(str(folder))

    def fail(batch, number):
        raise OSError("full")

    with ProgressLog(spark) as log:
        deliver([0, 1, 10])
        K.run_available(counts(), K.parquet_batches(out), "append", progress)
        deliver([2, 9.5, 20])  # the watermark stands at nine o'clock
        K.run_available(counts(), K.parquet_batches(out), "append", progress)
        query = K.foreach_batch_sink(counts(), fail, str(tmp_path / "other"), "append")
        with pytest.raises(Exception, match="full"):
            query.awaitTermination()
        log.settle(query)
    rows = log.table().collect()
    assert sum(r.input_rows or 0 for r in rows if r.query != str(query.id)) == 6
    assert sum(r.dropped_rows or 0 for r in rows) == 1
    assert [("full" in r.error) for r in rows if r.event == "ended" and r.error] == [True]
    assert sum(r.event == "started" for r in rows) == 3
    got = {r.window_start.hour + 24 * (r.window_start.day - 1): r.n for r in K.read_batches(spark, out).collect()}
    assert got == {0: 1, 1: 1, 9: 1, 10: 1}


@pytest.mark.parametrize("folder, kind", [(False, ""), (True, ""), (True, "lang")])
def test_table_streams_read_files_and_folders(spark, tmp_path, folder, kind):
    """A table is one file at a small size, a folder of files (or of folders) at a larger one."""
    import pathlib
    import shutil

    from brightloom.runtime import Tables
    from catalog.streams import stream

    rows = spark.createDataFrame([(i, f"w{i}", "en" if i % 2 else "de") for i in range(10)], "doc_id long, text string, lang string")
    writer = rows.repartition(3).write if folder else rows.coalesce(1).write
    (writer.partitionBy(kind) if kind else writer).parquet(f"{tmp_path}/written")
    rows.limit(2).write.parquet(f"{tmp_path}/in/labels.parquet")  # another table
    if folder:
        shutil.copytree(f"{tmp_path}/written", f"{tmp_path}/in/documents.parquet")
    else:
        shutil.copy(next(pathlib.Path(f"{tmp_path}/written").glob("*.parquet")), f"{tmp_path}/in/documents.parquet")
    got = stream(Tables(spark, f"{tmp_path}/in"), "documents")
    K.run_available(got.select("doc_id", "text", "lang"), K.parquet_batches(f"{tmp_path}/out"), "append")
    out = K.read_batches(spark, f"{tmp_path}/out").drop("batch_id")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows.collect()))
