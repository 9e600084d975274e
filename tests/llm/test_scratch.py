"""What operators leave on disk while they run and after."""

import os
import time

import pytest
from pyspark.sql import functions as F


def tables(folder):
    return {x for x in os.listdir(folder) if x.startswith("table-")}


def shuffled(spark):
    """Shuffle data files on this machine; they are removed in the background."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


@pytest.fixture(params=["{}", "file:{}", "file://{}", "file://{}/"])
def folder(request, tmp_path, monkeypatch):
    """The shared folder as a path and as URIs, as spark.checkpoint.dir may have it."""
    from brightloom import runtime
    from brightloom.llm import common

    for module in (runtime, common):
        monkeypatch.setattr(module, "shared_folder", lambda spark: request.param.format(tmp_path))
    return tmp_path


def test_forgotten_tables_are_deleted_however_the_folder_is_given(spark, folder):
    from brightloom.llm.common import forget
    from brightloom.runtime import durable

    kept, gone = durable(spark.range(10)), durable(spark.range(20))
    outside = f"{folder.parent}/{folder.name}-outside/table-1"
    spark.range(5).write.parquet(outside)
    assert len(tables(folder)) == 2
    forget(gone)
    forget(spark.read.parquet(outside))
    assert len(tables(folder)) == 1 and kept.count() == 10 and os.listdir(outside)


def test_a_written_table_leaves_no_shuffle_files(spark):
    from brightloom.runtime import TIDY, durable

    before = shuffled(spark)
    written = durable(spark.range(100_000).groupBy((F.col("id") % 7).alias("k")).count())
    assert len(written.collect()) == 7  # a count would shuffle itself
    until = time.time() + 20
    while shuffled(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffled(spark) <= before and spark.conf.get(TIDY, None) is None


def test_language_model_keeps_only_the_tables_it_looks_up(spark, tmp_path, monkeypatch):
    from brightloom import runtime
    from brightloom.llm import common, language_model

    for module in (runtime, common):
        monkeypatch.setattr(module, "shared_folder", lambda spark: f"file://{tmp_path}")
    docs = spark.createDataFrame([(i, f"text {i % 5} of a few words") for i in range(40)], "doc_id long, text string")
    model = language_model.fit_language_model(docs, held=8)
    assert len(tables(tmp_path)) == 2  # the counts and the keys' values, not the trees
    got = language_model.score_texts(docs, model)
    held = language_model.score_texts(docs, language_model.fit_language_model(docs))
    values = [{r.doc_id: (r.n_known, r.base_score, r.score) for r in x.collect()} for x in (got, held)]
    assert all(a == pytest.approx(values[1][k], rel=1e-5) for k, a in values[0].items()) and len(values[0]) == 40


def test_cutting_stage_shuffles_the_texts_one_after_the_other(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    from brightloom import runtime
    from brightloom.llm import common

    for module in (runtime, common):
        monkeypatch.setattr(module, "shared_folder", lambda spark: f"file://{tmp_path}")
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(0, passage + " tail"), (1, "head " + passage), (2, "alone"), (3, None)], "doc_id long, text string")
    got = corpus_pipeline.cut_repeats(spark, docs, "")
    assert "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString()  # the texts are cut already
    assert len(tables(tmp_path)) == 3  # whole and extended repeats, and the cut texts
    assert {r.doc_id: r.text for r in got.collect()} == {0: "tail", 1: "head", 2: "alone", 3: None}
