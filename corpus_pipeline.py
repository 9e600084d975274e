"""Training corpus from `documents`: the stages in order, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brightloom.llm.mixing import mix
from brightloom.llm.near_dedup import near_duplicates
from brightloom.llm.packing import pack_documents
from brightloom.llm.substring_dedup import text_keys, without_repeats
from brightloom.llm.toxicity import fit_toxicity, without_toxic
from brightloom.runtime import durable, scratch_path


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the table lacks."""
    while name in map(str.lower, docs.columns):
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones, does not reject."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return without_toxic(docs, fit_toxicity(docs, labels))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, five-word similarity 0.8 or more: the one with
    the least id, null ids last. Ids name nothing here: rows that repeat an id with other
    texts stay, and rows without an id are compared like all. Rows without words all stay."""
    key = _unused(docs, "_row")
    keyed = durable(docs.withColumn(key, F.monotonically_increasing_id()))
    classes = near_duplicates(keyed, id_col=key, percent=80).select(F.col("doc_id").alias(key), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(key)))[key]
    kept = keyed.select(key, "doc_id").join(classes, key).groupBy("component_id").agg(first.alias(key)).select(key)
    return keyed.join(kept, key, "left_semi").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand elsewhere. Texts that lose nothing
    stay as they are, null ones too; others keep their remaining words, joined by one space,
    and `n_chars` follows where there is such a column. Other columns, whatever their names,
    pass through; no rows give no rows. The texts that lose words are written before the
    documents take them, so that the texts' two shuffles are not on disk together."""
    first, second, kept = (_unused(docs, name) for name in ("_k1", "_k2", "_kept"))
    cut = durable(without_repeats(docs).where("n_removed > 0").select(
        F.col("k1").alias(first), F.col("k2").alias(second), F.col("kept").alias(kept)))
    joined = text_keys(docs, names=(first, second)).join(cut, [first, second], "left")
    changed = {"text": F.coalesce(kept, "text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(kept)).cast(docs.schema["n_chars"].dataType)
    return joined.withColumns(changed).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of smaller sources repeated towards the target weights; each at least once."""
    return mix(docs, target_entropy=0.995, max_passes=2.0).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in training sequences of 2048 tokens."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", one_of_each_group),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: SQL can express neither the fitted toxicity model nor best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
