"""Per-batch callbacks and runs to the end of the available input."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..runtime import scratch_path

log = logging.getLogger(__name__)
Batch = Callable[[DataFrame, int], None]


@dataclass
class Outcome:
    """What a guarded callback has seen."""

    batches: int = 0
    failures: int = 0
    errors: list[str] = field(default_factory=list)


def safe_batch(fn: Batch, reraise: bool = True) -> tuple[Batch, Outcome]:
    """Log and count failing batches. They fail the query too unless `reraise` is
    False, in which case the stream goes on with the next batch; the batch is then
    computed in full before `fn` sees it, so that its state is kept either way."""
    outcome = Outcome()

    def guarded(batch: DataFrame, batch_id: int) -> None:
        outcome.batches += 1
        if not reraise:
            batch = batch.persist()
            batch.count()
        try:
            fn(batch, batch_id)
        except Exception as error:
            outcome.failures += 1
            outcome.errors.append(f"{batch_id}: {error}")
            log.exception("batch %s failed", batch_id)
            if reraise:
                raise
        finally:
            if not reraise:
                batch.unpersist()

    return guarded, outcome


def batch_sql(view: str, statement: str, sink: Batch) -> Batch:
    """Run SQL text over each batch as a temp view and hand the result to `sink`."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.createOrReplaceTempView(view)
        sink(batch.sparkSession.sql(statement), batch_id)
    return run


def parquet_batches(path: str) -> Batch:
    """Write every batch to its own folder; a repeated batch replaces itself, so a
    restart cannot count it twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def foreach_batch_sink(df: DataFrame, fn: Batch, checkpoint: str, mode: str = "update",
                       every: str | None = None) -> StreamingQuery:
    """Start a query with a per-batch callback. `every` is the trigger interval;
    without it the query takes what is there and stops."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def console_sink(df: DataFrame, checkpoint: str, mode: str = "complete", every: str = "2 seconds",
                 rows: int = 10) -> StreamingQuery:
    """Print every batch."""
    return (df.writeStream.format("console").outputMode(mode).option("numRows", rows)
            .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())


def run_available(df: DataFrame, fn: Batch, mode: str, checkpoint: str | None = None) -> str:
    """Process all available input and wait. Returns the checkpoint path, which a
    later call can go on from."""
    spark = df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "progress")
    query = foreach_batch_sink(df, fn, checkpoint, mode)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return checkpoint


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All written batches with their number."""
    return spark.read.option("basePath", path).parquet(path)


def last_batch(spark: SparkSession, path: str) -> DataFrame:
    """The newest batch; in complete mode that is the final state."""
    batches = read_batches(spark, path)
    newest = batches.agg(F.max("batch_id")).first()[0]
    return batches.where(F.col("batch_id") == newest).drop("batch_id")


def merged_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Final state from update-mode batches: the newest row of every key."""
    batches = read_batches(spark, path)
    values = [c for c in batches.columns if c not in (*keys, "batch_id")]
    newest = batches.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return newest.select(*keys, "_v.*")
