"""Line streams from sockets, Kafka and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LINES = T.StructType([T.StructField("value", T.StringType())])


def read_lines_stream(spark: SparkSession, kind: str, path: str | None = None,
                      host: str | None = None, port: int | None = None,
                      schema: T.StructType | None = None, files_per_batch: int | None = None,
                      name_filter: str | None = None, **options) -> DataFrame:
    """An unbounded table of lines.

    ``socket``: host and port, with arrival time; for trials only, it cannot replay.
    ``kafka``: pass the Kafka options; the record value is decoded to text.
    ``text`` / ``parquet``: files below `path`, in arrival order."""
    reader = spark.readStream
    if kind == "socket":
        return (reader.format("socket").option("host", host).option("port", port)
                .option("includeTimestamp", "true").load())
    if kind == "kafka":
        return (reader.format("kafka").options(**options).load()
                .select(F.col("value").cast("string").alias("value"), "timestamp"))
    if kind not in ("text", "parquet"):
        raise ValueError("kind is 'socket', 'kafka', 'text' or 'parquet'")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.schema(schema or LINES).options(**options).format(kind).load(path)
