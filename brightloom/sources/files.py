"""File scans with explicit schemas, and the CSV sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
             decimal: str = ".", index_col: str | None = None) -> DataFrame:
    """CSV with header. With another decimal mark the fractional columns are read
    as text, repaired and cast. `index_col` names the row-label column; it is kept
    as an ordinary column and moved to the front."""
    fractional = [f.name for f in schema.fields
                  if isinstance(f.dataType, (T.FractionalType, T.DecimalType))]
    repair = decimal != "."
    as_read = T.StructType([
        T.StructField(f.name, T.StringType() if repair and f.name in fractional else f.dataType,
                      f.nullable)
        for f in schema.fields])
    df = spark.read.schema(as_read).csv(path, header=True, sep=sep, multiLine=False)
    if repair:
        df = df.withColumns({
            f.name: F.replace(F.col(f.name), F.lit(decimal), F.lit(".")).try_cast(f.dataType)
            for f in schema.fields if f.name in fractional})
    if index_col:
        df = df.select(index_col, *[c for c in df.columns if c != index_col])
    return df


def read_many(spark: SparkSession, glob: str, schema: T.StructType,
              file_col: str = "file_name") -> DataFrame:
    """All files of a glob in one scan; every row carries the path it came from."""
    return (spark.read.schema(schema).csv(glob, header=True)
            .withColumn(file_col, F.col("_metadata.file_path")))


def scan_labelled_dir(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Files below ``root/split/class/`` as (split, class, path, length, content).
    ``name=value`` folders give the value. Leave `content` unselected and Spark
    only lists the files."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", pattern).load(root))
    folders = r"/(?:[^/=]+=)?([^/=]+)/(?:[^/=]+=)?([^/=]+)/[^/]+$"
    return files.select(F.regexp_extract("path", folders, 1).alias("split"),
                        F.regexp_extract("path", folders, 2).alias("class"),
                        "path", "length", "content")


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """CSV with header; quotes inside fields are doubled."""
    df.write.mode(mode).csv(path, header=True, sep=sep, escape='"')
