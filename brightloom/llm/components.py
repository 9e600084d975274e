"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brightloom.runtime import durable

from .common import forget


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of an edge with the least node it is connected to.

    Alternates the large-star and small-star steps (Kiveris et al., 2014): after a
    logarithmic number of rounds each node points at its root. A hub's neighbours are
    combined by aggregation, never gathered. Self loops and repeated edges are fine;
    edges with a null end are left out. No edges, no rows."""
    e = (edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    e = durable(e)
    same = (F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s"))
    before = e.agg(*same).first()
    while before["n"]:
        both = e.union(e.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("m").alias("u"), "v")
                 .where("u <> v"))
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(low, "v").select(F.explode(F.array(
            F.struct(F.col("m").alias("u"), F.col("v")), F.struct(F.col("m").alias("u"), F.col("u").alias("v")))).alias("x"))
            .select("x.*").where("u <> v").distinct())
        new = durable(small)
        after = new.agg(*same).first()
        forget(e)
        e = new
        if before == after:
            break
        before = after
    found = e.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        e.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
    found = durable(found)
    forget(e)
    return found
