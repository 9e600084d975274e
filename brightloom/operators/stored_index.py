"""A persistent inverted index: built once, extended by generations, searched by term bucket.

Below its path lie, each partitioned by generation and term bucket:

* ``postings`` (term, doc, tf, positions), sorted by term within a file;
* ``terms`` (term, df, occurrences), the statistics of a generation;

and ``generations``, a row per generation. That row is written last, and only
generations that have one are read, so a build that fails leaves nothing behind
that a search could see.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from .relations import sized_join
from .rows import top_k, top_k_per_group
from .search import index_postings, index_tokens, query_terms, term_gain

#: Documents whose postings of one bucket share a file; hot terms spread over more files.
DOCS_PER_FILE = 500_000


@dataclass(frozen=True)
class StoredIndex:
    """Handle of the index below `path`; the same settings analyse documents and queries."""

    spark: SparkSession
    path: str
    doc: str = "doc_id"
    buckets: int = 64
    stop: tuple[str, ...] | None = None
    stem: str | None = None

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.hash(term), F.lit(self.buckets))

    def _generations(self) -> list[tuple[int, int, list[int]]]:
        try:
            rows = self.spark.read.parquet(f"{self.path}/generations").collect()
        except AnalysisException:  # nothing written yet
            return []
        return [(r["generation"], r["docs"], r["replaces"]) for r in rows]

    def live(self) -> dict[int, int]:
        """Generations that count, with their numbers of documents."""
        rows = self._generations()
        replaced = {g for _, _, gone in rows for g in gone}
        return {g: docs for g, docs, _ in rows if g not in replaced}

    def n_docs(self) -> int:
        return sum(self.live().values())

    def _read(self, table: str, wanted: list[int] | None = None) -> DataFrame:
        """A table of the live generations; with `wanted`, only those buckets' files."""
        live = sorted(self.live())
        if not live:
            raise ValueError(f"there is no index below {self.path}")
        rows = (self.spark.read.option("basePath", f"{self.path}/{table}")
                .parquet(*[f"{self.path}/{table}/generation={g}" for g in live]))
        return rows if wanted is None else rows.where(F.col("bucket").isin(wanted))

    def _commit(self, postings: DataFrame, docs: int, replaces: list[int]) -> int:
        number = 1 + max([g for g, _, _ in self._generations()], default=-1)
        place = f"generation={number}"
        (postings.sortWithinPartitions("bucket", "term", self.doc).drop("shard")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/postings/{place}"))
        (self.spark.read.parquet(f"{self.path}/postings/{place}").groupBy("bucket", "term")
         .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("occurrences"))
         .repartition("bucket").sortWithinPartitions("bucket", "term")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/terms/{place}"))
        self.spark.createDataFrame([(number, docs, replaces)], "generation int, docs long, replaces array<int>").coalesce(1) \
            .write.mode("append").parquet(f"{self.path}/generations")
        return number

    def append(self, docs: DataFrame, text: str = "text") -> int:
        """Add documents that the index does not hold yet, as a new generation. They are
        analysed once; the one shuffle takes their postings by bucket and share of the
        documents. One writer at a time."""
        n, ids = docs.agg(F.count(F.lit(1)), F.count_distinct(self.doc)).first()
        shards = 1 + n // DOCS_PER_FILE
        stop = None if self.stop is None else list(self.stop)
        share = F.pmod(F.xxhash64(self.doc), F.lit(shards))
        postings = (index_postings(docs, self.doc, text, stop, self.stem)
                    .repartition(self._bucket(F.col("term")), share)
                    .withColumns({"bucket": self._bucket(F.col("term")), "shard": share}))
        if ids < n:  # several rows make up one document
            postings = postings.groupBy("bucket", "shard", "term", self.doc).agg(
                F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"))
        tf = F.size("positions").cast("long").alias("tf")
        return self._commit(postings.select("bucket", "shard", "term", self.doc, tf, "positions"), n, [])

    def compact(self) -> int:
        """Write all generations as one; the old ones stay on disk and count no more."""
        live = self.live()
        shards = 1 + sum(live.values()) // DOCS_PER_FILE
        rows = self._read("postings").drop("generation").withColumn("shard", F.pmod(F.xxhash64(self.doc), F.lit(shards)))
        return self._commit(rows.repartition("bucket", "shard"), sum(live.values()), sorted(live))

    def statistics(self) -> DataFrame:
        """(term, df, occurrences) over all generations."""
        return self._read("terms").groupBy("term").agg(F.sum("df").alias("df"), F.sum("occurrences").alias("occurrences"))

    def analyse(self, query: str) -> list[str]:
        return query_terms(self.spark, query, None if self.stop is None else list(self.stop), self.stem)

    def _buckets_of(self, terms: list[str]) -> list[int]:
        row = self.spark.range(1).select(F.array_distinct(F.array(*[self._bucket(F.lit(t)) for t in terms]))).first()
        return list(row[0])

    def _empty(self, columns: str) -> DataFrame:
        kind = dict(self._read("postings").dtypes)[self.doc]
        return self.spark.createDataFrame([], columns.format(doc=f"{self.doc} {kind}"))

    def search(self, query: str, k: int = 10, scheme: str = "reference") -> DataFrame:
        """Top k documents (doc, score) for one query. Its terms are few, so their
        statistics become literals: only their buckets are read, and nothing is joined."""
        terms = self.analyse(query)
        if not terms:
            return self._empty("{doc}, score double")
        wanted = self._buckets_of(terms)
        known = self._read("terms", wanted).where(F.col("term").isin(terms)).groupBy("term").agg(F.sum("df").alias("df")).collect()
        n = F.lit(self.n_docs())
        gain = F.lit(None).cast("double")
        for row in known:
            gain = F.when(F.col("term") == row["term"],
                          term_gain(1 + F.ln("tf"), n, F.lit(row["df"]), scheme) * terms.count(row["term"])).otherwise(gain)
        scores = (self._read("postings", wanted).where(F.col("term").isin(terms))
                  .groupBy(self.doc).agg(F.sum(gain).alias("score")))
        return top_k(scores, [F.desc(F.round("score", 9)), F.asc(self.doc)], k)

    def phrase(self, query: str) -> DataFrame:
        """Documents that hold the query's terms next to each other, in order. Where a
        document holds them all, the starts that each term allows are intersected."""
        terms = self.analyse(query)
        if not terms:
            return self._empty("{doc}")
        distinct = list(dict.fromkeys(terms))
        found = (self._read("postings", self._buckets_of(distinct)).where(F.col("term").isin(distinct))
                 .groupBy(self.doc).agg(F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("_at"))
                 .where(F.size("_at") == len(distinct)))

        def starts_by(term: str, i: int) -> Column:
            return F.transform(F.col("_at")[term], lambda p: p - i)

        starts = [starts_by(term, i) for i, term in enumerate(terms)]
        return found.where(F.size(reduce(F.array_intersect, starts)) > 0).select(self.doc)

    def search_many(self, queries: DataFrame, query: str = "query_id", text: str = "text", k: int = 10,
                    scheme: str = "reference") -> DataFrame:
        """Top k documents for each row of a table of queries, with `rank`. Only buckets of
        the queries' terms are read; a term that a query repeats counts as often."""
        stop = None if self.stop is None else list(self.stop)
        asked = index_tokens(queries, query, text, stop, self.stem).groupBy(query, "term").agg(F.count(F.lit(1)).alias("times"))
        wanted = [r[0] for r in asked.select(self._bucket(F.col("term"))).distinct().collect()]  # at most `buckets`
        df = self._read("terms", wanted).groupBy("term").agg(F.sum("df").alias("df"))
        weighted = asked.join(df, "term")
        hits = sized_join(self._read("postings", wanted).select("term", self.doc, "tf"), weighted, ["term"])
        gain = term_gain(1 + F.ln("tf"), F.lit(self.n_docs()), F.col("df"), scheme)
        scores = hits.groupBy(query, self.doc).agg(F.sum(gain * F.col("times")).alias("score"))
        return top_k_per_group(scores, [query], [F.desc(F.round("score", 9)), F.asc(self.doc)], k)
