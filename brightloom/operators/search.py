"""Inverted and positional index, ranked and phrase search over frames; `stored_index`
keeps an index on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.porter import stem, stem_array, stem_vocabulary
from ..functions.strings import is_alphabetic, labelled_concat, split_non_word
from ..functions.values import bound
from ..functions.wordlists import ENGLISH_STOP_WORDS
from ..runtime import durable
from .relations import docs_with_all, match_terms, phrase_match
from .rows import top_k


def positions_of(df: DataFrame, keep: list[str], words: Column, name: str) -> DataFrame:
    """One row per array element with its position from 0.

    A plain ``posexplode`` makes Spark add a filter on the array's size, which
    computes the whole array a second and third time; the outer form does not."""
    return (df.select(*keep, F.posexplode_outer(words).alias("pos", name))
            .where(F.col("pos").isNotNull()))


FREQUENT = 400_000  # words at most whose stems every task gets


def stem_tokens(tokens: DataFrame, column: str, algorithm: str) -> DataFrame:
    """`column` replaced by its stem, without moving a token. Words are counted; each
    frequent one is stemmed once and looked up, the others, few tokens by their nature,
    are stemmed where they stand. Frequent are as many powers of two of the counts, from
    the top, as hold FREQUENT words together."""
    counts = durable(tokens.groupBy(column).agg(F.count(F.lit(1)).alias("_n")))
    powers = counts.groupBy(F.floor(F.log2("_n")).alias("power")).count().orderBy(F.desc("power")).collect()
    least, words = None, 0
    for power in powers:  # 63 at most
        words += power["count"]
        if words > FREQUENT:
            break
        least = 2 ** power["power"]
    frequent = counts.where(F.lit(False) if least is None else F.col("_n") >= least)
    looked_up = tokens.join(F.broadcast(durable(stem_vocabulary(frequent, column, algorithm))), column, "left")
    return (looked_up.withColumn(column, F.coalesce("stem", stem(column, algorithm)))
            .select(*tokens.columns))


def _terms(text: str, stop: list[str] | None) -> Column:
    stop = ENGLISH_STOP_WORDS if stop is None else stop
    wordy = lambda w: is_alphabetic(w) & (F.length(w) > 1)
    if stop:
        kept = F.filter(split_non_word(text), lambda w: wordy(w) & ~F.lower(w).isin(list(stop)))
    else:
        kept = F.filter(split_non_word(text), wordy)
    return F.transform(kept, F.lower)


def index_tokens(df: DataFrame, doc: str, text: str, stop: list[str] | None = None,
                 stem: str | None = None) -> DataFrame:
    """(doc, pos, term): split at non-words, keep alphabetic words longer than one
    letter, lower-case, drop stop words, stem. Positions count kept words only.
    Without stems everything happens within the row; stems are looked up by word."""
    tokens = positions_of(df, [doc], _terms(text, stop), "term")
    return stem_tokens(tokens, "term", stem) if stem else tokens


def index_postings(df: DataFrame, doc: str, text: str, stop: list[str] | None = None,
                   stem: str | None = None) -> DataFrame:
    """(doc, term, positions) of the terms of ``index_tokens``, positions ascending. Without
    stems a text is sorted and cut into runs of equal terms within its row, so rows that
    share a `doc` give postings of their own; with stems a posting is one per (doc, term)."""
    if stem:
        tokens = index_tokens(df, doc, text, stop, stem)
        return tokens.groupBy(doc, "term").agg(F.sort_array(F.collect_list("pos")).alias("positions"))

    def runs(a: Column) -> Column:
        first = F.transform(a, lambda x, i: F.when((i == 0) | (x["term"] != F.get(a, i - 1)["term"]), i))
        return bound(F.filter(first, lambda i: i.isNotNull()), lambda starts: F.transform(starts, lambda at, k: F.struct(
            F.get(a, at)["term"].alias("term"),
            F.transform(F.slice(a, at + 1, F.coalesce(F.get(starts, k + 1), F.size(a)) - at), lambda x: x["pos"]).alias("positions"))))

    in_order = F.sort_array(F.transform(_terms(text, stop), lambda t, i: F.struct(t.alias("term"), i.alias("pos"))))
    return (df.select(doc, F.explode_outer(bound(in_order, runs)).alias("_p")).where(F.col("_p").isNotNull())
            .select(doc, "_p.term", "_p.positions"))


def build_index(tokens: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Postings (term, doc, tf, weight) with weight ``1 + ln(tf)``."""
    return (tokens.groupBy("term", doc).agg(F.count(F.lit(1)).alias("tf"))
            .withColumn("weight", 1 + F.ln("tf")))


def build_positional_index(tokens: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Positions in long form (term, doc, pos); a term's positions in one document
    are rows, never one growing array."""
    return tokens.select("term", doc, "pos")


def query_terms(spark: SparkSession, query: str, stop: list[str] | None = None,
                stem: str | None = None) -> list[str]:
    """Analyse one query string the way the documents were; a query is short, so
    its terms come to the driver and can be pushed into the scan."""
    row = spark.range(1).select(F.lit(0).alias("doc_id"), F.lit(query).alias("text"))
    terms = _terms("text", stop)
    return list(row.select((stem_array(terms, stem) if stem else terms).alias("terms")).first()["terms"])


def term_gain(weight: Column, n_docs: Column, df: Column, scheme: str) -> Column:
    """Score one matching term adds: ``reference`` applies ``1 + ln`` to the stored
    weight once more, ``standard`` uses the weight itself."""
    tf_part = 1 + F.ln(weight) if scheme == "reference" else weight
    return tf_part * F.log10(n_docs / df)


def search_ranked(postings: DataFrame, terms: list[str], n_docs: int, k: int = 10,
                  doc: str = "doc_id", scheme: str = "reference") -> DataFrame:
    """Top k documents for one query. Only postings of its terms are read."""
    times: dict[str, int] = {}
    for term in terms:
        times[term] = times.get(term, 0) + 1
    relevant = match_terms(postings, list(times))
    df = relevant.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    count = F.lit(0)
    for term, n in times.items():
        count = F.when(F.col("term") == term, n).otherwise(count)
    gain = term_gain(F.col("weight"), F.lit(n_docs), F.col("df"), scheme)
    scores = (relevant.join(df, "term").groupBy(doc)
              .agg(F.sum(gain * count).alias("score")))
    return top_k(scores, [F.desc(F.round("score", 9)), F.asc(doc)], k)


def search_phrase(positions: DataFrame, terms: list[str], doc: str = "doc_id") -> DataFrame:
    """Documents that contain the terms as a phrase. An unknown term gives none."""
    relevant = match_terms(positions, list(dict.fromkeys(terms)))
    candidates = docs_with_all(relevant, terms, doc)
    return phrase_match(relevant.join(candidates, doc, "left_semi"), terms, doc)


def search_scope(pros: str, cons: str, scope: str = "both") -> Column:
    """The text to search: one column, or both with their labels."""
    if scope == "pros":
        return F.col(pros)
    if scope == "cons":
        return F.col(cons)
    if scope == "both":
        return labelled_concat("PROS: ", F.col(pros), " CONS: ", F.col(cons))
    raise ValueError("scope is 'pros', 'cons' or 'both'")
