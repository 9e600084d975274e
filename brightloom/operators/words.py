"""Word counts, token features and lexicon sentiment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.porter import stem_array
from ..functions.strings import is_digits, split_whitespace
from ..functions.values import bound
from ..functions.wordlists import NEGATION_ENDING, NEGATION_WORDS
from .relations import remove_listed, sized_join
from .rows import top_k
from .search import positions_of, stem_tokens


def _letters_only(text: Column) -> Column:
    return F.split(F.regexp_replace(F.lower(text), "[^A-Za-z]+", " "), " ")


def word_freq(df: DataFrame, column: str, stop: list[str] | DataFrame, n: int | None = None) -> DataFrame:
    """Most frequent words: lower-case, letters only, not listed, longer than two,
    not numeric. Words are counted first and the stop list meets distinct words."""
    words = positions_of(df, [], _letters_only(F.col(column)), "word")
    counts = (words.where((F.length("word") > 2) & ~is_digits("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("frequency")))
    kept = remove_listed(counts, stop)
    return kept if n is None else top_k(kept, [F.desc("frequency"), "word"], n)


def word_cloud_weights(df: DataFrame, column: str, stop: list[str] | DataFrame, n: int) -> DataFrame:
    """The n most frequent words with their frequency relative to the first."""
    top = word_freq(df, column, stop, n)
    return top.withColumn("weight", F.col("frequency")
                          / F.max("frequency").over(Window.partitionBy(F.lit(0))))


def plain_tokens(text: Column | str, stem: str | None = None) -> Column:
    """Split at whitespace, keep only ASCII letters and digits, drop empty words, stem."""
    bare = F.transform(split_whitespace(text), lambda w: F.regexp_replace(w, "[^A-Za-z0-9]+", ""))
    words = F.filter(bare, lambda w: w != "")
    return stem_array(words, stem) if stem else words


#: Bytes that white space becomes, and those that leave a text. In UTF-8 other than ASCII characters have none of the bytes that stay.
_SPACE = bytes.maketrans(b"\t\n\v\f\r", b"     ")
_OTHER = bytes(c for c in range(256) if not (c < 128 and chr(c).isalnum() or c in b" \t\n\v\f\r"))


def _token_lists(texts: pa.Array) -> pa.ListArray:
    """`plain_tokens` of a batch of texts."""
    words = [None if t is None else t.translate(_SPACE, _OTHER).split() for t in texts.cast(pa.binary()).to_pylist()]
    return pa.array(words, pa.list_(pa.binary())).cast(pa.list_(pa.string()))


def word_tokens(df: DataFrame, doc: str, text: str, stem: str | None = None) -> DataFrame:
    """(doc, pos, word): the words of ``plain_tokens`` as rows; stems are looked up by word."""
    tokens = positions_of(df, [doc], plain_tokens(text), "word")
    return stem_tokens(tokens, "word", stem) if stem else tokens


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of n neighbouring tokens, comma-joined."""
    last = F.size(tokens) - n
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(tokens, i + 1, F.lit(n)), ","))
    ).otherwise(F.array().cast("array<string>"))


TOKENS = 200_000  # of the documents whose features are made together
CHARS = 5  # for each token, about


def _feature_rows(df: DataFrame, doc: str, source: Column, *families: Callable) -> DataFrame:
    """(doc, feature, value) from (doc, array of words), or (doc, text) of which `plain_tokens` are
    taken. A family gets the words of some documents, as codes, the document of each and the
    dictionary, and yields documents, names and values."""
    schema = StructType([StructField(doc, df.schema[doc].dataType), StructField("feature", StringType()), StructField("value", DoubleType())])

    def some_rows(docs: pa.Array, lists: pa.ListArray) -> Iterator[pa.RecordBatch]:
        coded = lists.flatten().dictionary_encode()
        row = np.repeat(np.arange(len(docs)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        for family in families if len(row) else ():
            for at, names, values in family(coded.indices.to_numpy().astype("int64"), row, coded.dictionary):
                yield pa.RecordBatch.from_arrays([docs.take(pa.array(at)), names, pa.array(values)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, given = batch.column(0), batch.column(1)
            listed = pa.types.is_list(given.type)
            size = pc.list_value_length(given) if listed else pc.divide(pc.binary_length(given), CHARS)
            ends = np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False))
            first = 0
            while first < len(ends):
                last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + TOKENS, "right")))
                some = given.slice(first, last - first)
                yield from some_rows(docs.slice(first, last - first), some if listed else _token_lists(some))
                first = last

    return df.select(doc, source.alias("_source")).mapInArrow(run, schema)


def _firsts(row: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The first place of each code in its document."""
    return np.unique(row * (code.max() + 1) + code, return_index=True)[1]


def _joined(*parts: pa.Array | str, by: str = "") -> pa.Array:
    return pc.binary_join_element_wise(*parts, by).cast(pa.string())


def _ngrams(n: int) -> Callable:
    def family(code: np.ndarray, row: np.ndarray, words: pa.Array) -> Iterator[tuple]:
        gram, names = code, words
        for k in range(n):
            if k:  # every gram of k words with the word that follows it in its document
                on = np.flatnonzero(row[k:] == row[:len(row) - k])
                if not len(on):
                    return
                pairs, gram = np.unique(gram[on] * len(words) + code[on + k], return_inverse=True)
                whole = np.full(len(row) - k, -1)
                whole[on] = gram
                gram, names = whole, _joined(names.take(pa.array(pairs // len(words))), words.take(pa.array(pairs % len(words))), by=",")
            there = np.flatnonzero(gram >= 0)
            there = there[_firsts(row[there], gram[there])]
            yield row[there], _joined("has(", names, ")").take(pa.array(gram[there])), np.ones(len(there))

    return family


def ngram_features(df: DataFrame, doc: str, tokens: str, n: int = 3) -> DataFrame:
    """Presence features ``has(a)``, ``has(a,b)``, … as (doc, feature, value = 1).
    A document's features are made distinct within its row."""
    return _feature_rows(df, doc, F.col(tokens), _ngrams(n))


def is_negation(word: Column, words: list[str] | None = None, ending: str = NEGATION_ENDING) -> Column:
    return word.isin(NEGATION_WORDS if words is None else words) | word.contains(ending)


#: By distance from a negation; 0 from ten tokens on.
FADE = [1 - 0.1 * d for d in range(10)]


def _scored_words(words: Column, negations: list[str] | None) -> Column:
    """(word, left, right, pos) of every word of an array. A score fades to 0 within ten
    words, so each word looks at nine neighbours on either side."""
    def near(flags: Column, at: Column, side: int) -> Column:
        return F.coalesce(*[F.when(F.get(flags, at + side * d), F.lit(v)) for d, v in enumerate(FADE)], F.lit(0.0))

    def scored(words: Column) -> Column:
        return bound(F.transform(words, lambda w: is_negation(w, negations)), lambda flags: F.transform(
            words, lambda w, i: F.struct(w.alias("word"), near(flags, i, -1).alias("left"),
                                         near(flags, i, 1).alias("right"), i.alias("pos"))))

    return bound(words, scored)


def negation_scores(tokens: DataFrame, doc: str, negations: list[str] | None = None,
                    words: Column | None = None) -> DataFrame:
    """Adds ``left`` and ``right`` to (doc, pos, word): 1 at a negation, a tenth less
    with every further token after (left) or before it (right), not below 0.
    Windows run inside one document, which came from one row. With `words`, an array
    column, `tokens` has a row per document instead and all is found within the row."""
    if words is not None:
        return (tokens.select(doc, F.explode_outer(_scored_words(words, negations)).alias("_t"))
                .where(F.col("_t").isNotNull()).select(doc, "_t.pos", "_t.word", "_t.left", "_t.right"))
    flagged = tokens.withColumn("_at", F.when(is_negation(F.col("word"), negations), F.col("pos")))
    # two growing frames in opposite order: a shrinking frame costs the square of the length
    growing = lambda at: (Window.partitionBy(doc).orderBy(at)
                          .rowsBetween(Window.unboundedPreceding, 0))
    before = F.last("_at", ignorenulls=True).over(growing(F.asc("pos")))
    after = F.last("_at", ignorenulls=True).over(growing(F.desc("pos")))
    fade = lambda distance: F.greatest(F.lit(0.0), F.coalesce(1 - 0.1 * distance, F.lit(0.0)))
    return (flagged.withColumn("left", fade(F.col("pos") - before))
            .withColumn("right", fade(after - F.col("pos"))).drop("_at"))


def _negations(negations: list[str] | None) -> Callable:
    listed, ending = NEGATION_WORDS if negations is None else negations, NEGATION_ENDING
    fade = np.array([*FADE, 0.0])

    def family(code: np.ndarray, row: np.ndarray, words: pa.Array) -> Iterator[tuple]:
        negates = np.array([w in listed or ending in w for w in words.to_pylist()], bool)[code]
        place, far = np.arange(len(row)), len(FADE)
        before = np.maximum.accumulate(np.where(negates, place, -far))
        after = np.minimum.accumulate(np.where(negates, place, len(row) + far)[::-1])[::-1]
        last = len(row) - 1 - _firsts(row[::-1], code[::-1])
        for side, near in (("neg_l(", before), ("neg_r(", after)):
            inside = row[np.clip(near, 0, len(row) - 1)] == row
            away = np.where(inside, np.minimum(np.abs(place - near), far), far)
            yield row[last], _joined(side, words, ")").take(pa.array(code[last])), fade[away[last]]

    return family


def negation_features(tokens: DataFrame, doc: str, negations: list[str] | None = None,
                      words: Column | None = None) -> DataFrame:
    """``neg_l(word)`` and ``neg_r(word)`` per document; a repeated word keeps the
    value at its last position. `words` as in `negation_scores`: then all is found within
    the document's row, nothing is moved."""
    if words is not None:
        return _feature_rows(tokens, doc, words, _negations(negations))
    last = (negation_scores(tokens, doc, negations).groupBy(doc, "word")
            .agg(F.max_by(F.struct("left", "right"), "pos").alias("s")))
    pairs = F.array(
        F.struct(F.concat(F.lit("neg_l("), F.col("word"), F.lit(")")).alias("feature"),
                 F.col("s.left").alias("value")),
        F.struct(F.concat(F.lit("neg_r("), F.col("word"), F.lit(")")).alias("feature"),
                 F.col("s.right").alias("value")))
    return last.select(doc, F.explode(pairs).alias("p")).select(doc, "p.feature", "p.value")


def pos_features(tokens: DataFrame, doc: str, tags: DataFrame) -> DataFrame:
    """``has(word)_TAG`` for tokens found in a (word, tag) table."""
    tagged = sized_join(tokens.select(doc, "pos", "word"), tags.select("word", "tag"), ["word"])
    return (tagged.select(doc, F.concat(F.lit("has("), F.col("word"), F.lit(")_"), F.col("tag"))
                          .alias("feature")).distinct().withColumn("value", F.lit(1.0)))


def extract_features(df: DataFrame, doc: str, text: str, n: int = 3, stem: str | None = None,
                     negations: list[str] | None = None, pre_stem: bool = False,
                     tags: DataFrame | None = None) -> DataFrame:
    """All feature families of a text as (doc, feature, value). Negations are looked
    for in the cleaned, stemmed words; `pre_stem` looks in the raw lower-cased ones.
    With a (word, tag) table the part-of-speech family is added."""
    words = df.select(doc, plain_tokens(text, stem).alias("_words"),
                      F.transform(split_whitespace(text), F.lower).alias("_raw"))
    if pre_stem:
        families = ngram_features(words, doc, "_words", n).unionByName(negation_features(words, doc, negations, F.col("_raw")))
    else:  # both from the same words, so from one pass over them
        families = _feature_rows(df, doc, plain_tokens(text, stem) if stem else F.col(text), _ngrams(n), _negations(negations))
    if tags is not None:
        families = families.unionByName(pos_features(
            positions_of(words, [doc], F.col("_words"), "word"), doc, tags))
    return families


def feature_bags(features: DataFrame, doc: str) -> DataFrame:
    """One map per document; a document's features come from one text."""
    return features.groupBy(doc).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("features"))


def sentiment(df: DataFrame, doc: str, cols: list[str], lexicon: DataFrame) -> DataFrame:
    """Mean polarity and subjectivity of the lexicon words of each text column, 0
    without a hit or without a text. `lexicon` is (word, polarity, subjectivity).
    Adds nothing but the document key: join back for further columns."""
    texts = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in cols])
    long = df.select(doc, F.explode(texts).alias("t")).select(doc, "t.field", "t.text")
    words = long.select(doc, "field", F.explode_outer(
        F.split(F.lower("text"), r"[^\p{L}\p{N}_']+")).alias("word"))
    scored = sized_join(words, lexicon.select("word", "polarity", "subjectivity"), ["word"], "left")
    means = []
    for c in cols:
        here = F.col("field") == c
        means += [F.coalesce(F.avg(F.when(here, F.col(m))), F.lit(0.0)).alias(f"{m}_{c}")
                  for m in ("polarity", "subjectivity")]
    return scored.groupBy(doc).agg(*means)
