"""Text features, sentiment and retrieval."""

from pyspark.sql import functions as F

from brightloom.functions import porter
from brightloom.operators import search as Q, words as W
from brightloom.operators.ordering import split_ordered
from brightloom.operators.evaluate import accuracy_of, score
from brightloom.operators.stored_index import StoredIndex
from brightloom.plans.reviews import fit_text_classifier, score_error, score_reviews
from brightloom.runtime import scratch_path

from . import entry
from .joining import STOP_SQL, tokens_sql
from .sequences import CLEAN, NEGATION_SQL, NEGATIONS


def docs(t):
    return t.spread("documents", "doc_id")


@entry("t01_analyzer_a", f"SELECT doc_id, pos, word FROM ({CLEAN.format(text='text', table='documents')})")
def _(t):
    return W.word_tokens(docs(t), "doc_id", "text")


@entry("t02_analyzer_b", tokens_sql("documents"))
def _(t):
    return Q.index_tokens(docs(t), "doc_id", "text")


# --- SQL twin of the stemmer, written from the same published rules ---

def _porter_sql(words: str) -> str:
    c, v = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
    m0, m1 = f"^(?:{c})?{v}{c}", f"^(?:{c})?{v}{c}{v}{c}"
    one, cvc = f"^(?:{c})?{v}{c}(?:{v})?$", f"^(?:{c}[aeiouy][^aeiouwxy]|[aeiou][^aeiou])$"

    def chop(n):
        return f"substr(w, 1, length(w) - {n})"

    def rules(pairs, condition):
        lines = [f"WHEN ends_with(w, '{s}') THEN CASE WHEN regexp_matches({chop(len(s))}, '{condition}') "
                 f"THEN {chop(len(s))} || '{r}' ELSE w END" for s, r in pairs]
        return "CASE " + " ".join(lines) + " ELSE w END"

    two = "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e ousli:ous " \
          "ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble fulli:ful"
    three = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
    four = "al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize"
    split = lambda text: [tuple(p.split(":")) for p in text.split()]
    ion = f"WHEN ends_with(w, 'ion') THEN CASE WHEN regexp_matches({chop(3)}, '{m1}') AND regexp_matches({chop(3)}, '[st]$') THEN {chop(3)} ELSE w END"
    logi = f"WHEN ends_with(w, 'logi') THEN CASE WHEN regexp_matches({chop(3)}, '{m0}') THEN {chop(1)} ELSE w END"
    vowel = f"^(?:{c})?[aeiouy]"
    steps = [
        f"CASE WHEN ends_with(w, 'sses') THEN {chop(2)} WHEN ends_with(w, 'ies') THEN CASE WHEN length(w) = 4 THEN {chop(1)} ELSE {chop(2)} END "
        f"WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN {chop(1)} ELSE w END",
        f"CASE WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN {chop(1)} ELSE {chop(2)} END "
        f"WHEN ends_with(w, 'eed') THEN CASE WHEN regexp_matches({chop(3)}, '{m0}') THEN {chop(1)} ELSE w END "
        f"WHEN ends_with(w, 'ed') THEN CASE WHEN regexp_matches({chop(2)}, '{vowel}') THEN '+' || {chop(2)} ELSE w END "
        f"WHEN ends_with(w, 'ing') THEN CASE WHEN regexp_matches({chop(3)}, '{vowel}') THEN '+' || {chop(3)} ELSE w END ELSE w END",
        f"CASE WHEN w[1] <> '+' THEN w WHEN regexp_matches(w, '(at|bl|iz)$') THEN w[2:] || 'e' "
        f"WHEN length(w) > 2 AND w[-1] = w[-2] AND NOT regexp_matches(w[-1], '[aeiouy]') THEN CASE WHEN w[-1] IN ('l', 's', 'z') THEN w[2:] ELSE w[2:-2] END "
        f"WHEN regexp_matches(w[2:], '{one}') AND regexp_matches(w[2:], '{cvc}') THEN w[2:] || 'e' ELSE w[2:] END",
        f"CASE WHEN regexp_matches(w, '^.+[^aeiouy]y$') OR regexp_matches(w, '^.*[aeiou]yy$') THEN {chop(1)} || 'i' ELSE w END",
        rules([("alli", "al")], m0),
        rules(split(two), m0)[:-len(" ELSE w END")] + f" {logi} ELSE w END",
        rules(split(three), m0),
        rules([(s, "") for s in four.split()], m1)[:-len(" ELSE w END")] + f" {ion} ELSE w END",
        f"CASE WHEN ends_with(w, 'e') AND (regexp_matches({chop(1)}, '{m1}') OR (regexp_matches({chop(1)}, '{one}') AND NOT regexp_matches({chop(1)}, '{cvc}'))) THEN {chop(1)} ELSE w END",
        f"CASE WHEN ends_with(w, 'll') AND regexp_matches({chop(1)}, '{m1}') THEN {chop(1)} ELSE w END",
    ]
    known = " ".join(f"WHEN word = '{w}' THEN '{stem}'" for w, stem in porter.IRREGULAR.items())
    sql = f"WITH s0 AS MATERIALIZED (SELECT word, word AS w FROM ({words}))"
    for i, step in enumerate(steps):
        sql += f", s{i + 1} AS MATERIALIZED (SELECT word, {step} AS w FROM s{i})"
    return sql + f" SELECT word, CASE WHEN length(word) <= 2 THEN word {known} ELSE w END AS stem FROM s{len(steps)}"


VOCABULARY = f"SELECT DISTINCT term AS word FROM ({tokens_sql('documents')})"


@entry("t03_stem_vocabulary", _porter_sql(VOCABULARY))
def _(t):
    tokens = Q.index_tokens(docs(t), "doc_id", "text").select(F.col("term").alias("word"))
    return porter.stem_vocabulary(tokens)


@entry("t03_snowball_vocabulary")
def _(t):
    tokens = Q.index_tokens(docs(t), "doc_id", "text").select(F.col("term").alias("word"))
    return porter.stem_vocabulary(tokens, algorithm="snowball")


@entry("t01_analyzer_a_stemmed", f"""
    WITH tok AS ({CLEAN.format(text='lower(text)', table='documents')}), stems AS ({_porter_sql(
        "SELECT DISTINCT word FROM (" + CLEAN.format(text='lower(text)', table='documents') + ")")})
    SELECT doc_id, pos, stem AS word FROM tok JOIN stems USING (word)""")
def _(t):
    return W.word_tokens(docs(t).withColumn("text", F.lower("text")), "doc_id", "text", stem="porter")


@entry("t02_analyzer_b_stemmed", f"""
    WITH tok AS ({tokens_sql('documents')}), stems AS ({_porter_sql(VOCABULARY)})
    SELECT doc_id, pos, stem AS term FROM tok JOIN stems ON word = term""")
def _(t):
    return Q.index_tokens(docs(t), "doc_id", "text", stem="porter")


TURNS = '(SELECT conv_id * 100 + turn AS doc_id, text FROM conversations)'
NGRAMS = f"""
    WITH w AS ({CLEAN.format(text='text', table=TURNS)})
    SELECT DISTINCT doc_id, 'has(' || word || ')' AS feature FROM w
    UNION SELECT doc_id, 'has(' || a.word || ',' || b.word || ')' FROM w a JOIN w b USING (doc_id) WHERE b.pos = a.pos + 1
    UNION SELECT doc_id, 'has(' || a.word || ',' || b.word || ',' || c.word || ')' FROM w a JOIN w b USING (doc_id) JOIN w c USING (doc_id)
      WHERE b.pos = a.pos + 1 AND c.pos = a.pos + 2"""


def turns(t):
    """Every conversation turn as a document."""
    return t.spread("conversations", "conv_id").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("doc_id"), "text")


@entry("t04_ngram_features", NGRAMS)
def _(t):
    words = turns(t).select("doc_id", W.plain_tokens("text").alias("tokens"))
    return W.ngram_features(words, "doc_id", "tokens", 3).drop("value")


@entry("t05_negation_features", f"""
    SELECT doc_id, 'neg_l(' || word || ')' AS feature, round(arg_max(l, pos), 6) AS value FROM ({NEGATION_SQL}) GROUP BY doc_id, word
    UNION ALL SELECT doc_id, 'neg_r(' || word || ')', round(arg_max(r, pos), 6) FROM ({NEGATION_SQL}) GROUP BY doc_id, word""")
def _(t):
    features = W.negation_features(docs(t), "doc_id", NEGATIONS, W.plain_tokens(F.lower("text")))
    return features.withColumn("value", F.round("value", 6))


@entry("t06_feature_bags", f"""
    WITH f AS (SELECT doc_id, feature FROM ({NGRAMS})), n AS (SELECT doc_id, count(*) AS presence FROM f GROUP BY 1)
    SELECT doc_id, presence, presence + 2 * words AS features FROM n JOIN
      (SELECT doc_id, count(*) AS words FROM f WHERE NOT contains(feature, ',') GROUP BY 1) USING (doc_id)""")
def _(t):
    bags = W.feature_bags(W.extract_features(turns(t), "doc_id", "text", 3), "doc_id")
    names = F.map_keys("features")
    return bags.select("doc_id", F.size(F.filter(names, lambda n: n.startswith("has("))).cast("long").alias("presence"),
                       F.size(names).cast("long").alias("features"))


@entry("t07_tag_features", f"""
    WITH w AS ({CLEAN.format(text='lower(text)', table='documents')}),
    words AS (SELECT DISTINCT lang AS word, 'LANG' AS tag FROM documents UNION SELECT 'the', 'DT' UNION SELECT 'of', 'IN' UNION SELECT 'is', 'VBZ')
    SELECT DISTINCT doc_id, 'has(' || word || ')_' || tag AS feature FROM w JOIN words USING (word)""")
def _(t):
    fixed = t.spark.createDataFrame([("the", "DT"), ("of", "IN"), ("is", "VBZ")], "word string, tag string")
    tags = t.documents.select(F.col("lang").alias("word"), F.lit("LANG").alias("tag")).union(fixed).distinct()
    tokens = Q.positions_of(docs(t), ["doc_id"], W.plain_tokens(F.lower("text")), "word")
    return W.pos_features(tokens, "doc_id", tags).drop("value")


@entry("t08_text_classifier")
def _(t):
    labelled = t.spread("documents", "doc_id", t.labels.select("doc_id", "quality").where("quality is not null")).select("doc_id", "text", "quality")
    parts = split_ordered(labelled, ["doc_id"], 0.7)
    _, predict = fit_text_classifier(parts.where("is_train = 1"), "doc_id", "text", "quality", negations=NEGATIONS)
    return score(predict(parts.where("is_train = 0")), accuracy=accuracy_of("quality", "prediction"), reviews=F.count(F.lit(1)))


# A lexicon taken from the words themselves: length and vowel share make up the scores.
LEXICON_SQL = rf"""SELECT word, round((length(word) % 7 - 3) / 3.0::DOUBLE, 6) AS polarity, round((length(word) % 5) / 4.0::DOUBLE, 6) AS subjectivity
    FROM (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}_'']+')) AS word FROM benchmark) WHERE word <> ''"""


def lexicon(t):
    words = t.benchmark.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}_']+")).alias("word")).distinct()
    n = F.length("word")
    return words.where("word <> ''").select("word", F.round((n % 7 - 3) / 3.0, 6).alias("polarity"),
                                            F.round((n % 5) / 4.0, 6).alias("subjectivity"))


def _sentiment_sql(source, key, cols):
    joins, values = "", []
    for c in cols:
        joins += rf""" LEFT JOIN (SELECT {key}, avg(polarity) AS polarity_{c}, avg(subjectivity) AS subjectivity_{c} FROM
            (SELECT {key}, unnest(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}_'']+')) AS word FROM {source}) JOIN lexicon USING (word)
            GROUP BY 1) USING ({key})"""
        values += [f"coalesce(polarity_{c}, 0) AS polarity_{c}", f"coalesce(subjectivity_{c}, 0) AS subjectivity_{c}"]
    return f"SELECT {key}, {', '.join(values)} FROM {source}{joins}"


@entry("t09_sentiment", f"""
    WITH lexicon AS ({LEXICON_SQL}) SELECT doc_id, round(polarity_text, 6) + 0.0 AS polarity_text, round(subjectivity_text, 6) AS subjectivity_text
    FROM ({_sentiment_sql('documents', 'doc_id', ['text'])})""")
def _(t):
    s = W.sentiment(docs(t), "doc_id", ["text"], lexicon(t))
    return s.select("doc_id", *[(F.round(c, 6) + 0.0).alias(c) for c in s.columns[1:]])


REVIEWS = """SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS pros, arg_min(text, turn) FILTER (role = 'assistant') AS cons,
                    arg_min(text, turn) AS title FROM conversations GROUP BY conv_id"""
STARS = """CASE WHEN score <= 0 THEN 1 WHEN score <= 0.3 THEN 2 WHEN score <= 0.6 THEN 3 WHEN score <= 0.9 THEN 4 ELSE 5 END"""
SCORED_REVIEWS = f"""
    SELECT conv_id, score, {STARS} AS stars FROM (SELECT conv_id, round((polarity_title + polarity_pros + polarity_cons)
        * (1 - (subjectivity_title + subjectivity_pros + subjectivity_cons) / 3), 6) + 0.0 AS score
      FROM ({_sentiment_sql('reviews', 'conv_id', ['title', 'pros', 'cons'])}))"""


def reviews(t):
    """First user turn as pros, first assistant turn as cons, the first turn as title."""
    pick = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")),
                                 F.when(F.col("role") == role, F.col("turn")))
    return t.conversations.groupBy("conv_id").agg(
        pick("user").alias("pros"), pick("assistant").alias("cons"),
        F.min_by("text", "turn").alias("title"))


@entry("t10_review_scores", f"""
    WITH lexicon AS ({LEXICON_SQL}), reviews AS ({REVIEWS}) SELECT conv_id, score, CAST(stars AS VARCHAR) || ' Star' AS rank FROM ({SCORED_REVIEWS})""")
def _(t):
    return score_reviews(reviews(t), "conv_id", ["title", "pros", "cons"], lexicon(t)).select(
        "conv_id", (F.round("overall_score", 6) + 0.0).alias("score"), "rank")


@entry("t10_review_score_error", f"""
    WITH lexicon AS ({LEXICON_SQL}), reviews AS ({REVIEWS}), rated AS (SELECT doc_id AS conv_id, CAST(quality * 4 + 1 AS DOUBLE) AS rating FROM labels)
    SELECT round(avg(abs((rating - stars) / rating)) * 100, 6) AS mape, count(*) AS reviews FROM ({SCORED_REVIEWS}) JOIN rated USING (conv_id)""")
def _(t):
    scored = score_reviews(reviews(t), "conv_id", ["title", "pros", "cons"], lexicon(t))
    ratings = t.labels.select(F.col("doc_id").alias("conv_id"), (F.col("quality") * 4 + 1).alias("rating"))
    return score_error(scored, ratings, "conv_id", "rating").withColumn("mape", F.round("mape", 6))


@entry("t11_inverted_index", f"""
    SELECT term, doc_id, count(*) AS tf, round(1 + ln(count(*)), 8) AS weight FROM ({tokens_sql('documents')}) GROUP BY term, doc_id""")
def _(t):
    index = Q.build_index(Q.index_tokens(docs(t), "doc_id", "text"))
    return index.withColumn("weight", F.round("weight", 8))


@entry("t12_positional_index", f"SELECT term, doc_id, pos FROM ({tokens_sql('documents')})")
def _(t):
    return Q.build_positional_index(Q.index_tokens(docs(t), "doc_id", "text"))


def new_index(t):
    """The documents as a stored index in a new folder."""
    index = StoredIndex(t.spark, scratch_path(t.spark, "index"))
    index.append(docs(t))
    return index


INDEXES: dict[tuple, StoredIndex] = {}


def stored_index(t):
    """The stored index of a table: searches find the one that an earlier query wrote, as
    long as the table's files are the same ones."""
    files = t.documents.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    key = (t.spark.sparkContext.applicationId, *sorted(map(str, files.collect())))
    if key not in INDEXES:
        INDEXES[key] = new_index(t)
    return INDEXES[key]


@entry("t11_stored_index", f"""
    SELECT term, count(DISTINCT doc_id) AS df, count(*) AS occurrences FROM ({tokens_sql('documents')}) GROUP BY term""")
def _(t):
    return new_index(t).statistics()


QUERY = "les ndre est les thon"


@entry("t13_ranked_search", f"""
    WITH tok AS ({tokens_sql('documents')}), p AS (SELECT term, doc_id, 1 + ln(count(*)) AS weight FROM tok GROUP BY ALL),
    q AS (SELECT term, count(*) AS times FROM (SELECT unnest(string_split('{QUERY}', ' ')) AS term) WHERE term NOT IN {STOP_SQL} GROUP BY 1),
    d AS (SELECT term, count(*) AS df FROM p GROUP BY 1)
    SELECT doc_id, round(sum(times * (1 + ln(weight)) * log10((SELECT count(*) FROM documents) / df)), 6) AS score
    FROM p JOIN q USING (term) JOIN d USING (term) GROUP BY doc_id ORDER BY round(sum(times * (1 + ln(weight)) * log10((SELECT count(*) FROM documents) / df)), 9) DESC, doc_id LIMIT 10""")
def _(t):
    return stored_index(t).search(QUERY).withColumn("score", F.round("score", 6))


@entry("t14_phrase_search", f"""
    WITH tok AS ({tokens_sql('documents')})
    SELECT DISTINCT a.doc_id FROM tok a JOIN tok b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1
      JOIN tok c ON c.doc_id = a.doc_id AND c.pos = a.pos + 2 WHERE a.term = 'de' AND b.term = 'la' AND c.term = 'de'""")
def _(t):
    return stored_index(t).phrase("De la, DE")


@entry("t15_search_scope", f"""
    WITH reviews AS ({REVIEWS}) SELECT conv_id, 'PROS: ' || pros || ' CONS: ' || cons AS both_texts, pros, cons FROM reviews""")
def _(t):
    return reviews(t).select("conv_id", Q.search_scope("pros", "cons").alias("both_texts"),
                             Q.search_scope("pros", "cons", "pros").alias("pros"),
                             Q.search_scope("pros", "cons", "cons").alias("cons"))


@entry("t16_search_many", f"""
    WITH tok AS ({tokens_sql('documents')}), p AS (SELECT term, doc_id, 1 + ln(count(*)) AS weight FROM tok GROUP BY ALL),
    q AS (SELECT item_id, term, count(*) AS times FROM ({tokens_sql('benchmark', 'item_id')}) GROUP BY ALL),
    d AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
    s AS (SELECT item_id, doc_id, sum(times * (1 + ln(weight)) * log10((SELECT count(*) FROM documents) / df)) AS score
          FROM p JOIN q USING (term) JOIN d USING (term) GROUP BY ALL)
    SELECT item_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s) WHERE rank <= 10""")
def _(t):
    return stored_index(t).search_many(t.benchmark, "item_id").withColumn("score", F.round("score", 6))
