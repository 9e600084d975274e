"""The operators as queries over the test tables, with SQL twins for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .license_scan import licenses_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(read) -> DataFrame``; ``read(table)`` gives a whole table."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(lambda table: spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


#: Words of a text, for the SQL twins; null and wordless texts give an empty list.
WORDS_SQL = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
ASCII_LOWER_SQL = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op9_minhash_near_dedup", f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS_SQL.format(text="coalesce(" + ASCII_LOWER_SQL.format(text="text") + ", '')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept
FROM (SELECT node AS doc_id, min(root) AS c FROM r GROUP BY node) LEFT JOIN n USING (doc_id)
""")
def _(read):
    from .near_dedup import near_duplicates

    return near_duplicates(read("documents"))


@query("op3_substring_dedup", f"""
WITH d AS (SELECT doc_id, {WORDS_SQL.format(text="coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, unnest(generate_series(1, len(w) - 34)) AS i, w FROM d WHERE len(w) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM p),
r AS (SELECT doc_id, i FROM h JOIN (SELECT h FROM h GROUP BY h HAVING count(*) > 1) USING (h)),
c AS (SELECT DISTINCT doc_id, i + unnest(generate_series(0, 34)) AS i FROM r),
t AS (SELECT doc_id, w[i] AS word, i FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM d)),
k AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS kept, count(*) AS n FROM t ANTI JOIN c ON c.doc_id = t.doc_id AND c.i = t.i GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
""")
def _(read):
    from .substring_dedup import text_keys, without_repeats

    docs = read("documents")
    done = without_repeats(docs).select("k1", "k2", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return (text_keys(docs.select("doc_id", "text")).select("doc_id", "k1", "k2").join(done, ["k1", "k2"])
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


@query("op1_best_fit_packing")
def _(read):
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(read("documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op5_toxicity")
def _(read):
    from .common import fold_of
    from .toxicity import fit_toxicity, score_toxicity

    docs = read("documents")
    scored = score_toxicity(docs, fit_toxicity(docs, read("labels")))
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


#: Production settings of the mixture.
MIX_ENTROPY, MIX_PASSES = 0.995, 2.0


@query("op6_temperature_mixing", f"""
WITH d AS (SELECT doc_id, source, coalesce(len({WORDS_SQL.format(text="text")}), 0)::BIGINT AS tokens FROM documents),
t AS (SELECT source, sum(tokens)::BIGINT AS source_tokens, count(*) AS n FROM d GROUP BY source),
w AS (SELECT sum(source_tokens)::DOUBLE AS all_of, max(source_tokens)::DOUBLE AS most, count(*) AS k FROM t WHERE source_tokens > 0),
f AS (SELECT s / 10000.0 AS a, any_value(k) AS k, sum(pow(source_tokens / all_of, s / 10000.0)) AS z,
        sum(pow(source_tokens / all_of, s / 10000.0) * ln(pow(source_tokens / all_of, s / 10000.0))) AS e, max(pow(most / source_tokens, 1 - s / 10000.0)) AS passes
      FROM t, w, generate_series(0, 10000) g(s) WHERE source_tokens > 0 GROUP BY s),
x AS (SELECT greatest(coalesce(max(a) FILTER ((ln(z) - e / z) / ln(k) >= {MIX_ENTROPY}), 0), coalesce(min(a) FILTER (passes <= {MIX_PASSES}), 1)) AS a FROM f),
p AS (SELECT source, source_tokens, ceil(n / 4096.0)::BIGINT AS blocks, round(CASE WHEN source_tokens > 0 THEN pow(most / source_tokens, 1 - a) ELSE 1 END, 9) AS passes FROM t, w, x),
b AS (SELECT d.*, ('0x' || substr(md5('mix|block|' || doc_id), 1, 13))::BIGINT % blocks AS block, source_tokens, passes FROM d JOIN p USING (source)),
v AS (SELECT source, block, pass_no, block_tokens, source_tokens, passes, sum(block_tokens) OVER (PARTITION BY source, pass_no
        ORDER BY substr(md5('mix|' || source || '|' || pass_no || '|' || block), 1, 13), block) - block_tokens AS bef
      FROM (SELECT *, unnest(generate_series(0, greatest(ceil(passes) - 1, 0)::BIGINT)) AS pass_no
            FROM (SELECT source, block, sum(tokens) AS block_tokens, any_value(source_tokens) AS source_tokens, any_value(passes) AS passes FROM b GROUP BY 1, 2))),
r AS (SELECT source, block, pass_no, block_tokens, floor(least(1.0, passes - pass_no) * source_tokens) - bef AS room FROM v),
o AS (SELECT b.doc_id, b.source, pass_no, block, b.tokens, block_tokens, room, sum(b.tokens) OVER (PARTITION BY source, block, pass_no
        ORDER BY substr(md5('mix|' || pass_no || '|' || doc_id), 1, 13), b.tokens ROWS UNBOUNDED PRECEDING) AS upto
      FROM b JOIN r USING (source, block) WHERE room > 0 OR (room = 0 AND block_tokens = 0))
SELECT doc_id, source, pass_no::INTEGER AS pass_no, block::INTEGER AS block, tokens AS mix_tokens FROM o WHERE room >= block_tokens OR upto <= room
""")
def _(read):
    from .mixing import count_words, mix

    docs = read("documents").select("doc_id", "source", count_words(F.col("text")).alias("tokens"))
    mixed = mix(docs, tokens=F.col("tokens"), target_entropy=MIX_ENTROPY, max_passes=MIX_PASSES)
    return mixed.select("doc_id", "source", "pass_no", "block", "mix_tokens")


@query("op10_quality_rules")
def _(read):
    from .quality_rules import fit_field, judge_quality

    docs = read("documents")
    return judge_quality(docs, fit_field(docs, read("labels")))


@query("op7_exact_top_k", """
WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def _(read):
    from .exact_search import top_k

    return top_k(read("embeddings"))


@query("op8_context_tree_scoring")
def _(read):
    from .language_model import fit_language_model, score_texts

    docs = read("documents")
    return score_texts(docs, fit_language_model(docs))


@query("op4_license_scan", licenses_sql())
def _(read):
    from .license_scan import scan_licenses

    found = scan_licenses(read("documents"))
    return found.select("doc_id", "whole_license", "n_notices", F.array_join("licenses", ",").alias("licenses"))


@query("op2_quality_classifier")
def _(read):
    from .quality_classifier import classify_quality

    return classify_quality(read("documents"), read("labels"), site_cols=("source", "lang"))


@query("op11_embedding_whitening")
def _(read):
    from .whitening import whiten

    return whiten(read("embeddings"))


@query("op12_warc_capture_index", """
WITH p AS (SELECT page_id, coalesce(html, '') AS b FROM pages),
d AS (SELECT page_id, octet_length(encode(b))::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id < page_id THEN first_id END AS refers_to FROM f
""")
def _(read):
    from .warc import archive_pages

    return archive_pages(read("pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


TERMS_SQL = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op13_ranked_search", f"""
WITH d AS (SELECT doc_id, {TERMS_SQL.format(text=ASCII_LOWER_SQL.format(text="text"))} AS t FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, t, len(t) AS n FROM d WHERE len(t) > 0),
g AS (SELECT count(*)::BIGINT AS n_all, sum(n)::BIGINT AS l_all FROM h),
f AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM h) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_all) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, g GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest({TERMS_SQL.format(text=ASCII_LOWER_SQL.format(text="text"))}) AS term FROM benchmark),
m AS (SELECT doc_id, 50 + ((50 * n * n_all) // l_all) AS m FROM h, g),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN f USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
""")
def _(read):
    from .ranked_search import ranked_search

    return ranked_search(read("documents"), read("benchmark"))
