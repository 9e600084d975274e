"""Document quality by hierarchical empirical Bayes over hosts and paths."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from brightloom.runtime import durable

from .common import fold_of, only

#: Evidence of features that go together is counted in part.
TEMPER = 0.6
#: Rows that a prior can weigh as much as.
STRENGTH = (1.0, 10_000.0)


def _features(text: Column) -> dict[str, Column]:
    """Bins of what a text looks like; each is a small whole number."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    chars = F.greatest(F.length(text), F.lit(1))
    share = lambda kind: (chars - F.length(F.regexp_replace(text, kind, ""))) / chars
    per_word = lambda kind: F.regexp_count(text, F.lit(kind)) / F.greatest(n, F.lit(1))
    step = lambda x, *at: sum((F.when(x >= a, 1).otherwise(0) for a in at), F.lit(0))
    return {
        "length": step(n, 1, 5, 20, 50, 100, 300, 1000, 5000),
        "symbols": step(per_word(r"[#*$%&|<>]"), 0.01, 0.05, 0.2, 0.5),
        "capitals": step(share(r"\p{Lu}"), 0.01, 0.03, 0.08, 0.2, 0.5),
        "distinct": step(F.size(F.array_distinct(words)) / F.greatest(n, F.lit(1)), 0.05, 0.15, 0.3, 0.5, 0.7, 0.9),
        "marks": step(per_word(r"[!?]{2}"), 0.01, 0.1, 0.5),
        "sentences": step(per_word(r"[.!?](?:\s|$)"), 0.005, 0.02, 0.05, 0.1, 0.3),
        "word_length": step((chars - n) / F.greatest(n, F.lit(1)), 2, 3.5, 5, 6.5, 8, 12),
    }


def classify_quality(docs: DataFrame, labels: DataFrame, site_cols: tuple[str, ...], id_col: str = "doc_id",
                     text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Per row: doc_id, held_out, evidence, host_posterior, path_posterior, score, kept.

    `site_cols` name the levels of a site from the top: its host, then the parts of the
    path. `evidence` is the log odds of good against poor that the text's features give,
    learnt from labelled rows whose id's crc32 modulo 5 is not 0. With the share of good
    rows this makes a first estimate per row; the label takes its place where it may be
    used. Each level's posterior is the mean of its rows' estimates, shrunk towards the
    level above as far as the spread between sites of that level tells (moments of a beta
    distribution), the top level towards the share of all rows. `score` joins the
    evidence with the row's path, from which the row itself is taken out; kept is a score
    of 0.5 or more.

    Sites are aggregated before they are joined back, so a host with a third of all rows
    is one row of a small table. Null sites are a site; null texts are empty; null ids have
    no label and are not held out; rows that repeat an id share its label, the best if
    labels differ; other columns are ignored. Without labels the evidence is 0 and every
    score the prior of 0.5. No rows give no rows."""
    levels = [f"site{i}" for i in range(len(site_cols))]
    text = F.coalesce(F.col("text"), F.lit(""))
    features = _features(text)
    sites = [F.coalesce(docs[c].cast("string"), F.lit("\0")).alias(name) for c, name in zip(site_cols, levels, strict=True)]
    plain = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), *sites)
    rows = durable(plain.select("doc_id", *levels, *[b.cast("int").alias(f"f_{f}") for f, b in features.items()]))
    marks = only(labels, **{id_col: "doc_id", label_col: "label"}).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold_of(F.col("doc_id")) != 0)).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("label") > 0).cast("int")).alias("label"))
    marked = durable(rows.join(marks, "doc_id", "left"))

    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"f_{f}").alias("bin")) for f in features]))
    counts = marked.where("label is not null").select("label", pairs.alias("x")).groupBy("x.f", "x.bin").agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("poor")).collect()
    good = sum(r["good"] for r in counts) / len(features)
    poor = sum(r["poor"] for r in counts) / len(features)
    prior = math.log((good + 1) / (poor + 1))
    evidence = F.lit(0.0)
    for f in features:
        known = [r for r in counts if r["f"] == f]
        weight = F.lit(0.0)
        for r in known:
            odds = math.log((r["good"] + 0.5) / (good + 0.5 * len(known))) - math.log((r["poor"] + 0.5) / (poor + 0.5 * len(known)))
            weight = F.when(F.col(f"f_{f}") == r["bin"], odds).otherwise(weight)
        evidence = evidence + TEMPER * weight
    logistic = lambda z: 1 / (1 + F.exp(-z))
    first = F.coalesce(F.col("label").cast("double"), logistic(F.col("evidence") + prior))
    judged = marked.withColumn("evidence", evidence).select("doc_id", *levels, "evidence", first.alias("first"))

    paths = durable(judged.groupBy(*levels).agg(F.sum("first").alias("s"), F.count("*").alias("n")))
    total = paths.agg(F.sum("s"), F.sum("n")).first()
    mean = total[0] / total[1] if total[1] else 0.5
    above, table = None, None
    strengths = []
    for depth in range(1, len(levels) + 1):
        here = paths.groupBy(*levels[:depth]).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        here = here.withColumn("up", F.lit(mean)) if above is None else here.join(
            above.select(*levels[:depth - 1], F.col(f"post{depth - 2}").alias("up"), *[f"post{i}" for i in range(depth - 1)]), levels[:depth - 1])
        strength = _strength(here)
        strengths.append(strength)
        above = durable(here.withColumn(f"post{depth - 1}", (F.col("s") + strength * F.col("up")) / (F.col("n") + strength)))
    table = above.select(*levels, F.col("s").alias("path_s"), F.col("n").alias("path_n"), F.col("up").alias("path_up"), "post0",
                         F.col(f"post{len(levels) - 1}").alias("path_posterior"))
    without = (F.col("path_s") - F.col("first") + strengths[-1] * F.col("path_up")) / (F.col("path_n") - 1 + strengths[-1])
    safe = F.least(F.greatest(without, F.lit(1e-6)), F.lit(1 - 1e-6))
    score = logistic(F.col("evidence") + F.log(safe / (1 - safe)))
    return judged.join(table, levels).select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "evidence",
        F.col("post0").alias("host_posterior"), "path_posterior", score.alias("score"), (score >= 0.5).alias("kept"))


def _strength(sites: DataFrame) -> float:
    """Rows that the level above weighs as much as, from the spread of the sites' means around it."""
    share = F.col("s") / F.col("n")
    up = F.col("up")
    spread, noise, n = sites.agg(
        F.avg((share - up) ** 2), F.avg(up * (1 - up) / F.col("n")), F.avg(up * (1 - up))).first()
    if spread is None:
        return STRENGTH[0]
    between = spread - noise
    return min(max(n / between - 1, STRENGTH[0]), STRENGTH[1]) if between > 0 else STRENGTH[1]
