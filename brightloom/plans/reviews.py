"""From reviews to scores, rankings and classifier."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions.values import bin_score, overall_score
from ..operators.evaluate import mape_of
from ..operators.maxent import MaxentModel, fit_maxent
from ..operators.words import extract_features, sentiment


def score_reviews(reviews: DataFrame, key: str, texts: list[str], lexicon: DataFrame) -> DataFrame:
    """Sentiment of every text field, the overall score, its 1..5 bin and label."""
    parts = sentiment(reviews, key, texts, lexicon)
    scored = parts.withColumn("overall_score", overall_score(
        [f"polarity_{c}" for c in texts], [f"subjectivity_{c}" for c in texts]))
    return (scored.withColumn("stars", bin_score("overall_score"))
            .withColumn("rank", F.concat(F.col("stars").cast("string"), F.lit(" Star"))))


def score_error(scored: DataFrame, ratings: DataFrame, key: str, rating: str,
                by: list[str] = ()) -> DataFrame:
    """MAPE of the score bins against the rounded ratings; unrated reviews drop out."""
    rated = ratings.where(F.col(rating).isNotNull()).select(
        key, *by, F.bround(F.col(rating).cast("double"), 0).alias("_rating"))
    return scored.join(rated, key).groupBy(*by).agg(
        mape_of("_rating", "stars").alias("mape"), F.count(F.lit(1)).alias("reviews"))


def fit_text_classifier(texts: DataFrame, doc: str, text: str, label: str, n: int = 3, rounds: int = 25,
                        **options) -> tuple[MaxentModel, Callable[[DataFrame], DataFrame]]:
    """Maximum-entropy classifier on all feature families of a text: n-grams, negation
    values and, with a table of tags, parts of speech. Returns the model and a function
    that adds (prediction, probability) to a table of texts."""
    bag = lambda df: extract_features(df, doc, text, n, **options)
    model = fit_maxent(bag(texts), texts.select(doc, label), doc, label, rounds)
    return model, lambda df: df.join(model.predict(bag(df)), doc, "left")
