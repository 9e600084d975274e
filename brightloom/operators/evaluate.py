"""Measures over tables of actual and predicted values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c).cast("double") if isinstance(c, str) else c


def mape_of(actual: Column | str, pred: Column | str) -> Column:
    """Mean absolute percentage error; rows with a zero actual are left out."""
    a, p = _col(actual), _col(pred)
    return F.avg(F.when(a != 0, F.abs((a - p) / a))) * 100


def msfe_of(actual: Column | str, pred: Column | str) -> Column:
    """Mean squared (forecast) error."""
    return F.avg(F.pow(_col(actual) - _col(pred), F.lit(2.0)))


def r2_of(actual: Column | str, pred: Column | str) -> Column:
    """1 - residual over total sum of squares. The total is n times the population
    variance, so one pass is enough. A constant target gives null."""
    a, p = _col(actual), _col(pred)
    both = a.isNotNull() & p.isNotNull()
    rest = F.sum(F.when(both, F.pow(a - p, F.lit(2.0))))
    return 1 - F.try_divide(rest, F.count_if(both) * F.var_pop(F.when(both, a)))


def accuracy_of(label: Column | str, pred: Column | str, threshold: float | None = None) -> Column:
    """Share of equal labels; with a threshold the prediction is a probability."""
    p = _col(pred)
    guess = p if threshold is None else F.when(p > threshold, 1.0).otherwise(0.0)
    return F.avg((_col(label) == guess).cast("double"))


def log_loss_of(label: Column | str, score: Column | str, from_logits: bool = False,
                clip: float = 1e-7) -> Column:
    """Binary cross-entropy of probabilities clipped to [clip, 1 - clip], or of
    logits in the form that cannot overflow."""
    y, s = _col(label), _col(score)
    if from_logits:
        loss = F.greatest(s, F.lit(0.0)) - s * y + F.log1p(F.exp(-F.abs(s)))
    else:
        p = F.least(F.greatest(s, F.lit(clip)), F.lit(1 - clip))
        loss = -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    return F.avg(loss)


def generator_loss_of(fake: Column | str, from_logits: bool = False) -> Column:
    """Cross-entropy of generated scores against 1."""
    return log_loss_of(F.lit(1.0), fake, from_logits)


def discriminator_loss_of(real: Column | str, fake: Column | str, from_logits: bool = False) -> Column:
    """Cross-entropy of real scores against 1 plus generated scores against 0."""
    return log_loss_of(F.lit(1.0), real, from_logits) + log_loss_of(F.lit(0.0), fake, from_logits)


def score(df: DataFrame, by: list[str] = (), **measures: Column) -> DataFrame:
    """Any of the measures above, overall or per slice."""
    return df.groupBy(*by).agg(*[m.alias(name) for name, m in measures.items()])


def residuals(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """Observed value and residual."""
    return df.withColumn("residual", _col(actual) - _col(pred))


def residual_range(df: DataFrame, actual: str, pred: str, by: list[str] = ()) -> DataFrame:
    gap = _col(actual) - _col(pred)
    return df.groupBy(*by).agg(F.min(gap).alias("lowest"), F.max(gap).alias("highest"))


def prediction_error(df: DataFrame, actual: str, pred: str, by: list[str] = ()) -> DataFrame:
    """Best-fit line of predicted on actual, with R² of the predictions."""
    a, p = _col(actual), _col(pred)
    return df.groupBy(*by).agg(F.regr_slope(p, a).alias("slope"), F.regr_intercept(p, a).alias("intercept"),
                               r2_of(actual, pred).alias("r2"))


def leaderboard(frames: list[DataFrame] | DataFrame, metric: str, key: str,
                top: int | None = None) -> DataFrame:
    """Metric rows of several models, best first; `top` keeps the first few."""
    rows = frames if isinstance(frames, DataFrame) else reduce(DataFrame.unionByName, frames)
    ranked = rows.orderBy(F.desc(metric), F.asc(key))
    return ranked if top is None else ranked.limit(top)


def error_frame(df: DataFrame, row: str, model: str, scheme: str, actual: str, pred: str,
                cells: list[tuple[str, str]]) -> DataFrame:
    """One row per horizon, columns MAPE_/MSFE_<scheme>_<model> for the given
    (model, scheme) pairs."""
    columns = []
    for m, s in cells:
        here = (F.col(model) == m) & (F.col(scheme) == s)
        a, p = F.when(here, _col(actual)), F.when(here, _col(pred))
        columns += [mape_of(a, p).alias(f"MAPE_{s}_{m}"), msfe_of(a, p).alias(f"MSFE_{s}_{m}")]
    return df.groupBy(row).agg(*columns)
