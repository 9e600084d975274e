"""Compare seasonal models on many series by recursive and rolling backtests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.evaluate import error_frame
from ..operators.sarima import Sarima, backtest_sarima
from ..operators.series import backtest_frames

# fixed values: the five specifications that are compared
MODELS = [
    Sarima("M1", (3, 1, 0), (1, 1, 0), 4, log=True),
    Sarima("M2", (0, 1, 3), (0, 1, 1), 4, log=True),
    Sarima("M3", (0, 0, 2), (0, 2, 1), 4, log=True),
    Sarima("M4", (0, 1, 0), (1, 1, 0), 4, log=False),
    Sarima("M5", (1, 1, 0), (2, 1, 0), 4, log=True),
]


def both_schemes(series: DataFrame, keys: list[str], n_test: int, horizons: int) -> DataFrame:
    sizes = series.groupBy(*keys).agg(F.max("t").alias("n"))
    return backtest_frames(sizes, n_test, horizons, "recursive").unionByName(
        backtest_frames(sizes, n_test, horizons, "rolling"))


def compare_models(series: DataFrame, keys: list[str], models: list[Sarima] = MODELS,
                   n_test: int = 25, horizons: int = 4) -> DataFrame:
    """MAPE and MSFE of every model and scheme, one row per horizon."""
    results = backtest_sarima(series, both_schemes(series, keys, n_test, horizons), keys, models)
    cells = [(m.name, s) for m in models for s in ("recursive", "rolling")]
    return error_frame(results, "horizon", "model", "scheme", "actual", "pred", cells)
