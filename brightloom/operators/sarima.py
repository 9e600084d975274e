"""Seasonal ARIMA over many series: Spark fans the fits out, numpy solves one.

A fit works on one row: a series (an array as long as its calendar) and the part
of it to train on. Rows are spread over the cluster by series, model and range, so
a thousand fits of one series run as parallel as one fit of a thousand series.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .series import lag_polynomial

EXACT_LIMIT = 400  # longer series keep the conditional fit, the two agree there


@dataclass(frozen=True)
class Sarima:
    """(p, d, q)(P, D, Q)s, on the logarithm of the series if `log`."""

    name: str
    order: tuple[int, int, int]
    seasonal: tuple[int, int, int]
    period: int = 4
    log: bool = False

    @property
    def sizes(self) -> tuple[int, int, int, int]:
        return self.order[0], self.seasonal[0], self.order[2], self.seasonal[2]


def _stationary(raw: np.ndarray) -> np.ndarray:
    """Unbounded numbers to AR coefficients, by way of partial autocorrelations."""
    phi = np.zeros(0)
    for r in np.tanh(raw):
        phi = np.append(phi - r * phi[::-1], r)
    return phi


def _polynomials(spec: Sarima, params: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expanded AR (1 - …) and MA (1 + …) polynomials."""
    p, big_p, q, big_q = spec.sizes
    cuts = np.cumsum([p, big_p, q])
    ar, sar, ma, sma = np.split(params, cuts)

    def seasonal(coefs: np.ndarray) -> np.ndarray:
        poly = np.zeros(len(coefs) * spec.period + 1)
        poly[0] = 1.0
        poly[spec.period::spec.period] = coefs
        return poly

    return (np.convolve(np.append(1.0, -ar), seasonal(-sar)),
            np.convolve(np.append(1.0, ma), seasonal(sma)))


def _filter(w: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> np.ndarray:
    """Residuals with zeros before the start; the first AR-order ones are zero."""
    x = np.convolve(w, ar)[: len(w)]
    x[: len(ar) - 1] = 0.0
    if len(ma) == 1:
        return x
    e = np.zeros(len(w) + len(ma) - 1)
    back = ma[:0:-1]
    for t in range(len(w)):
        e[t + len(ma) - 1] = x[t] - back @ e[t:t + len(ma) - 1]
    return e[len(ma) - 1:]


def _autocovariance(ar: np.ndarray, ma: np.ndarray, n: int) -> np.ndarray:
    """Autocovariances 0..n-1 at unit innovation variance, from the usual linear
    equations in the first of them and the AR recursion after that."""
    p, q = len(ar) - 1, len(ma) - 1
    m = max(p, q)
    psi = np.zeros(q + 1)
    for j in range(q + 1):
        psi[j] = ma[j] - sum(ar[i] * psi[j - i] for i in range(1, min(j, p) + 1))
    right = np.zeros(m + 1)
    for k in range(q + 1):
        right[k] = ma[k:] @ psi[: q + 1 - k]
    left = np.zeros((m + 1, m + 1))
    for k in range(m + 1):
        for i in range(p + 1):
            left[k, abs(k - i)] += ar[i]
    gamma = np.zeros(max(n, m + 1))
    gamma[: m + 1] = np.linalg.solve(left, right)
    for k in range(m + 1, n):
        gamma[k] = -(ar[1:] @ gamma[k - 1:k - p - 1:-1]) if p else 0.0
    return gamma[:n]


def _cholesky(gamma: np.ndarray) -> np.ndarray:
    n = len(gamma)
    return np.linalg.cholesky(gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))])


def _minimise(fn, start: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Quasi-Newton descent with numerical gradients and step halving."""
    def gradient(x: np.ndarray) -> np.ndarray:
        steps = 1e-5 * np.eye(len(x))
        return np.array([(fn(x + h) - fn(x - h)) / 2e-5 for h in steps])

    x, value, inverse = start, fn(start), np.eye(len(start))
    grad = gradient(x)
    for _ in range(rounds):
        step = -inverse @ grad
        if step @ grad >= 0:
            inverse, step = np.eye(len(x)), -grad
        size = 1.0
        while size > 1e-8 and not fn(x + size * step) < value + 1e-4 * size * (step @ grad):
            size /= 2
        if size <= 1e-8:
            break
        s = size * step
        new_grad = gradient(x + s)
        y = new_grad - grad
        x, gain, grad = x + s, value - fn(x + s), new_grad
        value -= gain
        if s @ y > 1e-12:
            rho = 1.0 / (s @ y)
            left = np.eye(len(x)) - rho * np.outer(s, y)
            inverse = left @ inverse @ left.T + rho * np.outer(s, s)
        if gain < 1e-10 or np.max(np.abs(grad)) < 1e-6:
            break
    return x


@dataclass
class Fitted:
    spec: Sarima
    params: np.ndarray
    sigma2: float
    loglik: float
    y: np.ndarray
    w: np.ndarray
    mean: float


def fit_one(y: np.ndarray, spec: Sarima, exact: bool = True) -> Fitted:
    """Conditional sum of squares, then exact Gaussian likelihood from there."""
    y = np.log(y) if spec.log else np.asarray(y, float)
    poly = lag_polynomial(spec.order[1], spec.seasonal[1], spec.period)
    reach = max(poly)
    w = sum(c * y[reach - lag:len(y) - lag] for lag, c in poly.items())
    mean = float(w.mean()) if reach == 0 else 0.0
    w = w - mean
    p, big_p, q, big_q = spec.sizes
    if len(w) <= p + big_p * spec.period + q + big_q:
        raise ValueError(f"{len(y)} values are too few for {spec.name}")

    def expand(raw: np.ndarray) -> np.ndarray:
        return np.concatenate([_stationary(raw[:p]), _stationary(raw[p:p + big_p]), raw[p + big_p:]])

    def conditional(raw: np.ndarray) -> float:
        ar, ma = _polynomials(spec, expand(raw))
        e = _filter(w, ar, ma)
        n = max(len(w) - len(ar) + 1, 1)
        total = float(e @ e) / n
        return 0.5 * math.log(total) if 0 < total < math.inf else 1e10

    def likelihood(raw: np.ndarray) -> float:
        try:
            ar, ma = _polynomials(spec, expand(raw))
            low = _cholesky(_autocovariance(ar, ma, len(w)))
        except np.linalg.LinAlgError:
            return 1e10
        e = np.linalg.solve(low, w)
        total = 0.5 * math.log(e @ e / len(w)) + np.log(np.diag(low)).mean()
        return total if math.isfinite(total) else 1e10

    with np.errstate(all="ignore"):
        use_exact = exact and len(w) <= EXACT_LIMIT
        raw = _minimise(conditional, np.zeros(p + big_p + q + big_q), 15 if use_exact else 60)
        if use_exact and likelihood(raw) >= 1e10:
            raw = np.zeros_like(raw)
        if use_exact:
            raw = _minimise(likelihood, raw)
            objective = likelihood(raw)
            ar, ma = _polynomials(spec, expand(raw))
            e = np.linalg.solve(_cholesky(_autocovariance(ar, ma, len(w))), w)
            sigma2 = float(e @ e) / len(w)
        else:
            objective = conditional(raw)
            sigma2 = math.exp(2 * objective)
    loglik = -len(w) * (objective + 0.5 + 0.5 * math.log(2 * math.pi))
    return Fitted(spec, expand(raw), sigma2, loglik, y, w, mean)


def residuals_one(model: Fitted) -> np.ndarray:
    """One-step prediction errors of the differenced series."""
    ar, ma = _polynomials(model.spec, model.params)
    if len(model.w) <= EXACT_LIMIT:
        return np.linalg.solve(_cholesky(_autocovariance(ar, ma, len(model.w))), model.w)
    return _filter(model.w, ar, ma)


def forecast_one(model: Fitted, steps: int) -> np.ndarray:
    """Point forecasts 1..steps on the original scale."""
    spec, w = model.spec, model.w
    ar, ma = _polynomials(spec, model.params)
    n = len(w)
    if n <= EXACT_LIMIT:
        gamma = _autocovariance(ar, ma, n + steps)
        low = _cholesky(gamma[:n])
        weights = np.linalg.solve(low.T, np.linalg.solve(low, w))
        ahead = np.array([gamma[h:h + n][::-1] @ weights for h in range(1, steps + 1)])
    else:
        e, full = list(_filter(w, ar, ma)), list(w)
        for _ in range(steps):
            full.append(-sum(ar[i] * full[-i] for i in range(1, len(ar)))
                        + sum(ma[i] * e[-i] for i in range(1, len(ma))))
            e.append(0.0)
        ahead = np.array(full[n:])
    poly = lag_polynomial(spec.order[1], spec.seasonal[1], spec.period)
    level = list(model.y)
    for value in ahead + model.mean:
        level.append(value - sum(c * level[-lag] for lag, c in poly.items() if lag))
    out = np.array(level[len(model.y):])
    return np.exp(out) if spec.log else out


def series_arrays(series: DataFrame, keys: list[str]) -> DataFrame:
    """One row per series: its values in order of t."""
    return (series.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct("t", "y"))).alias("_points"))
            .select(*keys, F.transform("_points", lambda p: p["y"]).alias("values")))


def _fan_out(df: DataFrame, models: list[Sarima], spread: list[str]) -> DataFrame:
    names = F.array(*[F.lit(m.name) for m in models])
    tasks = df.withColumn("model", F.explode(names))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return tasks.repartition(4 * cores, "model", *spread)


def fit_sarima(series: DataFrame, keys: list[str], models: list[Sarima],
               horizon: int = 4, exact: bool = True) -> DataFrame:
    """Every model on every series: parameters in the order AR, seasonal AR, MA,
    seasonal MA, innovation variance, log-likelihood, AIC and forecasts. A series a
    model cannot be fitted to gives a row with the reason in `problem`."""
    table = {m.name: m for m in models}
    arrays = series_arrays(series, keys)
    schema = T.StructType([arrays.schema[k] for k in keys] + T._parse_datatype_string(
        "model string, params array<double>, sigma2 double, loglik double, aic double, "
        "forecast array<double>, problem string").fields)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                spec = table[row.model]
                head = [getattr(row, k) for k in keys]
                try:
                    model = fit_one(np.asarray(row.values, float), spec, exact)
                    aic = -2 * model.loglik + 2 * (len(model.params) + 1)
                    rows.append([*head, row.model, model.params.tolist(), model.sigma2, model.loglik, aic,
                                 forecast_one(model, horizon).tolist(), None])
                except (ValueError, np.linalg.LinAlgError) as error:
                    rows.append([*head, row.model, None, None, None, None, None, str(error)])
            yield pd.DataFrame(rows, columns=schema.names)

    return _fan_out(arrays, models, keys).mapInPandas(solve, schema)


def sarima_residuals(series: DataFrame, keys: list[str], models: list[Sarima]) -> DataFrame:
    """(keys…, model, t, y) with the one-step errors as y, ready for the diagnostics."""
    table = {m.name: m for m in models}
    arrays = series_arrays(series, keys)
    schema = T.StructType([arrays.schema[k] for k in keys] + T._parse_datatype_string(
        "model string, t int, y double").fields)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                try:
                    errors = residuals_one(fit_one(np.asarray(row.values, float), table[row.model]))
                except (ValueError, np.linalg.LinAlgError):
                    continue
                yield pd.DataFrame({**{k: getattr(row, k) for k in keys}, "model": row.model,
                                    "t": np.arange(1, len(errors) + 1, dtype="int32"), "y": errors})

    return _fan_out(arrays, models, keys).mapInPandas(solve, schema)


def backtest_sarima(series: DataFrame, frames: DataFrame, keys: list[str], models: list[Sarima],
                    exact: bool = True) -> DataFrame:
    """Forecast the target of every frame with every model. Frames that train on the
    same rows share one fit. Returns (keys…, model, frame, actual, pred); pred is
    null where the fit failed."""
    table = {m.name: m for m in models}
    fits = (frames.groupBy(*keys, "scheme", "lo", "hi")
            .agg(F.collect_list(F.struct("origin", "horizon", "target")).alias("goals")))
    arrays = fits.join(series_arrays(series, keys), keys)
    schema = T.StructType([arrays.schema[k] for k in keys] + T._parse_datatype_string(
        "model string, scheme string, origin int, horizon int, lo int, hi int, target int, "
        "actual double, pred double").fields)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                values = np.asarray(row.values, float)
                goals = [dict(g) if isinstance(g, dict) else g.asDict() for g in row.goals]
                steps = max(g["horizon"] for g in goals)
                try:
                    ahead = forecast_one(fit_one(values[row.lo - 1:row.hi], table[row.model], exact), steps)
                except (ValueError, np.linalg.LinAlgError):
                    ahead = np.full(steps, np.nan)
                for g in goals:
                    pred = ahead[g["horizon"] - 1]
                    rows.append([*[getattr(row, k) for k in keys], row.model, row.scheme, g["origin"],
                                 g["horizon"], row.lo, row.hi, g["target"], values[g["target"] - 1],
                                 float(pred) if np.isfinite(pred) else None])
            yield pd.DataFrame(rows, columns=schema.names)

    return _fan_out(arrays, models, [*keys, "scheme", "lo", "hi"]).mapInPandas(solve, schema)


def shapiro_wilk(df: DataFrame, keys: list[str], y: str = "y") -> DataFrame:
    """Shapiro-Wilk W and p per series by Royston's (1995) approximation, for 3 to
    5000 values; longer series belong to `jarque_bera`. One series is one group."""
    schema = T.StructType([df.schema[k] for k in keys] + T._parse_datatype_string(
        "n int, statistic double, p_value double").fields)

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        w, p = shapiro_one(pdf[y].dropna().to_numpy(float))
        return pd.DataFrame([[*[pdf[k].iloc[0] for k in keys], int(pdf[y].notna().sum()), w, p]],
                            columns=schema.names)

    return df.groupBy(*keys).applyInPandas(test, schema)


def shapiro_one(x: np.ndarray) -> tuple[float | None, float | None]:
    from statistics import NormalDist
    normal = NormalDist()
    n = len(x)
    x = np.sort(x)
    if n < 3 or n > 5000 or x[-1] == x[0]:
        return None, None
    if n == 3:
        a = np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    else:
        m = np.array([normal.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
        square, u = float(m @ m), 1 / math.sqrt(n)
        a = np.zeros(n)
        # fixed values: Royston's polynomials for the two outermost weights
        last = np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, m[-1] / math.sqrt(square)], u)
        second = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, m[-2] / math.sqrt(square)], u)
        if n > 5:
            rest = (square - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last ** 2 - 2 * second ** 2)
            a[2:-2] = m[2:-2] / math.sqrt(rest)
            a[-2], a[1] = second, -second
        else:
            rest = (square - 2 * m[-1] ** 2) / (1 - 2 * last ** 2)
            a[1:-1] = m[1:-1] / math.sqrt(rest)
        a[-1], a[0] = last, -last
    w = min(float(a @ x) ** 2 / float(((x - x.mean()) ** 2).sum()), 1.0)
    if n == 3:
        return w, max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w == 1.0:
        return w, 1.0
    # fixed values: normalising transformation
    if n <= 11:
        g = -2.273 + 0.459 * n
        if math.log(1 - w) >= g:
            return w, 0.0
        value = -math.log(g - math.log(1 - w))
        mu = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)
        sigma = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        log_n = math.log(n)
        value = math.log(1 - w)
        mu = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], log_n)
        sigma = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], log_n))
    return w, 1 - normal.cdf((value - mu) / sigma)
