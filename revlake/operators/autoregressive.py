"""Autoregressive forecasts: one small least-squares fit per series and candidate, in grouped tasks.

The history of a series is one row per day, so a group is bounded by the calendar; the engine's work
is spread over series and candidate orders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.functions.columns import finite
from revlake.operators.forecasting import z_value

# Shortest history, weekly season, default order.
MIN_POINTS = 50
SEASON = 7
DEFAULT_ORDER = (2, 1, True)
GRID = [(p, d, s) for p in range(6) for d in range(3) for s in (False, True)]
MAX_LAG = 7


def _fit(z: np.ndarray, lags: list[int], start: int):
    """Least squares of z[t] on a constant and its lags for t >= start."""
    rows = np.arange(start, len(z))
    design = np.column_stack([np.ones(len(rows)), *[z[rows - k] for k in lags]])
    beta, *_ = np.linalg.lstsq(design, z[rows], rcond=None)
    error = z[rows] - design @ beta
    return beta, error


def _lags(p: int, seasonal: bool) -> list[int]:
    return sorted(set(range(1, p + 1)) | ({SEASON} if seasonal else set()))


def _scaled(y: np.ndarray) -> tuple[np.ndarray, bool]:
    logged = bool((y > 0).all())
    return (np.log1p(y) if logged else y), logged


def _moments(z: np.ndarray) -> np.ndarray:
    """Cross-products of a constant and the level 0 .. ``MAX_LAG`` + 2 days back, over the days every order can explain."""
    reach = MAX_LAG + 2
    z = z - z.mean()  # the constant takes up the mean; products stay small
    days = np.arange(reach, len(z))
    columns = np.column_stack([np.ones(len(days)), *[z[days - k] for k in range(reach + 1)]])
    return columns.T @ columns


def _differences(d: int, lags: list[int]) -> np.ndarray:
    """Combinations of the columns of ``_moments``: constant, the ``lags`` of the d-times differenced series, its day itself."""
    out = np.zeros((MAX_LAG + 4, len(lags) + 2))
    out[0, 0] = 1.0
    for place, lag in enumerate([*lags, 0], start=1):
        for j in range(d + 1):
            out[1 + lag + j, place] = (-1) ** j * comb(d, j)
    return out


def information_criteria(z: np.ndarray, moments: np.ndarray, p: int, d: int, seasonal: bool) -> dict[str, float]:
    """AIC, BIC and HQIC on the same target days for every order: all errors start at one day.

    Errors of a differenced model are errors of the level as well, so orders with different d compare.
    Every order is solved from the one matrix of ``_moments``.
    """
    lags = _lags(p, seasonal)
    change = _differences(d, lags)
    matrix = change.T @ moments @ change
    inner, toward, whole = matrix[:-1, :-1], matrix[:-1, -1], float(matrix[-1, -1])
    beta, *_ = np.linalg.lstsq(inner, toward, rcond=None)
    squares = whole - float(beta @ toward)
    if squares <= 1e-5 * whole:
        # Little is left, and the difference of two sums cannot tell well how little.
        _, error = _fit(np.diff(z, n=d) if d else z, lags, MAX_LAG + 2 - d)
        squares = float(error @ error)
    n, k = len(z) - MAX_LAG - 2, len(lags) + 2
    base = n * np.log(max(squares / n, 1e-300))
    return {"aic": base + 2 * k, "bic": base + k * np.log(n), "hqic": base + 2 * k * np.log(np.log(n))}


def recursive_forecast(y: np.ndarray, p: int, d: int, seasonal: bool, horizon: int, interval: float):
    """Mean and bounds of the next days: each step is fed back, bounds widen with the horizon.

    The path of an explosive fit to logarithms may pass the largest number: it is infinite from there on.
    """
    z, logged = _scaled(y)
    w = np.diff(z, n=d) if d else z
    lags = _lags(p, seasonal)
    beta, error = _fit(w, lags, max(lags, default=0))
    spare = max(len(error) - len(beta), 1)
    sigma = float(np.sqrt(error @ error / spare))
    path = list(w)
    impulse = []
    for h in range(horizon):
        path.append(beta[0] + sum(b * path[-k] for b, k in zip(beta[1:], lags, strict=True)))
        impulse.append(1.0 if h == 0 else sum(b * impulse[h - k] for b, k in zip(beta[1:], lags, strict=True) if k <= h))
    mean, weight = np.array(path[len(w):]), np.array(impulse)
    for level in range(d, 0, -1):
        # Undo one difference: continue from the last value one level up.
        mean = np.cumsum(mean) + (np.diff(z, n=level - 1)[-1] if level > 1 else z[-1])
        weight = np.cumsum(weight)
    spread = z_value(interval) * sigma * np.sqrt(np.cumsum(weight**2))
    bounds = mean, mean - spread, mean + spread
    if logged:
        with np.errstate(over="ignore"):
            bounds = tuple(np.expm1(b) for b in bounds)
    return bounds


def _ready(pdf: pd.DataFrame) -> tuple[np.ndarray, str | None]:
    """The values of a series by day, and why no autoregression is fitted to them."""
    y = pdf.sort_values("ds")["y"].to_numpy(dtype=float)
    if len(y) < MIN_POINTS:
        return y, f"{len(y)} days, fewer than {MIN_POINTS}"
    bad = int((~np.isfinite(y)).sum())
    return y, f"{bad} values missing or not finite" if bad else None


def _keyed(rows: dict, pdf: pd.DataFrame, keys: Sequence[str], columns: list[str]) -> pd.DataFrame:
    """Rows of one series with its keys; columns that are not given are null."""
    out = pd.DataFrame(rows)
    for k in keys:
        out[k] = pdf[k].iloc[0]
    for c in columns:
        if c not in out:
            out[c] = pd.Series([None] * len(out), dtype=object)
    return out[columns]


def _grouped(df: DataFrame, keys: Sequence[str], work: Callable, schema: str) -> DataFrame:
    return df.groupBy(*keys).applyInPandas(work, schema)


def _key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{k}` {types[k]}" for k in keys)


def forecast_ar(
    df: DataFrame,
    horizon: int = 30,
    interval: float = 0.95,
    order: tuple[int, int, bool] = DEFAULT_ORDER,
    orders: DataFrame | None = None,
    keys: Sequence[str] = ("series",),
    reasons: bool = False,
) -> DataFrame:
    """Forecast each series with ``order`` = (p, d, weekly lag), or with its own row of ``orders``.

    ``reasons`` adds a column that is null for forecasts, and one row without values for every series
    that is not fitted (or has no row in ``orders``), saying why.
    """
    keys = list(keys)
    if orders is None:
        p, d, seasonal = order
        tasks = df.withColumns({"p": F.lit(p), "d": F.lit(d), "seasonal": F.lit(seasonal)})
    else:
        own = orders.select(*[F.col(k).alias(f"_o_{k}") for k in keys], "p", "d", "seasonal")
        tasks = df.join(own, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys], "left" if reasons else "inner")
    columns = [*keys, "ds", "yhat", "lower", "upper", *["reason"] * reasons]

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        y, why = _ready(pdf)
        p, d, seasonal = (pdf[c].iloc[0] for c in ("p", "d", "seasonal"))
        if why is None and pd.isna(p):
            why = "no order"
        if why is not None:
            return _keyed({"reason": [why] * reasons}, pdf, keys, columns)
        mean, low, high = recursive_forecast(y, int(p), int(d), bool(seasonal), horizon, interval)
        first = pd.Timestamp(pdf["ds"].max()) + pd.Timedelta(days=1)
        rows = {"ds": pd.date_range(first, periods=horizon).date, "yhat": mean, "lower": low, "upper": high}
        return _keyed(rows, pdf, keys, columns)

    schema = f"{_key_schema(df, keys)}, ds date, yhat double, lower double, upper double" + ", reason string" * reasons
    return _grouped(tasks.select(*keys, "ds", "y", "p", "d", "seasonal"), keys, work, schema)


def score_orders(
    df: DataFrame, grid: Sequence[tuple[int, int, bool]] = GRID, keys: Sequence[str] = ("series",), reasons: bool = False
) -> DataFrame:
    """Information criteria of every order of the grid for every series, from one matrix of cross-products.

    ``reasons`` is that of ``forecast_ar``.
    """
    keys = list(keys)
    scores = ["aic", "bic", "hqic"]
    columns = [*keys, "p", "d", "seasonal", *scores, *["reason"] * reasons]

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        y, why = _ready(pdf)
        if why is not None:
            return _keyed({"reason": [why] * reasons}, pdf, keys, columns)
        z, _ = _scaled(y)
        moments = _moments(z)
        rows = [{"p": p, "d": d, "seasonal": s, **information_criteria(z, moments, p, d, s)} for p, d, s in grid]
        return _keyed(rows, pdf, keys, columns)

    schema = f"{_key_schema(df, keys)}, p int, d int, seasonal boolean, aic double, bic double, hqic double" + ", reason string" * reasons
    return _grouped(df.select(*keys, "ds", "y"), keys, work, schema)


def grid_search_order(
    df: DataFrame,
    grid: Sequence[tuple[int, int, bool]] = GRID,
    criterion: str = "aic",
    keys: Sequence[str] = ("series",),
    reasons: bool = False,
) -> DataFrame:
    """The order with the lowest criterion per series; the simpler one on ties. ``reasons`` is that of ``forecast_ar``."""
    scores = score_orders(df, grid, keys, reasons)
    best = F.min_by(F.struct("p", "d", "seasonal", criterion), F.when(F.col(criterion).isNotNull(), F.struct(criterion, "p", "d", "seasonal")))
    found = scores.groupBy(*keys).agg(best.alias("b"), *[F.max("reason").alias("reason")] * reasons)
    return found.select(*keys, "b.*", *["reason"] * reasons)


def reasons(df: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Every series and why no autoregression is fitted to it; null where one is."""
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count(finite("y")).alias("_finite"))
    short = F.format_string(f"%d days, fewer than {MIN_POINTS}", "_n")
    bad = F.format_string("%d values missing or not finite", F.col("_n") - F.col("_finite"))
    return rows.select(*keys, F.when(F.col("_n") < MIN_POINTS, short).when(F.col("_n") > F.col("_finite"), bad).alias("reason"))


def with_reasons(out: DataFrame, why: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """``out`` with a column ``reason``, and one row with a reason and no values for every series of ``why`` that has no row.

    ``out`` is used once, so that no fit behind it runs a second time.
    """
    lost = why.select(*keys, F.coalesce("reason", F.lit("no row of the model")).alias("reason"), F.lit(False).alias("_made"))
    made = out.withColumns({"reason": F.lit(None).cast("string"), "_made": F.lit(True)})
    rows = F.count_if("_made").over(W.partitionBy(*keys))
    both = made.unionByName(lost, allowMissingColumns=True).withColumn("_rows", rows)
    return both.where(F.col("_made") | (F.col("_rows") == 0)).drop("_made", "_rows")
