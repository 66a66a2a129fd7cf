"""Pluggable models: a name, and a function from one series' history to forecast rows."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.operators.autoregressive import forecast_ar, reasons, with_reasons
from revlake.operators.forecasting import forecast_ensemble, forecast_seasonal_trend

FORECAST = "series string, ds date, yhat double, lower double, upper double"
Frame = Callable[..., DataFrame]

# Built-in models work on the whole frame of series at once.
MODELS: dict[str, Frame] = {
    "seasonal_trend": forecast_seasonal_trend,
    "autoregressive": forecast_ar,
    "ensemble": lambda df, horizon=30, interval=0.95: forecast_ensemble(
        forecast_seasonal_trend(df, horizon, interval), forecast_ar(df, horizon, interval)
    ),
}


def register(name: str, model: Frame) -> None:
    MODELS[name] = model


def register_per_series(name: str, fit_predict: Callable[[pd.DataFrame, int, float], pd.DataFrame]) -> None:
    """Register a plain function ``(history, horizon, interval) -> forecast`` run once per series."""

    def run(df: DataFrame, horizon: int = 30, interval: float = 0.95) -> DataFrame:
        return df.select("series", "ds", "y").groupBy("series").applyInPandas(
            lambda pdf: fit_predict(pdf.sort_values("ds"), horizon, interval), FORECAST
        )

    register(name, run)


def run_models(df: DataFrame, names: list[str], horizon: int = 30, interval: float = 0.95) -> DataFrame:
    """Forecasts of several models over all series, one frame.

    A series without a forecast of a model has one row of that model, with a ``reason`` and no values.
    """
    out, why = None, reasons(df)
    unknown = why.withColumn("reason", F.lit(None).cast("string"))
    for name in names:
        model = MODELS[name]
        if model is forecast_ar:
            rows = forecast_ar(df, horizon, interval, reasons=True)
        else:
            # Other models have limits of their own; the ensemble has those of its members.
            rows = with_reasons(model(df, horizon=horizon, interval=interval), why if name == "ensemble" else unknown)
        rows = rows.select("series", F.lit(name).alias("model"), "ds", "yhat", "lower", "upper", "reason")
        out = rows if out is None else out.unionByName(rows)
    return out
