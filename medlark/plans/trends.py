"""Raw events to alerts and forecasts per series."""

from __future__ import annotations

from pyspark.sql import DataFrame

from medlark.operators import series


def series_alerts(events: DataFrame, by: list[str], ts: str, value: str, period: str = "day",
                  agg: str = "count", threshold: float = series.THRESHOLD) -> DataFrame:
    """Alerts per series and direction, zero where there are none."""
    grid = series.prepare_series(events, by, ts, value, period, agg)
    return series.alert_counts(grid, by, threshold=threshold)


def series_forecast(events: DataFrame, by: list[str], ts: str, value: str, period: str = "month",
                    agg: str = "sum", horizon: int = 12) -> DataFrame:
    grid = series.prepare_series(events, by, ts, value, period, agg)
    return series.linear_forecast(grid, by, horizon=horizon)
