"""The alert plan kept up to date from a stream of events.

The stream folds events to the same (series, period) grid as the batch plan.
Late events within the watermark still count. CUSUM needs the mean of the
whole series, so alerts are read from the stored grid, not from stream state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medlark.functions.types import col
from medlark.operators import series


def stream_grid(events: DataFrame, by: list[str], ts: str, value: str, period: str = "1 day",
                late: str = "2 days") -> DataFrame:
    """(by.., period, value): counts per series and period of a streaming table."""
    timed = events.where(col(value).isNotNull()).select(
        *[col(b) for b in by], col(ts).cast("timestamp").alias("_ts"), col(value).alias("_v"))
    return (
        timed.withWatermark("_ts", late)
        .groupBy(*[col(b) for b in by], F.window("_ts", period).alias("_w"))
        .agg(F.count("_v").cast("double").alias("value"))
        .select(*[col(b) for b in by], F.col("_w.start").cast("timestamp_ntz").alias("period"), "value")
    )


def store_grid(grid: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append closed periods to ``path``; ``trigger`` as in ``writeStream.trigger``."""
    return (
        grid.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def current_alerts(spark: SparkSession, path: str, by: list[str],
                   threshold: float = series.THRESHOLD) -> DataFrame:
    """Alerts per series over the periods stored so far."""
    return series.alert_counts(spark.read.parquet(path), by, threshold=threshold)
