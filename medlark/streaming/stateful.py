"""Alert counts per series kept up to date by the state of a streaming query.

The state of a series is its grid, one count per period, so it is bounded by the calendar. CUSUM is scored
against the mean and spread of the whole series, which every event moves: a batch folds its events into the grid, late ones
like any others, and the recursion runs over the grid once more.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from medlark.functions.types import col
from medlark.operators.series import MIN_POINTS, PERIODS, SLACK, THRESHOLD

_STATE = "periods array<long>, counts array<long>"


def _alerts(values: np.ndarray, slack: float, threshold: float) -> tuple[int, int]:
    """Points above the upper and below the lower sum; none for short series and those without spread."""
    spread = values.std()
    if len(values) < MIN_POINTS or not spread > 0:
        return 0, 0
    up = down = 0.0
    n_up = n_down = 0
    for i, z in enumerate((values - values.mean()) / spread):
        up, down = (0.0, 0.0) if i == 0 else (max(0.0, up + z - slack), min(0.0, down + z + slack))
        n_up, n_down = n_up + (up > threshold), n_down + (down < -threshold)
    return n_up, n_down


def stateful_alerts(
    events: DataFrame, by: list[str], ts: str, value: str, period: str = "day",
    threshold: float = THRESHOLD, slack: float = SLACK,
) -> DataFrame:
    """(by.., n_points, n_up, n_down) of every series that a batch touches; output mode ``update``.

    Events are counted per period; those without time or value do not count.
    """
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    when = F.date_trunc(period, col(ts).try_cast("timestamp"))
    narrow = events.where(col(value).isNotNull() & when.isNotNull()).select(
        *[col(b) for b in by], F.unix_micros(when).alias("_period"))

    def fold(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        grid: dict[int, int] = dict(zip(*state.get)) if state.exists else {}
        for batch in batches:
            for p, n in batch["_period"].value_counts().items():
                grid[int(p)] = grid.get(int(p), 0) + int(n)
        periods = sorted(grid)
        counts = [grid[p] for p in periods]
        state.update((periods, counts))
        up, down = _alerts(np.array(counts, float), slack, threshold)
        yield pd.DataFrame([[*key, len(periods), up, down]], columns=[*by, "n_points", "n_up", "n_down"])

    out = T.StructType([*[events.schema[b] for b in by], *[T.StructField(n, T.LongType()) for n in ("n_points", "n_up", "n_down")]])
    return narrow.groupBy(*[col(b) for b in by]).applyInPandasWithState(
        fold, out, _STATE, "update", GroupStateTimeout.NoTimeout)


def keep_alerts(alerts: DataFrame, path: str, checkpoint: str, **trigger):
    """Store each batch's updates below ``path``; a repeated batch replaces itself. ``trigger`` as in ``writeStream.trigger``."""
    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (alerts.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def latest_alerts(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """The last update of every series."""
    last = Window.partitionBy(*[col(b) for b in by]).orderBy(F.col("batch").desc())
    ranked = spark.read.parquet(path).withColumn("_n", F.row_number().over(last))
    return ranked.where(F.col("_n") == 1).drop("batch", "_n")
