"""Time series per key.

``prepare_series`` folds raw rows to one row per series and period. That is
what bounds the windows below: a series then has at most as many rows as the
calendar has periods, however many raw rows it had. All operators partition
by the series key, so a chain of them shuffles once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from medlark.functions.types import col

# Fixed values of the series operators.
PERIODS = ["hour", "day", "week", "month", "quarter", "year"]
LAST_POINTS = 12
Z95 = 1.96
MIN_POINTS = 10
SLACK = 0.5
THRESHOLD = 3.0
UP, DOWN = "upward_spike", "downward_drop"

AGGREGATES = {
    "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max,
    "count": lambda c: F.count(c).cast("double"),
}


def _all(by: list[str]) -> WindowSpec:
    return Window.partitionBy(*[col(b) for b in by])


def _ordered(by: list[str], ts: str) -> WindowSpec:
    return _all(by).orderBy(col(ts))


def prepare_series(df: DataFrame, by: list[str], ts: str, value: str, period: str = "day",
                   agg: str = "sum") -> DataFrame:
    """(by.., period, value): one row per series and period; rows without time or value go."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    if not by:
        raise ValueError("a series key is needed")
    when = col(ts).try_cast("timestamp_ntz")
    return (
        df.select(*[col(b) for b in by],
                  F.date_trunc(period, when).cast("timestamp_ntz").alias("period"),
                  col(value).alias("value"))
        .where(F.col("period").isNotNull() & F.col("value").isNotNull())
        .groupBy(*[col(b) for b in by], "period")
        .agg(AGGREGATES[agg](F.col("value")).alias("value"))
    )


def rolling_mean(df: DataFrame, by: list[str], ts: str = "period", value: str = "value",
                 n: int = LAST_POINTS, into: str | None = None) -> DataFrame:
    """Mean of the last ``n`` rows; null until there are ``n`` values."""
    w = _ordered(by, ts).rowsBetween(1 - n, 0)
    return df.withColumn(into or f"ma_{n}",
                         F.when(F.count(value).over(w) == n, F.avg(value).over(w)))


def _last_rows(df: DataFrame, by: list[str], ts: str, n: int) -> DataFrame:
    newest = _all(by).orderBy(col(ts).desc())
    return df.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= n)


def linear_forecast(df: DataFrame, by: list[str], ts: str = "period", value: str = "value",
                    last: int = LAST_POINTS, horizon: int = 12) -> DataFrame:
    """Least squares on the last points, carried on to the next month ends.

    Forecast and lower band stay at or above 0, the upper band does not bend;
    the band is 1.96 population stds of the residuals. A series with fewer points
    has one line, with nulls for step and figures.
    """
    x = F.lit(float(last)) - F.col("_back")
    pts = _last_rows(df, by, ts, last).select(
        *[col(b) for b in by], col(ts).alias("_ts"), x.alias("_x"), col(value).alias("_y"))
    w = _all(by)
    fitted = pts.select(
        "*",
        F.regr_slope("_y", "_x").over(w).alias("slope"),
        F.regr_intercept("_y", "_x").over(w).alias("intercept"))
    lines = fitted.groupBy(*[col(b) for b in by]).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_ts").alias("_end"),
        F.first("slope").alias("slope"), F.first("intercept").alias("intercept"),
        F.stddev_pop(F.col("_y") - (F.col("slope") * F.col("_x") + F.col("intercept"))).alias("_band"),
    )
    enough = F.col("_n") == last
    steps = F.when(enough, F.sequence(F.lit(1), F.lit(horizon))).otherwise(F.array(F.lit(None).cast("int")))
    ahead = lines.select("*", F.explode(steps).alias("step"))
    forecast = F.when(enough, F.greatest(
        F.col("slope") * (F.lit(float(last)) + F.col("step") - 1) + F.col("intercept"), F.lit(0.0)))
    band = F.lit(Z95) * F.col("_band")
    return ahead.select(
        *[col(b) for b in by], "step",
        F.last_day(F.add_months("_end", F.col("step"))).alias("forecast_date"),
        F.when(enough, F.col("slope")).alias("slope"), forecast.alias("forecast"),
        F.when(enough, F.greatest(forecast - band, F.lit(0.0))).alias("lower"),
        (forecast + band).alias("upper"))


def _cusum_columns(df: DataFrame, by: list[str], ts: str, value: str, slack: float) -> DataFrame:
    """``idx``, ``z`` and the two sums for every point; null in series that are not scored."""
    w, o = _all(by), _ordered(by, ts)
    run = o.rowsBetween(Window.unboundedPreceding, 0)
    std = F.stddev_pop(value).over(w)
    usable = (F.count(value).over(w) >= MIN_POINTS) & (std > 0)
    scored = df.where(col(value).isNotNull()).select(
        "*", (F.row_number().over(o) - 1).alias("idx"),
        F.when(usable, (col(value) - F.avg(value).over(w)) / std).alias("z"))

    def moved(by_slack: float):
        return F.sum(F.when(F.col("idx") == 0, F.col("z") * 0).otherwise(F.col("z") + F.lit(by_slack))
                     ).over(run)

    summed = scored.select("*", moved(-slack).alias("_up"), moved(slack).alias("_down"))
    return summed.select(
        *[col(c) for c in df.columns], "idx", "z",
        (F.col("_up") - F.min("_up").over(run)).alias("cusum_pos"),
        (F.col("_down") - F.max("_down").over(run)).alias("cusum_neg"))


def cusum(df: DataFrame, by: list[str], ts: str = "period", value: str = "value",
          slack: float = SLACK) -> DataFrame:
    """Add ``idx``, ``z``, ``cusum_pos`` and ``cusum_neg``, both 0 at the first point.

    S+ is the running sum of (z - slack) less its running minimum, S- the
    running sum of (z + slack) less its running maximum: the recursion without
    a loop. Series with under 10 points or no spread give no rows.
    """
    return _cusum_columns(df, by, ts, value, slack).where(F.col("z").isNotNull())


def cusum_anomalies(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Alerts of a :func:`cusum` table, ``type`` up or down; a row can give both."""
    kinds = F.array_compact(F.array(
        F.when(F.col("cusum_pos") > threshold, UP),
        F.when(F.col("cusum_neg") < -threshold, DOWN)))
    return scored.withColumn("type", F.explode(kinds))


def alert_counts(df: DataFrame, by: list[str], ts: str = "period", value: str = "value",
                 slack: float = SLACK, threshold: float = THRESHOLD) -> DataFrame:
    """Alerts per series, for every series of the table, zero where there are none.

    The windows and the final counts share the partitioning by series key.
    """
    scored = _cusum_columns(df, by, ts, value, slack)
    return scored.groupBy(*[col(b) for b in by]).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.count_if(F.col("cusum_pos") > threshold).alias("n_up"),
        F.count_if(F.col("cusum_neg") < -threshold).alias("n_down"))


def centered_trend(df: DataFrame, by: list[str], ts: str = "period", value: str = "value",
                   n: int = LAST_POINTS, into: str = "trend") -> DataFrame:
    """Centred mean of ``n`` rows; the ends take the nearest full mean, later ones first."""
    o = _ordered(by, ts)
    back = n // 2
    w = o.rowsBetween(-back, n - 1 - back)
    raw = df.withColumn("_raw", F.when(F.count(value).over(w) == n, F.avg(value).over(w)))
    after = F.first("_raw", ignorenulls=True).over(o.rowsBetween(0, Window.unboundedFollowing))
    before = F.last("_raw", ignorenulls=True).over(o.rowsBetween(Window.unboundedPreceding, 0))
    return raw.withColumn(into, F.coalesce(after, before)).drop("_raw")


def decompose(df: DataFrame, by: list[str], ts: str = "period", value: str = "value",
              n: int = LAST_POINTS) -> DataFrame:
    """Add ``trend``, ``seasonal`` (mean of the rest by calendar month) and ``residual``."""
    base = centered_trend(df, by, ts, value, n).withColumn("_rest", col(value) - F.col("trend"))
    month = Window.partitionBy(*[col(b) for b in by], F.month(col(ts)))
    return base.withColumn("seasonal", F.avg("_rest").over(month)).withColumn(
        "residual", F.col("_rest") - F.col("seasonal")).drop("_rest")


def trailing_decompose(df: DataFrame, by: list[str], ts: str = "period", value: str = "value",
                       n: int = LAST_POINTS) -> DataFrame:
    """Add the trailing mean as ``trend`` and what is left as ``residual``, null at the start."""
    return rolling_mean(df, by, ts, value, n, into="trend").withColumn(
        "residual", col(value) - F.col("trend"))


def drift_forecast(df: DataFrame, by: list[str], ts: str = "period", value: str = "value",
                   last: int = LAST_POINTS, steps: int = 12) -> DataFrame:
    """Last value plus the mean step of the last points.

    The band is 1.96 sample stds of those points; its lower end stays at or
    above 0, the forecast does not.
    """
    pts = _last_rows(df, by, ts, last)
    o = _ordered(by, ts)
    diff = pts.withColumn("_diff", col(value) - F.lag(value).over(o))
    ends = diff.groupBy(*[col(b) for b in by]).agg(
        F.max_by(col(value), col(ts)).alias("_last"), F.avg("_diff").alias("drift"),
        F.stddev_samp(value).alias("_std"))
    ahead = ends.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    forecast = F.col("_last") + F.col("drift") * F.col("step")
    band = F.lit(Z95) * F.col("_std")
    return ahead.select(*[col(b) for b in by], "step", "drift", forecast.alias("forecast"),
                        F.greatest(forecast - band, F.lit(0.0)).alias("lower"),
                        (forecast + band).alias("upper"))


def holdout_tail(df: DataFrame, by: list[str], days: int, ts: str = "period") -> DataFrame:
    """Add ``is_holdout``: 1 for the last ``days // 7`` points of each series."""
    newest = _all(by).orderBy(col(ts).desc())
    return df.withColumn(
        "is_holdout", (F.row_number().over(newest) <= days // 7).cast("int"))
