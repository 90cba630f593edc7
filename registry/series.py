from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlark.operators import series
from medlark.functions.storage import scratch_path
from medlark.plans.trends import series_alerts
from medlark.streaming.stateful import keep_alerts, latest_alerts, stateful_alerts
from registry.base import day, query, rounded, table
from registry.sql import ALERTS_SQL, CUSUM_SQL, DAILY_SQL, MONTHLY_SQL

BY = ["event_type"]
DAY_SQL = "strftime(period, '%Y-%m-%d') AS period"


def daily(spark, d) -> DataFrame:
    return series.prepare_series(table(spark, d, "events"), BY, "ts", "value", "day", "count")


def monthly(spark, d) -> DataFrame:
    return series.prepare_series(table(spark, d, "orders"), ["o_orderpriority"], "o_orderdate",
                                 "o_totalprice", "month", "sum")


def _shown(df: DataFrame, *cols: str) -> DataFrame:
    return df.select([day("period") if c == "period" else F.col(c) for c in cols])


@query("prepare_series", f"WITH {DAILY_SQL} SELECT event_type, {DAY_SQL}, value FROM daily")
def prepare_series(spark, d):
    return _shown(daily(spark, d), "event_type", "period", "value")


@query("rolling_mean", f"""
WITH {DAILY_SQL}
SELECT event_type, {DAY_SQL},
  CASE WHEN count(*) OVER w3 = 3 THEN round(avg(value) OVER w3, 6) END AS ma_3,
  CASE WHEN count(*) OVER w12 = 12 THEN round(avg(value) OVER w12, 6) END AS ma_12
FROM daily WINDOW
  w3 AS (PARTITION BY event_type ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
  w12 AS (PARTITION BY event_type ORDER BY period ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def rolling_mean(spark, d):
    m = series.rolling_mean(series.rolling_mean(daily(spark, d), BY, n=3), BY, n=12)
    return rounded(_shown(m, "event_type", "period", "ma_3", "ma_12"), 6, "ma_3", "ma_12")


@query("linear_forecast", f"""
WITH {MONTHLY_SQL},
p AS (SELECT *, 12 - row_number() OVER (PARTITION BY o_orderpriority ORDER BY period DESC) AS x
      FROM monthly QUALIFY x >= 0),
l AS (SELECT o_orderpriority, regr_slope(value, x) AS s, regr_intercept(value, x) AS i,
             max(period) AS last, count(*) AS n FROM p GROUP BY 1),
r AS (SELECT l.o_orderpriority, stddev_pop(value - (s * x + i)) AS sd
      FROM p JOIN l USING (o_orderpriority) GROUP BY 1)
SELECT o_orderpriority, CAST(h AS INTEGER) AS step,
       strftime(last_day(last + to_months(CAST(h AS INTEGER))), '%Y-%m-%d') AS forecast_date,
       round(s, 2) AS slope, round(greatest(s * (11 + h) + i, 0), 2) AS forecast,
       round(greatest(greatest(s * (11 + h) + i, 0) - 1.96 * sd, 0), 2) AS lower,
       round(greatest(s * (11 + h) + i, 0) + 1.96 * sd, 2) AS upper
FROM l JOIN r USING (o_orderpriority), range(1, 13) g(h) WHERE n = 12
UNION ALL SELECT o_orderpriority, NULL, NULL, NULL, NULL, NULL, NULL FROM l WHERE n < 12""")
def linear_forecast(spark, d):
    f = series.linear_forecast(monthly(spark, d), ["o_orderpriority"])
    f = f.withColumn("forecast_date", day("forecast_date"))
    return rounded(f, 2, "slope", "forecast", "lower", "upper")


@query("cusum", f"""
WITH {CUSUM_SQL}
SELECT event_type, {DAY_SQL}, value, CAST(idx AS INTEGER) AS idx, round(z, 8) + 0.0 AS z,
       round(cusum_pos, 8) + 0.0 AS cusum_pos, round(cusum_neg, 8) + 0.0 AS cusum_neg FROM scored""")
def cusum(spark, d):
    c = series.cusum(daily(spark, d), BY)
    return rounded(_shown(c, "event_type", "period", "value", "idx", "z", "cusum_pos", "cusum_neg"),
                   8, "z", "cusum_pos", "cusum_neg")


def alerts_by_type(spark, d) -> DataFrame:
    return series.cusum_anomalies(series.cusum(daily(spark, d), BY), 1.5)


@query("cusum_anomalies", f"""
WITH {ALERTS_SQL}
SELECT event_type, {DAY_SQL}, CAST(idx AS INTEGER) AS idx, value, type FROM alerts""")
def cusum_anomalies(spark, d):
    return _shown(alerts_by_type(spark, d), "event_type", "period", "idx", "value", "type")


SERIES_ALERTS_SQL = f"""
WITH {ALERTS_SQL}
SELECT event_type, n_points, coalesce(up, 0) AS n_up, coalesce(down, 0) AS n_down
FROM (SELECT event_type, count(*) AS n_points FROM daily GROUP BY 1)
LEFT JOIN (SELECT event_type, count(*) FILTER (WHERE type = 'upward_spike') AS up,
                  count(*) FILTER (WHERE type = 'downward_drop') AS down
           FROM alerts GROUP BY 1) USING (event_type)"""


@query("series_alerts", SERIES_ALERTS_SQL)
def flagship(spark, d):
    return series_alerts(table(spark, d, "events"), BY, "ts", "value", threshold=1.5)


@query("stateful_alerts", SERIES_ALERTS_SQL)
def stateful(spark, d):
    """Events in five files, one a batch, folded into the state of a streaming query."""
    source, out, progress = (scratch_path(spark, n) for n in ("events", "alerts", "progress"))
    events = table(spark, d, "events")
    # Dealt by a hash, so every file has events of all days: late ones throughout.
    events.repartition(5, F.xxhash64("event_id")).write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    keep_alerts(stateful_alerts(stream, BY, "ts", "value", threshold=1.5), out, progress).awaitTermination()
    return latest_alerts(spark, out, BY)


TREND_SQL = f"""{MONTHLY_SQL},
raw AS (SELECT *, CASE WHEN count(*) OVER w = 12 THEN avg(value) OVER w END AS m
        FROM monthly WINDOW w AS (PARTITION BY o_orderpriority ORDER BY period
                                  ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)),
trended AS (SELECT o_orderpriority, period, value, coalesce(
    first_value(m IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY period
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    last_value(m IGNORE NULLS) OVER (PARTITION BY o_orderpriority ORDER BY period
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS trend FROM raw)"""


@query("centered_trend", f"""
WITH {TREND_SQL} SELECT o_orderpriority, {DAY_SQL}, round(trend, 4) AS trend FROM trended""")
def centered_trend(spark, d):
    t = series.centered_trend(monthly(spark, d), ["o_orderpriority"])
    return rounded(_shown(t, "o_orderpriority", "period", "trend"), 4, "trend")


@query("decompose", f"""
WITH {TREND_SQL},
s AS (SELECT *, avg(value - trend) OVER (PARTITION BY o_orderpriority, month(period)) AS seasonal
      FROM trended)
SELECT o_orderpriority, {DAY_SQL}, round(trend, 4) AS trend, round(seasonal, 4) + 0.0 AS seasonal,
       round(value - trend - seasonal, 4) + 0.0 AS residual FROM s""")
def decompose(spark, d):
    t = series.decompose(monthly(spark, d), ["o_orderpriority"])
    return rounded(_shown(t, "o_orderpriority", "period", "trend", "seasonal", "residual"), 4,
                   "trend", "seasonal", "residual")


@query("trailing_decompose", f"""
WITH {DAILY_SQL}
SELECT event_type, {DAY_SQL}, CASE WHEN count(*) OVER w = 12 THEN round(avg(value) OVER w, 6) END
         AS trend,
       CASE WHEN count(*) OVER w = 12 THEN round(value - avg(value) OVER w, 6) + 0.0 END AS residual
FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY period
                        ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def trailing_decompose(spark, d):
    t = series.trailing_decompose(daily(spark, d), BY)
    return rounded(_shown(t, "event_type", "period", "trend", "residual"), 6, "trend", "residual")


@query("drift_forecast", f"""
WITH {DAILY_SQL},
p AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY period DESC) AS back
      FROM daily QUALIFY back <= 12),
e AS (SELECT event_type, max(CASE WHEN back = 1 THEN value END) AS last,
             (max(CASE WHEN back = 1 THEN value END) - max(CASE WHEN back = 12 THEN value END)) / 11
               AS drift, stddev_samp(value) AS sd FROM p GROUP BY 1)
SELECT event_type, CAST(h AS INTEGER) AS step, round(drift, 6) + 0.0 AS drift,
       round(last + drift * h, 6) AS forecast,
       round(greatest(last + drift * h - 1.96 * sd, 0), 6) AS lower,
       round(last + drift * h + 1.96 * sd, 6) AS upper
FROM e, range(1, 13) g(h)""")
def drift_forecast(spark, d):
    f = series.drift_forecast(daily(spark, d), BY)
    return rounded(f, 6, "drift", "forecast", "lower", "upper")


@query("holdout_tail", f"""
WITH {MONTHLY_SQL}
SELECT o_orderpriority, {DAY_SQL}, CASE WHEN row_number() OVER
         (PARTITION BY o_orderpriority ORDER BY period DESC) <= 12 THEN 1 ELSE 0 END AS is_holdout
FROM monthly""")
def holdout_tail(spark, d):
    t = series.holdout_tail(monthly(spark, d), ["o_orderpriority"], days=90)
    return _shown(t, "o_orderpriority", "period", "is_holdout")
