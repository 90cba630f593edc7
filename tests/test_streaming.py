from __future__ import annotations

from pyspark.sql import functions as F

from medlark.functions.storage import scratch_path
from medlark.operators import series
from medlark.plans.trends import series_alerts
from medlark.streaming.alerts import current_alerts, store_grid, stream_grid
from medlark.streaming.stateful import keep_alerts, latest_alerts, stateful_alerts


def test_stream_grid_is_the_batch_grid(spark, sf_dir):
    source = scratch_path(spark, "events")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.write.parquet(source)
    # An event long after the others closes their periods; its own stays open.
    events.limit(1).selectExpr("event_id", "ts + interval 400 days AS ts", "user_id", "event_type",
                               "value", "props").write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    grid = stream_grid(stream, ["event_type"], "ts", "value")
    path = scratch_path(spark, "grid")
    q = store_grid(grid, path, scratch_path(spark, "progress"))
    q.awaitTermination(120)
    batch = series.prepare_series(events, ["event_type"], "ts", "value", "day", "count")
    got = spark.read.parquet(path).select("event_type", "period", "value")
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    alerts = current_alerts(spark, path, ["event_type"], 1.5)
    want = series.alert_counts(batch, ["event_type"], threshold=1.5)
    assert alerts.exceptAll(want).count() == 0


def test_state_gives_what_all_events_give_after_every_batch(spark, sf_dir):
    """Late events, rows without time or value and short series; each batch's update is that of the events so far."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type", "value")
    odd = spark.createDataFrame([(-1, None, "view", 1.0), (-2, "2024-01-05", "view", None), (-3, "2024-01-05", "rare", 1.0)],
                                "event_id long, ts string, event_type string, value double")
    odd = odd.withColumn("ts", F.col("ts").cast(events.schema["ts"].dataType))
    every = events.unionByName(odd)
    source, out = scratch_path(spark, "events"), scratch_path(spark, "alerts")
    parts = [every.where(F.pmod("event_id", F.lit(3)) == i) for i in range(3)]
    progress = scratch_path(spark, "progress")
    seen = None
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(every.schema).option("maxFilesPerTrigger", 1).parquet(source)
        keep_alerts(stateful_alerts(stream, ["event_type"], "ts", "value", threshold=1.5), out, progress).awaitTermination()
        seen = part if seen is None else seen.unionByName(part)
        batch = series_alerts(seen, ["event_type"], "ts", "value", threshold=1.5)
        got = latest_alerts(spark, out, ["event_type"])
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.select(got.columns).collect()))
