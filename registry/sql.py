"""SQL shared by several checks: period grids and the CUSUM recursion."""

DAILY_SQL = """daily AS (
  SELECT event_type, date_trunc('day', ts) AS period, CAST(count(value) AS DOUBLE) AS value
  FROM events GROUP BY 1, 2)"""

MONTHLY_SQL = """monthly AS (
  SELECT o_orderpriority, date_trunc('month', o_orderdate) AS period, sum(o_totalprice) AS value
  FROM orders GROUP BY 1, 2)"""

# The recursion itself, point by point, against the closed form in Spark.
CUSUM_SQL = f"""RECURSIVE {DAILY_SQL}, zed AS (
  SELECT event_type, period, value,
         row_number() OVER (PARTITION BY event_type ORDER BY period) - 1 AS idx,
         (value - avg(value) OVER (PARTITION BY event_type))
           / stddev_pop(value) OVER (PARTITION BY event_type) AS z,
         count(*) OVER (PARTITION BY event_type) AS points
  FROM daily), scored AS (
  SELECT event_type, period, value, idx, z, 0.0::DOUBLE AS cusum_pos, 0.0::DOUBLE AS cusum_neg
  FROM zed WHERE idx = 0 AND points >= 10
  UNION ALL
  SELECT t.event_type, t.period, t.value, t.idx, t.z,
         greatest(0, s.cusum_pos + t.z - 0.5), least(0, s.cusum_neg + t.z + 0.5)
  FROM scored s JOIN zed t ON t.event_type = s.event_type AND t.idx = s.idx + 1)"""

ALERTS_SQL = f"""{CUSUM_SQL}, alerts AS (
  SELECT event_type, period, idx, value, 'upward_spike' AS type FROM scored WHERE cusum_pos > 1.5
  UNION ALL
  SELECT event_type, period, idx, value, 'downward_drop' FROM scored WHERE cusum_neg < -1.5)"""
