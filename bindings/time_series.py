from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import query, table
from sensorloom.operators import resample
from sensorloom.sources.landing import missing_days


def _rounded(df, *names):
    return df.withColumns({name: F.round(name, 6) for name in names})


def _mean_sql(minutes: int) -> str:
    return f"""
  SELECT event_type, time_bucket(INTERVAL '{minutes} minutes', ts) AS ts, round(avg(value), 6) AS value
  FROM events GROUP BY 1, 2
"""


def _grid_sql(minutes: int, means: str) -> str:
    return f"""
WITH means AS ({means}),
     grid AS (SELECT event_type, unnest(generate_series(min(ts), max(ts), INTERVAL '{minutes} minutes')) AS ts
              FROM means GROUP BY event_type)
SELECT grid.event_type, grid.ts, means.value
FROM grid LEFT JOIN means ON means.event_type = grid.event_type AND means.ts = grid.ts
"""


_SEVEN_SQL = """
  WITH origin AS (SELECT event_type, date_trunc('day', min(ts)) AS o FROM events GROUP BY 1)
  SELECT e.event_type, time_bucket(INTERVAL '7 minutes', ts, o) AS ts, round(avg(value), 6) AS value
  FROM events e JOIN origin ON e.event_type = origin.event_type GROUP BY 1, 2
"""


@query("resample_10m", _mean_sql(10))
def resample_10m(spark, sf_dir):
    return _rounded(
        resample.resample_mean(table(spark, sf_dir, "events"), "ts", ["value"], "10min", ["event_type"]), "value")


@query("resample_60m", _mean_sql(60))
def resample_60m(spark, sf_dir):
    return _rounded(
        resample.resample_mean(table(spark, sf_dir, "events"), "ts", ["value"], "60min", ["event_type"]), "value")


@query("resample_7m_midnight", _SEVEN_SQL)
def resample_7m_midnight(spark, sf_dir):
    return _rounded(
        resample.resample_mean(table(spark, sf_dir, "events"), "ts", ["value"], "7min", ["event_type"]), "value")


@query("resample_grid", _grid_sql(10, _mean_sql(10)))
def resample_grid(spark, sf_dir):
    return _rounded(
        resample.resample_grid(table(spark, sf_dir, "events"), "ts", ["value"], "10min", ["event_type"]), "value")


@query("resample_grid_7m", _grid_sql(7, _SEVEN_SQL))
def resample_grid_7m(spark, sf_dir):
    return _rounded(
        resample.resample_grid(table(spark, sf_dir, "events"), "ts", ["value"], "7min", ["event_type"]), "value")


@query("resample_grid_per_user", """
WITH means AS (SELECT user_id, time_bucket(INTERVAL '60 minutes', ts) AS ts, round(avg(value), 6) AS value
               FROM events GROUP BY 1, 2),
     grid AS (SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL '60 minutes')) AS ts
              FROM means GROUP BY user_id)
SELECT grid.user_id, grid.ts, means.value
FROM grid LEFT JOIN means ON means.user_id = grid.user_id AND means.ts = grid.ts
""")
def resample_grid_per_user(spark, sf_dir):
    return _rounded(
        resample.resample_grid(table(spark, sf_dir, "events"), "ts", ["value"], "60min", ["user_id"]), "value")


_WIDE_SQL = """
  SELECT ts, CASE WHEN event_type IN ('click', 'view') THEN value END AS clicks,
         CASE WHEN event_type = 'error' THEN value END AS errors
  FROM events
"""


@query("resample_wide", f"""
WITH means AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS ts, round(avg(clicks), 6) AS clicks,
                      round(avg(errors), 6) AS errors FROM ({_WIDE_SQL}) GROUP BY 1),
     grid AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL '10 minutes')) AS ts FROM means)
SELECT grid.ts, clicks, errors FROM grid LEFT JOIN means ON means.ts = grid.ts
""")
def resample_wide(spark, sf_dir):
    """Channels as columns share one grid; NaN and NULL are skipped."""
    kind = F.col("event_type")
    wide = table(spark, sf_dir, "events").select(
        "ts",
        F.when(kind.isin("click", "view"), F.col("value")).otherwise(F.lit(float("nan"))).alias("clicks"),
        F.when(kind == "error", F.col("value")).alias("errors"))
    return _rounded(resample.resample_grid(wide, "ts", ["clicks", "errors"], "10min"), "clicks", "errors")


@query("time_bounds", "SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY user_id")
def time_bounds(spark, sf_dir):
    return resample.time_bounds(table(spark, sf_dir, "events"), "ts", ["user_id"])


@query("missing_days", """
SELECT o_orderpriority, cast(d AS date) AS day
FROM (SELECT DISTINCT o_orderpriority FROM orders),
     (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS d)
WHERE (o_orderpriority, cast(d AS date)) NOT IN (SELECT (o_orderpriority, cast(o_orderdate AS date)) FROM orders)
""")
def missing_days_query(spark, sf_dir):
    """Per priority the days without any order of it."""
    return missing_days(table(spark, sf_dir, "orders"), "o_orderdate", "1995-01-01", "2002-01-01", ["o_orderpriority"])
