from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import guid, query, table
from sensorloom.functions.keys import micros_key, surrogate_key
from sensorloom.operators import conform, dedupe
from sensorloom.sources.tables import Table, load_table, read_table
from sensorloom.session import shared_folder


@query("surrogate_key", f"""
SELECT event_id, {guid('event', 'event_id', "CASE WHEN event_type <> 'error' THEN event_type END", 'epoch_us(ts)')}
  AS id FROM events
""")
def surrogate_key_query(spark, sf_dir):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return table(spark, sf_dir, "events").select(
        "event_id", surrogate_key("event", "event_id", kind, micros_key("ts")).alias("id"))


_EXISTING_SQL = f"""
  SELECT {guid('sensor', 'event_type', 'user_id')} AS sensor_id, event_type, user_id, -1::double AS value
  FROM (SELECT DISTINCT event_type, user_id FROM events WHERE event_type = 'click')
"""
_FIRST_SQL = """
  SELECT event_type, user_id, arg_min(value, (ts, event_id)) AS value FROM events GROUP BY event_type, user_id
"""


def _existing(spark, sf_dir):
    return (
        table(spark, sf_dir, "events").filter("event_type = 'click'").select("event_type", "user_id").distinct()
        .select(surrogate_key("sensor", "event_type", "user_id").alias("sensor_id"), "event_type", "user_id",
                F.lit(-1.0).alias("value")))


@query("get_or_create_dimension", f"""
WITH existing AS ({_EXISTING_SQL}), firsts AS ({_FIRST_SQL})
SELECT * FROM existing
UNION ALL
SELECT {guid('sensor', 'f.event_type', 'f.user_id')}, f.event_type, f.user_id, f.value
FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM existing e
                                WHERE e.event_type = f.event_type AND e.user_id = f.user_id)
""")
def get_or_create_dimension(spark, sf_dir):
    return conform.get_or_create(
        table(spark, sf_dir, "events"), _existing(spark, sf_dir), ["event_type", "user_id"], ["value"],
        ["ts", "event_id"], "sensor_id", "sensor")


@query("first_write_wins", _FIRST_SQL)
def first_write_wins(spark, sf_dir):
    return conform.first_per_key(
        table(spark, sf_dir, "events"), ["event_type", "user_id"], ["value"], ["ts", "event_id"])


@query("conform_fact", f"""
WITH dim AS (SELECT {guid('sensor', 'event_type', 'user_id')} AS sensor_id, event_type, user_id, value AS first_value
             FROM ({_FIRST_SQL}))
SELECT {guid('reading', 'event_id')} AS reading_id, dim.sensor_id, event_id, e.value, first_value
FROM events e JOIN dim ON dim.sensor_id = {guid('sensor', 'e.event_type', 'e.user_id')}
""")
def conform_fact(spark, sf_dir):
    """Facts compute the dimension's id; the join back shows that both sides agree."""
    events = table(spark, sf_dir, "events")
    dimension = conform.new_dimension_rows(
        events, None, ["event_type", "user_id"], ["value"], ["ts", "event_id"], "sensor_id", "sensor")
    facts = conform.with_id(conform.with_id(events, "sensor_id", "sensor", ["event_type", "user_id"]),
                            "reading_id", "reading", ["event_id"])
    return facts.select("reading_id", "sensor_id", "event_id", "value").join(
        dimension.select("sensor_id", F.col("value").alias("first_value")), "sensor_id")


@query("child_rows", f"""
SELECT {guid('reading', 'event_id')} AS reading_id, value FROM events WHERE event_type <> 'error'
""")
def child_rows(spark, sf_dir):
    keyed = conform.with_id(table(spark, sf_dir, "events"), "reading_id", "reading", ["event_id"])
    keyed = keyed.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return conform.child_rows(keyed, "reading_id", "value", present="value")


_COPIES_SQL = """
  SELECT event_id, ts, user_id, event_type, value FROM events
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type IN ('error', 'view')
"""


def _copies(spark, sf_dir):
    """Every event, errors and views twice."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return events.unionByName(events.filter(F.col("event_type").isin("error", "view")))


@query("dedupe_readings", f"""
SELECT {guid('reading', 'event_id', 'user_id', 'event_type', 'epoch_us(ts)')} AS reading_id, event_id, user_id,
       event_type, ts, value
FROM (SELECT DISTINCT * FROM ({_COPIES_SQL}))
""")
def dedupe_readings(spark, sf_dir):
    copies = _copies(spark, sf_dir)
    return conform.with_id(
        dedupe.drop_identical(copies), "reading_id", "reading",
        ["event_id", "user_id", "event_type", micros_key("ts")])


_NUMBERED_SQL = """
  SELECT *, 'a-' || event_id AS row_id FROM events
  UNION ALL
  SELECT *, 'b-' || event_id AS row_id FROM events WHERE event_type IN ('error', 'view')
"""


def _numbered(spark, sf_dir):
    """Copies that differ in a random-looking row id."""
    events = table(spark, sf_dir, "events")
    first = events.withColumn("row_id", F.concat(F.lit("a-"), F.col("event_id").cast("string")))
    again = events.filter(F.col("event_type").isin("error", "view")).withColumn(
        "row_id", F.concat(F.lit("b-"), F.col("event_id").cast("string")))
    return first.unionByName(again)


@query("dedupe_random_ids", f"""
SELECT event_id, user_id, event_type, row_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id, user_id, event_type, ts ORDER BY row_id) AS rn
  FROM ({_NUMBERED_SQL})) WHERE rn = 1
""")
def dedupe_random_ids(spark, sf_dir):
    kept = dedupe.keep_one_per_key(_numbered(spark, sf_dir), ["event_id", "user_id", "event_type", "ts"], ["row_id"])
    return kept.select("event_id", "user_id", "event_type", "row_id")


@query("hot_key_dedupe", f"""
SELECT event_type, row_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY row_id) AS rn FROM ({_NUMBERED_SQL})) WHERE rn = 1
""")
def hot_key_dedupe(spark, sf_dir):
    """Five groups hold all rows: each task sends one row per group."""
    return dedupe.keep_one_per_key(_numbered(spark, sf_dir), ["event_type"], ["row_id"]).select(
        "event_type", "row_id")


@query("surplus_copies", f"""
SELECT event_id, count(*) - 1 AS surplus FROM ({_COPIES_SQL}) GROUP BY 1 HAVING count(*) > 1
""")
def surplus_copies(spark, sf_dir):
    return dedupe.copies_per_key(_copies(spark, sf_dir), ["event_id"])


@query("cascade_children", f"""
WITH kept AS (
  SELECT row_id FROM (SELECT *, row_number() OVER (PARTITION BY event_id, user_id, event_type, ts ORDER BY row_id) AS rn
                      FROM ({_NUMBERED_SQL})) WHERE rn = 1)
SELECT row_id, value FROM ({_NUMBERED_SQL}) WHERE row_id IN (SELECT row_id FROM kept)
""")
def cascade_children(spark, sf_dir):
    readings = _numbered(spark, sf_dir)
    survivors = dedupe.keep_one_per_key(readings, ["event_id", "user_id", "event_type", "ts"], ["row_id"])
    return dedupe.cascade(conform.child_rows(readings, "row_id", "value"), survivors, ["row_id"])


_SENSORS = Table(
    "sensors", "sensor_id string, event_type string, value double",
    natural_key=("event_type",), generated_id="sensor_id")
_READINGS = Table("readings", "reading_id string, event_id bigint, ts timestamp", day_of="ts")


@query("bulk_keyed_append", f"""
SELECT {guid('readings', 'event_id')} AS reading_id, event_id, ts FROM events
""")
def bulk_keyed_append(spark, sf_dir):
    """Keyed rows written as three loads, one of them repeated, and read back."""
    root = shared_folder(spark, "append")
    rows = conform.with_id(table(spark, sf_dir, "events"), "reading_id", "readings", ["event_id"]).withColumn(
        "ts", F.col("ts").cast("timestamp"))
    is_error, is_view = F.col("event_type") == "error", F.col("event_type") == "view"
    load_table(rows.filter(is_error), root, _READINGS, "errors")
    load_table(rows.filter(is_view), root, _READINGS, "views")
    load_table(rows.filter(~is_error & ~is_view), root, _READINGS, "rest")
    load_table(rows.filter(is_view), root, _READINGS, "views")
    return read_table(spark, root, _READINGS).select(
        "reading_id", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("dimension_scan", f"""
SELECT {guid('sensors', 'event_type')} AS sensor_id, event_type, arg_min(value, (ts, event_id)) AS value
FROM events GROUP BY event_type
""")
def dimension_scan(spark, sf_dir):
    """A dimension loaded twice, the second time with other attributes, and read back."""
    root = shared_folder(spark, "dimension")
    events = table(spark, sf_dir, "events").withColumns(
        {"_seen_at": F.col("ts"), "_seen_id": F.col("event_id")})
    load_table(events, root, _SENSORS, "first")
    load_table(events.withColumn("value", F.col("value") + 1), root, _SENSORS, "second")
    return read_table(spark, root, _SENSORS).distinct()
