"""The water feed: orders as polled documents, its eleven tables, and the wide history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindings.registry import guid, landed, query, table
from sensorloom.functions.keys import surrogate_key
from sensorloom.plans import water
from sensorloom.sources.documents import read_documents, readable
from sensorloom.sources.schemas import WATER_POLL
from sensorloom.plans.load import load_batch
from sensorloom.session import shared_folder
from sensorloom.sources.tables import dimension_rows, read_tables


def polls(spark, sf_dir) -> DataFrame:
    """Polled documents that landed as JSON."""
    folder = landed(spark, sf_dir, "water", "orders", _orders_as_polls)
    return readable(read_documents(spark, folder, WATER_POLL))


def _orders_as_polls(orders: DataFrame) -> DataFrame:
    """Urgent orders are failed fetches, P orders report two channels, F orders no update time."""
    status, key = F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    mode = F.left("o_orderpriority", F.lit(1)).cast("int")

    def analog(number: int, name: str, units: str):
        return F.struct(
            F.lit(str(number)).alias("aid"), F.lit(name).alias("name"), F.lit(units).alias("units"),
            key.alias("value"), F.lit("0").alias("recharge"), F.lit("1.5").alias("cycle_pulses"),
            F.lit("0").alias("start"), F.lit("10.25").alias("stop"), F.lit("2").alias("dp"))

    both = F.array(analog(1, "flow", "l"), analog(2, "level", "m"))
    block = F.struct(
        mode.alias("mode"), F.when(status != "F", stamp).alias("last_update"),
        F.when(status == "P", both).otherwise(F.slice(both, 1, 1)).alias("analogs"),
        F.array(F.struct(
            F.lit("7").alias("oid"), F.concat(F.lit("valve "), key).alias("name"), (mode + 10).alias("mode"),
            F.lit(1).alias("status"), F.lit("on").alias("high_state"), F.lit("off").alias("low_state"),
            F.when(status == "O", stamp).alias("last_update"))).alias("outputs"),
        F.array(F.struct(
            F.lit("3").alias("aid"), F.lit("leak").alias("name"), F.lit(4).alias("type"), mode.alias("status"),
            F.lit("pulses").alias("pulse_units"), F.lit("ok").alias("healthy_name"),
            F.lit(None).cast("string").alias("faulty_name"), F.lit("12.5").alias("pulse_total"),
            F.when(status == "P", stamp).alias("last_change"))).alias("alarms"))
    document = F.struct(
        F.when(status == "O", "false").otherwise("true").alias("success"), F.lit("read").alias("message"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+01:00'").alias("now"),
        F.struct(F.concat(F.lit("d "), key).alias("name"), F.lit("Europe/London").alias("tz"),
                 F.lit(15).alias("update_cycle"), F.when(status != "P", stamp).alias("last_update")).alias("details"),
        F.array(block, block).alias("blocks"))
    return orders.select(
        F.struct(F.col("o_custkey").cast("int").alias("id"), F.concat(F.lit("unit "), key).alias("name"))
        .alias("unit"),
        F.when(F.col("o_orderpriority") != "1-URGENT", document).alias("document"))


WATER_SQL = f"""
  base AS (
    SELECT o_custkey AS u, o_orderstatus AS s, o_orderdate AS d, cast(left(o_orderpriority, 1) AS integer) AS m,
           {guid('water_units', 'o_custkey')} AS "unitGUID",
           {guid('water_requests', 'o_custkey', "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+01:00'")}
             AS "requestGUID"
    FROM orders WHERE o_orderpriority <> '1-URGENT'),
  analogs AS (
    SELECT *, {guid('water_readings', '"requestGUID"', 'pos')} AS "readingGUID",
           {guid('water_measure_units', 'units')} AS "mUnitGUID", {guid('water_sensors', 'name')} AS "sensorGUID"
    FROM (SELECT *, 0 AS pos, 'flow' AS name, 'l' AS units FROM base
          UNION ALL SELECT *, 1, 'level', 'm' FROM base WHERE s = 'P')),
  outputs AS (SELECT *, {guid('water_outputs', '"requestGUID"', '0')} AS "outputGUID" FROM base),
  alarms AS (SELECT *, {guid('water_alarms', '"requestGUID"', '0')} AS "alarmGUID" FROM base)
"""

_NO_TEXT = "NULL::varchar"


def _coded(stem: str, values: str) -> str:
    return f"""
        SELECT {guid(f'water_{stem}s' if stem != 'status' else 'water_statuses', 'c')} AS "{stem}GUID",
               cast(c AS integer) AS "{stem}ID", {_NO_TEXT} AS "{stem}Name" FROM (SELECT DISTINCT c FROM ({values}))"""


_TABLE_SQL = {
    "water_units": """
        SELECT DISTINCT "unitGUID", cast(u AS integer) AS "unitID", 'unit ' || u AS "unitName" FROM base""",
    "water_modes": _coded("mode", "SELECT m AS c FROM base UNION ALL SELECT m + 10 FROM base"),
    "water_statuses": _coded("status", "SELECT m AS c FROM base UNION ALL SELECT 1 FROM base"),
    "water_types": _coded("type", "SELECT 4 AS c FROM base"),
    "water_measure_units": f"""
        SELECT {guid('water_measure_units', 'n')} AS "mUnitGUID", n AS "mUnitName"
        FROM (SELECT DISTINCT units AS n FROM analogs UNION SELECT 'pulses' FROM base)""",
    "water_sensors": 'SELECT DISTINCT "sensorGUID", name AS "sensorName" FROM analogs',
    "water_requests": f"""
        SELECT "requestGUID", "unitGUID", {guid('water_modes', 'm')} AS "modeGUID", s <> 'O' AS success,
               'read' AS "requestMessage", d - INTERVAL 1 HOUR AS "requestNow", 'd ' || u AS "requestName",
               'Europe/London' AS tz, 15 AS "updateCycle" FROM base""",
    "water_readings": """
        SELECT "readingGUID", "unitGUID", "mUnitGUID", "sensorGUID", cast(pos + 1 AS integer) AS "analogID",
               cast(u AS varchar) AS "readingValue", 0 AS recharge, 1.5::double AS "cyclePulses",
               0::double AS "readingStart", 10.25::double AS "readingStop", 2 AS dp FROM analogs""",
    "water_outputs": f"""
        SELECT "outputGUID", "unitGUID", {guid('water_modes', 'm + 10')} AS "modeGUID",
               {guid('water_statuses', '1')} AS "statusGUID", 7 AS "outputID", 'valve ' || u AS "outputName",
               'on' AS "highState", 'off' AS "lowState" FROM outputs""",
    "water_alarms": f"""
        SELECT "alarmGUID", "unitGUID", {guid('water_types', '4')} AS "typeGUID",
               {guid('water_statuses', 'm')} AS "statusGUID", {guid('water_measure_units', "'pulses'")} AS "mUnitGUID",
               3 AS "alarmID", 'leak' AS "alarmName", 'ok' AS "healthyName", {_NO_TEXT} AS "faultyName",
               12.5::double AS "pulseTotal" FROM alarms""",
    "water_updates": f"""
        SELECT "requestGUID", {_NO_TEXT} AS "alarmGUID", {_NO_TEXT} AS "readingGUID", {_NO_TEXT} AS "outputGUID",
               d AS "lastUpdate" FROM base WHERE s <> 'P'
        UNION ALL SELECT NULL, NULL, "readingGUID", NULL, d FROM analogs WHERE s <> 'F'
        UNION ALL SELECT NULL, NULL, NULL, "outputGUID", d FROM outputs WHERE s = 'O'
        UNION ALL SELECT NULL, "alarmGUID", NULL, NULL, d FROM alarms WHERE s = 'P'""",
}


def stored(frames: dict[str, DataFrame], name: str) -> DataFrame:
    spec = water.TABLES[name]
    rows = dimension_rows(frames[name], spec) if spec.is_dimension else frames[name].select(*spec.schema.names)
    times = [field.name for field in rows.schema if field.dataType.typeName() == "timestamp"]
    return rows.withColumns({column: F.col(column).cast("timestamp_ntz") for column in times})


def _register(name: str) -> None:
    @query(name, f"WITH {WATER_SQL} {_TABLE_SQL[name]}")
    def stored_table(spark, sf_dir):
        return stored(water.build(polls(spark, sf_dir)), name)


for _name in _TABLE_SQL:
    _register(_name)


# History: events as wide rows of three channels; orders say which sensors a unit's channels have.
_HISTORY_SQL = f"""
  wide AS (SELECT event_id AS "ID", user_id AS "INTERFACE_ID", ts AS "DATETIME", event_id AS "AI1", user_id AS "AI2",
                  CASE WHEN event_type <> 'error' THEN length(event_type) END AS "AI3" FROM events),
  long AS (SELECT "ID", "INTERFACE_ID" AS "unitID", "DATETIME", cast(ltrim(n, 'AI') AS bigint) AS "analogID",
                  v AS "readingValue"
           FROM (FROM wide UNPIVOT INCLUDE NULLS (v FOR n IN ("AI1", "AI2", "AI3")))),
  units AS (SELECT {guid('water_units', 'c_custkey')} AS "unitGUID", c_custkey AS "unitID", c_name AS "unitName"
            FROM customer WHERE c_acctbal > 0),
  catalogue AS (SELECT DISTINCT {guid('water_sensors', 'o_orderstatus')} AS "sensorGUID",
                       {guid('water_units', 'o_custkey')} AS "unitGUID",
                       cast(left(o_orderpriority, 1) AS bigint) AS "analogID",
                       {guid('water_measure_units', 'o_orderstatus')} AS "mUnitGUID",
                       'sensor ' || o_orderstatus AS "sensorName"
                FROM orders)
"""


def _history(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    long = water.long_history(events.select(
        F.col("event_id").alias("ID"), F.col("user_id").alias("INTERFACE_ID"), F.col("ts").alias("DATETIME"),
        F.col("event_id").alias("AI1"), F.col("user_id").alias("AI2"),
        F.when(kind != "error", F.length(kind).cast("bigint")).alias("AI3")))
    units = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        surrogate_key("water_units", "c_custkey").alias("unitGUID"), F.col("c_custkey").alias("unitID"),
        F.col("c_name").alias("unitName"))
    orders = table(spark, sf_dir, "orders")
    readings = orders.select(
        surrogate_key("water_sensors", "o_orderstatus").alias("sensorGUID"),
        surrogate_key("water_units", "o_custkey").alias("unitGUID"),
        F.left("o_orderpriority", F.lit(1)).cast("bigint").alias("analogID"),
        surrogate_key("water_measure_units", "o_orderstatus").alias("mUnitGUID"))
    sensors = orders.select(
        surrogate_key("water_sensors", "o_orderstatus").alias("sensorGUID"),
        F.concat(F.lit("sensor "), "o_orderstatus").alias("sensorName"))
    return long, units, water.sensor_catalogue(readings, sensors)


@query("history_rekey", f"""
WITH {_HISTORY_SQL}
SELECT "ID", "DATETIME", long."analogID", "readingValue", "unitName", "sensorName",
       replace("sensorName", 'sensor', 'unit') AS "mUnitName", units."unitGUID", "sensorGUID", "mUnitGUID"
FROM long JOIN units ON long."unitID" = units."unitID"
     JOIN catalogue ON catalogue."unitGUID" = units."unitGUID" AND catalogue."analogID" = long."analogID"
""")
def history_rekey(spark, sf_dir):
    long, units, catalogue = _history(spark, sf_dir)
    names = table(spark, sf_dir, "orders").select(
        surrogate_key("water_measure_units", "o_orderstatus").alias("mUnitGUID"),
        F.concat(F.lit("unit "), "o_orderstatus").alias("mUnitName"))
    return water.rekey_history(long, units, catalogue, names).select(
        "ID", "DATETIME", "analogID", "readingValue", "unitName", "sensorName", "mUnitName", "unitGUID", "sensorGUID",
        "mUnitGUID")


_LOADED_SQL = """
  loaded AS (
    SELECT "ID", "unitID", "DATETIME", long."analogID", "readingValue", units."unitGUID", s."sensorGUID",
           m."mUnitGUID"
    FROM long JOIN units USING ("unitID")
    LEFT JOIN (SELECT "unitGUID", "analogID", min("sensorGUID") AS "sensorGUID" FROM catalogue GROUP BY 1, 2) s
      ON s."unitGUID" = units."unitGUID" AND s."analogID" = long."analogID"
    LEFT JOIN (SELECT "unitGUID", "sensorGUID", min("mUnitGUID") AS "mUnitGUID" FROM catalogue GROUP BY 1, 2) m
      ON m."unitGUID" = units."unitGUID" AND m."sensorGUID" = s."sensorGUID")
"""


@query("history_load", f"""
WITH {_HISTORY_SQL}, {_LOADED_SQL}
SELECT "unitGUID", "mUnitGUID", "sensorGUID", cast("analogID" AS integer) AS "analogID",
       cast("readingValue" AS varchar) AS "readingValue", "DATETIME" AS "lastUpdate"
FROM loaded
""")
def history_load(spark, sf_dir):
    frames, _ = water.load_history(*_history(spark, sf_dir))
    return frames["water_readings"].join(frames["water_updates"], "readingGUID").select(
        "unitGUID", "mUnitGUID", "sensorGUID", "analogID", "readingValue",
        F.col("lastUpdate").cast("timestamp_ntz").alias("lastUpdate"))


@query("history_unknown_units", f"""
WITH {_HISTORY_SQL}
SELECT "ID", "unitID", "analogID" FROM long WHERE "unitID" NOT IN (SELECT "unitID" FROM units)
""")
def history_unknown_units(spark, sf_dir):
    return water.load_history(*_history(spark, sf_dir))[1].select("ID", "unitID", "analogID")


@query("sensor_catalogue", f"WITH {_HISTORY_SQL} SELECT * FROM catalogue")
def sensor_catalogue(spark, sf_dir):
    return _history(spark, sf_dir)[2]


@query("water_from_unit_lists", """
SELECT s_suppkey::int AS "unitID", s_name AS "unitName", CASE WHEN s_acctbal < 0 THEN 'no document' ELSE 'stored' END AS outcome
FROM supplier
UNION ALL SELECT -s_suppkey::int, NULL, 'unit in no list' FROM supplier WHERE s_nationkey = 7
""")
def water_from_unit_lists(spark, sf_dir):
    """Suppliers as units of one list per nation, their documents in files of their own; some were not fetched."""
    lists, fetched, root = (shared_folder(spark, name) for name in ("lists", "documents", "tables"))
    suppliers = table(spark, sf_dir, "supplier")
    poll, unit = F.col("s_nationkey").alias("poll"), F.col("s_suppkey").cast("string")
    suppliers.groupBy(poll).agg(F.collect_list(F.struct(unit.alias("id"), F.col("s_name").alias("name"))).alias("units")) \
        .write.partitionBy("poll").json(lists)
    block = F.struct(F.lit("1").alias("mode"), F.lit("2024-01-01 00:00:00").alias("last_update"))
    strays = suppliers.filter("s_nationkey = 7").withColumns({"s_suppkey": -F.col("s_suppkey"), "s_acctbal": F.lit(0.0)})
    documents = suppliers.unionByName(strays).filter("s_acctbal >= 0").select(
        poll, F.col("s_suppkey").alias("unit"), F.lit("true").alias("success"), F.lit("read").alias("message"),
        F.lit("2024-01-01T00:00:00+01:00").alias("now"), F.array(block).alias("blocks"))
    # A file of its own for each unit: all tasks make them, and each moves its own into place.
    documents.repartition(4 * spark.sparkContext.defaultParallelism, "poll", "unit").write.option(
        "mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("poll", "unit").json(fetched)
    polls = water.read_polls(spark, lists, fetched)
    rejected = load_batch(polls, water.prepare, water.tables, water.TABLES, root, "all", shared_folder(spark, "staging"), water.stage)
    stored = read_tables(spark, root, water.TABLES)
    requests = stored["water_requests"].join(stored["water_units"], "unitGUID")
    return requests.select("unitID", "unitName", F.lit("stored").alias("outcome")).unionAll(
        rejected.select(F.col("unit.id").cast("int"), "unit.name", "reject_reason"))
