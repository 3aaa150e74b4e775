"""The indoor feed from messages to its ten tables, its reports and the flagship query."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, functions as F

from bindings.constraints import constraints_sql
from bindings.registry import guid, landed, once, query, table
from bindings.time_series import _rounded
from bindings.views import MESSAGES_SQL, as_messages, as_text, messages
from sensorloom.operators import metrics, resample
from sensorloom.plans import checks, indoor, reports
from sensorloom.plans.load import load_batch
from sensorloom.session import shared_folder
from sensorloom.sources.documents import read_envelope
from sensorloom.sources.schemas import INDOOR_MESSAGE, REST_GATEWAY, REST_MESSAGE, REST_SENSOR
from sensorloom.sources.tables import dimension_rows, read_table, read_tables

SETTINGS = indoor.IndoorSettings(sensor_types=("Click",))

ROWS_SQL = f"""
  msg AS ({MESSAGES_SQL}),
  trimmed AS (SELECT * REPLACE (CASE WHEN regexp_matches("sensorName", '^click', 'i')
                                     THEN left("rawData", greatest(length("rawData") - 4, 0))
                                     ELSE "rawData" END AS "rawData") FROM msg),
  cut AS (SELECT *, string_split_regex("rawData", '%7c|\\|') AS a, string_split_regex("dataValue", '%7c|\\|') AS b,
                 string_split_regex("dataType", '%7c|\\|') AS c, string_split_regex("plotValues", '%7c|\\|') AS d,
                 string_split_regex("plotLabels", '%7c|\\|') AS e FROM trimmed),
  numbered AS (SELECT *, unnest(range(greatest(len(a), len(b), len(c), len(d), len(e)))) AS i FROM cut),
  parts AS (
    SELECT "dataMessageGUID", "sensorName", "networkID", "applicationID", "messageDate", "signalStrength", "voltage",
           "batteryLevel", CASE "pendingChange" WHEN 'True' THEN true WHEN 'False' THEN false END AS "pendingChange",
           coalesce(a[i + 1], '') AS "rawData", coalesce(b[i + 1], '') AS "dataValue",
           coalesce(c[i + 1], '') AS "dataType", coalesce(d[i + 1], '') AS "plotValue",
           coalesce(e[i + 1], '') AS "plotLabel" FROM numbered),
  keyed AS (
    SELECT *, {guid('indoor_sensors', '"sensorName"')} AS "sensorID",
           {guid('indoor_data_types', '"dataType"')} AS "dataTypeID",
           {guid('indoor_plot_labels', '"plotLabel"')} AS "plotLabelID" FROM parts),
  readings AS (
    SELECT *, {guid('indoor_readings', '"dataMessageGUID"', '"sensorID"', '"dataTypeID"', '"plotLabelID"',
                    'epoch_us("messageDate")', '"rawData"', '"dataValue"', '"plotValue"')} AS "readingID"
    FROM keyed)
"""


def _frames(spark, sf_dir) -> dict[str, DataFrame]:
    return indoor.build(messages(spark, sf_dir), SETTINGS)


def _stored(frames: dict[str, DataFrame], name: str) -> DataFrame:
    """The rows that the load would leave in the table."""
    spec = indoor.TABLES[name]
    return dimension_rows(frames[name], spec) if spec.is_dimension else frames[name].select(*spec.schema.names)


def landed_messages(spark, sf_dir) -> DataFrame:
    """Messages that landed as JSON documents."""
    def documents(events: DataFrame) -> DataFrame:
        sent = as_text(as_messages(events), "messageDate")
        return sent.select(F.array(F.struct(*sent.columns)).alias("sensorMessages"))

    return read_envelope(spark, landed(spark, sf_dir, "indoor", "events", documents), INDOOR_MESSAGE)


def load_indoor(spark, sf_dir, root: str) -> None:
    """All messages as one load; then those with a flag are delivered once more, as another load."""
    sent, staging = landed_messages(spark, sf_dir), shared_folder(spark, "staging")
    prepare = partial(indoor.prepare, settings=SETTINGS)
    load_batch(sent, prepare, indoor.tables, indoor.TABLES, root, "first", staging)
    again = sent.filter("pendingChange IS NOT NULL")
    load_batch(again, prepare, indoor.tables, indoor.TABLES, root, "again", staging)


def stored_indoor(spark, sf_dir) -> dict[str, DataFrame]:
    root = once(spark, sf_dir, "indoor_tables", lambda folder: load_indoor(spark, sf_dir, folder))
    return read_tables(spark, root, indoor.TABLES)


_TABLE_SQL = {
    "indoor_networks": 'SELECT DISTINCT "networkID", NULL::varchar AS "networkName" FROM readings',
    "indoor_applications": 'SELECT DISTINCT "applicationID", NULL::varchar AS "applicationName" FROM readings',
    "indoor_sensors": """
        SELECT "sensorID", arg_min("applicationID", ("messageDate", "dataMessageGUID")) AS "applicationID",
               arg_min("networkID", ("messageDate", "dataMessageGUID")) AS "networkID", "sensorName"
        FROM readings GROUP BY "sensorID", "sensorName" """,
    "indoor_data_types": 'SELECT DISTINCT "dataTypeID", "dataType" FROM readings',
    "indoor_plot_labels": 'SELECT DISTINCT "plotLabelID", "plotLabel" FROM readings',
    "indoor_readings": """
        SELECT "readingID", "dataMessageGUID", "sensorID", "dataTypeID", "plotLabelID", "messageDate", "rawData",
               "dataValue", "plotValue" FROM readings""",
    "indoor_signal_status": 'SELECT "readingID", "dataMessageGUID", "signalStrength" FROM readings',
    "indoor_battery_status": 'SELECT "readingID", "dataMessageGUID", "batteryLevel" FROM readings',
    "indoor_pending_changes": 'SELECT "readingID", "dataMessageGUID", "pendingChange" FROM readings',
    "indoor_sensor_voltage": 'SELECT "readingID", "dataMessageGUID", "voltage" FROM readings',
}


def _register(name: str) -> None:
    @query(name, f"WITH {ROWS_SQL} {_TABLE_SQL[name]}")
    def stored_table(spark, sf_dir):
        rows = _stored(_frames(spark, sf_dir), name)
        if "messageDate" in rows.columns:
            rows = rows.withColumn("messageDate", F.col("messageDate").cast("timestamp_ntz"))
        return rows


for _name in _TABLE_SQL:
    _register(_name)


_REPORT_SQL = """
  SELECT "sensorName", "messageDate", "rawData", "dataValue", "dataType", "plotValue", "plotLabel" FROM readings
"""


@query("indoor_report", f"""
WITH {ROWS_SQL} {_REPORT_SQL}
WHERE "messageDate" > TIMESTAMP '2024-01-05' AND "messageDate" < TIMESTAMP '2024-01-20' ORDER BY "messageDate" DESC
""")
def indoor_report(spark, sf_dir):
    report = reports.indoor_report(stored_indoor(spark, sf_dir), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20))
    return report.withColumn("messageDate", F.col("messageDate").cast("timestamp_ntz"))


@query("indoor_newest_1000", f"""
WITH {ROWS_SQL} {_REPORT_SQL}
ORDER BY "messageDate" DESC, "sensorName", "rawData", "dataValue", "dataType", "plotValue", "plotLabel" LIMIT 1000
""")
def indoor_newest_1000(spark, sf_dir):
    rows = reports.indoor_sample(stored_indoor(spark, sf_dir), 1000, ordered=True)
    return rows.withColumn("messageDate", F.col("messageDate").cast("timestamp_ntz"))


@query("indoor_constraints", constraints_sql(ROWS_SQL, indoor.TABLES, _TABLE_SQL))
def indoor_constraints(spark, sf_dir):
    """All declared constraints of the ten stored tables."""
    return checks.constraint_report(stored_indoor(spark, sf_dir), indoor.TABLES)


@query("load_constraints", constraints_sql(ROWS_SQL, indoor.TABLES, {
    name: sql if indoor.TABLES[name].is_dimension else f'{sql} WHERE "pendingChange" IS NOT NULL' for name, sql in _TABLE_SQL.items()}))
def load_constraints(spark, sf_dir):
    """Constraints of the second of two loads, of which only its own folders are judged."""
    root, staging = shared_folder(spark, "tables"), shared_folder(spark, "staging")
    sent = landed_messages(spark, sf_dir)
    for load, condition in (("plain", "pendingChange IS NULL"), ("flagged", "pendingChange IS NOT NULL")):
        load_batch(sent.filter(condition), partial(indoor.prepare, settings=SETTINGS), indoor.tables, indoor.TABLES, root, load, staging)
    return checks.load_constraint_report(spark, root, indoor.TABLES, "flagged")


@query("indoor_load", f"""
WITH {ROWS_SQL}
SELECT count(*) AS readings, count(DISTINCT "sensorName") AS sensors, count(*) AS voltages
FROM (SELECT DISTINCT "readingID", "sensorName" FROM readings)
""")
def indoor_load(spark, sf_dir):
    """The two loads themselves, into new tables; the second delivery adds nothing."""
    root = shared_folder(spark, "tables")
    load_indoor(spark, sf_dir, root)
    counts = [read_table(spark, root, indoor.TABLES[name]).agg(F.count("*").alias(alias)) for name, alias in (
        ("indoor_readings", "readings"), ("indoor_sensors", "sensors"), ("indoor_sensor_voltage", "voltages"))]
    return counts[0].crossJoin(counts[1]).crossJoin(counts[2])


@query("redelivered_indoor_children", f"""
WITH {ROWS_SQL}
SELECT "readingID", "dataMessageGUID", "voltage", "pendingChange", "signalStrength" FROM readings
""")
def redelivered_indoor_children(spark, sf_dir):
    """Readings with three children after messages came twice: one row each."""
    tables = stored_indoor(spark, sf_dir)
    keys = ["readingID", "dataMessageGUID"]
    rows = tables["indoor_readings"].select(*keys)
    for name in ("indoor_sensor_voltage", "indoor_pending_changes", "indoor_signal_status"):
        rows = rows.join(tables[name].drop("batch", "day"), keys)
    return rows


@query("redelivered_voltage", f"""
WITH {ROWS_SQL}
SELECT "readingID", "voltage", 'first' AS batch FROM readings
""")
def redelivered_voltage(spark, sf_dir):
    """Flagged messages come again with other voltages: a reading keeps the one that it was delivered with first."""
    root, staging = shared_folder(spark, "tables"), shared_folder(spark, "staging")
    sent = landed_messages(spark, sf_dir)
    changed = sent.filter("pendingChange IS NOT NULL").withColumn(
        "voltage", (F.col("voltage").cast("double") + 1).cast("string"))
    for load, documents in (("first", sent), ("second", changed)):
        load_batch(documents, partial(indoor.prepare, settings=SETTINGS), indoor.tables, indoor.TABLES, root, load, staging)
    tables = read_tables(spark, root, indoor.TABLES)
    return tables["indoor_readings"].select("readingID").join(
        tables["indoor_sensor_voltage"].select("readingID", "voltage", "batch"), "readingID")


@query("any_1000", f"WITH {ROWS_SQL} SELECT least(1000, count(*)) AS row_count, 0 AS strangers FROM readings")
def any_1000(spark, sf_dir):
    """Some thousand rows in no order: how many there are, and how many of them the report does not have."""
    tables = stored_indoor(spark, sf_dir)
    some = reports.indoor_sample(tables, 1000)
    strangers = some.exceptAll(reports.indoor_report(tables)).count()
    return some.agg(F.count("*").alias("row_count")).withColumn("strangers", F.lit(strangers))


@query("observed_load", "SELECT count(*) AS seen, count(DISTINCT event_id) AS messages FROM events")
def observed_load(spark, sf_dir):
    """Progress counts that a load takes on its way."""
    sent, observation = metrics.counted(landed_messages(spark, sf_dir), "landed")
    root, staging = shared_folder(spark, "tables"), shared_folder(spark, "staging")
    load_batch(sent, partial(indoor.prepare, settings=SETTINGS), indoor.tables, indoor.TABLES, root, "first", staging)
    stored = read_table(spark, root, indoor.TABLES["indoor_readings"])
    return stored.agg(F.countDistinct("dataMessageGUID").alias("messages")).withColumn(
        "seen", F.lit(observation.get["rows"]).cast("bigint"))


@query("one_sided_range", f"""
WITH {ROWS_SQL}
SELECT 'from' AS side, count(*) AS row_count FROM readings WHERE "messageDate" > TIMESTAMP '2024-01-10'
UNION ALL SELECT 'until', count(*) FROM readings WHERE "messageDate" < TIMESTAMP '2024-01-10'
""")
def one_sided_range(spark, sf_dir):
    """Reports with one bound only."""
    tables, day = stored_indoor(spark, sf_dir), dt.datetime(2024, 1, 10)
    sides = {"from": reports.indoor_report(tables, start=day), "until": reports.indoor_report(tables, end=day)}
    first, second = (
        report.agg(F.count("*").alias("row_count")).withColumn("side", F.lit(side)) for side, report in sides.items())
    return first.unionByName(second)


@query("indoor_rejects", """
SELECT CASE event_type WHEN 'view' THEN 'unreadable message date' ELSE 'networkID is not int' END AS reject_reason,
       count(*) AS messages
FROM events WHERE event_type IN ('view', 'error') GROUP BY 1
""")
def indoor_rejects(spark, sf_dir):
    """Messages with unreadable dates and numbers, read back from a load."""
    kind = F.element_at(F.split("sensorName", " "), 1)
    sent = as_text(messages(spark, sf_dir), "messageDate").withColumns({
        "networkID": F.when(kind == "error", F.lit("none")).otherwise(F.col("networkID").cast("string")),
        "messageDate": F.when(kind == "view", F.lit("soon")).otherwise(F.col("messageDate"))})
    rejected = load_batch(
        sent, partial(indoor.prepare, settings=SETTINGS), indoor.tables, indoor.TABLES, shared_folder(spark, "tables"),
        "first", shared_folder(spark, "staging"))
    return rejected.groupBy("reject_reason").agg(F.count("*").alias("messages"))


_FLAGSHIP_SQL = f"""
WITH {ROWS_SQL},
  copies AS (SELECT DISTINCT "readingID", "messageDate", "dataType", try_cast("dataValue" AS double) AS value
             FROM readings),
  means AS (SELECT "dataType", time_bucket(INTERVAL '60 minutes', "messageDate") AS "messageDate",
                   round(avg(value), 6) AS value FROM copies GROUP BY 1, 2),
  grid AS (SELECT "dataType", unnest(generate_series(min("messageDate"), max("messageDate"), INTERVAL '60 minutes'))
             AS "messageDate" FROM means GROUP BY "dataType")
SELECT grid."dataType", grid."messageDate", means.value
FROM grid LEFT JOIN means ON means."dataType" = grid."dataType" AND means."messageDate" = grid."messageDate"
"""


@query("indoor_flagship", _FLAGSHIP_SQL)
def indoor_flagship(spark, sf_dir):
    """Messages, many of them delivered twice, in conformed tables; their report is resampled."""
    return _resampled_report(stored_indoor(spark, sf_dir))


@query("indoor_messages_to_report", _FLAGSHIP_SQL)
def indoor_messages_to_report(spark, sf_dir):
    """The whole way in one: both deliveries are loaded into new tables, and these are reported."""
    root = shared_folder(spark, "tables")
    load_indoor(spark, sf_dir, root)
    return _resampled_report(read_tables(spark, root, indoor.TABLES))


def _resampled_report(tables):
    report = reports._indoor_rows(tables, None, None)
    numeric = report.select("dataType", "messageDate", F.col("dataValue").try_cast("double").alias("value"))
    grid = resample.resample_grid(numeric, "messageDate", ["value"], "60min", ["dataType"])
    return _rounded(grid, "value").withColumn("messageDate", F.col("messageDate").cast("timestamp_ntz"))


_REST_SQL = """
WITH m AS (SELECT cast(event_id AS varchar) AS "dataMessageGUID", user_id AS "sensorID",
                  CASE WHEN event_type <> 'error' THEN length(event_type) END AS "gatewayID",
                  date_trunc('second', ts) AS "messageDate", value AS "voltage" FROM events
           WHERE event_type <> 'signup')
SELECT "dataMessageGUID", "sensorID", m."gatewayID", "messageDate", "voltage", c_name AS "sensorName",
       n_name AS "gatewayName"
FROM m LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = "sensorID"
       LEFT JOIN (SELECT CASE WHEN n_nationkey > 0 THEN n_nationkey END AS g, n_name FROM nation)
              ON g IS NOT DISTINCT FROM m."gatewayID"
"""


@query("indoor_from_rest", _REST_SQL)
def indoor_from_rest(spark, sf_dir):
    """REST lists: wrapped epochs, a message list, a sensor list and a gateway list."""
    kind = F.col("event_type")
    listed = table(spark, sf_dir, "events").select(
        F.when(kind != "signup", F.col("event_id").cast("string")).alias("DataMessageGUID"),
        F.col("user_id").alias("SensorID"),
        F.when(kind != "error", F.length(kind).cast("bigint")).alias("GatewayID"),
        F.concat(F.lit("/Date("), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.lit(")/"))
        .alias("MessageDate"),
        F.col("value").alias("Voltage"))
    sensors = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("SensorID"), F.col("c_name").alias("SensorName"))
    gateways = table(spark, sf_dir, "nation").select(
        F.when(F.col("n_nationkey") > 0, F.col("n_nationkey").cast("bigint")).alias("GatewayID"),
        F.col("n_name").alias("Name"))
    return indoor.from_rest(listed, sensors, gateways).select(
        "dataMessageGUID", "sensorID", "gatewayID", F.col("messageDate").cast("timestamp_ntz").alias("messageDate"),
        "voltage", "sensorName", "gatewayName")


@query("rest_readings", f"""
WITH {ROWS_SQL}
SELECT "dataMessageGUID", c_name AS "sensorName", date_trunc('second', "messageDate") AS "messageDate", "rawData",
       "dataValue", "dataType", "plotValue", "plotLabel"
FROM (SELECT * REPLACE (CASE WHEN "rawData" <> '' THEN "rawData" END AS "rawData") FROM (
        SELECT "dataMessageGUID", "networkID" AS n, "messageDate", coalesce(a2[i + 1], '') AS "rawData",
               coalesce(b[i + 1], '') AS "dataValue", coalesce(c[i + 1], '') AS "dataType",
               coalesce(d[i + 1], '') AS "plotValue", coalesce(e[i + 1], '') AS "plotLabel"
        FROM (SELECT *, unnest(range(greatest(len(a2), len(b), len(c), len(d), len(e)))) AS i
              FROM (SELECT *, string_split("rawData", '%7c') AS a2, string_split("dataValue", '|') AS b,
                           string_split("dataType", '|') AS c, string_split("plotValues", '|') AS d,
                           string_split("plotLabels", '|') AS e FROM msg)))) r
JOIN customer ON c_custkey = n
""")
def rest_readings(spark, sf_dir):
    """REST lists as JSON with a ``Result`` each, joined, split into readings and read back from the tables."""
    folder = shared_folder(spark, "rest")
    sent = messages(spark, sf_dir)
    listed = sent.select(
        F.col("dataMessageGUID").alias("DataMessageGUID"), F.col("networkID").alias("SensorID"),
        F.lit("g").alias("GatewayID"), F.col("rawData").alias("Data"), F.col("dataValue").alias("DataValues"),
        F.col("dataType").alias("DataTypes"), F.col("plotValues").alias("PlotValues"), F.col("plotLabels").alias("PlotLabels"),
        F.concat(F.lit("/Date("), F.unix_millis(F.col("messageDate").cast("timestamp")).cast("string"), F.lit(")/"))
        .alias("MessageDate"), F.col("voltage").alias("Voltage"), F.col("signalStrength").alias("SignalStrength"),
        F.col("batteryLevel").alias("Battery"))
    sensors = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("SensorID"), F.lit(1).alias("ApplicationID"), F.col("c_name").alias("SensorName"))
    gateways = spark.range(1).select(F.lit("g").alias("GatewayID"), F.lit(7).alias("NetworkID"), F.lit("hall").alias("Name"))
    read = {}
    for name, rows, schema in (
            ("messages", listed, REST_MESSAGE), ("sensors", sensors, REST_SENSOR), ("gateways", gateways, REST_GATEWAY)):
        rows.select(F.array(F.struct(*rows.columns)).alias("Result")).write.json(f"{folder}/{name}")
        read[name] = read_envelope(spark, f"{folder}/{name}", schema, "Result")
    joined = indoor.from_rest(read["messages"], read["sensors"], read["gateways"])
    root = shared_folder(spark, "tables")
    load_batch(joined, indoor.prepare, indoor.tables, indoor.TABLES, root, "rest", shared_folder(spark, "staging"))
    tables = read_tables(spark, root, indoor.TABLES)
    rows = tables["indoor_readings"].select("dataMessageGUID", "readingID").join(
        reports._indoor_rows({**tables}, None, None, ("readingID",)), "readingID").drop("readingID")
    return rows.withColumn("messageDate", F.col("messageDate").cast("timestamp_ntz"))
