"""Water controllers: polled documents into eleven tables, and the wide history files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sensorloom.functions.keys import surrogate_key
from sensorloom.functions.temporal import offset_timestamp, plain_timestamp
from sensorloom.functions.text import truthy
from sensorloom.operators.clean import REJECT, split_rejects, with_reject_reason
from sensorloom.operators.joins import left_enrich, left_lookup, unique_lookup
from sensorloom.operators.reshape import first_of, number_channels, unpivot_channels
from sensorloom.sources.documents import read_keyed_documents, readable
from sensorloom.sources.schemas import WATER_DOCUMENT, WATER_UNIT
from sensorloom.sources.tables import Table

HISTORY_IDS = ("ID", "INTERFACE_ID", "DATETIME")


def _coded(name: str, stem: str) -> Table:
    return Table(
        name, f"{stem}GUID string, {stem}ID int, {stem}Name string", natural_key=(f"{stem}ID",),
        generated_id=f"{stem}GUID", primary_key=(f"{stem}GUID",), required=(f"{stem}GUID", f"{stem}ID"),
        max_length={f"{stem}Name": 20})


def _ref(column: str, table: str) -> tuple[tuple[str, ...], str, tuple[str, ...]]:
    return (column,), table, (column,)


TABLES = {table.name: table for table in (
    Table("water_units", "unitGUID string, unitID int, unitName string",
          natural_key=("unitID",), generated_id="unitGUID", primary_key=("unitGUID",),
          required=("unitGUID", "unitID", "unitName"), max_length={"unitName": 50}),
    _coded("water_modes", "mode"),
    _coded("water_statuses", "status"),
    _coded("water_types", "type"),
    Table("water_measure_units", "mUnitGUID string, mUnitName string",
          natural_key=("mUnitName",), generated_id="mUnitGUID", primary_key=("mUnitGUID",),
          required=("mUnitGUID", "mUnitName"), max_length={"mUnitName": 20}),
    Table("water_sensors", "sensorGUID string, sensorName string",
          natural_key=("sensorName",), generated_id="sensorGUID", primary_key=("sensorGUID",),
          required=("sensorGUID", "sensorName"), max_length={"sensorName": 20}),
    Table("water_outputs",
          "outputGUID string, unitGUID string, modeGUID string, statusGUID string, outputID int, "
          "outputName string, highState string, lowState string",
          primary_key=("outputGUID",),
          required=("outputGUID", "unitGUID", "modeGUID", "statusGUID", "outputID", "outputName", "highState",
                    "lowState"),
          max_length={"outputName": 50, "highState": 5, "lowState": 5},
          references=(_ref("unitGUID", "water_units"), _ref("modeGUID", "water_modes"),
                      _ref("statusGUID", "water_statuses"))),
    Table("water_requests",
          "requestGUID string, unitGUID string, modeGUID string, success boolean, requestMessage string, "
          "requestNow timestamp, requestName string, tz string, updateCycle int",
          primary_key=("requestGUID",), day_of="requestNow", period="month",
          required=("requestGUID", "unitGUID", "modeGUID", "success", "requestMessage", "requestNow",
                    "requestName", "tz", "updateCycle"),
          max_length={"requestMessage": 35, "requestName": 50, "tz": 25},
          references=(_ref("unitGUID", "water_units"), _ref("modeGUID", "water_modes"))),
    Table("water_alarms",
          "alarmGUID string, unitGUID string, typeGUID string, statusGUID string, mUnitGUID string, alarmID int, "
          "alarmName string, healthyName string, faultyName string, pulseTotal double",
          primary_key=("alarmGUID",),
          required=("alarmGUID", "unitGUID", "typeGUID", "statusGUID", "mUnitGUID", "alarmID", "alarmName",
                    "pulseTotal"),
          max_length={"alarmName": 50, "healthyName": 10, "faultyName": 10},
          references=(_ref("unitGUID", "water_units"), _ref("typeGUID", "water_types"),
                      _ref("statusGUID", "water_statuses"), _ref("mUnitGUID", "water_measure_units"))),
    # The history load leaves ids and cycle columns empty, so only these are required.
    Table("water_readings",
          "readingGUID string, unitGUID string, mUnitGUID string, sensorGUID string, analogID int, "
          "readingValue string, recharge int, cyclePulses double, readingStart double, readingStop double, dp int",
          primary_key=("readingGUID",), day_of="updated", period="month", required=("readingGUID", "unitGUID", "analogID"),
          max_length={"readingValue": 10},
          references=(_ref("unitGUID", "water_units"), _ref("mUnitGUID", "water_measure_units"),
                      _ref("sensorGUID", "water_sensors"))),
    Table("water_updates",
          "requestGUID string, alarmGUID string, readingGUID string, outputGUID string, lastUpdate timestamp",
          required=("lastUpdate",), day_of="lastUpdate", period="month",
          one_parent_of=("requestGUID", "alarmGUID", "readingGUID", "outputGUID"),
          one_for=("requestGUID", "alarmGUID", "readingGUID", "outputGUID"),
          references=(_ref("requestGUID", "water_requests"), _ref("alarmGUID", "water_alarms"),
                      _ref("readingGUID", "water_readings"), _ref("outputGUID", "water_outputs"))),
)}


#: Where the path of a landed file tells its poll, and its unit.
POLL_OF, UNIT_FOLDER, UNIT_FILE = r"/poll=([^/]+)/", r"/unit=([^/]+)/", r"/([^/]+)\.json$"


def read_polls(spark: SparkSession, lists: str, documents: str, multi_line: bool = False) -> DataFrame:
    """(unit, document) from two landed folders: lists of units, and the documents fetched for them.

    Both have a folder ``poll=...`` for each poll, or none if there is only one.  A document belongs to the unit
    of its folder ``unit=...`` or of its file's name.  A listed unit without a document, or with one that cannot
    be read, has a NULL document, and a document whose unit no list names has a unit without a name: :func:`prepare`
    rejects the first, the second with ``unlisted``.
    """
    listing = T.StructType([T.StructField("units", T.ArrayType(WATER_UNIT))])
    listed = readable(read_keyed_documents(spark, lists, listing, {"poll": POLL_OF}, multi_line))
    units = listed.select("poll", F.explode("units").alias("unit")).filter("unit.id IS NOT NULL").distinct()
    fetched = read_keyed_documents(
        spark, documents, WATER_DOCUMENT, {"poll": POLL_OF, "_folder": UNIT_FOLDER, "_file": UNIT_FILE}, multi_line)
    found = readable(fetched).select(
        "poll", F.coalesce(F.nullif("_folder", F.lit("")), "_file").alias("_unit"), F.struct(*WATER_DOCUMENT.names).alias("document"))
    paired = units.join(
        found.withColumnRenamed("poll", "_poll"), (F.col("poll") == F.col("_poll")) & (F.col("unit.id") == F.col("_unit")), "full")
    unit = F.coalesce("unit", F.struct(F.col("_unit").alias("id"), F.lit(None).cast("string").alias("name")))
    return paired.select(unit.alias("unit"), "document", F.col("unit").isNull().alias("unlisted"))


#: Column of staged rows with the poll as it came, of rejected ones only.
POLL = "_poll"


def prepare(polls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(polls, rejected polls).  A failed fetch leaves no document.  Takes polls, or what :func:`stage` makes of them."""
    if POLL not in polls.columns:
        return split_rejects(_judged(polls))
    accepted, rejected = split_rejects(polls)
    return accepted.drop(POLL), rejected.select(f"{POLL}.*", REJECT)


def stage(polls: DataFrame) -> DataFrame:
    """All polls with the reason of their rejection, accepted ones as rows of :func:`_requests`."""
    judged = _judged(polls).withColumn(POLL, F.when(F.col(REJECT).isNotNull(), F.struct(*polls.columns)))
    return _requests(judged, REJECT, POLL)


def _judged(polls: DataFrame) -> DataFrame:
    unlisted = {"unit in no list": F.col("unlisted")} if "unlisted" in polls.columns else {}
    return with_reject_reason(polls, {
        **unlisted,
        "no unit": F.col("unit.id").try_cast("int").isNull(),
        "no document": F.col("document").isNull(),
        "no block": F.coalesce(F.size("document.blocks"), F.lit(0)) < 1,
        "unreadable time": offset_timestamp(F.col("document.now")).isNull(),
    })


def _requests(polls: DataFrame, *also: str) -> DataFrame:
    """Of each poll its ids, the fields of its request and its first block, from which all tables are cut."""
    details = F.col("document.details")
    return polls.select(
        F.col("unit.id").try_cast("int").alias("unitID"), F.col("unit.name").alias("unitName"),
        truthy(F.col("document.success")).alias("success"),
        F.col("document.message").alias("requestMessage"),
        offset_timestamp(F.col("document.now")).alias("requestNow"),
        details.getField("name").alias("requestName"), details.getField("tz").alias("tz"),
        details.getField("update_cycle").try_cast("int").alias("updateCycle"),
        details.getField("last_update").alias("_details_update"),
        F.col("document.now").alias("_now"), first_of(F.col("document.blocks")).alias("block"), *also,
    ).withColumns({
        "unitGUID": surrogate_key("water_units", "unitID"),
        "requestGUID": surrogate_key("water_requests", "unitID", "_now"),
    }).drop("_now")


def _updates(rows: DataFrame, own_key: str, timestamp: Column) -> DataFrame:
    """Timestamp rows of one kind of parent; parents without a timestamp have none."""
    keys = TABLES["water_updates"].one_parent_of
    return rows.select(*[
        F.col(key) if key == own_key else F.lit(None).cast("string").alias(key) for key in keys
    ], timestamp.alias("lastUpdate")).filter("lastUpdate IS NOT NULL")


def tables(polls: DataFrame, use_unit_zone: bool = False) -> dict[str, DataFrame]:
    """Accepted polls, as they came or staged, as rows of the stored tables.

    Update times have no zone.  They are read as UTC, or in the document's zone.
    """
    zone = F.col("tz") if use_unit_zone else None
    shaped = polls if "requestGUID" in polls.columns else _requests(polls)
    mode = F.col("block.mode").try_cast("int")
    requests = shaped.withColumns({"modeID": mode, "modeGUID": surrogate_key("water_modes", mode)})

    def children(array: str, id_column: str, table: str) -> DataFrame:
        return requests.select(
            "unitGUID", "requestGUID", "tz", "requestNow", F.col("block.last_update").alias("_block_update"),
            F.posexplode(f"block.{array}").alias("pos", "item"),
        ).withColumn(id_column, surrogate_key(table, "requestGUID", "pos"))

    item = F.col("item")

    def number(name: str, kind: str = "int") -> Column:
        return item.getField(name).try_cast(kind)

    analogs = children("analogs", "readingGUID", "water_readings").withColumns({
        "mUnitGUID": surrogate_key("water_measure_units", "item.units"),
        "sensorGUID": surrogate_key("water_sensors", "item.name")})
    outputs = children("outputs", "outputGUID", "water_outputs").withColumns({
        "modeGUID": surrogate_key("water_modes", number("mode")),
        "statusGUID": surrogate_key("water_statuses", number("status"))})
    alarms = children("alarms", "alarmGUID", "water_alarms").withColumns({
        "typeGUID": surrogate_key("water_types", number("type")),
        "statusGUID": surrogate_key("water_statuses", number("status")),
        "mUnitGUID": surrogate_key("water_measure_units", "item.pulse_units")})

    def code(rows: DataFrame, column: Column, stem: str) -> DataFrame:
        return rows.select(column.alias(f"{stem}ID"))

    return {
        "water_units": requests.select("unitID", "unitName", F.col("requestNow").alias("_seen_at"),
                                       F.col("requestGUID").alias("_seen_id")),
        "water_modes": code(requests, F.col("modeID"), "mode").unionByName(
            code(outputs, number("mode"), "mode")),
        "water_statuses": code(outputs, number("status"), "status").unionByName(
            code(alarms, number("status"), "status")),
        "water_types": code(alarms, number("type"), "type"),
        "water_measure_units": analogs.select(item.getField("units").alias("mUnitName")).unionByName(
            alarms.select(item.getField("pulse_units").alias("mUnitName"))),
        "water_sensors": analogs.select(item.getField("name").alias("sensorName")),
        "water_requests": requests.select(*TABLES["water_requests"].schema.names),
        "water_readings": analogs.select(
            "readingGUID", "unitGUID", "mUnitGUID", "sensorGUID", number("aid", "int").alias("analogID"),
            item.getField("value").alias("readingValue"), number("recharge", "int").alias("recharge"),
            number("cycle_pulses", "double").alias("cyclePulses"), number("start", "double").alias("readingStart"),
            number("stop", "double").alias("readingStop"), number("dp", "int").alias("dp"),
            # Readings are kept by the time of their update, so that a range of updates finds them.
            F.coalesce(plain_timestamp(F.col("_block_update"), zone), "requestNow").alias("updated")),
        "water_outputs": outputs.select(
            "outputGUID", "unitGUID", "modeGUID", "statusGUID", number("oid", "int").alias("outputID"),
            item.getField("name").alias("outputName"), item.getField("high_state").alias("highState"),
            item.getField("low_state").alias("lowState")),
        "water_alarms": alarms.select(
            "alarmGUID", "unitGUID", "typeGUID", "statusGUID", "mUnitGUID", number("aid", "int").alias("alarmID"),
            item.getField("name").alias("alarmName"), item.getField("healthy_name").alias("healthyName"),
            item.getField("faulty_name").alias("faultyName"),
            number("pulse_total", "double").alias("pulseTotal")),
        "water_updates": (
            _updates(requests, "requestGUID", plain_timestamp(F.col("_details_update"), zone))
            .unionByName(_updates(analogs, "readingGUID", plain_timestamp(F.col("_block_update"), zone)))
            .unionByName(_updates(outputs, "outputGUID", plain_timestamp(item.getField("last_update"), zone)))
            .unionByName(_updates(alarms, "alarmGUID", plain_timestamp(item.getField("last_change"), zone)))),
    }


def build(polls: DataFrame, use_unit_zone: bool = False) -> dict[str, DataFrame]:
    """Polls straight to table rows, rejected ones left out."""
    return tables(prepare(polls)[0], use_unit_zone)


# ---- history files -------------------------------------------------------------------------------


def long_history(wide: DataFrame) -> DataFrame:
    """Wide history (one column per channel) as (ID, unitID, DATETIME, analogID, readingValue)."""
    long = number_channels(unpivot_channels(wide, HISTORY_IDS, name="aid", value="value"))
    return long.withColumnsRenamed({"INTERFACE_ID": "unitID", "aid": "analogID", "value": "readingValue"})


def sensor_catalogue(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """Distinct (sensor, unit, channel, measure unit) of the stored readings, with sensor names.

    The readings are reduced to distinct keys before the join.
    """
    seen = readings.select("sensorGUID", "unitGUID", "analogID", "mUnitGUID").distinct()
    return seen.join(sensors.select("sensorGUID", "sensorName").distinct(), "sensorGUID")


def rekey_history(long: DataFrame, units: DataFrame, catalogue: DataFrame, measure_units: DataFrame) -> DataFrame:
    """History rows with the ids and names of their unit, sensor and measure unit.

    Rows of unknown channels drop out; a channel with several sensors yields a row for each.  The
    small tables are joined with each other first, so the history is joined only once.
    """
    known_units = units.select("unitGUID", "unitID", "unitName").distinct()
    names = measure_units.select("mUnitGUID", "mUnitName").distinct()
    channels = known_units.join(catalogue, "unitGUID").join(names, "mUnitGUID")
    return long.join(channels, ["unitID", "analogID"])


def load_history(long: DataFrame, units: DataFrame, catalogue: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """History rows as rows of the readings and updates tables, and the rows of unknown units.

    A channel without a known sensor keeps its reading with empty sensor and measure unit.
    """
    located = left_lookup(long, units, ["unitID"], ["unitGUID"])
    accepted, rejected = split_rejects(with_reject_reason(located, {"unknown unit": F.col("unitGUID").isNull()}))
    sensors = unique_lookup(catalogue, ["unitGUID", "analogID"], ["sensorGUID"])
    channels = left_lookup(sensors, catalogue, ["unitGUID", "sensorGUID"], ["mUnitGUID"])
    measured = left_enrich(accepted, channels, ["unitGUID", "analogID"]).withColumn(
        "readingGUID", surrogate_key("water_history", "ID", "unitID", "DATETIME", "analogID"))
    readings = measured.select(
        "readingGUID", "unitGUID", "mUnitGUID", "sensorGUID", F.col("analogID").cast("int").alias("analogID"),
        F.col("readingValue").cast("string").alias("readingValue"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in (
            ("recharge", "int"), ("cyclePulses", "double"), ("readingStart", "double"),
            ("readingStop", "double"), ("dp", "int"))], F.col("DATETIME").try_cast("timestamp").alias("updated"))
    updates = _updates(measured, "readingGUID", F.col("DATETIME").try_cast("timestamp"))
    return {"water_readings": readings, "water_updates": updates}, rejected
