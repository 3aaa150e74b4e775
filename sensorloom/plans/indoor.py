"""Indoor sensor messages: one message carries several measurands, stored in ten tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions.keys import micros_key, surrogate_key
from sensorloom.functions.temporal import epoch_wrapper_to_timestamp
from sensorloom.functions.text import literal_alternation
from sensorloom.operators.clean import (
    align_particulate, cast_columns, cast_failures, flag_word_unknown, flag_words_to_boolean, particulate_too_short,
    rename_columns, split_rejects, trim_suffix_by_prefix, with_reject_reason,
)
from sensorloom.operators.conform import child_rows
from sensorloom.operators.filters import drop_null_keys
from sensorloom.operators.joins import left_enrich
from sensorloom.operators.reshape import split_parallel
from sensorloom.sources.tables import Table

_READING_REF = ((("readingID", "dataMessageGUID"), "indoor_readings", ("readingID", "dataMessageGUID")),)


def _status(name: str, column: str) -> Table:
    return Table(
        name, f"readingID string, dataMessageGUID string, {column}",
        required=("readingID", "dataMessageGUID"), references=_READING_REF, one_for=("readingID", "dataMessageGUID"),
        day_of="messageDate")


TABLES = {table.name: table for table in (
    Table("indoor_applications", "applicationID int, applicationName string",
          natural_key=("applicationID",), primary_key=("applicationID",), max_length={"applicationName": 20}),
    Table("indoor_networks", "networkID int, networkName string",
          natural_key=("networkID",), primary_key=("networkID",), max_length={"networkName": 20}),
    Table("indoor_sensors", "sensorID string, applicationID int, networkID int, sensorName string",
          natural_key=("sensorName",), generated_id="sensorID", primary_key=("sensorID",),
          required=("sensorID", "applicationID", "networkID"),
          references=((("applicationID",), "indoor_applications", ("applicationID",)),
                      (("networkID",), "indoor_networks", ("networkID",)))),
    Table("indoor_data_types", "dataTypeID string, dataType string",
          natural_key=("dataType",), generated_id="dataTypeID", primary_key=("dataTypeID",),
          required=("dataTypeID", "dataType"), max_length={"dataType": 20}),
    Table("indoor_plot_labels", "plotLabelID string, plotLabel string",
          natural_key=("plotLabel",), generated_id="plotLabelID", primary_key=("plotLabelID",),
          required=("plotLabelID", "plotLabel"), max_length={"plotLabel": 20}),
    Table("indoor_readings",
          "readingID string, dataMessageGUID string, sensorID string, dataTypeID string, plotLabelID string, "
          "messageDate timestamp, rawData string, dataValue string, plotValue string",
          primary_key=("readingID", "dataMessageGUID"), day_of="messageDate",
          required=("readingID", "dataMessageGUID", "sensorID", "dataTypeID", "plotLabelID", "messageDate",
                    "dataValue", "plotValue"),
          max_length={"rawData": 10, "dataValue": 10, "plotValue": 10},
          references=((("sensorID",), "indoor_sensors", ("sensorID",)),
                      (("dataTypeID",), "indoor_data_types", ("dataTypeID",)),
                      (("plotLabelID",), "indoor_plot_labels", ("plotLabelID",)))),
    _status("indoor_signal_status", "signalStrength double"),
    _status("indoor_battery_status", "batteryLevel int"),
    _status("indoor_pending_changes", "pendingChange boolean"),
    _status("indoor_sensor_voltage", "voltage double"),
)}

# The columns that make two readings copies of each other.
BUSINESS_KEY = (
    "dataMessageGUID", "sensorID", "dataTypeID", "plotLabelID", "messageDate", "rawData", "dataValue", "plotValue")

# Field names of the REST lists and of the messages.
MESSAGE_NAMES = {
    "MessageDate": "messageDate", "SensorID": "sensorID", "DataMessageGUID": "dataMessageGUID", "State": "state",
    "SignalStrength": "signalStrength", "Voltage": "voltage", "Battery": "batteryLevel", "Data": "rawData",
    "DisplayData": "displayData", "PlotValue": "plotValue",
    "MetNotificationRequirements": "metNotificationRequirements", "GatewayID": "gatewayID",
    "DataValues": "dataValue", "DataTypes": "dataType", "PlotValues": "plotValues", "PlotLabels": "plotLabels",
}
SENSOR_NAMES = {
    "SensorID": "sensorID", "ApplicationID": "applicationID", "SensorName": "sensorName", "AccountID": "accountID"}
GATEWAY_NAMES = {"GatewayID": "gatewayID", "NetworkID": "networkID", "Name": "gatewayName"}


NUMBERS = {
    "networkID": "int", "applicationID": "int", "signalStrength": "double", "voltage": "double", "batteryLevel": "int"}


@dataclass(frozen=True)
class IndoorSettings:
    """Which sensors carry trailing characters, which cells are split and where.

    ``ignore_case`` stores names, types and labels in lower case, so that spellings that differ in
    case are one.
    """

    sensor_types: Sequence[str] = ()
    split_columns: Sequence[str] = ("rawData", "dataValue", "dataType", "plotValues", "plotLabels")
    delimiters: Sequence[str] = ("%7c", "|")
    ignore_case: bool = False

    def __post_init__(self) -> None:
        literal_alternation(self.delimiters)

    @classmethod
    def from_text(cls, sensor_types: str, split_columns: str, delimiters: str) -> IndoorSettings:
        """Settings from list texts: commas between names, asterisks between delimiters."""
        def items(text: str, separator: str) -> list[str]:
            return [item.strip() for item in text.split(separator)]
        return cls(items(sensor_types, ","), items(split_columns, ","), items(delimiters, "*"))


def from_rest(messages: DataFrame, sensors: DataFrame, gateways: DataFrame) -> DataFrame:
    """REST lists joined to messages in the form that :func:`prepare` takes.

    Every message with an id is kept, with NULLs where its sensor or gateway is unknown.  NULL
    sensor or gateway ids match each other.
    """
    named = rename_columns(messages, MESSAGE_NAMES).withColumn(
        "messageDate", epoch_wrapper_to_timestamp(F.col("messageDate")))
    named = drop_null_keys(named, ["dataMessageGUID"])
    with_sensor = left_enrich(named, rename_columns(sensors, SENSOR_NAMES), ["sensorID"], null_safe=True)
    return left_enrich(with_sensor, rename_columns(gateways, GATEWAY_NAMES), ["gatewayID"], null_safe=True)


def prepare(messages: DataFrame, settings: IndoorSettings = IndoorSettings()) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected messages): cleaned messages with one row per measurand and its ids."""
    dated = messages.withColumn("messageDate", F.col("messageDate").try_cast("timestamp"))
    if settings.sensor_types:
        dated = trim_suffix_by_prefix(dated, settings.sensor_types)
    numbers = {name: kind for name, kind in NUMBERS.items() if name in dated.columns}
    flags = {"pendingChange is no flag": flag_word_unknown("pendingChange")} if "pendingChange" in dated.columns else {}
    judged = with_reject_reason(dated, {
        "no message id": F.col("dataMessageGUID").isNull(),
        "unreadable message date": F.col("messageDate").isNull(),
        "too few particulate values": particulate_too_short(),
        **cast_failures(dated, numbers), **flags,
    })
    accepted, rejected = split_rejects(judged)
    typed = cast_columns(accepted, numbers, lenient=True)
    rows = split_parallel(align_particulate(typed), settings.split_columns, settings.delimiters)
    if settings.ignore_case:
        rows = rows.withColumns({name: F.lower(name) for name in ("sensorName", "dataType", "plotLabels")})
    return with_keys(flag_words_to_boolean(rows, "pendingChange")), rejected


def with_keys(rows: DataFrame) -> DataFrame:
    """Rows with the ids of their dimensions and of their reading.

    The reading's id is computed from the business key, so copies of a reading share it.
    """
    keyed = rows.withColumns({
        "sensorID": surrogate_key("indoor_sensors", "sensorName"),
        "dataTypeID": surrogate_key("indoor_data_types", "dataType"),
        "plotLabelID": surrogate_key("indoor_plot_labels", "plotLabels"),
        "plotLabel": F.col("plotLabels"),
        "plotValue": F.col("plotValues"),
    })
    parts = [micros_key(name) if name == "messageDate" else F.col(name) for name in BUSINESS_KEY]
    return keyed.withColumn("readingID", surrogate_key("indoor_readings", *parts))


def tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The rows of :func:`prepare` as rows of the stored tables; children carry the day of their reading."""
    seen = rows.withColumns({"_seen_at": F.col("messageDate"), "_seen_id": F.col("dataMessageGUID")})
    frames = {
        "indoor_networks": rows.select("networkID"),
        "indoor_applications": rows.select("applicationID"),
        "indoor_sensors": seen.select("sensorName", "applicationID", "networkID", "_seen_at", "_seen_id"),
        "indoor_data_types": rows.select("dataType"),
        "indoor_plot_labels": rows.select("plotLabel"),
        "indoor_readings": rows.select(*TABLES["indoor_readings"].schema.names),
        "indoor_signal_status": child_rows(rows, "readingID", "dataMessageGUID", "messageDate", "signalStrength"),
        "indoor_battery_status": child_rows(rows, "readingID", "dataMessageGUID", "messageDate", "batteryLevel"),
        "indoor_sensor_voltage": child_rows(rows, "readingID", "dataMessageGUID", "messageDate", "voltage"),
    }
    if "pendingChange" in rows.columns:
        frames["indoor_pending_changes"] = child_rows(rows, "readingID", "dataMessageGUID", "messageDate", "pendingChange")
    return frames


def build(messages: DataFrame, settings: IndoorSettings = IndoorSettings()) -> dict[str, DataFrame]:
    """Messages straight to table rows, rejected ones left out."""
    return tables(prepare(messages, settings)[0])
