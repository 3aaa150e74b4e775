"""Reports over the stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from sensorloom.operators.combine import any_rows, newest, newest_first
from sensorloom.operators.filters import between_exclusive, matching
from sensorloom.operators.joins import star_join, with_parent_timestamp

INDOOR_COLUMNS = ("sensorName", "messageDate", "rawData", "dataValue", "dataType", "plotValue", "plotLabel")
WATER_COLUMNS = ("sensorName", "unitName", "mUnitName", "readingValue", "lastUpdate")


def _in_range(df: DataFrame, timestamp: str, start: Any, end: Any, period: str = "day") -> DataFrame:
    """Exclusive range; on tables partitioned by day only the days of the range are read."""
    return between_exclusive(_in_days(df, start, end, period), timestamp, start, end)


def _in_days(df: DataFrame, start: Any, end: Any, period: str) -> DataFrame:
    if "day" in df.columns:
        if start is not None:
            df = df.filter(F.col("day") >= F.to_date(F.date_trunc(period, F.lit(start))))
        if end is not None:
            df = df.filter(F.col("day") <= F.to_date(F.lit(end)))
    return df


def indoor_report(tables: Mapping[str, DataFrame], start: Any = None, end: Any = None) -> DataFrame:
    """Readings with their sensor, data type and plot label, newest first."""
    return newest_first(_indoor_rows(tables, start, end), "messageDate", ("sensorName", "rawData", "plotLabel"))


def _indoor_rows(tables: Mapping[str, DataFrame], start: Any, end: Any, also: Sequence[str] = ()) -> DataFrame:
    readings = _in_range(tables["indoor_readings"], "messageDate", start, end)
    return star_join(readings, [
        (tables["indoor_sensors"].select("sensorID", "sensorName"), "sensorID"),
        (tables["indoor_plot_labels"], "plotLabelID"),
        (tables["indoor_data_types"], "dataTypeID"),
    ]).select(*INDOOR_COLUMNS, *also)


def indoor_sample(tables: Mapping[str, DataFrame], count: int = 1000, ordered: bool = False) -> DataFrame:
    """Some rows of the report, or its newest ones."""
    rows = _indoor_rows(tables, None, None)
    if ordered:
        return newest(rows, count, "messageDate", [name for name in INDOOR_COLUMNS if name != "messageDate"])
    return any_rows(rows, count)


def water_report(
    tables: Mapping[str, DataFrame], sensor: str | None = None, unit: str | None = None,
    start: Any = None, end: Any = None,
) -> DataFrame:
    """Readings with sensor, unit, measure unit and update time, newest first.

    The small tables are joined first, so that a sensor or unit filter thins the readings before
    they meet the updates, which are as many as the readings.
    """
    # A stored reading lies in the day of its update.
    readings = star_join(_in_days(tables["water_readings"], start, end, "month").select(
        "readingGUID", "sensorGUID", "unitGUID", "mUnitGUID", "readingValue"), [
        (matching(tables["water_sensors"], {"sensorName": sensor}), "sensorGUID"),
        (matching(tables["water_units"], {"unitName": unit}), "unitGUID"),
        (tables["water_measure_units"], "mUnitGUID"),
    ])
    updates = _in_range(tables["water_updates"], "lastUpdate", start, end, "month")
    rows = with_parent_timestamp(readings, updates, "readingGUID", "lastUpdate")
    return newest_first(rows, "lastUpdate", ("readingGUID",)).select(*WATER_COLUMNS)
