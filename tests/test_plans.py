"""Physical plans that must not come back, and settings that must be refused."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bindings import QUERIES
from bindings.indoor_feed import stored_indoor
from bindings.stored import _water
from sensorloom.functions.temporal import seconds_of
from sensorloom.operators import filters
from sensorloom.plans import indoor, reports
from sensorloom.sources import delimited
from sensorloom.sources.tables import load_tables, read_table, dimension_rows

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_dimensions_without_attributes_are_hashed(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "networkID int, other string")
    frame = dimension_rows(rows, indoor.TABLES["indoor_networks"])
    assert sorted(map(tuple, frame.collect())) == [(1, None), (2, None)]
    assert "SortAggregate" not in plan_of(frame) and "HashAggregate" in plan_of(frame)


def test_known_keys_leave_before_the_rows_are_reduced(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 1, 1, 1), (2, "b", 1, 1, 1)], "n int, sensorName string, applicationID int, networkID int, x int")
    spec = indoor.TABLES["indoor_sensors"]
    for load, part in (("one", rows.filter("n = 1")), ("two", rows.withColumn("networkID", F.lit(9)))):
        load_tables({spec.name: part}, {spec.name: spec}, str(tmp_path), load)
    stored = read_table(spark, str(tmp_path), spec)
    assert sorted((row["sensorName"], row["networkID"]) for row in stored.collect()) == [("a", 1), ("b", 9)]


def test_history_is_joined_by_equality(spark):
    assert "NestedLoop" not in plan_of(QUERIES["history_rekey"](spark, SF_DIR))


@pytest.mark.parametrize("column", ["readingValue", "lastUpdate"])
def test_a_report_of_one_day_reads_the_folders_of_that_day(spark, column):
    day = dt.datetime(1997, 3, 4)
    report = reports.water_report(_water(spark, SF_DIR), start=day, end=day + dt.timedelta(hours=12))
    scans = [line for line in plan_of(report).split("\n") if "FileScan" in line and f"{column}#" in line.split("]")[0]]
    assert scans and all("PartitionFilters: [isnotnull(day" in line for line in scans)


def test_reports_read_stored_tables_only(spark):
    plan = plan_of(reports.indoor_report(stored_indoor(spark, SF_DIR)))
    assert "FileScan json" not in plan and "Generate" not in plan


@pytest.mark.parametrize("period", ["1500ms", "999ms", 0, "2.5s"])
def test_periods_are_whole_seconds(period):
    with pytest.raises(ValueError):
        seconds_of(period)


def test_ranges_may_be_open(spark):
    frame = spark.range(5)
    assert filters.between_exclusive(frame, "id", 1, None).count() == 3
    assert filters.between_exclusive(frame, "id", None, 1).count() == 1
    assert filters.between_exclusive(frame, "id", None, None).count() == 5


def test_logger_files_compile_and_are_cut_into_cells_once(spark, tmp_path):
    """The stage compiles (no fallback to interpretation), and the headers' scan keeps only lines with both names."""
    folder = tmp_path / "logger"
    folder.mkdir()
    (folder / "a.csv").write_text('"DATE";"TIME";"CH1"\n"1/2/2024";"10:00";"1.5"\n31/02/2024;1:00;2\n')
    (folder / "b.csv").write_text("TIME;DATE;CH2\n10:00:01.5;2024-02-01;7\n")
    for name, value in (("spark.sql.codegen.wholeStage", "true"), ("spark.sql.codegen.fallback", "false")):
        spark.conf.set(name, value)
    try:
        rows = delimited.read_logger_long(spark, str(folder))
        found = sorted((str(r["date_time"]), r["channel"], r["value"]) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
        spark.conf.unset("spark.sql.codegen.fallback")
    assert found == [("2024-02-01 10:00:00", "CH1", "1.5"), ("2024-02-01 10:00:01.500000", "CH2", "7")]
    assert plan_of(rows).split("Initial Plan")[0].count("gettimestamp(") == 1
