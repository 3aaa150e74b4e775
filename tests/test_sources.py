import datetime as dt

from pyspark.sql import functions as F, types as T

from sensorloom.plans import logger
from sensorloom.sources import delimited, landing
from sensorloom.sources.documents import read_documents

QUOTED = r'''"DATE";"TIME";"10668";"106\;70"
"29/03/2021";"12:00:00";"1.5";"2"
"29/03/2021";"12:09:59";"2.5";""

"30/02/2021";"12:00:00";"9";"9"
"29/03/2021";"12:30:00";"3"
'''
PLAIN = '''DATE;10670;TIME
1/4/2021;7;0:05:00
'''


def _logger_folder(tmp_path):
    folder = tmp_path / "logger"
    folder.mkdir()
    (folder / "a.csv").write_text(QUOTED)
    (folder / "b.csv").write_text(PLAIN)
    return str(folder)


def test_logger_files_keep_their_own_headers(spark, tmp_path):
    rows = logger.merged_wide(spark, _logger_folder(tmp_path), ["10668", "10670", "106;70"]).orderBy("date_time")
    assert [tuple(row) for row in rows.collect()] == [
        (dt.datetime(2021, 3, 29, 12), 1.5, None, 2.0), (dt.datetime(2021, 3, 29, 12, 9, 59), 2.5, None, None),
        (dt.datetime(2021, 3, 29, 12, 30), 3.0, None, None), (dt.datetime(2021, 4, 1, 0, 5), None, 7.0, None)]


def test_logger_long_has_every_cell(spark, tmp_path):
    cells = delimited.read_logger_long(spark, _logger_folder(tmp_path))
    found = sorted((row.channel, row.value or "") for row in cells.collect())
    assert found == [("10668", "1.5"), ("10668", "2.5"), ("10668", "3"), ("10670", "7"), ("106;70", ""),
                     ("106;70", ""), ("106;70", "2")]


def test_logger_resampled_is_gapless(spark, tmp_path):
    merged = logger.merged_wide(spark, _logger_folder(tmp_path), ["10668"])
    grid = logger.resampled_wide(merged.filter(F.col("date_time") < "2021-03-30")).orderBy("date_time").collect()
    assert [(row.date_time.minute, row["10668"]) for row in grid] == [(0, 2.0), (10, None), (20, None), (30, 3.0)]


def test_csv_append_keeps_headers_out_of_the_rows(spark, tmp_path):
    path = str(tmp_path / "csv")
    frame = spark.createDataFrame([(1, "a;\"b"), (2, None)], "id int, v string")
    delimited.append_csv(frame, path)
    delimited.append_csv(frame, path)
    read = delimited.read_history(spark, path, frame.schema)
    assert read.count() == 4 and read.filter("id = 1").first().v == 'a;"b'
    delimited.overwrite_csv(frame, path)
    assert delimited.read_history(spark, path, frame.schema).count() == 2


def test_day_range_is_half_open_and_prunes(spark, tmp_path):
    path = str(tmp_path / "days")
    days = landing.day_range(spark, "2024-02-27", "2024-03-02")
    assert days.count() == 4
    assert landing.day_range(spark, "2024-03-02", "2024-03-02").count() == 0
    days.withColumn("v", F.lit(1)).write.partitionBy("day").json(path)
    schema = T.StructType([T.StructField("v", T.IntegerType())])
    part = landing.read_days(spark, path, schema, "2024-02-28", "2024-03-01")
    assert {row.day for row in part.collect()} == {dt.date(2024, 2, 28), dt.date(2024, 2, 29)}
    assert "PartitionFilters: [isnotnull(day" in part._jdf.queryExecution().executedPlan().toString()
    landed = spark.createDataFrame([(dt.datetime(2024, 2, 28, 5),), (None,)], "at timestamp")
    missing = landing.missing_days(landed, "at", "2024-02-27", "2024-03-02")
    assert sorted(row.day.day for row in missing.collect()) == [1, 27, 29]


def test_missing_days_of_each_source(spark):
    """A source without a name is one, days outside the range do not count, and two columns can name a source."""
    rows = [("a", 1, "2024-02-28"), ("a", 1, "2024-02-28"), (None, 1, "2024-02-27"), ("b", 2, "2023-01-01"), ("b", None, None)]
    landed = spark.createDataFrame(rows, "source string, part int, at string")
    found = landing.missing_days(landed, "at", "2024-02-27", "2024-02-29", ["source"]).collect()
    assert sorted((row.source or "", row.day.day) for row in found) == [("", 28), ("a", 27), ("b", 27), ("b", 28)]
    assert landing.missing_days(landed, "at", "2024-02-27", "2024-02-29", ["source", "part"]).count() == 6
    assert landing.missing_days(landed, "at", "2024-02-29", "2024-02-27", ["source"]).count() == 0


def test_unreadable_documents_are_kept_as_text(spark, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text('{"a": 1}\n{"a": \n{}\n')
    rows = read_documents(spark, str(folder), T.StructType([T.StructField("a", T.IntegerType())])).collect()
    assert sorted((row.a, row.unreadable_record) for row in rows if row.a) == [(1, None)]
    assert [row.unreadable_record for row in rows if row.unreadable_record] == ['{"a": ']


def test_multi_line_documents(spark, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text('{\n  "a": 1\n}\n')
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert read_documents(spark, str(folder), schema, multi_line=True).first().a == 1


def test_raw_archive_keeps_text_and_file(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.json").write_text('{"a": 1}\nbroken\n')
    landing.archive_raw(landing.raw_lines(spark, str(folder)), str(tmp_path / "archive"))
    rows = spark.read.parquet(str(tmp_path / "archive")).collect()
    assert sorted(row.payload for row in rows) == ["broken", '{"a": 1}']
    assert all(row.source_file.endswith("a.json") and row.day for row in rows)
