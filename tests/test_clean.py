import pytest
from pyspark.sql import functions as F

from sensorloom.functions import text
from sensorloom.operators import clean, quality

LABEL = "?g/m^3|PM1|PM2.5|PM10"
THREE = "Micrograms|Micrograms|Micrograms"


def test_suffix_is_trimmed_for_prefixes_in_any_case(spark):
    rows = spark.createDataFrame([
        ("humidity 3", "12%7c0"), ("Humidity", "ab"), ("x Humidity", "12%7c0"), ("Humidity", None), (None, "abcdef"),
    ], "sensorName string, rawData string")
    found = [row.rawData for row in clean.trim_suffix_by_prefix(rows, ["Humidity"]).collect()]
    assert found == ["12", "", "12%7c0", "", "abcdef"]


def test_prefix_with_regex_characters(spark):
    rows = spark.createDataFrame([("a.b 1", "12345"), ("axb 1", "12345")], "sensorName string, rawData string")
    assert [row.rawData for row in clean.trim_suffix_by_prefix(rows, ["a.b"]).collect()] == ["1", "12345"]


def test_particulate_rows_are_aligned(spark):
    rows = spark.createDataFrame(
        [(LABEL, "a%7cb%7cc", "1|2|3", THREE), ("x", "a", "1", THREE), ("x", "a", "1", "Count"),
         (LABEL, "a%7cb%7cc%7cd%7ce", "1|2|3", "Count")],
        "plotLabels string, rawData string, dataValue string, dataType string")
    found = [tuple(row)[1:] for row in clean.align_particulate(rows).collect()]
    assert found == [
        ("0%7cc%7ca%7cb", "0|1|2|3", THREE + "|Micrograms"), ("a", "1", THREE + "|Micrograms"), ("a", "1", "Count"),
        ("0%7cc%7ca%7cb", "0|1|2|3", "Count")]


def test_short_particulate_rows_are_rejected(spark):
    rows = spark.createDataFrame(
        [(LABEL, "a"), (LABEL, None), (LABEL, "a%7cb%7cc"), ("x", "a"), (None, None)],
        "plotLabels string, rawData string")
    judged = clean.with_reject_reason(rows, {"short": clean.particulate_too_short()})
    good, bad = clean.split_rejects(judged)
    assert bad.count() == 2 and good.count() == 3
    assert "reject_reason" not in good.columns


def test_flag_words(spark):
    rows = spark.createDataFrame([("True",), ("False",), ("true",), ("x",), (None,)], "pendingChange string")
    assert [row[0] for row in clean.flag_words_to_boolean(rows, "pendingChange").collect()] == [
        True, False, True, None, None]
    assert clean.flag_words_to_boolean(rows, "other").columns == ["pendingChange"]


def test_strict_casts_fail_and_lenient_ones_do_not(spark):
    rows = spark.createDataFrame([("1",), ("x",)], "a string")
    assert [row.a for row in clean.cast_columns(rows, {"a": "int"}, lenient=True).collect()] == [1, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.cast_columns(rows, {"a": "int"}).collect()


def test_dropping_unknown_columns(spark):
    rows = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.drop_columns(rows, ["b", "c"]).columns == ["a"]
    with pytest.raises(ValueError):
        clean.drop_columns(rows, ["c"], strict=True)


def test_overlay_keeps_rows_and_base_values(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    over = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert sorted(row.v for row in clean.overlay(base, over, ["k"], ["v"]).collect()) == ["b", "c", "x"]


def test_empty_delimiter_is_refused():
    with pytest.raises(ValueError):
        text.literal_alternation(["|", ""])
    with pytest.raises(ValueError):
        text.literal_alternation([])


def test_truthy_words(spark):
    rows = spark.createDataFrame([("true",), ("false",), ("0",), ("",), ("yes",), (None,)], "a string")
    assert [row[0] for row in rows.select(text.truthy(F.col("a"))).collect()] == [True, False, False, False, True, None]


def test_quality_checks(spark):
    rows = spark.createDataFrame(
        [("a", None, 1), ("a", "bb", None), (None, "b", 2), (None, "b", None)], "k string, v string, p int")
    assert {row.k: row.row_count for row in quality.pk_violations(rows, ["k"]).collect()} == {"a": 2, None: 2}
    assert quality.null_violations(rows, ["k", "v"]).count() == 3
    assert quality.length_violations(rows, {"v": 1}).count() == 1
    assert quality.parent_count_violations(rows, ["v", "p"]).count() == 1
    parents = spark.createDataFrame([("a",)], "k string")
    children = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert [row.c for row in quality.fk_orphans(children, parents, ["c"], ["k"]).collect()] == ["z"]
    report = quality.column_report(rows, ["k", "p"], {"v": 1}).first()
    assert (report.row_count, report.null_k, report.null_p, report.long_v) == (4, 2, 2, 1)
