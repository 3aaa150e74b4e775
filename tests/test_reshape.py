import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sensorloom.functions.text import split_any
from sensorloom.operators import reshape

DELIMITERS = ["%7c", "|"]


def _split(spark, rows):
    frame = spark.createDataFrame(rows, "id int, a string, b string")
    found = reshape.split_parallel(frame, ["a", "b"], DELIMITERS, "pos").orderBy("id", "pos").collect()
    return [tuple(row) for row in found]


def test_parts_are_paired_by_position(spark):
    assert _split(spark, [(1, "21.5", "F")]) == [(1, "21.5", "F", 0)]
    assert _split(spark, [(1, "21.5%7c40", "F|H")]) == [(1, "21.5", "F", 0), (1, "40", "H", 1)]
    assert _split(spark, [(1, "x%7cy%7cz", "F|H")]) == [(1, "x", "F", 0), (1, "y", "H", 1), (1, "z", "", 2)]
    assert _split(spark, [(1, "a%7c", "F")]) == [(1, "a", "F", 0), (1, "", "", 1)]
    assert _split(spark, [(1, "a", "")]) == [(1, "a", "", 0)]
    assert _split(spark, [(1, "a", None)]) == [(1, "a", "", 0)]
    assert _split(spark, [(1, None, None)]) == [(1, "", "", 0)]


def test_no_columns_gives_no_rows(spark):
    frame = spark.createDataFrame([(1,)], "id int")
    assert reshape.split_parallel(frame, [], DELIMITERS).count() == 0
    assert reshape.split_parallel(frame, [], DELIMITERS, "pos").columns == ["id", "pos"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab|%7c;", max_size=8), min_size=1, max_size=6),
       st.sampled_from([["%7c", "|"], ["|", "%7c"], ["ab", "bc", ";"], ["a", "ab"], ["|"], ["%7", "7c", "|"]]))
def test_split_equals_ordered_alternation(spark, cells, delimiters):
    frame = spark.createDataFrame([(index, cell) for index, cell in enumerate(cells)], "i int, c string")
    found = {row.i: row.parts for row in frame.select("i", split_any(F.col("c"), delimiters).alias("parts")).collect()}
    pattern = "|".join(map(re.escape, delimiters))
    assert found == {index: re.split(pattern, cell) for index, cell in enumerate(cells)}


def test_unpivot_keeps_nulls_and_numbers_channels(spark):
    frame = spark.createDataFrame([(1, 0.5, None)], "ID int, AI1 double, AI12 double")
    found = reshape.number_channels(reshape.unpivot_channels(frame, ["ID"])).collect()
    assert sorted(tuple(row) for row in found if row.value is not None) == [(1, 1, 0.5)]
    assert sorted(row.aid for row in found) == [1, 12]


def test_children_of_empty_parents(spark):
    frame = spark.createDataFrame([(1, ["x", "y"]), (2, []), (3, None)], "id int, items array<string>")
    assert reshape.explode_children(frame, "items").count() == 2
    assert reshape.explode_children(frame, "items", keep_empty=True).count() == 4


def test_pairs_ignore_surplus_values(spark):
    frame = spark.createDataFrame([(["a", "b"], ["1", "2", "3"])], "n array<string>, v array<string>")
    pairs = frame.select(F.inline(reshape.zip_names_values(F.col("n"), F.col("v")))).collect()
    assert [tuple(row) for row in pairs] == [("a", "1"), ("b", "2")]


def test_positions_outside_a_list(spark):
    frame = spark.createDataFrame([([],), ([1, 2, 3],), (None,)], "a array<int>")
    rows = frame.select(
        reshape.first_of(F.col("a")), reshape.last_where(F.col("a"), lambda x: x < 3),
        reshape.last_where(F.col("a"), lambda x: x > 9)).collect()
    assert [tuple(row) for row in rows] == [(None, None, None), (1, 2, None), (None, None, None)]


def test_flatten_separator_and_lists(spark):
    frame = spark.sql("select 1 a, named_struct('b', named_struct('c', 2, 'd', array(3))) s")
    assert reshape.flatten_nested(frame).columns == ["a", "s.b.c", "s.b.d"]
    assert reshape.flatten_nested(frame, "_").select("s_b_c", "s_b_d").first() == (2, [3])


def test_reshaping_is_narrow(spark):
    frame = spark.createDataFrame([(1, "a|b", "c")], "id int, a string, b string")
    plan = reshape.split_parallel(frame, ["a", "b"], DELIMITERS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("value", ["a.b", "x\\Ey", "$1", "\\"])
def test_delimiters_are_literal(spark, value):
    frame = spark.createDataFrame([(f"1{value}2{value}3",)], "c string")
    assert frame.select(split_any(F.col("c"), [value, "##"])).first()[0] == ["1", "2", "3"]
