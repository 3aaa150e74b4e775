import random
import re

from pyspark.sql import functions as F

from sensorloom.functions.keys import surrogate_key
from sensorloom.operators import conform, dedupe, joins
from sensorloom.operators.metrics import counted
from sensorloom.operators.quality import ID_PATTERN
from test_plans import plan_of as plan_text


def test_keys_are_stable_and_keep_null_apart(spark):
    rows = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None), ("a", "b", ""), ("a", "b", None)], "x string, y string, z string")
    keys = [row[0] for row in rows.select(surrogate_key("t", "x", "y", "z")).collect()]
    assert keys[1] == keys[3] and len(set(keys)) == 3
    assert all(re.match(ID_PATTERN, key) for key in keys)
    assert rows.select(surrogate_key("u", "x", "y", "z")).first()[0] != keys[0]


def test_first_write_wins_and_replay_adds_nothing(spark):
    batch = spark.createDataFrame(
        [("s1", 2, 20, "m2"), ("s1", 1, 10, "m1"), (None, 7, 30, "m3"), ("s2", 5, None, "m4"), ("s2", 6, 40, "m5")],
        "name string, network int, at int, id string")
    empty = spark.createDataFrame([], "sensor_id string, name string, network int")
    arguments = (["name"], ["network"], ["at", "id"], "sensor_id", "sensor")
    once = conform.get_or_create(batch, empty, *arguments)
    assert {row.name: row.network for row in once.collect()} == {"s1": 1, None: 7, "s2": 6}
    later = batch.withColumn("network", F.lit(99)).withColumn("at", F.lit(0))
    twice = conform.get_or_create(later, once, *arguments)
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_labels_are_equal_not_patterns(spark):
    batch = spark.createDataFrame([("%",), ("PM1",), ("PM_",)], "label string")
    assert conform.new_dimension_rows(batch, None, ["label"], id_column="id", tag="l").count() == 3


def test_null_key_parts_match_existing_ones(spark):
    batch = spark.createDataFrame([(1.5, None), (2.5, None)], "lat double, source string")
    existing = spark.createDataFrame([(1.5, None)], "lat double, source string")
    assert [row.lat for row in conform.absent_from(batch, existing, ["lat", "source"]).collect()] == [2.5]


def test_dedupe_is_a_fixpoint_and_null_keys_are_equal(spark):
    rows = spark.createDataFrame(
        [("m", None, "b"), ("m", None, "a"), ("n", 1, "c")], "guid string, raw int, id string")
    kept = dedupe.keep_one_per_key(rows, ["guid", "raw"], ["id"])
    assert sorted(row.id for row in kept.collect()) == ["a", "c"]
    assert sorted(kept.collect()) == sorted(dedupe.keep_one_per_key(kept, ["guid", "raw"], ["id"]).collect())
    children = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "id string, v double")
    assert sorted(row.id for row in dedupe.cascade(children, kept, ["id"]).collect()) == ["a", "c"]


def test_dedupe_limits_copies_before_the_shuffle(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise(F.hex("id")).alias("k"), "id")
    plan = dedupe.keep_one_per_key(rows, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_lookups(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    lookup = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n")], "k int, v string")
    assert {row.k: row.v for row in joins.left_lookup(rows, lookup, ["k"], ["v"]).collect()} == {
        1: "a", 2: None, None: None}
    assert joins.left_enrich(rows, lookup, ["k"], null_safe=True).count() == 4
    assert [tuple(row) for row in joins.lookup_conflicts(lookup, ["k"], ["v"]).collect()] == [(1, 2)]


def test_like_lookup_against_every_pair(spark):
    names = ["PM1", "PM2.5", "PM10", "P_1", "", "Temperature", "100%", "a\\b"]
    patterns = ["PM1", "PM%", "%1", "P_1", "%", "_", "___", "%e%r%", "x%", "%.%", "", "____%", "%%", "a\\b", "%\\%"]
    found = joins.like_lookup(
        spark.createDataFrame([(p,) for p in patterns] * 2, "pattern string"),
        spark.createDataFrame([(n,) for n in names] * 2, "name string"), "pattern", "name").collect()

    def matches(pattern, name):
        return re.fullmatch(
            "".join({"%": ".*", "_": "."}.get(ch, re.escape(ch)) for ch in pattern), name, re.S) is not None

    wanted = {p: min((n for n in names if matches(p, n)), default=None) for p in patterns}
    assert {row.pattern: row.name for row in found} == {p: n for p, n in wanted.items() if n is not None}
    assert len(found) == len({row.pattern for row in found})


def test_registry(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,), (None,)], "sn int")
    registry = spark.createDataFrame([(2,), (2,)], "sn int")
    assert [row.sn for row in joins.known_only(rows, registry, "sn").collect()] == [2, 2]
    assert sorted(str(row.sn) for row in joins.unknown_only(rows, registry, "sn").collect()) == ["1", "None"]


def test_counting_needs_no_extra_pass(spark):
    frame, observation = counted(spark.range(7).toDF("id"))
    frame.write.format("noop").mode("overwrite").save()
    assert observation.get["rows"] == 7


def test_like_lookup_on_many_texts(spark, monkeypatch):
    """Random names and patterns, frequent pieces in small cells; no name is cut into pieces of every asked length."""
    monkeypatch.setattr(joins._like_by_grams, "__defaults__", (7,))
    rng = random.Random(3)
    names = sorted({"".join(rng.choices("ab ", k=rng.randint(1, 9))) + "PM" for _ in range(150)})
    patterns = sorted({"".join(rng.choices("ab%_ ", k=rng.randint(1, 7))) for _ in range(150)} | {f"%{n % 7 * 'a'}PM%_" for n in range(40)} | {"%PM%"})
    frame = joins.like_lookup(
        spark.createDataFrame([(p,) for p in patterns], "pattern string"),
        spark.createDataFrame([(n,) for n in names], "name string"), "pattern", "name")

    def matches(pattern, name):
        return re.fullmatch(
            "".join({"%": ".*", "_": "."}.get(ch, re.escape(ch)) for ch in pattern), name, re.S) is not None

    wanted = {p: min((n for n in names if matches(p, n)), default=None) for p in patterns}
    assert {row.pattern: row.name for row in frame.collect()} == {p: n for p, n in wanted.items() if n is not None}


def test_index_rows_stay_within_their_bound(spark):
    """10,000 patterns with one piece in common: index rows are bounded by the names' characters, pairs are checked in the join."""
    names = spark.range(500).select(F.concat(F.lit("shared "), F.col("id").cast("string"), F.lit(" tail")).alias("name"))
    patterns = spark.range(10_000).select(F.concat(F.lit("%shared_"), F.col("id").cast("string"), F.lit("%l")).alias("pattern"))
    frame = joins.like_lookup(patterns, names, "pattern", "name")
    found = {row.pattern: row.name for row in frame.collect()}
    assert found["%shared_49%l"] == "shared 49 tail" and found["%shared_4%l"] == "shared 4 tail" and "%shared_500%l" not in found
    assert "Cartesian" not in plan_text(frame) and "NestedLoop" not in plan_text(frame)


def test_lookups_and_first_rows_are_planned_by_hash(spark):
    lookup = spark.createDataFrame([(1, "b"), (1, "a")] * 3, "k int, v string")
    seen = spark.createDataFrame(
        [("x", 2, "late", 1), ("x", 1, "b", 1), ("x", 1, "a", 2), ("x", None, "never", 0), ("y", None, "n", 0), (None, 3, "o", 0)],
        "k string, at int, v string, id int")
    first = conform.first_per_key(seen, ["k"], ["v"], ["at", "id"])
    assert {row.k: row.v for row in first.collect()} == {"x": "b", "y": "n", None: "o"}
    assert [tuple(row) for row in joins.unique_lookup(lookup, ["k"], ["v"]).collect()] == [(1, "a")]
    for frame in (first, joins.unique_lookup(lookup, ["k"], ["v"])):
        assert "SortAggregate" not in plan_text(frame) and "HashAggregate" in plan_text(frame)
