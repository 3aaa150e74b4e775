"""Loads, repeats, withdrawal, compaction and clean-up of stored tables, and what is left when one is stopped."""

import json
import os
import random
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from sensorloom.plans import checks
from sensorloom.sources import store as store_module, tables as tables_module
from sensorloom.sources.store import Conflict, Store, forget_unused
from sensorloom.sources.tables import (
    Table, batches_of, compact, load_tables, read_repeats, read_table, read_tables, remove_duplicates, withdraw)
from sensorloom.streaming.bins import Bins, merge_bins, read_bins, stream_bins

FACT = Table("fact", "id int, at timestamp, v string", primary_key=("id",), day_of="at")
NAME = Table("name", "v string", natural_key=("v",), primary_key=("v",))
PLAIN = Table("plain", "id int, v string", primary_key=("id",))
TABLES = {table.name: table for table in (FACT, NAME, PLAIN)}


def _frames(spark, facts):
    """facts: id to value; an id lies in day id // 10."""
    rows = [(i, f"2024-01-{1 + i // 10:02d} 10:00:00", v) for i, v in facts.items()]
    frame = spark.createDataFrame(rows, "id int, at string, v string").withColumn("at", F.col("at").cast("timestamp"))
    return {"fact": frame, "name": frame.select("v"), "plain": frame.select("id", "v")}


def _load(spark, root, load, facts):
    load_tables(_frames(spark, facts), TABLES, root, load)


def _state(spark, root):
    """Facts by id, the same for the table without days, and the names."""
    tables = read_tables(spark, root, TABLES)
    out = []
    for name in ("fact", "plain"):
        rows = tables[name].select("id", "v", "batch").collect()
        assert len(rows) == len({row["id"] for row in rows})
        out.append({row["id"]: (row["v"], row["batch"]) for row in rows})
    return (*out, sorted(row["v"] for row in tables["name"].collect()))


def _files(root, table="fact"):
    return {
        os.path.join(folder, name) for folder, _, names in os.walk(os.path.join(root, table))
        for name in names if name.endswith(".parquet")}


def test_a_fact_stays_while_any_load_delivers_it(spark, tmp_path):
    root = str(tmp_path)
    _load(spark, root, "A", {1: "a", 2: "a"})
    _load(spark, root, "B", {2: "b", 3: "b"})
    assert _state(spark, root)[0] == {1: ("a", "A"), 2: ("a", "A"), 3: ("b", "B")}
    assert [(row["id"], row["batch"]) for row in read_repeats(spark, root, FACT).collect()] == [(2, "B")]
    _load(spark, root, "A", {1: "a2"})
    assert _state(spark, root)[0] == {1: ("a2", "A"), 2: ("b", "B"), 3: ("b", "B")}
    withdraw(spark, root, TABLES, "B")
    assert _state(spark, root) == ({1: ("a2", "A")}, {1: ("a2", "A")}, ["a", "a2", "b"])
    withdraw(spark, root, TABLES, "A")
    withdraw(spark, root, TABLES, "never loaded")
    assert _state(spark, root)[:2] == ({}, {}) and batches_of(spark, root, FACT) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_random_loads_withdrawals_and_compactions(spark, tmp_path, seed, monkeypatch):
    """Against a plain model: a fact is there if any load delivers it, with the value of one that does."""
    if seed == 2:
        monkeypatch.setattr(store_module, "NAMED_LOADS", 1)
    rng, root, loads = random.Random(seed), str(tmp_path), {}
    for step in range(12):
        load = rng.choice("ABC")
        kind = rng.random()
        if kind < 0.6:
            loads[load] = {i: f"{load}{step}" for i in rng.sample(range(25), rng.randint(0, 10))}
            _load(spark, root, load, loads[load])
        elif kind < 0.75:
            loads.pop(load, None)
            withdraw(spark, root, TABLES, load)
        else:
            for table in TABLES.values():
                compact(spark, root, table, least=2)
        facts, plain, _ = _state(spark, root)
        assert set(facts) == set(plain) == {i for own in loads.values() for i in own}
        assert all(loads[batch][i] == v for state in (facts, plain) for i, (v, batch) in state.items())


def test_days_without_rows_of_the_load_are_left_alone(spark, tmp_path):
    root = str(tmp_path)
    _load(spark, root, "A", {1: "a", 11: "a"})
    _load(spark, root, "B", {2: "b", 21: "b"})
    compact(spark, root, FACT, least=2)
    before = {folder.path("", "fact") for folder in Store(spark, root).folders(Store(spark, root).latest(), "fact")}
    _load(spark, root, "B", {2: "b2"})
    after = {folder.path("", "fact") for folder in Store(spark, root).folders(Store(spark, root).latest(), "fact")}
    assert {path.rsplit("/", 1)[1] for path in before & after} == {"day=2024-01-02"}
    assert _state(spark, root)[0] == {1: ("a", "A"), 2: ("b2", "B"), 11: ("a", "A")}


def test_first_child_wins_across_and_inside_loads(spark, tmp_path):
    child = Table("child", "parent int, voltage double", one_for=("parent",), day_of="at")
    rows = spark.createDataFrame([(1, 2.9), (1, 3.1), (2, 3.0)], "parent int, voltage double").withColumn(
        "at", F.lit("2024-01-01").cast("timestamp"))
    root = str(tmp_path)
    load_tables({"child": rows}, {"child": child}, root, "A")
    load_tables({"child": rows.withColumn("voltage", F.lit(5.0))}, {"child": child}, root, "B")
    assert sorted((r["parent"], r["voltage"]) for r in read_table(spark, root, child).collect()) == [(1, 2.9), (2, 3.0)]
    withdraw(spark, root, {"child": child}, "A")
    assert sorted((r["parent"], r["voltage"]) for r in read_table(spark, root, child).collect()) == [(1, 5.0), (2, 5.0)]


class Stopped(Exception):
    pass


def _stop(monkeypatch, method, nth=1, after=False):
    """The store stops at the n-th call of a step, before or after it."""
    calls, turn, original = [], threading.Lock(), getattr(Store, method)

    def stopping(self, *args, **kwargs):
        with turn:
            calls.append(1)
            mine = len(calls)
        if mine == nth and not after:
            raise Stopped
        result = original(self, *args, **kwargs)
        if mine == nth:
            raise Stopped
        return result

    monkeypatch.setattr(Store, method, stopping)


def _cleaned(spark, root):
    remove_duplicates(spark, root, FACT, ("at", "v"), ("id",), {"plain": (PLAIN, ("id",))})


ACTIONS = {
    "load": lambda spark, root: _load(spark, root, "C", {2: "c", 30: "c"}),
    "replay": lambda spark, root: _load(spark, root, "A", {1: "new"}),
    "withdraw": lambda spark, root: withdraw(spark, root, TABLES, "A"),
    "compact": lambda spark, root: compact(spark, root, FACT, least=2),
    "clean": _cleaned,
}


@pytest.fixture(scope="module")
def two_loads(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("two_loads") / "store")
    _load(spark, root, "A", {1: "a", 2: "a", 11: "a"})
    _load(spark, root, "B", {2: "b", 3: "b"})
    return root, _state(spark, root)


@pytest.mark.parametrize("action", list(ACTIONS))
def test_a_stopped_change_leaves_the_old_or_the_new_rows(spark, tmp_path, two_loads, action):
    source, old = two_loads

    def filled(name):
        return shutil.copytree(source, str(tmp_path / name))

    root = filled("whole")
    ACTIONS[action](spark, root)
    new = _state(spark, root)
    assert (old != new) == (action != "compact")
    steps = [("written", 1, False), ("written", 1, True), ("_write", 1, False), ("_write", 1, True),
             ("_publish", 1, False), ("_publish", 1, True)]
    for at, (method, nth, after) in enumerate(steps):
        root = filled(f"step{at}")
        with pytest.MonkeyPatch.context() as patch:
            _stop(patch, method, nth, after)
            with pytest.raises(Stopped):
                ACTIONS[action](spark, root)
        assert _state(spark, root) == (new if (method, after) == ("_publish", True) else old)
    ACTIONS[action](spark, root)  # and it can be done again
    assert _state(spark, root) == new


def test_clean_up_writes_only_days_with_copies(spark, tmp_path):
    root = str(tmp_path)
    _load(spark, root, "A", {1: "x", 2: "x", 3: "y", 11: "x", 21: "z"})
    before = {f: f for f in Store(spark, root).folders(Store(spark, root).latest(), "fact")}
    _cleaned(spark, root)
    after = Store(spark, root).folders(Store(spark, root).latest(), "fact")
    assert {f.day for f in after if f in before} == {"2024-01-02", "2024-01-03"}
    facts, plain, _ = _state(spark, root)
    assert set(facts) == set(plain) == {1, 3, 11, 21}
    files = _files(root)
    _cleaned(spark, root)
    assert _files(root) == files


def test_size_tiers(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for n in range(3):
        _load(spark, root, f"L{n}", {n: "v"})
    assert compact(spark, root, FACT) == 0
    _load(spark, root, "L3", {3: "v"})
    assert compact(spark, root, FACT) == 4
    folders = Store(spark, root).folders(Store(spark, root).latest(), "fact")
    assert len(folders) == 1 and folders[0].loads == ("L0", "L1", "L2", "L3")
    monkeypatch.setattr("sensorloom.sources.tables.FULL_FOLDER", 1)
    _load(spark, root, "L4", {4: "v"})
    assert compact(spark, root, FACT, least=2) == 0
    assert batches_of(spark, root, FACT) == ["L0", "L1", "L2", "L3", "L4"]


def test_a_commit_refuses_a_taken_number_and_the_load_is_tried_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    store = Store(spark, root)
    base = store.latest()
    store.commit(base, {})
    with pytest.raises(Conflict):
        store.commit(base, {})
    original, meddled = Store.commit, []

    def meddling(self, base, changes, streams=None):
        if not meddled:
            meddled.append(1)
            _load(spark, root, "other", {1: "other", 2: "other"})
        return original(self, base, changes, streams)

    monkeypatch.setattr(Store, "commit", meddling)
    _load(spark, root, "mine", {2: "mine", 3: "mine"})
    assert _state(spark, root)[0] == {1: ("other", "other"), 2: ("other", "other"), 3: ("mine", "mine")}


def test_a_committed_stream_batch_is_left_as_it_is(spark, tmp_path):
    root = str(tmp_path)
    for batch, value in ((0, "a"), (0, "again"), (1, "b")):
        load_tables(_frames(spark, {1 + batch: value}), TABLES, root, f"stream-s-{batch}", {"s": batch})
    assert _state(spark, root)[0] == {1: ("a", "stream-s-0"), 2: ("b", "stream-s-1")}
    assert dict(Store(spark, root).latest().streams) == {"s": 1}


def test_readers_keep_their_commit_and_unused_folders_go(spark, tmp_path):
    root = str(tmp_path)
    _load(spark, root, "A", {1: "a"})
    reader = read_table(spark, root, FACT)
    _load(spark, root, "A", {1: "b"})
    assert [row["v"] for row in reader.collect()] == ["a"]
    assert forget_unused(spark, root, keep=1) == 0  # too young
    assert forget_unused(spark, root, keep=1, older_than_hours=-1) == 2
    assert _state(spark, root)[0] == {1: ("b", "A")}
    assert len(_files(root)) == 1


def test_empty_loads_and_null_days(spark, tmp_path):
    root = str(tmp_path)
    _load(spark, root, "A", {})
    assert _state(spark, root) == ({}, {}, [])
    undated = _frames(spark, {1: "a"})
    undated["fact"] = undated["fact"].withColumn("at", F.lit(None).cast("timestamp"))
    for load in ("A", "B"):
        load_tables(undated, TABLES, root, load)
    assert _state(spark, root)[0] == {1: ("a", "A")}
    withdraw(spark, root, TABLES, "A")
    assert _state(spark, root)[0] == {1: ("a", "B")}


def test_constraints_of_one_load(spark, tmp_path):
    parent = Table("parent", "id int, at timestamp, v string", primary_key=("id",), day_of="at", max_length={"v": 3})
    # Loads let rows with differing content in, so that a key may be there twice.
    loose = Table("parent", "id int, at timestamp, v string", day_of="at")
    child = Table("child", "parent int, at timestamp", references=((("parent",), "parent", ("id",)),), day_of="at")
    root, tables = str(tmp_path), {"parent": parent, "child": child}

    def load(name, parents, children):
        frames = {
            "parent": spark.createDataFrame(parents, "id int, day string, v string"),
            "child": spark.createDataFrame(children, "parent int, day string")}
        frames = {key: frame.withColumn("at", F.col("day").cast("timestamp")) for key, frame in frames.items()}
        load_tables(frames, {"parent": loose, "child": child}, root, name)

    load("A", [(1, "2024-01-01", "long"), (2, "2024-01-01", "a"), (9, "2024-01-05", "long")], [(7, "2024-01-01"), (8, "2024-01-05")])
    load("B", [(2, "2024-01-01", "b"), (3, "2024-01-01", "long")], [(1, "2024-01-01"), (5, "2024-01-01")])

    def report(name):
        frame = checks.load_constraint_report(spark, root, tables, name)
        return {(r["table_name"], r["check_name"]): r["violations"] for r in frame.collect()}, frame

    length, key, reference = ("parent", "length"), ("parent", "primary key"), ("child", "reference to parent")
    assert report("A")[0] == {length: 2, key: 1, reference: 2}
    found, frame = report("B")
    assert found == {length: 1, key: 1, reference: 1}
    files = {file for file in frame.inputFiles()}
    assert files and not any("day=2024-01-05" in file for file in files)


def test_bins_take_late_rows_and_repeated_batches(spark, tmp_path):
    bins = Bins("bins", "ts", ("v", "w"), "10min", "s string")
    landing, root = tmp_path / "events", str(tmp_path / "store")
    landing.mkdir()

    def land(name, *rows):
        (landing / name).write_text("\n".join(json.dumps({"s": s, "ts": ts, "v": v}) for s, ts, v in rows))
        rows = spark.readStream.schema("s string, ts string, v double, w double").json(str(landing))
        stream_bins(rows, bins, root, str(tmp_path / "checkpoint")).awaitTermination()

    def means():
        return sorted((r["s"] or "", str(r["ts"]), r["v"], r["w"]) for r in read_bins(spark, root, bins).collect())

    land("1.json", ("a", "2024-01-01T00:01:00", 1.0), ("a", "2024-01-01T05:00:00", 4.0), (None, "2024-01-01T00:00:00", 2.0))
    land("2.json", ("a", "2024-01-01T00:09:59", 2.0), ("a", None, 9.0), ("a", "2024-01-01T05:09:00", None))
    expected = [("", "2024-01-01 00:00:00", 2.0, None), ("a", "2024-01-01 00:00:00", 1.5, None), ("a", "2024-01-01 05:00:00", 4.0, None)]
    assert means() == expected and read_table(spark, root, bins.table).count() == 5
    load_tables({"bins": bins.partial(spark.createDataFrame([("a", "2024-01-01", 7.0, 7.0)], "s string, ts string, v double, w double"), "x")},
                {"bins": bins.table}, root, "x", dict(Store(spark, root).latest().streams))
    assert means() == expected  # a batch that is committed already
    assert merge_bins(spark, root, bins, least=2) == 2
    assert means() == expected and read_table(spark, root, bins.table).count() == 3
    with pytest.raises(ValueError):
        Bins("bins", "ts", ("v",), "7min")


def test_rows_without_copies_are_written_where_they_lie(spark, tmp_path, monkeypatch):
    """A first load compares only keys' hashes, and rows of copies; days with enough rows are not dealt anew."""
    monkeypatch.setattr(tables_module, "DAY_ROWS", 1)
    store = Store(spark, str(tmp_path))
    rows = spark.range(0, 100, 1, 2).selectExpr("cast(id as int) id", "cast('2024-01-01' as timestamp) at", "'x' v")
    once = tables_module._each_once(rows, store, FACT, ("id",))
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    copies = rows.unionAll(rows.filter("id < 5").withColumn("v", F.lit("a")))
    once = tables_module._each_once(copies, store, FACT, ("id",)).collect()
    assert sorted((row["id"], row["v"]) for row in once) == [(i, "a" if i < 5 else "x") for i in range(100)]
    monkeypatch.setattr(tables_module, "NAMED_KEYS", 2)
    assert tables_module._each_once(copies, store, FACT, ("id",)).count() == 100
    load_tables({"fact": copies}, {"fact": FACT}, str(tmp_path), "a")
    assert _files(tmp_path) and all(name.endswith(".zstd.parquet") for name in _files(tmp_path))
    assert read_table(spark, str(tmp_path), FACT).count() == 100


def test_keys_with_nulls_in_other_places_are_other_keys(spark, tmp_path):
    table = Table("child", "a string, b string, at timestamp", one_for=("a", "b"), day_of="at")
    for load, facts in (("first", [("k", None), ("m", "n")]), ("second", [(None, "k"), ("k", None), (None, None)])):
        frame = spark.createDataFrame(facts, "a string, b string").withColumn("at", F.lit("2024-01-01").cast("timestamp"))
        load_tables({"child": frame}, {"child": table}, str(tmp_path), load)
    kept = {(row["a"], row["b"], row["batch"]) for row in read_table(spark, str(tmp_path), table).collect()}
    assert kept == {("k", None, "first"), ("m", "n", "first"), (None, "k", "second"), (None, None, "second")}
    assert [(row["a"], row["b"]) for row in read_repeats(spark, str(tmp_path), table).collect()] == [("k", None)]


def test_landed_documents_are_compressed(spark, tmp_path):
    from bindings.registry import landed
    spark.range(50).write.parquet(str(tmp_path / "ids.parquet"))
    folder = landed(spark, str(tmp_path), "compressed", "ids", lambda rows: rows.selectExpr("struct(id, 'text' as name) as one"))
    names = [name for name in os.listdir(folder.removeprefix("file:")) if name.startswith("part-")]
    assert names and all(name.endswith(".json.gz") for name in names)
    assert spark.read.json(folder).select("one.id").distinct().count() == 50


def test_a_second_delivery_is_judged_where_it_lies(spark, tmp_path, monkeypatch):
    """Tables with the same keys share one comparison of digests, and most rows of a load are not shuffled for it."""
    monkeypatch.setattr(tables_module, "DAY_ROWS", 1)
    asked = []
    answer = tables_module._exceptions
    monkeypatch.setattr(tables_module, "_exceptions", lambda *some: asked.append(some[3].name) or answer(*some))
    child = Table("child", "id int, w double", one_for=("id",), day_of="at")
    specs, root = {"fact": FACT, "child": child}, str(tmp_path)

    def load(name, rows):
        frames = {"fact": rows, "child": rows.selectExpr("id", "at", "cast(id as double) w")}
        load_tables(frames, specs, root, name)

    def stored(read):
        return sorted((row["id"], row["v"], row["batch"]) for row in read(spark, root, FACT).collect())

    rows = spark.range(0, 40, 1, 2).selectExpr("cast(id as int) id", "cast('2024-01-01' as timestamp) at", "'x' v")
    load("a", rows)
    # Most rows come again, some of them twice, and a few are new or lie in another day.
    more = rows.filter("id >= 10").unionAll(rows.filter("id < 3").selectExpr("id + 100 id", "at", "v")).unionAll(
        rows.filter("id in (12, 13)").selectExpr("id", "at", "'a' v")).unionAll(
        rows.filter("id = 5").selectExpr("id", "at + interval 1 day at", "v"))
    load("b", more)
    assert len(asked) == 2  # one table of each load asked for the other
    kept = [(i, "x", "a") for i in range(40)] + [(5, "x", "b")] + [(i, "x", "b") for i in (100, 101, 102)]
    assert stored(read_table) == sorted(kept)
    assert stored(read_repeats) == [(i, "a" if i in (12, 13) else "x", "b") for i in range(10, 40)]
    assert read_table(spark, root, child).count() == 44
    # Mostly new rows, and too many exceptions to be named.
    load("c", rows.selectExpr("id + 30 id", "at", "v"))
    monkeypatch.setattr(tables_module, "NAMED_KEYS", 2)
    load("d", rows.selectExpr("id + 50 id", "at", "v"))
    assert {row["batch"]: row["count"] for row in read_table(spark, root, FACT).groupBy("batch").count().collect()} == {
        "a": 40, "b": 4, "c": 30, "d": 20}
    assert read_repeats(spark, root, FACT).filter("batch = 'd'").count() == 20
    plan = tables_module._where_they_lie(
        rows, rows.withColumn("batch", F.lit("a")), FACT,
        spark.createDataFrame([], "_digest_1 bigint, _digest_2 bigint, copies boolean"), True)
    assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()


def test_a_delivery_with_copies_that_comes_again_is_mostly_known(spark, tmp_path, monkeypatch):
    """A store has each key once, so fewer rows than such a load; its rows must not be shuffled for that."""
    monkeypatch.setattr(tables_module, "DAY_ROWS", 1)
    monkeypatch.setattr(tables_module, "NAMED_KEYS", 10)
    monkeypatch.setattr(tables_module, "_each_once", lambda *some: pytest.fail("rows are shuffled"))
    root = str(tmp_path)
    rows = spark.range(0, 100, 1, 2).selectExpr("cast(id as int) id", "timestamp'2024-01-01' + make_interval(0, 0, 0, id % 9) at", "'x' v")
    copies = rows.unionAll(rows.filter("id < 5").selectExpr("id", "at", "'a' v"))
    for load, frame in (("a", copies), ("b", copies), ("c", rows.selectExpr("id + 100 id", "at", "v"))):
        load_tables({"fact": frame}, {"fact": FACT}, root, load)
        # Copies are put aside in one folder, whatever their days.
        aside = {os.path.dirname(path).partition("kept=__HIVE_DEFAULT_PARTITION__")[2] for path in _files(root) if "kept=__HIVE" in path}
        assert aside in ({"/day=__HIVE_DEFAULT_PARTITION__"}, set())
    kept = {(row["id"], row["v"], row["batch"], row["at"].day) for row in read_table(spark, root, FACT).collect()}
    assert kept == {(i, "a" if i < 5 else "x", "a", 1 + i % 9) for i in range(100)} | {(i + 100, "x", "c", 1 + i % 9) for i in range(100)}
    again = {(row["id"], row["v"], row["batch"], str(row["day"])) for row in read_repeats(spark, root, FACT).collect()}
    assert again == {(i, "a" if i < 5 else "x", "b", f"2024-01-{1 + i % 9:02d}") for i in range(100)}


def test_folders_of_a_write_are_found_with_their_sizes(spark, tmp_path):
    _load(spark, str(tmp_path), "A", {1: "a", 11: "b", 12: "c"})
    store = Store(spark, str(tmp_path))
    for table in ("fact", "plain"):
        for folder in store.folders(store.latest(), table):
            path = folder.path(str(tmp_path), table)
            assert folder.size == sum(os.path.getsize(os.path.join(path, name)) for name in os.listdir(path) if name.endswith(".parquet"))
    assert [folder.day for folder in store.folders(store.latest(), "fact")] == ["2024-01-01", "2024-01-02"]


def test_small_parts_of_a_load_are_written_together(spark, tmp_path, monkeypatch):
    """Each task that writes leaves a file a day: many tasks with few rows left many."""
    monkeypatch.setattr(tables_module, "DAY_ROWS", 1)
    rows = spark.range(0, 600, 1, 60).selectExpr("cast(id as int) id", "timestamp'2024-01-01' at", "'x' v")
    most = tables_module.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert most < 60
    for name, task_rows, files in (("few", 2_000_000, most), ("many", 10, 60)):
        monkeypatch.setattr(tables_module, "TASK_ROWS", task_rows)
        load_tables({"fact": rows}, {"fact": FACT}, str(tmp_path / name), "a")
        assert len(_files(tmp_path / name)) == files
        assert read_table(spark, str(tmp_path / name), FACT).select("id").distinct().count() == 600
