"""Parquet tables: loads, dimension rows, withdrawal, compaction and clean-up.

Every change of a store is one commit (:mod:`sensorloom.sources.store`), so loads change all their tables or none.

A fact is stored once, under the load that delivered it first.  When another load delivers it again, that
delivery is kept too, apart from the table.  A repeated load replaces its own rows: a fact that it no longer
has goes, unless other loads delivered it; then it stays as the first of them (by name) delivered it.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from sensorloom.functions.keys import surrogate_key
from sensorloom.operators.conform import absent_from, first_per_key
from sensorloom.operators.dedupe import drop_identical, keep_one_per_key
from sensorloom.sources.schemas import schema_of
from sensorloom.sources.store import NO_DAY, Conflict, Folder, Store, Version

# Days of one load that are looked up in the store one by one; with more, all folders are read.
MAX_NAMED_DAYS = 1000
TABLES_AT_ONCE = 4
#: How often a load is tried again after another writer has committed first.
ATTEMPTS = 20
#: Folders of at least so many bytes are not compacted any further.
FULL_FOLDER = 512 << 20
#: Folders of one day whose sizes lie within a factor ``TIER`` are put together when there are ``TIER`` of them.
TIER = 4

#: Compression of stored tables: ids are hexadecimal digits, of which others leave twice as much.
#: Level 1 leaves no more than the default 3 of them, and takes less time.
CODEC = "zstd"
COMPRESSED = {"compression": CODEC, "parquet.compression.codec.zstd.level": "1"}
#: Keys that may occur twice are sent to all tasks up to so many; with more, whole rows are shuffled.
NAMED_KEYS = 2_000_000
#: Parts that a day's rows are dealt to when they meet the stored ones.
DAY_PARTS, KEY_PARTS = 16, 1 << 20
#: A first load with at least so many rows a day is written as it lies: each task's share of a day fills a file.
DAY_ROWS = 50_000
#: Each task that writes where it lies leaves a file a day; up to so many rows are written by one, if all cores have some tasks.
TASK_ROWS, TASKS_PER_CORE = 2_000_000, 3

#: Day of the rows that a write puts aside, which lie in no day's folder.
ASIDE = "_day"

SEEN = ("_seen_at", "_seen_id")  # order in which a dimension's rows arrived


@dataclass(frozen=True)
class Table:
    """What the engine needs to know about a stored table.

    ``natural_key`` makes it a dimension.  ``generated_id`` is its computed id column, if its
    natural key is not its id.  ``day_of`` is the column, of the table or only of the frames that
    are loaded, whose day a fact table is partitioned by; with ``period="month"`` a folder is named by
    the first day of its month, for feeds with few rows a day.  ``one_for`` names the columns of the parent
    of a table without a key that has at most one row for each parent.
    """

    name: str
    columns: str
    natural_key: tuple[str, ...] = ()
    generated_id: str | None = None
    primary_key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    references: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    one_parent_of: tuple[str, ...] = ()
    one_for: tuple[str, ...] = ()
    day_of: str | None = None
    period: str = "day"

    @property
    def schema(self) -> T.StructType:
        return schema_of(self.columns)

    @property
    def attributes(self) -> list[str]:
        return [name for name in self.schema.names if name not in self.natural_key and name != self.generated_id]

    @property
    def row_key(self) -> list[str]:
        """Columns that tell facts apart: ids are computed, so equal rows are copies."""
        return list(self.primary_key or self.one_for or self.schema.names)

    @property
    def stored_schema(self) -> T.StructType:
        """Facts are stored with their load, and their day if the table is kept by day."""
        schema = T.StructType(list(self.schema.fields))
        if not self.is_dimension:
            schema.add("batch", T.StringType())
            if self.day_of:
                schema.add("day", T.DateType())
        return schema

    @property
    def is_dimension(self) -> bool:
        return bool(self.natural_key)


def read_folders(store: Store, table: Table, folders: Sequence[Folder]) -> DataFrame:
    """The rows of some folders of a table."""
    schema = table.stored_schema
    if not folders:
        return store.spark.createDataFrame([], schema)
    top = f"{store.root}/{table.name}"
    paths = [folder.path(store.root, table.name) for folder in folders]
    return store.spark.read.schema(schema).option("basePath", top).parquet(*paths).select(*schema.names)


def read_table(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The table as of the latest commit, or an empty frame while nothing has been written."""
    return read_tables(spark, root, {table.name: table})[table.name]


def read_tables(spark: SparkSession, root: str, tables: Mapping[str, Table]) -> dict[str, DataFrame]:
    """Some tables of a store, all as of one commit."""
    store = Store(spark, root)
    version = store.latest()
    return {
        name: read_folders(store, table, [f for f in store.folders(version, table.name) if f.kept])
        for name, table in tables.items()}


def read_repeats(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """Deliveries of facts that another load had stored already, one row for each fact and load."""
    store = Store(spark, root)
    return read_folders(store, table, [f for f in store.folders(store.latest(), table.name) if not f.kept])


def dimension_rows(batch: DataFrame, table: Table) -> DataFrame:
    """The batch reduced to one row per natural key, with ids, in the table's column order.

    Attributes that the batch has no column for are NULL; without any it is a plain distinct.
    """
    attributes = [name for name in table.attributes if name in batch.columns]
    rows = first_per_key(batch, table.natural_key, attributes, [name for name in SEEN if name in batch.columns])
    rows = rows.withColumns({
        name: F.lit(None).cast(table.schema[name].dataType) for name in table.attributes if name not in attributes})
    if table.generated_id:
        rows = rows.withColumn(table.generated_id, surrogate_key(table.name, *table.natural_key))
    return rows.select(*table.schema.names)


def _fill(rows: DataFrame, store: Store, table: Table, loads: set[str] | None, dealt: bool = False) -> list[Folder]:
    """Write rows with a column ``kept`` to a fresh folder; those in which it is NULL are put aside.

    Rows of a table kept by day are spread by day before the write, with large days split, so tasks
    neither write into every day's folder nor wait for one huge day; ``dealt`` rows are written where they lie.  Other
    tables are written without a shuffle of their own.
    """
    write = store.new_write()
    parts = ["kept", *(["day"] if table.day_of else [])]
    spread = rows.hint("rebalance", *parts) if table.day_of and not dealt else rows
    spread.write.mode("errorifexists").options(**COMPRESSED).partitionBy(*parts).parquet(
        f"{store.root}/{table.name}/write={write}")
    return store.written(table.name, write, loads)


def _with_dimension_rows(batch: DataFrame, store: Store, version: Version, table: Table) -> list[Folder]:
    """The dimension's folders with the rows whose natural key is new.  Repeating it adds nothing.

    Known keys leave before the rows are reduced: on a running system these are almost all rows.
    """
    folders = store.folders(version, table.name)
    rows = absent_from(batch, read_folders(store, table, folders), table.natural_key) if folders else batch
    new = dimension_rows(rows, table).withColumn("kept", F.lit(True)).hint("rebalance")
    return folders + _fill(new, store, table, None)


def _of_days(folders: Iterable[Folder], days: Sequence | None) -> list[Folder]:
    if days is None:
        return list(folders)
    names = {NO_DAY if day is None else str(day) for day in days}
    return [folder for folder in folders if folder.day in names]


def _days_of(rows: DataFrame) -> list | None:
    """The days of the rows, ``None`` if they are too many to be named."""
    days = [row["day"] for row in rows.select("day").distinct().limit(MAX_NAMED_DAYS + 1).collect()]
    return days if len(days) <= MAX_NAMED_DAYS else None


def _dated(rows: DataFrame, table: Table) -> DataFrame:
    names = table.schema.names
    if table.day_of:
        rows = rows.withColumn("day", F.to_date(F.date_trunc(table.period, table.day_of)))
        names = [*names, "day"]
    return rows.select(*names)


def _same(keys: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(key).eqNullSafe(F.col(f"{prefix}{key}")) for key in keys]


def _digest(keys: Sequence[str], seed: int = 0) -> Column:
    """64 bits of a key; a NULL part is told from an absent one by its place."""
    return F.xxhash64(F.lit(seed), *[part for key in keys for part in (F.col(key).isNull(), F.col(key))])


def _judged(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with ``kept``: false for those that another load has stored.

    Rows meet the stored ones in one shuffle, that of parts of days, so the write needs no other.  Of stored rows only
    128 bits of their key are sent, as many as a computed id has.
    """
    names = rows.columns
    dated = ["day"] if "day" in keys else []
    digests = {f"_digest_{seed}": _digest([key for key in keys if key != "day"], seed) for seed in (1, 2)}
    absent = [F.lit(None).cast(rows.schema[name].dataType).alias(name) for name in names if name not in dated]
    part = F.pmod(digests["_digest_1"], F.lit(DAY_PARTS if dated else KEY_PARTS)).alias("_part")
    known = stored.select(*absent, *dated, part, *[digest.alias(name) for name, digest in digests.items()])
    met = rows.select("*", part, *[F.lit(None).cast("bigint").alias(name) for name in digests]).unionByName(known)
    # The digests of the rows themselves are computed where they arrive.
    met = met.repartition(*dated, "_part").withColumn("_known", F.col("_digest_1").isNotNull()).withColumns(
        {name: F.coalesce(name, digest) for name, digest in digests.items()})
    same = Window.partitionBy(*dated, "_part", *digests)
    judged = met.withColumn("kept", ~F.max("_known").over(same)).filter(~F.col("_known"))
    return judged.select(*names, "kept")


def _each_once(rows: DataFrame, store: Store, table: Table, keys: Sequence[str] | None) -> DataFrame:
    """Rows without copies (:func:`drop_identical`).

    Keys that may occur twice are found by hash first, so that only their rows are compared: few of a feed's rows
    are copies, and the others are not shuffled for it.
    """
    digest = _digest(keys or rows.columns)
    twice = rows.select(digest.alias("_digest")).groupBy("_digest").agg(F.count("*").alias("_rows")).filter("_rows > 1")
    path = f"{store.root}/_twice/{table.name}-{store.new_write()}"
    twice.select("_digest").write.parquet(path)
    named = store.spark.read.schema("_digest bigint").parquet(path)
    copies = named.count()
    if not copies:
        return rows
    if copies > NAMED_KEYS:
        return drop_identical(rows, keys)
    marked = rows.withColumn("_digest", digest)
    single = marked.join(F.broadcast(named), "_digest", "left_anti").drop("_digest")
    several = marked.join(F.broadcast(named), "_digest", "left_semi").drop("_digest")
    return single.unionAll(drop_identical(several, keys).select(*rows.columns))


def _load_key(table: Table) -> list[str]:
    """Columns that tell the rows of one load apart."""
    keyed = table.primary_key or table.one_for
    return list(keyed or [*table.schema.names, *(["day"] if table.day_of else [])])


def _summary(rows: DataFrame, table: Table, digested: bool) -> dict | None:
    """Of each day the number of rows and, if asked for, sums of their keys' digests, by which the same keys are known.

    ``None`` if the days are too many to be named.
    """
    digests = [_digest(_load_key(table), seed) for seed in (1, 2)] if digested else []
    halves = [half for digest in digests for half in (digest.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(digest, 32))]
    day = F.col("day") if table.day_of else F.lit(None).cast("date")
    sums = [F.try_sum(half).alias(f"sum_{place}") for place, half in enumerate(halves)]
    found = rows.groupBy(day.alias("day")).agg(F.count("*").alias("rows"), *sums).limit(MAX_NAMED_DAYS + 1).collect()
    return {row["day"]: tuple(row)[1:] for row in found} if len(found) <= MAX_NAMED_DAYS else None


def _rows_of(rows: DataFrame, summary: dict | None) -> int:
    return rows.count() if summary is None else sum(day[0] for day in summary.values())


class _Shared:
    """Answers that the tables of one load may share: each is computed once, and the others wait for it."""

    def __init__(self, tables: Iterable[Table] = ()) -> None:
        self._keys = Counter(_asked(table) for table in tables if not table.is_dimension)
        self._lock = threading.Lock()
        self._locks: dict[tuple, threading.Lock] = {}
        self._found: dict[tuple, tuple[DataFrame | None, bool]] = {}

    def by_several(self, table: Table) -> bool:
        """Whether another table has keys of the same names."""
        return self._keys[_asked(table)] > 1

    def get(self, question: tuple, compute: Callable[[], tuple[DataFrame | None, bool]]) -> tuple[DataFrame | None, bool]:
        with self._lock:
            lock = self._locks.setdefault(question, threading.Lock())
        with lock:
            if question not in self._found:
                self._found[question] = compute()
            return self._found[question]


def _asked(table: Table) -> tuple:
    return tuple(_load_key(table)), bool(table.day_of)


def _question(table: Table, new: dict | None, known: dict | None) -> tuple | None:
    """What the exceptions of a load depend on: the keys' names, and which keys are delivered and stored on each day."""
    if new is None or known is None or any(part is None for days in (new, known) for sums in days.values() for part in sums):
        return None
    return *_asked(table), frozenset(new.items()), frozenset(known.items())


def _exceptions(
    rows: DataFrame, stored: DataFrame | None, store: Store, table: Table, mostly_known: bool
) -> DataFrame | None:
    """Digests of the keys whose rows are not, like most, delivered once and (not) stored; ``None`` if they are many.

    Only digests are shuffled: 64 bits of a key where nothing is stored and keys that share them are compared all the same,
    else 128, as many as a computed id has.  ``copies`` are keys whose rows must be compared.
    """
    names = _digest_names(stored)
    day = F.coalesce(F.unix_date("day"), F.lit(-2_000_000_000)) if table.day_of else F.lit(0)

    def sent(frame: DataFrame) -> list[Column]:
        return [_digest(_load_key(table), seed).alias(name) for seed, name in enumerate(names, 1)]

    if stored is None:
        found = rows.select(*sent(rows)).groupBy(*names).agg(F.count("*").alias("_rows")).filter("_rows > 1").select(
            *names, F.lit(True).alias("copies"))
    else:
        nothing = F.lit(None).cast("int")
        met = rows.select(*sent(rows), day.alias("_new"), nothing.alias("_old")).unionAll(
            stored.select(*sent(stored), nothing.alias("_new"), day.alias("_old")))
        each = met.groupBy(*names).agg(
            F.count("_new").alias("_rows"), F.count("_old").alias("_stored"), F.min("_new").alias("_day"),
            F.min("_old").alias("_first"), F.max("_old").alias("_last")).filter("_rows > 0")
        # A stored key may lie in several days; with more than two, days between the first and the last are looked up.
        known = F.coalesce((F.col("_day") == F.col("_first")) | (F.col("_day") == F.col("_last")), F.lit(False))
        copies = (F.col("_rows") > 1) | (F.col("_stored") > 2)
        found = each.select(*names, copies.alias("copies"), known.alias("_known")).filter(
            F.col("copies") | (F.col("_known") != mostly_known)).drop("_known")
    path = f"{store.root}/_twice/{table.name}-{store.new_write()}"
    found.write.options(**COMPRESSED).parquet(path)
    named = store.spark.read.schema(found.schema).parquet(path)
    return named if named.count() <= NAMED_KEYS else None


def _digest_names(stored: DataFrame | None) -> list[str]:
    return ["_digest_1"] if stored is None else ["_digest_1", "_digest_2"]


def _where_they_lie(
    rows: DataFrame, stored: DataFrame | None, table: Table, named: DataFrame, mostly_known: bool
) -> DataFrame:
    """Rows with ``kept``, which is NULL for those whose key may occur twice; no row is shuffled."""
    met = _marked(rows, table, stored).join(F.broadcast(named), _digest_names(stored), "left")
    kept = F.col("copies").isNotNull() if mostly_known else F.col("copies").isNull()
    return met.select(*rows.columns, F.when(F.col("copies"), F.lit(None).cast("boolean")).otherwise(kept).alias("kept"))


def _marked(frame: DataFrame, table: Table, stored: DataFrame | None) -> DataFrame:
    digests = {name: _digest(_load_key(table), seed) for seed, name in enumerate(_digest_names(stored), 1)}
    return frame.withColumns(digests)


def _compared(
    copies: DataFrame, stored: DataFrame | None, table: Table, keys: Sequence[str], named: DataFrame
) -> DataFrame:
    """Rows whose key may occur twice: each once, with ``kept``."""
    once = drop_identical(copies, table.primary_key or table.one_for or None).select(*copies.columns)
    if stored is None:
        return once.withColumn("kept", F.lit(True))
    names = _digest_names(stored)
    same = _marked(stored, table, stored).join(F.broadcast(named.filter("copies").select(*names)), names, "left_semi")
    return _judged(once, same.select(*stored.columns), keys)


def _holding(store: Store, table: Table, folders: Sequence[Folder], load: str) -> list[Folder]:
    """Of folders that may hold rows of a load those that do; Parquet statistics answer for most files."""
    sure = [folder for folder in folders if folder.loads is not None and folder.may_hold(load)]
    open_ = [folder for folder in folders if folder.loads is None]
    if not open_:
        return sure
    top = f"{store.root}/{table.name}"
    schema = T.StructType([T.StructField("batch", T.StringType())])
    for part in ("write", "kept", "day"):
        schema.add(part, T.StringType())
    rows = store.spark.read.schema(schema).option("basePath", top).parquet(*[f.path(store.root, table.name) for f in open_])
    day = [F.col("day")] if table.day_of else [F.lit(None).alias("day")]
    found = {
        (row["write"], row["kept"] == "true", None if not table.day_of else row["day"] or NO_DAY)
        for row in rows.filter(F.col("batch") == load).select("write", "kept", *day).distinct().collect()}
    return sure + [folder for folder in open_ if (folder.write, folder.kept, folder.day) in found]


def _loads_of(folders: Iterable[Folder], *more: str) -> set[str] | None:
    """The loads that some folders name, and some more; ``None`` if one of the folders may hold any."""
    folders = list(folders)
    return None if any(f.loads is None for f in folders) else {*more, *(load for f in folders for load in f.loads)}


def rows_of_load(store: Store, table: Table, folders: Sequence[Folder], load: str) -> tuple[list[Folder], DataFrame]:
    """The folders that hold rows of a load, and these rows."""
    holding = _holding(store, table, folders, load)
    return holding, read_folders(store, table, holding).filter(F.col("batch") == load)


def _with_load(
    rows: DataFrame, store: Store, version: Version, table: Table, load: str, shared: _Shared | None = None
) -> list[Folder]:
    """The table's folders with the rows of a load in the place of those that the load had delivered before.

    A stored copy is looked for in the folders of the row's own day: what is delivered again has its day again.
    Folders of other loads are not written again, unless compaction has put rows of this load among theirs.
    """
    folders = store.folders(version, table.name)
    dated = _dated(rows, table)
    own = _holding(store, table, folders, load) if folders else []
    if own:
        return _in_place(dated, store, table, load, folders, own)
    return folders + _added(dated, store, table, load, folders, shared or _Shared())


def _added(
    dated: DataFrame, store: Store, table: Table, load: str, folders: Sequence[Folder], shared: _Shared
) -> list[Folder]:
    """New folders with the rows of a load that the table does not hold yet.

    Most rows of a load are new, or most have been stored by another load.  The keys of the others are found by their digests
    and named to all tasks, so rows need not be shuffled to be compared; where they are too many, rows are.
    """
    keys = [*table.row_key, *(["day"] if table.day_of else [])]
    several = shared.by_several(table)
    new = _summary(dated, table, several)
    held = _of_days([f for f in folders if f.kept], list(new) if table.day_of and new is not None else None)
    stored = read_folders(store, table, held).filter(F.col("batch") != load) if held else None
    known = _summary(stored, table, several) if held else {}
    size = _rows_of(dated, new)
    # A load has copies and the store has each key once, so as many rows as are stored may be fewer than those delivered.
    guess = stored is not None and 2 * _rows_of(stored, known) >= size

    def exceptions() -> tuple[DataFrame | None, bool]:
        named = _exceptions(dated, stored, store, table, guess)
        if named is None and stored is not None:
            return _exceptions(dated, stored, store, table, not guess), not guess
        return named, guess

    question = _question(table, new, known) if several else None
    named, mostly_known = exceptions() if question is None else shared.get((stored is None, *question), exceptions)
    days = 1
    if table.day_of:
        days = len(new) if new is not None else dated.agg(F.countDistinct("day").alias("days")).first()["days"]
    dealt = size >= DAY_ROWS * max(days, 1)

    def filled(parts: DataFrame, dealt: bool, *also: str) -> list[Folder]:
        delivered = parts.withColumn("batch", F.lit(load)).select(*table.stored_schema.names, "kept", *also)
        return _fill(delivered, store, table, {load}, dealt)

    if named is None:
        once = _each_once(dated, store, table, table.primary_key or table.one_for or None)
        if stored is None:
            return filled(once.withColumn("kept", F.lit(True)), dealt)
        return filled(_judged(once, stored, keys), True)
    if dealt:
        dated = dated.coalesce(max(size // TASK_ROWS, TASKS_PER_CORE * store.spark.sparkContext.defaultParallelism))
    if named.isEmpty():
        return filled(dated.withColumn("kept", F.lit(not mostly_known)), dealt)
    # Rows that must be compared are put aside by the same write, in one folder: the load is not read once more for them.
    judged = _where_they_lie(dated, stored, table, named, mostly_known)
    if table.day_of:
        day = F.col("day")
        judged = judged.withColumns({"day": F.when(F.col("kept").isNotNull(), day), ASIDE: F.when(F.col("kept").isNull(), day)})
    written = filled(judged, dealt, *([ASIDE] if table.day_of else []))
    aside = [folder for folder in written if folder.kept is None]
    found = [folder for folder in written if folder.kept is not None]
    if not aside:
        return found
    return found + filled(_compared(_put_aside(store, table, aside, dated.columns), stored, table, keys, named), True)


def _put_aside(store: Store, table: Table, folders: Sequence[Folder], columns: Sequence[str]) -> DataFrame:
    """Rows that a write has put aside, with the day that it has written beside them."""
    schema = T.StructType([table.stored_schema[name] for name in columns if name != "day"])
    if table.day_of:
        schema.add(ASIDE, T.DateType())
    rows = store.spark.read.schema(schema).parquet(*[folder.path(store.root, table.name) for folder in folders])
    return rows.withColumnRenamed(ASIDE, "day").select(*columns)


def _in_place(
    dated: DataFrame, store: Store, table: Table, load: str, folders: Sequence[Folder], own: Sequence[Folder]
) -> list[Folder]:
    """The table's folders after a repeated load."""
    keys = [*table.row_key, *(["day"] if table.day_of else [])]
    once = _each_once(dated, store, table, table.primary_key or table.one_for or None)
    delivered = once.withColumn("batch", F.lit(load))
    columns = table.stored_schema.names
    days = _days_of(dated) if table.day_of else None
    others = read_folders(store, table, _of_days([f for f in folders if f.kept and f.loads != (load,)], days))
    parts = [_judged(delivered, others.filter(F.col("batch") != load), keys).select(*columns, "kept")]
    moved: list[Folder] = []  # folders with rows of other loads that are written again
    # Facts that this load held and no longer delivers go to the first other load that delivered them.
    held = read_folders(store, table, [f for f in own if f.kept]).filter(F.col("batch") == load)
    gone = absent_from(held.select(*keys), once, keys)
    own_days = [None if f.day == NO_DAY else f.day for f in own] if table.day_of else None
    again = [f for f in _of_days(folders, own_days) if not f.kept and f.loads != (load,)]
    if again:
        repeats = read_folders(store, table, again).filter(F.col("batch") != load)
        left = repeats.join(
            gone.select(*[F.col(key).alias(f"_gone_{key}") for key in keys]), _same(keys, "_gone_"), "left_semi")
        parts.append(keep_one_per_key(left, keys, ["batch"]).withColumn("kept", F.lit(True)))
        moved += again
    mixed = [f for f in own if f.loads != (load,)]
    for kept in {folder.kept for folder in mixed}:
        rest = read_folders(store, table, [f for f in mixed if f.kept == kept]).filter(F.col("batch") != load)
        parts.append(rest.withColumn("kept", F.lit(kept)))
    moved += mixed
    new = _fill(reduce(DataFrame.unionByName, parts), store, table, _loads_of(moved, load), dealt=len(parts) == 1)
    return [folder for folder in folders if folder not in own] + new


def _in_thread(function: Callable[[str], None], spark: SparkSession) -> Callable[[str], None]:
    """The function for another thread, which gets the job properties of this one."""
    return inheritable_thread_target(spark)(function)


def _change(
    store: Store, tables: Mapping[str, Table], names: Sequence[str],
    changed: Callable[[Version, Table], list[Folder]], streams: Mapping[str, int] | None = None, together: bool = False,
) -> Version:
    """Commit the changed folders of some tables as one.

    When another writer commits first, the tables that it has changed are computed again, with ``together`` all
    of them if it has changed any.
    """
    computed: dict[str, tuple[str | None, list[Folder]]] = {}
    for _ in range(ATTEMPTS):
        base = store.latest()
        if any(base.streams.get(stream, -1) >= batch for stream, batch in (streams or {}).items()):
            return base

        def compute(name: str, base: Version = base) -> None:
            computed[name] = base.lists.get(name), changed(base, tables[name])

        stale = [name for name in names if name not in computed or computed[name][0] != base.lists.get(name)]
        stale = list(names) if together and stale else stale
        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            for done in [pool.submit(_in_thread(compute, store.spark), name) for name in stale]:
                done.result()
        try:
            return store.commit(base, {name: folders for name, (_, folders) in computed.items()}, streams)
        except Conflict:
            continue
    raise Conflict(f"{ATTEMPTS} other commits came first")


def load_tables(
    frames: Mapping[str, DataFrame], tables: Mapping[str, Table], root: str, batch: str,
    streams: Mapping[str, int] | None = None,
) -> None:
    """Write one load of a feed, a few tables at a time, and commit it as a whole.

    ``streams`` names the stream's batch that the load is; a batch that has been committed is left as it is.
    """
    store = Store(next(iter(frames.values())).sparkSession, root)
    shared = _Shared([tables[name] for name in frames])

    def changed(version: Version, table: Table) -> list[Folder]:
        if table.is_dimension:
            return _with_dimension_rows(frames[table.name], store, version, table)
        return _with_load(frames[table.name], store, version, table, batch, shared)

    _change(store, tables, list(frames), changed, streams)


def load_table(rows: DataFrame, root: str, table: Table, batch: str) -> None:
    """Write one load of a single table."""
    load_tables({table.name: rows}, {table.name: table}, root, batch)


def withdraw(spark: SparkSession, root: str, tables: Mapping[str, Table], batch: str) -> None:
    """Take back a load: its facts go, those that other loads delivered too stay under the first of them.

    Dimension rows stay: later loads may use them.
    """
    store = Store(spark, root)

    def changed(version: Version, table: Table) -> list[Folder]:
        folders = store.folders(version, table.name)
        if not any(folder.may_hold(batch) for folder in folders):
            return folders
        nothing = T.StructType(list(table.schema.fields))
        if table.day_of and table.day_of not in nothing.names:
            nothing.add(table.day_of, T.TimestampType())
        return _with_load(spark.createDataFrame([], nothing), store, version, table, batch)

    _change(store, tables, [name for name, table in tables.items() if not table.is_dimension], changed)


def batches_of(spark: SparkSession, root: str, table: Table) -> list[str]:
    """Names of the loads that hold facts of the table."""
    return sorted(row["batch"] for row in read_table(spark, root, table).select("batch").distinct().collect())


def _tier(size: int) -> int:
    """Sizes of one tier lie within a factor ``TIER``; everything up to a megabyte is one."""
    tier = 0
    while size > (1 << 20) * TIER ** tier:
        tier += 1
    return tier


def _crowded(folders: Sequence[Folder], least: int) -> list[Folder]:
    """Folders to be put together: of each day, and apart for repeats, tiers with enough folders."""
    tiers: dict[tuple, list[Folder]] = {}
    for folder in folders:
        if folder.size < FULL_FOLDER:
            tiers.setdefault((folder.kept, folder.day, _tier(folder.size)), []).append(folder)
    return [folder for group in tiers.values() if len(group) >= least for folder in group]


def compact(
    spark: SparkSession, root: str, table: Table, least: int = TIER, combine: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Put small folders of a table together, by day and size; returns how many.

    Size tiers keep the work in bounds: a row is written again once for each tier, so a number of times that grows
    with the logarithm of its folder's size.  Rows keep their load, which can still be replaced or withdrawn, unless
    ``combine`` makes fewer rows of them.
    """
    store = Store(spark, root)
    merged: list[Folder] = []

    def changed(version: Version, table: Table) -> list[Folder]:
        folders = store.folders(version, table.name)
        merged[:] = _crowded(folders, least)
        if not merged:
            return folders
        parts = [
            (combine or (lambda rows: rows))(read_folders(store, table, some)).withColumn("kept", F.lit(kept))
            for kept in (True, False) if (some := [f for f in merged if f.kept == kept])]
        chosen = set(merged)
        return [f for f in folders if f not in chosen] + _fill(
            reduce(DataFrame.unionByName, parts), store, table, _loads_of(merged))

    _change(store, {table.name: table}, [table.name], changed)
    return len(merged)


def remove_duplicates(
    spark: SparkSession, root: str, table: Table, business_key: tuple[str, ...], tie_break: tuple[str, ...],
    children: Mapping[str, tuple[Table, tuple[str, ...]]],
) -> None:
    """Delete stored copies, rows with one business key, and what hangs below the deleted rows.

    For tables with rows whose ids are not computed, as another system may have left them.  The first row by
    ``tie_break`` stays.  ``children`` maps names to (table, columns that refer to ``tie_break``); a child lies in
    the day of its parent.  Only the folders of days that hold copies are written again, and the parent and its
    children change in one commit.  A table without copies is left untouched.
    """
    store = Store(spark, root)
    specs = {table.name: table, **{child.name: child for child, _ in children.values()}}
    refers = {child.name: columns for child, columns in children.values()}
    day = ["day"] if table.day_of else []
    found: dict[int, DataFrame] = {}
    finding = threading.Lock()

    def surplus(version: Version) -> DataFrame:
        """Id and day of the rows to be deleted, written once and kept as a record below the store."""
        with finding:
            if version.number not in found:
                rows = read_folders(store, table, [f for f in store.folders(version, table.name) if f.kept])
                renamed = [F.col(key).alias(f"_copy_{key}") for key in business_key]
                first = rows.groupBy(*business_key).agg(
                    F.count("*").alias("_copies"), *[F.min(F.struct(*tie_break)).alias("_first")])
                crowd = rows.join(
                    first.filter("_copies > 1").select(*renamed, "_first"), _same(business_key, "_copy_"))
                lost = crowd.filter(~F.col("_first").eqNullSafe(F.struct(*tie_break))).select(*tie_break, *day)
                path = f"{store.root}/_deleted/{table.name}-{store.new_write()}"
                lost.write.parquet(path)
                found[version.number] = spark.read.schema(lost.schema).parquet(path)
            return found[version.number]

    def changed(version: Version, spec: Table) -> list[Folder]:
        folders = store.folders(version, spec.name)
        deleted = surplus(version)
        if deleted.isEmpty():
            return folders
        columns = refers.get(spec.name, tie_break)
        aligned = bool(table.day_of and spec.day_of) and spec.period == table.period
        touched = _of_days([f for f in folders if f.kept], _days_of(deleted) if aligned else None)
        lost = deleted.select(*[F.col(key).alias(f"_lost_{name}") for key, name in zip(tie_break, columns)])
        left = read_folders(store, spec, touched).join(lost, _same(columns, "_lost_"), "left_anti")
        chosen = set(touched)
        return [f for f in folders if f not in chosen] + _fill(
            left.withColumn("kept", F.lit(True)), store, spec, _loads_of(touched))

    _change(store, specs, list(specs), changed, together=True)
