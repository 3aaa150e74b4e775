"""All declared constraints of a feed's tables as one report."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.operators.combine import append_by_name
from sensorloom.operators.quality import (
    badly_formed, fk_orphans, missing, not_one_parent, pk_violations, row_check_counts, too_long,
)
from sensorloom.sources.store import Store
from sensorloom.sources.tables import Table, read_folders, rows_of_load


def constraint_report(
    frames: Mapping[str, DataFrame], tables: Mapping[str, Table], among: Callable[[str, str], DataFrame] | None = None,
) -> DataFrame:
    """(table_name, check_name, violations), one row per declared constraint.

    Each table is read once for the checks of single rows, once for its primary key and once per
    reference to another of the given tables.  ``among(table, other)`` gives the rows of ``other`` that can share a key
    with the frame's rows (``other`` the table itself) or be their parents; without it these are the frames.
    """
    among = among or (lambda table, other: frames[other])
    found: list[DataFrame] = []

    def add(table: str, counts: DataFrame) -> None:
        found.append(counts.select(F.lit(table).alias("table_name"), "check_name", "violations"))

    def add_count(table: str, check: str, offending: DataFrame) -> None:
        add(table, offending.agg(F.count("*").alias("violations")).withColumn("check_name", F.lit(check)))

    for name, frame in frames.items():
        table = tables[name]
        conditions = {}
        if table.required:
            conditions["not null"] = missing(table.required)
        if table.max_length:
            conditions["length"] = too_long(table.max_length)
        if table.generated_id:
            conditions["id format"] = badly_formed([table.generated_id])
        if table.one_parent_of:
            conditions["one parent"] = not_one_parent(table.one_parent_of)
        if conditions:
            add(name, row_check_counts(frame, conditions))
        if table.primary_key:
            rows = among(name, name)
            if rows is not frame:
                own = frame.select(*[F.col(key).alias(f"_own_{key}") for key in table.primary_key]).distinct()
                rows = rows.join(own, [F.col(key).eqNullSafe(F.col(f"_own_{key}")) for key in table.primary_key], "left_semi")
            add_count(name, "primary key", pk_violations(rows, table.primary_key))
        for columns, parent, parent_columns in table.references:
            if parent in frames:
                add_count(name, f"reference to {parent}", fk_orphans(frame, among(name, parent), columns, parent_columns))
    return append_by_name(*found)


def load_constraint_report(spark: SparkSession, root: str, tables: Mapping[str, Table], load: str) -> DataFrame:
    """The constraint report on the facts of one load; dimensions, whose rows have no load, are checked whole.

    Only folders that hold rows of the load are judged.  Copies of a key are looked for in the folders of the
    same days, where loads look for them too; parents in the same days if they are kept by the day of the same
    column, otherwise in the whole table, of which only the key is read.
    """
    store = Store(spark, root)
    version = store.latest()
    folders = {name: [f for f in store.folders(version, name) if f.kept] for name in tables}
    own = {name: rows_of_load(store, table, folders[name], load) for name, table in tables.items() if not table.is_dimension}
    days = {name: {folder.day for folder in holding} for name, (holding, _) in own.items()}

    def among(name: str, other: str) -> DataFrame:
        child, parent = tables[name], tables[other]
        aligned = bool(parent.day_of) and (child.day_of, child.period) == (parent.day_of, parent.period)
        near = [f for f in folders[other] if f.day in days[name]] if aligned and name in days else folders[other]
        return read_folders(store, parent, near)

    frames = {
        name: own[name][1] if name in own else read_folders(store, table, folders[name]) for name, table in tables.items()}
    return constraint_report(frames, tables, among)
