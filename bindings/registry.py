from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sensorloom.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that checks it."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDERS: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Folder that ``write`` fills; done once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FOLDERS:
        folder = shared_folder(spark, name)
        write(folder)
        _FOLDERS[key] = folder
    return _FOLDERS[key]


#: Rows of a table that one landed file is made of.
LANDED_ROWS = 500_000


def landed(spark: SparkSession, sf_dir: str, name: str, source: str, documents: Callable[[DataFrame], DataFrame]) -> str:
    """Folder with the documents as JSON lines, in several compressed files as they would land.

    The rows of the source table are dealt to the files: they are far smaller than the documents made of them.
    """
    def write(folder: str) -> None:
        rows = table(spark, sf_dir, source)
        files = max(spark.sparkContext.defaultParallelism, rows.count() // LANDED_ROWS)
        # Documents repeat their field names: the fastest level leaves little, and takes half the time.
        landing = documents(rows.repartition(files)).write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        landing.json(folder)

    return once(spark, sf_dir, name, write)


def guid(tag: str, *parts: str) -> str:
    """SQL of a surrogate key."""
    texts = "".join(f", coalesce(cast({part} AS varchar), chr(30))" for part in parts)
    groups = r"'(.{8})(.{4})(.{4})(.{4})(.{12})', '\1-\2-\3-\4-\5'"
    return f"regexp_replace(md5(concat_ws(chr(31), '{tag}'{texts})), {groups})"
