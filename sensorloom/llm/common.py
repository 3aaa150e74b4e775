"""Expressions and helpers that several operators share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorloom.session import shared_folder

#: Space and U+0009 to U+000D: the characters that separate words.
SPACES = " \t\n\x0b\x0c\r"


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def words(text: Column) -> Column:
    """Array of the maximal runs of characters other than SPACES."""
    spaced = F.translate(text, SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: they survive lost executors."""
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of text whose parcels one Python worker holds at once.
ROUTE_BYTES = 64 << 20


def routes_for(documents: DataFrame) -> int:
    """How many ranges parcels of the documents' texts are dealt to: as many as tasks, or more for much text."""
    size = documents.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(partitions(documents.sparkSession), -(-size // ROUTE_BYTES))


#: Rows and bytes that go to Python at once: texts have some kilobytes each, and Arrow buffers lie outside
#: the heap.
AT_ONCE = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def reachable(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, and get texts in batches of bounded size."""
    for key, most in AT_ONCE.items():
        present = spark.conf.get(key)
        if not (present.isdigit() and 0 < int(present) <= most):
            spark.conf.set(key, str(most))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
