"""JSON documents from a landing folder, as a batch or as a stream."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

UNREADABLE = "unreadable_record"
LISTING, LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 64


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType, stream: bool = False, multi_line: bool = False
) -> DataFrame:
    """One row per document, with an extra column that holds the text of unreadable ones.

    ``multi_line`` is for files that hold one pretty-printed document each; the default is one
    document per line, which lets Spark split large files.
    """
    reader = spark.readStream if stream else spark.read
    full = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])
    return (
        reader.schema(full).option("columnNameOfCorruptRecord", UNREADABLE)
        .option("multiLine", multi_line).json(path)
    )


def read_keyed_documents(
    spark: SparkSession, path: str, schema: T.StructType, keys: Mapping[str, str], multi_line: bool = False,
) -> DataFrame:
    """Documents with columns that the path of their file gives: name to a pattern with one group, '' where it fails."""
    place = F.col("_metadata.file_path")
    with _listed_by_few(spark):
        documents = read_documents(spark, path, schema, multi_line=multi_line)
    return documents.select(*schema.names, UNREADABLE, *[F.regexp_extract(place, pattern, 1).alias(name) for name, pattern in keys.items()])


@contextlib.contextmanager
def _listed_by_few(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by at most ``LISTING_TASKS`` tasks at a time: by default each of them is a task of its own."""
    before = spark.conf.get(LISTING, None)
    spark.conf.set(LISTING, str(LISTING_TASKS))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(LISTING)
        else:
            spark.conf.set(LISTING, before)


def readable(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col(UNREADABLE).isNull()).drop(UNREADABLE)


def read_envelope(
    spark: SparkSession, path: str, element: T.StructType, envelope: str = "sensorMessages",
    stream: bool = False, multi_line: bool = False,
) -> DataFrame:
    """Elements of the list that each document carries under ``envelope``, one row each."""
    schema = T.StructType([T.StructField(envelope, T.ArrayType(element))])
    documents = read_documents(spark, path, schema, stream, multi_line)
    return unwrap(readable(documents), envelope)


def unwrap(documents: DataFrame, envelope: str) -> DataFrame:
    return documents.select(F.explode(envelope).alias("_element")).select("_element.*")
