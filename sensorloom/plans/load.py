"""Batch loads of a feed."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from sensorloom.sources.tables import COMPRESSED, Table, load_tables


def load_batch(
    documents: DataFrame, prepare: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    build: Callable[[DataFrame], Mapping[str, DataFrame]], tables: Mapping[str, Table], root: str, batch: str,
    staging: str, stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Load documents into the feed's tables and return the rejected ones.

    The source is parsed once: the documents are first written to ``staging`` as Parquet, and accepted and
    rejected ones, and each table from the columns it needs, are cut from there.  A lost executor costs a
    re-read instead of a re-parse.  Repeating a batch replaces its rows; facts that another batch
    has stored are not stored again.

    ``stage`` judges documents and cuts them to what the tables need before they are written, so one write does:
    without it accepted documents are written once more.  ``prepare`` gets what it has written.
    """
    spark = documents.sparkSession
    folder = f"{staging}/{batch}"

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").options(**COMPRESSED).parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    accepted, rejected = prepare(written(stage(documents) if stage else documents, "documents"))
    load_tables(build(accepted if stage else written(accepted, "accepted")), tables, root, batch)
    return rejected
