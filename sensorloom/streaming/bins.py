"""Means per bin that late rows can still change: sums and counts are stored, and added up on reading.

Every micro-batch adds one row for each series and bin that it has rows of, so a late row costs as much as any other
and nothing is computed again from the archive.  ``merge_bins`` makes one row of the rows of a bin.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.functions.temporal import seconds_of
from sensorloom.sources.tables import Table, compact, load_tables, read_table
from sensorloom.streaming.ingest import start_named

BIN, PART = "bin_start", "part"


@dataclass(frozen=True)
class Bins:
    """Bins of a period, which must divide a day, per series; ``by`` are columns with their types."""

    name: str
    timestamp: str
    values: Sequence[str]
    period: str | int = "10min"
    by: str = ""

    def __post_init__(self) -> None:
        if 86_400 % seconds_of(self.period):
            raise ValueError("a streamed period must divide a day")

    @property
    def series(self) -> list[str]:
        return [part.split()[0] for part in self.by.split(",") if part.strip()]

    @property
    def table(self) -> Table:
        sums = ", ".join(f"{name}_sum double, {name}_count bigint" for name in self.values)
        series = f"{self.by}, " if self.by else ""
        return Table(
            self.name, f"{series}{BIN} timestamp, {PART} string, {sums}", primary_key=(*self.series, BIN, PART), day_of=BIN)

    def partial(self, rows: DataFrame, part: str) -> DataFrame:
        """One row per series and bin; rows without a timestamp belong to no bin, NaN counts as no value."""
        start = F.window(F.col(self.timestamp).cast("timestamp"), f"{seconds_of(self.period)} seconds").getField("start")
        plain = {name: F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")) for name in self.values}
        sums = [column for name, value in plain.items()
                for column in (F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_count"))]
        dated = rows.filter(F.col(self.timestamp).isNotNull())
        return dated.groupBy(*self.series, start.alias(BIN)).agg(*sums).withColumn(PART, F.lit(part))


def stream_bins(
    rows: DataFrame, bins: Bins, root: str, checkpoint: str, period: str | None = None
) -> StreamingQuery:
    """Add a stream to the stored bins; a repeated micro-batch counts once."""
    def write(batch: DataFrame, batch_id: int, stream: str) -> None:
        load = f"stream-{stream}-{batch_id}"
        load_tables({bins.name: bins.partial(batch, load)}, {bins.name: bins.table}, root, load, {stream: batch_id})

    return start_named(rows, write, checkpoint, period)


def _added(rows: DataFrame, bins: Bins, *more) -> DataFrame:
    sums = [F.sum(f"{name}_{kind}").alias(f"{name}_{kind}") for name in bins.values for kind in ("sum", "count")]
    return rows.groupBy(*bins.series, BIN, *[name for name in ("day",) if name in rows.columns]).agg(*sums, *more)


def read_bins(spark: SparkSession, root: str, bins: Bins) -> DataFrame:
    """(series, timestamp, means) of all bins with rows; a mean without values is NULL."""
    added = _added(read_table(spark, root, bins.table), bins)
    means = [F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_count")).alias(name) for name in bins.values]
    return added.select(*bins.series, F.col(BIN).alias(bins.timestamp), *means)


def merge_bins(spark: SparkSession, root: str, bins: Bins, least: int = 4) -> int:
    """Put small folders together, with one row for each bin in them; returns how many folders."""
    def combine(rows: DataFrame) -> DataFrame:
        merged = _added(rows, bins, F.min(PART).alias(PART), F.min("batch").alias("batch"))
        return merged.select(*rows.columns)

    return compact(spark, root, bins.table, least, combine)
