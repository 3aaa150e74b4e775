"""Mean per time bin, and gapless grids of bins.

Bins are closed on the left, labelled by their start and aligned to midnight of the first day.
NULL and NaN values are skipped.  ``by`` names the columns that identify one series; without it
the whole frame is one series with a column per channel.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.functions.temporal import DAY_SECONDS, MICROS, seconds_of

GRID_CHUNK = 256  # bins generated per intermediate row


def _number(name: str) -> Column:
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _binned(rows: DataFrame, timestamp: str, seconds: int) -> DataFrame:
    """Timestamps replaced by the start of their bin, counted from the epoch; NULL ones dropped."""
    start = F.window(F.col(timestamp), f"{seconds} seconds").getField("start")
    return rows.withColumn(timestamp, start).filter(F.col(timestamp).isNotNull())


def _interval(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds))


def time_bounds(df: DataFrame, timestamp: str, by: Sequence[str] = ()) -> DataFrame:
    """First and last timestamp of each series."""
    return df.groupBy(*by).agg(F.min(timestamp).alias("first_ts"), F.max(timestamp).alias("last_ts"))


def _unpack(df: DataFrame, by: Sequence[str], timestamp: str, values: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"_series.{name}") for name in by], timestamp, *values)


def _series_mean(
    df: DataFrame, timestamp: str, values: Sequence[str], seconds: int, by: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(_series, bin, means), and the (_series, _lo, _hi) of its first and last bin.

    The series is one struct, so a NULL series name equals itself.
    """
    rows = df.select(F.struct(F.lit(0), *by).alias("_series"), timestamp, *values)
    if DAY_SECONDS % seconds == 0:
        binned = _binned(rows, timestamp, seconds)
        means = binned.groupBy("_series", timestamp).agg(*[F.avg(_number(name)).alias(name) for name in values])
        return means, _bounds(means, timestamp, values)
    return _series_mean_from_first_midnight(rows, timestamp, values, seconds)


def _series_mean_from_first_midnight(
    rows: DataFrame, timestamp: str, values: Sequence[str], seconds: int
) -> tuple[DataFrame, DataFrame]:
    """For periods that do not divide a day the bins depend on each series' first day.

    Sums and counts per fine step (which divides both the period and a day) are enough to find the
    first day and to build the final bins and their bounds, so only these sums are shuffled and joined.
    """
    step = gcd(seconds, DAY_SECONDS)
    # Parts that one series is spread over when it is joined with its first day.
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = [agg for index, name in enumerate(values) for agg in (
        F.sum(_number(name)).alias(f"_s{index}"), F.count(_number(name)).alias(f"_n{index}"))]
    fine = _binned(rows, timestamp, step).groupBy("_series", timestamp).agg(*sums)
    used = F.coalesce(*[F.col(f"_s{index}") + F.col(f"_n{index}") for index in range(len(values))])
    kind = rows.schema[timestamp].dataType

    def bin_of(column: Column) -> Column:
        offset = F.unix_micros(column.cast("timestamp")) - F.col("_origin")
        whole = F.col("_origin") + F.floor(offset / (seconds * MICROS)) * (seconds * MICROS)
        return F.timestamp_micros(whole).cast(kind)

    starts = _read_once(fine.groupBy("_series").agg(
        F.min(timestamp).alias("_lo"), F.max(timestamp).alias("_hi"), F.count(used).alias("_tally"))
    ).withColumn("_origin", F.unix_micros(F.date_trunc("day", "_lo")))
    spread = starts.select("_series", "_origin", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    salted = fine.withColumn("_salt", F.pmod(F.xxhash64(timestamp), F.lit(salts)).cast("int"))
    means = (
        salted.join(spread, ["_series", "_salt"])
        .groupBy("_series", bin_of(F.col(timestamp)).alias(timestamp))
        .agg(*[(F.sum(f"_s{i}") / F.nullif(F.sum(f"_n{i}"), F.lit(0))).alias(name) for i, name in enumerate(values)])
    )
    return means, starts.select("_series", bin_of(F.col("_lo")).alias("_lo"), bin_of(F.col("_hi")).alias("_hi"))


def _read_once(bounds: DataFrame) -> DataFrame:
    """Keep the bounds on the shuffled aggregate that the other side of the join uses.

    Without a use of the tally the planner would compute the bounds by a second scan of the input;
    with it both sides need the same aggregate and share its shuffle.
    """
    return bounds.filter("_tally >= 0").drop("_tally")


def _bounds(keyed: DataFrame, timestamp: str, values: Sequence[str]) -> DataFrame:
    return _read_once(keyed.groupBy("_series").agg(
        F.min(timestamp).alias("_lo"), F.max(timestamp).alias("_hi"), F.count(F.coalesce(*values)).alias("_tally")))


def _fill(keyed: DataFrame, bounds: DataFrame, timestamp: str, seconds: int) -> DataFrame:
    span = seconds * GRID_CHUNK
    # A given number of partitions is not merged by adaptive execution, which would judge the chunks
    # by their small size and expand all of them in one task.
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (
        bounds.select("_series", "_hi", F.explode(F.sequence("_lo", "_hi", _interval(span))).alias("_chunk"))
        .repartition(tasks, "_series", "_chunk")
    )
    last = F.least(F.col("_hi"), F.col("_chunk") + _interval(span - seconds))
    grid = chunks.select("_series", F.explode(F.sequence("_chunk", last, _interval(seconds))).alias(timestamp))
    return grid.join(keyed, ["_series", timestamp], "left")


def resample_mean(
    df: DataFrame, timestamp: str, values: Sequence[str], period: str | int = "10min", by: Sequence[str] = ()
) -> DataFrame:
    """One row per series and non-empty bin, with the mean of each value column."""
    return _unpack(_series_mean(df, timestamp, values, seconds_of(period), by)[0], by, timestamp, values)


def gapless_grid(
    binned: DataFrame, timestamp: str, period: str | int = "10min", by: Sequence[str] = ()
) -> DataFrame:
    """Every bin between the first and the last of each series; bins without a row get NULLs.

    The range of a series is cut into chunks that are spread over the cluster before they are
    expanded, so neither one long series nor a stray far-off timestamp is expanded by one task.
    """
    values = [name for name in binned.columns if name not in (*by, timestamp)]
    keyed = binned.select(F.struct(F.lit(0), *by).alias("_series"), timestamp, *values)
    bounds = _bounds(keyed, timestamp, values)
    return _unpack(_fill(keyed, bounds, timestamp, seconds_of(period)), by, timestamp, values)


def resample_grid(
    df: DataFrame, timestamp: str, values: Sequence[str], period: str | int = "10min", by: Sequence[str] = ()
) -> DataFrame:
    """Mean per bin on a gapless grid."""
    seconds = seconds_of(period)
    means, bounds = _series_mean(df, timestamp, values, seconds, by)
    return _unpack(_fill(means, bounds, timestamp, seconds), by, timestamp, values)
