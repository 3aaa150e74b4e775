"""Mixing sources to target weights by a curriculum that changes over training time.

Every source has a weight schedule over the training time t in [0, 1], here a ramp
``weight * (1 + slope * (2 t - 1))`` whose integral over the whole time is the weight.  The
cumulative demand of a source is therefore ``target * (t + slope * (t * t - t))``, and the word at
offset c of the source's shuffled stream is trained at the t where the demand reaches c.  A stream
repeats its documents in the same order until the target is met; its last document may be cut.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source of its
own, last in order; no documents give no rows; rows that repeat a doc_id are documents of their own;
ties in the shuffled order go by doc_id, then size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.llm.common import stored, text_of, words

WEIGHTS = (3.0, 1.0, 2.0)
SLOPES = (-0.5, 0.0, 0.5)
SHARE, CAP = 1.5, 2.0
#: Targets of so many sources, of about 100 bytes each, are broadcast; more are joined by shuffles.
MAX_BROADCAST_SOURCES = 10_000

#: Columns that a mix adds.
RESULTS = ("source_size", "target", "taken", "position", "again_position", "first_words")

_SPREAD = 2.0 ** 32


def word_sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source and size in words."""
    return documents.select("doc_id", "source", F.size(words(text_of())).cast("long").alias("size"))


def targets(sized: DataFrame, weights=WEIGHTS, slopes=SLOPES, share=SHARE, cap=CAP) -> DataFrame:
    """One row per source: its size, rows, target and slope.

    Targets share ``share`` times all words by weight.  None exceeds ``cap`` times its source: with
    the sources in order of cap per weight, the first so many are capped, and the rest share what is
    left; the level of the rest is that of the first source which it does not lift over its cap.
    """
    by_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(in_order) - 1

    def cycled(values) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("turn") % len(values) + 1).cast("int"))

    weighted = by_source.withColumn("turn", turn).withColumns({
        "weight": cycled(weights), "slope": cycled(slopes), "cap": F.lit(float(cap)) * F.col("source_size")})
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "turn")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    levels = weighted.withColumn(
        "level",
        (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    fits = F.col("level") <= F.col("cap") / F.col("weight")
    level = F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("cap") / F.col("weight"))).over(everything)
    return levels.withColumn(
        "target", F.least(F.col("cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    ).select("source", "source_size", "source_rows", "target", "slope")


def time_of(offset: Column, target: Column, slope: Column) -> Column:
    """Training time at which a ramp's cumulative demand reaches the offset."""
    reached = offset / target
    rest = F.lit(1.0) - slope
    return F.lit(2.0) * reached / (rest + F.sqrt(rest * rest + F.lit(4.0) * slope * reached))


def mix(sized: DataFrame, weights=WEIGHTS, slopes=SLOPES, share=SHARE, cap=CAP, ties: tuple[str, ...] = ()) -> DataFrame:
    """Words taken of each row of ``sized`` (doc_id, source, size, ties), and when they are trained.

    Other columns are kept, whatever their names, but for those that the results replace.  Adds source_size, target, taken, position (of the first pass) and again_position (of the second;
    null where the pass takes nothing).  The offset of a row in its source is a sum in two steps:
    over slices of the shuffled order, then inside each slice, so that a source that holds most rows
    is spread over many tasks.  Only one row per source, and one per slice, meet in one task.
    """
    own = ["doc_id", "source", "size", *ties]
    others = [name for name in sized.columns if name not in (*own, *RESULTS)]
    # Other columns travel as one, so that no name of theirs can clash.
    rest = F.struct(*[sized[f"`{name}`"] for name in others], F.lit(0).alias("_"))
    sized = sized.select(*own, rest.alias("rest"))
    sources = stored(targets(sized, weights, slopes, share, cap), "targets")
    if sources.count() <= MAX_BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    shuffled = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    place = F.conv(F.substring(shuffled, 1, 8), 16, 10).cast("double") / F.lit(_SPREAD)
    slices = F.ceil(F.col("source_rows") / F.greatest(F.lit(512.0), F.sqrt("source_rows")))
    placed = sized.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.*", "source_size", "target", "slope", shuffled.alias("_order"),
        F.floor(place * slices).alias("_slice"))
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    placed = placed.withColumn("_source", key)
    earlier = Window.partitionBy("_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_source", "_slice").agg(F.sum("size").alias("_words")).select(
        "_source", "_slice", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_source", "_slice").orderBy("_order", "doc_id", "size", *ties).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    offset = F.col("_start") + F.col("_within") - F.col("size")
    again = offset + F.col("source_size")

    def taken(start: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - start))

    first, second = taken(offset), taken(again)
    results = {
        "taken": (first + second).cast("long"),
        "position": F.when(first > 0, time_of(offset, F.col("target"), F.col("slope"))),
        "again_position": F.when(second > 0, time_of(again, F.col("target"), F.col("slope"))),
        "first_words": first.cast("long")}
    return (
        placed.withColumn("_within", F.sum("size").over(inside)).join(starts, ["_source", "_slice"])
        .select(*own, *[F.col("rest").getField(name).alias(name) for name in others], "source_size", "target",
                *[column.alias(name) for name, column in results.items()]))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """Rows sorted by range over the training positions; rows that are not taken come last."""
    return mixed.orderBy(F.col("position").asc_nulls_last(), "doc_id", "size")
