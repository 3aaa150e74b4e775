"""Star joins, enrichment and lookups.

No side is forced to be broadcast.  The planner broadcasts a side only when its known or measured
size is below ``spark.sql.autoBroadcastJoinThreshold``; above it the join shuffles, and adaptive
execution splits the partition of a hot key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

WILDCARDS = "%_"
#: Characters of the pieces that names are indexed by, and names of one piece that are checked together.
GRAM, GRAM_CELL = 3, 10_000
NO_ESCAPE = "\x01"  # LIKE patterns are data: a backslash in one is an ordinary character


def star_join(facts: DataFrame, dimensions: Sequence[tuple[DataFrame, str | Sequence[str]]]) -> DataFrame:
    """Inner join of facts with each (dimension, key columns) in turn."""
    for dimension, keys in dimensions:
        facts = facts.join(dimension, [keys] if isinstance(keys, str) else list(keys), "inner")
    return facts


def left_enrich(df: DataFrame, details: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Every row of ``df`` with the matching details.  ``null_safe`` lets NULL keys match each other."""
    if not null_safe:
        return df.join(details, list(keys), "left")
    renamed = details.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    return df.join(renamed, condition, "left").drop(*[f"_right_{key}" for key in keys])


def unique_lookup(lookup: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key: the smallest value wins where a key has several.

    Copies leave by hash before anything is sorted.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*values))
    rows = lookup.select(*keys, *values).distinct().withColumn("_rank", rank)
    return rows.filter("_rank = 1").select(*keys, *values)


def left_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """At most one match per row; no match gives NULL."""
    return left_enrich(df, unique_lookup(lookup, keys, values), keys)


def lookup_conflicts(lookup: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys that carry more than one distinct value."""
    return (
        lookup.select(*keys, *values).distinct().groupBy(*keys)
        .agg(F.count("*").alias("candidates")).filter("candidates > 1")
    )


def known_only(df: DataFrame, registry: DataFrame, on: str, registry_key: str | None = None) -> DataFrame:
    """Rows whose id is registered."""
    return _exists(df, registry, on, registry_key, "left_semi")


def unknown_only(df: DataFrame, registry: DataFrame, on: str, registry_key: str | None = None) -> DataFrame:
    """Rows whose id is not registered."""
    return _exists(df, registry, on, registry_key, "left_anti")


def _exists(df: DataFrame, registry: DataFrame, on: str, registry_key: str | None, how: str) -> DataFrame:
    ids = registry.select(F.col(registry_key or on).alias("_registered"))
    return df.join(ids, F.col(on) == F.col("_registered"), how)


def with_parent_timestamp(parents: DataFrame, updates: DataFrame, parent_key: str, timestamp: str) -> DataFrame:
    """Join parents with the rows of a many-parent timestamp table that belong to this kind of parent.

    Every row of the timestamp table counts; the load stores repeated ones once.
    """
    own = updates.filter(F.col(parent_key).isNotNull()).select(parent_key, timestamp)
    return parents.join(own, parent_key, "inner")


def longest_literal(pattern: Column) -> Column:
    """The longest run of ordinary characters of a LIKE pattern, ``''`` if it has only wildcards."""
    pieces = F.transform(
        F.split(pattern, f"[{WILDCARDS}]"), lambda piece: F.struct(F.length(piece).alias("n"), piece.alias("text")))
    return F.array_max(pieces).getField("text")


def like_lookup(patterns: DataFrame, names: DataFrame, pattern: str, name: str) -> DataFrame:
    """For each distinct LIKE pattern the smallest name that it matches: (pattern, name).

    Both sides are reduced to their distinct texts, and patterns are told apart by their form.  One literal
    alone, or with ``%`` on one side, is an equality with whole names, beginnings or ends, of which the
    smallest name is found first: as many rows as there are names, however many patterns share a literal.  Patterns
    of wildcards alone depend on the length of a name.  The others, with a literal anywhere inside, go
    through an index of the names by their short pieces (:func:`_like_by_grams`).
    """
    asked = patterns.select(pattern).distinct().filter(F.col(pattern).isNotNull()).withColumn(
        "_piece", longest_literal(F.col(pattern)))
    piece = F.col("_piece")
    begins, ends = F.concat(piece, F.lit("%")), F.concat(F.lit("%"), piece)
    form = (
        F.when(piece == "", "length").when(F.col(pattern) == piece, "whole").when(F.col(pattern) == begins, "start")
        .when(F.col(pattern) == ends, "end").otherwise("inside"))
    asked = asked.withColumn("_form", form)
    offered = names.select(name).distinct().filter(F.col(name).isNotNull())
    simple = asked.filter("_form IN ('whole', 'start', 'end')")
    smallest = _pieces(simple, offered, name).groupBy("_form", "_piece").agg(F.min(name).alias(name))
    found = simple.hint("merge").join(smallest, ["_form", "_piece"]).select(pattern, name)
    inside = _like_by_grams(asked.filter("_form = 'inside'"), offered, pattern, name)
    lengths = _like_by_length(asked.filter("_form = 'length'"), offered, pattern, name)
    return found.unionByName(inside).unionByName(lengths)


def _pieces(asked: DataFrame, offered: DataFrame, name: str) -> DataFrame:
    """What each name offers to patterns of one literal, in the lengths that are asked for."""
    def offers(form: str, piece: Callable[[Column, Column], Column]) -> DataFrame:
        # The lengths of the pieces of one form are one value of the query.
        sizes = asked.filter(F.col("_form") == form).agg(F.collect_set(F.length("_piece")).alias("_sizes"))
        fitting = F.array_intersect(F.sequence(F.lit(1), F.length(name)), sizes.scalar())
        sized = offered.filter(F.length(name) > 0).select(name, F.explode(fitting).alias("_size"))
        return sized.select(name, F.lit(form).alias("_form"), piece(F.col(name), F.col("_size")).alias("_piece"))

    return (
        offered.select(name, F.lit("whole").alias("_form"), F.col(name).alias("_piece"))
        .unionAll(offers("start", F.left)).unionAll(offers("end", F.right)))


def _grams(text: Column, sizes: Column) -> Column:
    """The distinct pieces of a text in the given sizes."""
    fitting = F.filter(sizes, lambda size: size <= F.length(text))
    return F.array_distinct(F.flatten(F.transform(fitting, lambda size: F.transform(
        F.sequence(F.lit(1), F.length(text) - size + 1), lambda start: F.substring(text, start, size)))))


def _like_by_grams(asked: DataFrame, offered: DataFrame, pattern: str, name: str, cell: int = GRAM_CELL) -> DataFrame:
    """The smallest matching name of patterns, found through pieces of at most ``GRAM`` characters.

    A pattern is looked up under the piece of its longest literal that the fewest names have, and checked against
    these names.  The index has at most ``GRAM`` rows for each character of a name, and only pieces that
    a pattern has.  The names of a frequent piece are cut into cells of about ``cell`` names, each for all
    patterns of the piece, so that no task holds more names of it.  A pair of pattern and name is checked inside the
    join; as many pairs are checked as the patterns' rarest pieces have names.
    """
    cut = F.array(*[F.least(F.length("_piece"), F.lit(GRAM))])
    wanted = asked.select(pattern, F.explode(_grams(F.col("_piece"), cut)).alias("_gram"))
    sizes = wanted.agg(F.collect_set(F.length("_gram")).alias("_sizes")).scalar()
    sized = offered.withColumn("_sizes", F.coalesce(sizes, F.array().cast("array<int>")))
    index = sized.select(name, F.explode(_grams(F.col(name), F.col("_sizes"))).alias("_gram"))
    index = index.join(wanted.select("_gram").distinct(), "_gram", "left_semi")
    frequency = index.groupBy("_gram").agg(F.count("*").alias("_names"))
    rarest = Window.partitionBy(pattern).orderBy("_names", "_gram")
    chosen = wanted.join(frequency, "_gram").withColumn("_rank", F.row_number().over(rarest)).filter("_rank = 1")
    cells = F.ceil(F.col("_names") / F.lit(cell)).cast("int")
    asking = chosen.select(pattern, "_gram", F.explode(F.sequence(F.lit(0), cells - 1)).alias("_cell"))
    crowded = frequency.select("_gram", cells.alias("_cells")).filter("_cells > 1")
    place = F.pmod(F.xxhash64(name), F.coalesce(F.col("_cells"), F.lit(1))).cast("int")
    dealt = index.join(crowded, "_gram", "left").select(name, "_gram", place.alias("_cell"))
    # The planner cannot foresee how many names a piece has, so neither side may be broadcast.
    matching = F.like(F.col(name), F.col(pattern), F.lit(NO_ESCAPE))
    left, right = asking.hint("merge").alias("a"), dealt.alias("d")
    same = (F.col("a._gram") == F.col("d._gram")) & (F.col("a._cell") == F.col("d._cell"))
    return left.join(right, same & matching).groupBy(pattern).agg(F.min(name).alias(name))


def _like_by_length(asked: DataFrame, offered: DataFrame, pattern: str, name: str) -> DataFrame:
    fixed = F.length(pattern) - F.length(F.translate(F.col(pattern), "_", ""))
    open_ended = F.contains(F.col(pattern), F.lit("%"))
    smallest = offered.groupBy(F.length(name).alias("_length")).agg(F.min(name).alias(name))
    exact = smallest.select(F.lit(False).alias("_open"), F.col("_length").alias("_fixed"), name)
    at_least = smallest.select(
        F.lit(True).alias("_open"), F.explode(F.sequence(F.lit(0), "_length")).alias("_fixed"), name)
    by_shape = exact.unionByName(at_least).groupBy("_open", "_fixed").agg(F.min(name).alias(name))
    shaped = asked.select(pattern, open_ended.alias("_open"), fixed.alias("_fixed"))
    return shaped.join(by_shape, ["_open", "_fixed"]).select(pattern, name)
