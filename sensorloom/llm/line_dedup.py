"""Line dedup by overlapping windows of three lines.

A text is cut at ``\\n``; lines are compared after dropping outer blanks.  Every window of three
consecutive lines with at least one line that is not blank is hashed.  The first place of a window is
the smallest (doc_id, position), null doc_ids last.  Its other places, except those that overlap the first one, are
removed; the lines that a document loses are the union of these windows.

Defined results: a null text stays null and loses nothing; texts under three lines lose nothing; rows
with the same doc_id and the same text count as one document and all lose the same lines; no documents
give no rows.  Other columns are kept, whatever their names; ``n_lines`` and ``n_removed_lines`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 3
_BLANKS = " \t\x0b\x0c\r"
_KEY = ["line_doc", "line_text"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keyed(documents: DataFrame) -> DataFrame:
    """Whole rows as one column, so that no name of theirs can clash, beside their key and text."""
    row = F.struct(*[documents[f"`{name}`"] for name in documents.columns])
    return documents.select(row.alias("row"), F.col("doc_id").alias("line_doc"), F.xxhash64("text").alias("line_text"), "text")


def _windows(documents: DataFrame) -> DataFrame:
    """One row per window: its document, position and 128-bit hash."""
    trimmed = F.transform(_lines(F.col("text")), lambda line: F.btrim(line, F.lit(_BLANKS)))
    lined = _keyed(documents).select(*_KEY, trimmed.alias("lines")).filter(F.size("lines") >= WINDOW)

    def window(line, at):
        nearby = [line, *[F.get("lines", at + step) for step in range(1, WINDOW)]]
        hashes = F.struct(F.xxhash64(*nearby).alias("a"), F.xxhash64(F.lit(1), *nearby[::-1]).alias("b"))
        return F.when(F.concat(*nearby) != "", hashes)

    found = lined.select(*_KEY, F.posexplode(F.slice(F.transform("lines", window), F.lit(1), F.size("lines") - WINDOW + 1)))
    return found.filter("col IS NOT NULL").select(*_KEY, F.col("pos").alias("at"), "col.a", "col.b")


def repeated_places(documents: DataFrame) -> DataFrame:
    """One row per document that loses lines: the sorted starts of the windows to remove."""
    windows = _windows(documents)
    first = windows.groupBy("a", "b").agg(
        F.min(F.struct(F.col("line_doc").isNull(), *_KEY, "at")).alias("first"), F.count("*").alias("places")).filter("places > 1")
    apart = ~(F.col("line_doc").eqNullSafe(F.col("first.line_doc")) & (F.col("line_text") == F.col("first.line_text")))
    later = windows.join(first, ["a", "b"]).filter(apart | (F.col("at") >= F.col("first.at") + WINDOW))
    return later.groupBy(*_KEY).agg(F.sort_array(F.collect_set("at")).alias("starts"))


def dedup_lines(documents: DataFrame) -> DataFrame:
    """The documents with their repeated lines removed, plus n_lines and n_removed_lines."""
    found = repeated_places(documents)
    same = F.col("k.line_doc").eqNullSafe(F.col("f.line_doc")) & (F.col("k.line_text") == F.col("f.line_text"))
    joined = _keyed(documents).drop("text").alias("k").join(found.alias("f"), same, "left").select("row", "starts")
    # Pieces between the removed windows: after the end of one window, up to the start of the next.
    ends = F.concat(F.array(F.lit(-WINDOW)), "starts")
    nexts = F.concat("starts", F.array(F.size("lines")))
    pieces = F.zip_with(ends, nexts, lambda end, following: F.slice(
        "lines", end + WINDOW + 1, F.greatest(F.lit(0), following - end - WINDOW)))
    left = F.when(F.col("starts").isNotNull(), F.flatten(pieces)).otherwise(F.col("lines"))
    text = F.col("row").getField("text")
    counted = joined.withColumn("lines", _lines(text)).withColumn("left", left)
    results = {
        "text": F.when(F.col("starts").isNull(), text).otherwise(F.array_join("left", "\n")),
        "n_lines": F.size("lines").cast("long"),
        "n_removed_lines": (F.size("lines") - F.size("left")).cast("long"),
    }
    others = [name for name in documents.columns if name not in ("n_lines", "n_removed_lines")]
    return counted.select(
        *[results[name].alias(name) if name in results else F.col("row").getField(name).alias(name) for name in others],
        *[results[name].alias(name) for name in ("n_lines", "n_removed_lines")])
