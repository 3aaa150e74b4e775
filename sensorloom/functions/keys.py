"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEPARATOR = "\x1f"
ABSENT = "\x1e"


def surrogate_key(tag: str, *parts: Column | str, where: Column | None = None) -> Column:
    """Id in UUID form from a table tag and the natural key.

    The same key always gives the same id, so a replayed batch, a retried task and the fact side
    of a load agree without a lookup.  An absent part counts as a part of its own.  Rows that do
    not meet ``where`` get NULL; the condition stands inside the digest, so that the digest is
    computed once per row and not once per piece.
    """
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    texts = [F.coalesce(column.cast("string"), F.lit(ABSENT)) for column in columns]
    text = F.concat_ws(SEPARATOR, F.lit(tag), *texts)
    # Pieces are cut from bytes: of text, every cut counts characters from its start.
    digest = F.md5(text if where is None else F.when(where, text)).cast("binary")
    first, *others = [
        F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(first, *[piece for other in others for piece in (F.lit(b"-"), other)]).cast("string")


def micros_key(column: Column | str) -> Column:
    """Timestamp as whole microseconds, for use as a key part."""
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(column.cast("timestamp"))
