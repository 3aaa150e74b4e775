"""Text expressions used by the cleaning and reshaping operators."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, functions as F


def literal_alternation(literals: Sequence[str], ignore_case: bool = False) -> str:
    """Java regex that matches any of the literals, the earlier one first."""
    if not literals or any(item == "" for item in literals):
        raise ValueError("an alternation needs at least one literal and no empty ones")
    quoted = ("\\Q" + item.replace("\\E", "\\E\\\\E\\Q") + "\\E" for item in literals)
    return ("(?i)" if ignore_case else "") + "(?:" + "|".join(quoted) + ")"


def _can_overlap(first: str, second: str) -> bool:
    if second in first:
        return True
    return any(first.endswith(second[:size]) for size in range(1, min(len(first), len(second))))


def split_any(column: Column, delimiters: Sequence[str]) -> Column:
    """Split at every occurrence of any delimiter; a trailing delimiter yields a last ``''``.

    When one delimiter is a single character and no two delimiters can overlap, the others are
    first replaced by it: a one-character split needs no regex per row.
    """
    pattern = literal_alternation(delimiters)
    single = next((item for item in delimiters if len(item) == 1), None)
    distinct = list(dict.fromkeys(delimiters))
    if single is None or any(_can_overlap(a, b) for a, b in permutations(distinct, 2)):
        return F.split(column, pattern)
    for item in distinct:
        if item != single:
            column = F.replace(column, F.lit(item), F.lit(single))
    return F.split(column, single if single.isalnum() else "\\" + single)


def starts_with_any(column: Column, prefixes: Sequence[str]) -> Column:
    """True where the text begins with one of the prefixes, ignoring case."""
    return column.rlike("^" + literal_alternation(prefixes, ignore_case=True))


def drop_last(column: Column, count: int) -> Column:
    """Text without its last ``count`` characters; shorter text becomes empty."""
    return F.substring(column, F.lit(1), F.greatest(F.length(column) - count, F.lit(0)))


def strip_leading(column: Column, characters: str) -> Column:
    """Remove leading characters that belong to the given set."""
    return F.ltrim(column, F.lit(characters))


def remove_quotes(column: Column) -> Column:
    return F.translate(column, '"', "")


def channel_number(column: Column, prefix_characters: str = "AI") -> Column:
    """``'AI12'`` -> 12."""
    return strip_leading(column, prefix_characters).cast("bigint")


def text_or_none_word(column: Column) -> Column:
    """Parity form of an absent attribute: the word ``None`` instead of NULL."""
    return F.coalesce(column.cast("string"), F.lit("None"))


def truthy(column: Column) -> Column:
    """Boolean from JSON text: empty, zero and false words are false, NULL stays NULL.

    JSON ``false`` and the text ``"false"`` cannot be told apart once read as text, and both are taken as
    false: a sender that quotes its flags means them.
    """
    return ~F.lower(F.trim(column)).isin("false", "0", "", "none", "null")
