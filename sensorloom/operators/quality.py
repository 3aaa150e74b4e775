"""Table constraints as checks: each returns the offending keys or rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, functions as F

ID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def fk_orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str]) -> DataFrame:
    """Child rows whose parent is missing; a NULL foreign key is allowed."""
    known = parent.select(*[F.col(key).alias(f"_p{index}") for index, key in enumerate(parent_keys)])
    referring = child.dropna(subset=list(child_keys))
    condition = [F.col(key) == F.col(f"_p{index}") for index, key in enumerate(child_keys)]
    return referring.join(known, condition, "left_anti")


def missing(columns: Sequence[str]) -> Column:
    """True where any of the columns is NULL."""
    return reduce(or_, [F.col(name).isNull() for name in columns])


def badly_formed(columns: Sequence[str]) -> Column:
    """True where an id is not in UUID form; a NULL id counts as missing, not as badly formed."""
    return reduce(or_, [F.coalesce(~F.col(name).rlike(ID_PATTERN), F.lit(False)) for name in columns])


def too_long(limits: Mapping[str, int]) -> Column:
    """True where a text is longer than its column allows."""
    return reduce(or_, [F.coalesce(F.length(name) > size, F.lit(False)) for name, size in limits.items()])


def not_one_parent(parent_keys: Sequence[str]) -> Column:
    """True where a row of a many-parent table does not name exactly one parent."""
    return reduce(add, [F.col(key).isNotNull().cast("int") for key in parent_keys]) != 1


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(missing(columns))


def id_format_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(badly_formed(columns))


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    return df.filter(too_long(limits))


def parent_count_violations(df: DataFrame, parent_keys: Sequence[str]) -> DataFrame:
    return df.filter(not_one_parent(parent_keys))


def cut_to_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Parity form: texts cut to the declared length."""
    return df.withColumns({name: F.left(F.col(name), F.lit(size)) for name, size in limits.items()})


def row_check_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check_name, violations) of several row conditions, counted in one pass."""
    counts = df.agg(*[F.count_if(condition).alias(f"n{index}") for index, condition in enumerate(checks.values())])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(f"n{index}").alias("violations"))
        for index, name in enumerate(checks)
    ])))


def column_report(df: DataFrame, required: Sequence[str], limits: Mapping[str, int]) -> DataFrame:
    """Counts of missing and over-long values of all columns in one pass."""
    counts = [F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in required]
    counts += [F.count_if(F.length(name) > size).alias(f"long_{name}") for name, size in limits.items()]
    return df.agg(F.count("*").alias("row_count"), *counts)
