"""Aggregations that need more than one built-in call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_end(nr: int, value: str) -> Column:
    """Value of the row whose sequence number is `nr`: turns two terminal rows into two columns."""
    return F.max(F.when(F.col("nr") == nr, F.col(value)))


def concat_ordered(column: str, separator: str, distinct: bool = False) -> Column:
    """Joined text of a group in value order, so the result does not depend on row order."""
    if distinct:
        # A set combines before the exchange; DISTINCT inside an aggregate would double the rows instead.
        return F.array_join(F.array_sort(F.collect_set(column)), separator)
    return F.expr(f"listagg({column}, '{separator}') WITHIN GROUP (ORDER BY {column})")


def best_per_key(df: DataFrame, key: str, order: str, *rest: str) -> DataFrame:
    """The row with the largest `order` per key; NULL and NaN never win, ties take the largest rest.

    A partial maximum runs before the exchange, so a hot key is one row per task.
    """
    rows = df.filter(F.col(order).isNotNull() & ~F.isnan(order))
    return rows.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("best")).select(key, "best.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One whole row per key: the first in the given order, then by all columns; combined before the exchange."""
    rest = [c for c in df.columns if c not in keys]
    rank = [F.col(c).alias(f"_{i}") if isinstance(c, str) else c.alias(f"_{i}") for i, c in enumerate(order)]
    row = F.struct(*rank, F.struct(*rest).alias("row"))
    return df.groupBy(*keys).agg(F.min(row).alias("first")).select(*keys, "first.row.*").select(*df.columns)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    return df.join(counts, list(keys), "left_semi")
