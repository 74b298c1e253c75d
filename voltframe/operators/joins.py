"""Graph-shaped joins expressed with DataFrame joins. All keep duplicates (bag semantics)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def required(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows that bind every given column; a plain filter, so that it reaches the scan."""
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))


def optional(left: DataFrame, body: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join: the columns of the body are all bound or all NULL."""
    return left.join(body, on, "left")


def without(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of the left side that have no match."""
    return left.join(right, on, "left_anti")


def with_match(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on, "left_semi")


def alternatives(df: DataFrame, into: str, *columns: str) -> DataFrame:
    """One row per non-NULL alternative, so a row that binds two of them appears twice; no exchange."""
    values = F.array_compact(F.array(*columns))
    return df.withColumn("_alternative", F.explode(values)).drop(*columns).withColumnRenamed("_alternative", into)


def walk(start: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """Sequence path: each step joins the last column of the path to `source` and continues at `target`."""
    path = start
    for edges, source, target in steps:
        end = path.columns[-1]
        hop = edges.select(F.col(source).alias(end), F.col(target).alias(f"{target}_{len(path.columns)}"))
        path = path.join(required(hop, *hop.columns), end)
        path = path.select(*[c for c in path.columns if c != end and c != hop.columns[1]], end, hop.columns[1])
    return path


def fallback(preferred: DataFrame, second: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of the preferred branch, and rows of the second branch for keys the first does not have."""
    keys = [on] if isinstance(on, str) else list(on)
    return preferred.unionByName(without(second, preferred.select(*keys).distinct(), keys), allowMissingColumns=True)


def has_type(*classes: str) -> Column:
    return F.arrays_overlap(F.col("types"), F.array(*map(F.lit, classes)))
