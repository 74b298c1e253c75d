"""Type conversion by datatype, schema coercion, and constraint checks as counting jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from voltframe.functions import bool_of, duration_of, strip_iri, time_of_day, truth
from voltframe.functions.expr import IRI_HEAD_PATTERN
from voltframe.functions.namespaces import shorten

Caster = Callable[[Column], Column]


def _text(c: Column) -> Column:
    return c.cast("string")


def _timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c)


# Casters by datatype name; a text that does not parse gives NULL.
XSD_CASTERS: dict[str, Caster] = {
    "boolean": bool_of,
    "date": lambda c: c.try_cast("date"),
    "dateTime": _timestamp,
    "decimal": lambda c: c.try_cast("decimal(38,18)"),
    "double": lambda c: c.try_cast("double"),
    "duration": duration_of,
    "float": lambda c: c.try_cast("double"),
    "integer": lambda c: c.try_cast("bigint"),
    "time": time_of_day,
}
CIM_CASTERS: dict[str, Caster] = {
    "String": _text,
    "Integer": lambda c: c.try_cast("bigint"),
    "Boolean": bool_of,
    "Float": lambda c: c.try_cast("double"),
    "Date": lambda c: c.try_cast("date"),
}
UNTYPED_CASTERS: dict[str, Caster] = {"literal": _text, "uri": _text}
PRIMITIVES: dict[str, Caster] = {f"xsd:{name}": caster for name, caster in XSD_CASTERS.items()} | {
    f"cim:{name}": caster for name, caster in CIM_CASTERS.items()
}


def casters(ranges: Mapping[str, str] | None = None, additions: Mapping[str, Caster] | None = None) -> dict[str, Caster]:
    """Datatype -> caster: untyped values, vocabulary datatypes by their range, primitives, then own additions."""
    vocabulary = {datatype: PRIMITIVES.get(kind, _text) for datatype, kind in (ranges or {}).items()}
    return UNTYPED_CASTERS | vocabulary | PRIMITIVES | dict(additions or {})


def vocabulary_ranges(types: DataFrame) -> dict[str, str]:
    """Datatype -> primitive, both prefixed, from the datatype report; as small as the vocabulary."""
    short = types.select(shorten(F.col("sparql_type")).alias("datatype"), shorten(F.col("range")).alias("range"))
    return {row.datatype: row.range for row in short.distinct().collect()}


def convert(df: DataFrame, datatypes: Mapping[str, str], known: Mapping[str, Caster] | None = None) -> DataFrame:
    """Convert columns by datatype in one projection; columns of an unknown datatype stay."""
    known = known or casters()
    return df.withColumns({c: known[d](F.col(c)) for c, d in datatypes.items() if d in known})


def datatypes_of(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row with the datatype seen in every column of value structs (value, datatype, kind)."""
    seen = [F.max(F.coalesce(F.col(f"{c}.datatype"), F.col(f"{c}.kind"))).alias(c) for c in columns]
    return df.agg(*seen)


def strip_iris(df: DataFrame, pattern: str = IRI_HEAD_PATTERN) -> DataFrame:
    """Keep only the identifier in every column whose name contains 'mrid'."""
    return df.withColumns({c: strip_iri(c, pattern) for c in df.columns if "mrid" in c})


@dataclass(frozen=True)
class Field:
    kind: str
    nullable: bool = False
    isin: tuple[str, ...] = ()
    above: float | None = None
    least: float | None = None

    def rules(self, column: str) -> dict[str, Column]:
        """Rule name -> condition of a violating row."""
        value = F.col(column)
        found = {} if self.nullable else {"not_null": value.isNull()}
        if self.isin:
            found["isin"] = ~value.isin(*self.isin)
        if self.above is not None:
            found["gt"] = value <= self.above
        if self.least is not None:
            found["ge"] = value < self.least
        return found


@dataclass(frozen=True)
class Schema:
    fields: dict[str, Field]
    unique: tuple[str, ...] = ()


def coerce(df: DataFrame, schema: Schema, strict: bool = False) -> DataFrame:
    """Cast the declared columns; other columns pass through.

    A value that doesn't convert becomes NULL (`failed_casts` counts them), or fails the query when `strict`.
    """
    kinds = dict(df.dtypes)
    casts = {}
    for column, field in schema.fields.items():
        if kinds[column] == field.kind:
            continue
        if field.kind == "boolean":
            casts[column] = truth(column)
            continue
        value, cast = F.col(column), F.col(column).try_cast(field.kind)
        said = F.concat(F.lit(f"{column} is no {field.kind}: "), value.cast("string"))
        failed = F.when(value.isNotNull() & cast.isNull(), F.raise_error(said))
        casts[column] = failed.otherwise(cast) if strict else cast
    return df.withColumns(casts) if casts else df


def failed_casts(df: DataFrame, schema: Schema) -> DataFrame:
    """Per column, the number of values that do not convert."""
    changed = [c for c, f in schema.fields.items() if dict(df.dtypes)[c] != f.kind]
    counts = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(schema.fields[c].kind).isNull()).alias(c) for c in changed
    ]
    return _long(df.agg(*counts), {c: ("cast", c) for c in changed}) if changed else _none(df)


def _long(one_row: DataFrame, names: Mapping[str, tuple[str, str]]) -> DataFrame:
    entries = [
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.col(f"`{key}`").cast("bigint").alias("violations"))
        for key, (rule, column) in names.items()
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("x")).select("x.*")


def _none(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "rule string, column string, violations bigint")


def _row_rules(schema: Schema) -> tuple[dict[str, tuple[str, str]], list[Column]]:
    """Names of the rules that a row can break alone, and a count of the rows that break each."""
    names, counts = {}, []
    for column, field in schema.fields.items():
        for rule, broken in field.rules(column).items():
            key = f"{rule}:{column}"
            names[key] = (rule, column)
            counts.append(F.count_if(broken).alias(key))
    return names, counts


def violations(df: DataFrame, schema: Schema) -> DataFrame:
    """Violations per rule and column: one pass for row rules, one aggregation per unique column."""
    names, counts = _row_rules(schema)
    result = _long(df.agg(*counts), names) if counts else _none(df)
    for column in schema.unique:
        result = result.unionByName(repeats(df, column))
    return result


def write_checked(df: DataFrame, schema: Schema, folder: str, mode: str = "errorifexists") -> DataFrame:
    """Write rows as Parquet and return their violations, as `violations` does.

    Rules of single rows are counted by the tasks that write, so the report is computed once. Repeats of a key need
    an exchange; they are counted on the written column alone.
    """
    names, counts = _row_rules(schema)
    seen = Observation()
    (df.observe(seen, *counts) if counts else df).write.mode(mode).parquet(folder)
    spark = df.sparkSession
    found = [(rule, column, seen.get[key]) for key, (rule, column) in names.items()] if counts else []
    result = spark.createDataFrame(found, "rule string, column string, violations bigint")
    for column in schema.unique:
        result = result.unionByName(repeats(spark.read.schema(df.schema).parquet(folder), column))
    return result


def repeats(df: DataFrame, column: str) -> DataFrame:
    """Number of rows beyond the first of their key."""
    keys = df.select(F.col(column).alias("key"))
    extra = keys.groupBy("key").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("v"))
    return extra.select(F.lit("unique").alias("rule"), F.lit(column).alias("column"), F.col("v").cast("bigint").alias("violations"))


def unbound(df: DataFrame) -> DataFrame:
    """Per column, the number of rows that do not bind it."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _long(counts, {c: ("bound", c) for c in df.columns})


def options(df: DataFrame, distinct: bool = False, limit: int | None = None, offset: int | None = None) -> DataFrame:
    """Request options of a report."""
    df = df.distinct() if distinct else df
    df = df.offset(offset) if offset else df
    return df if limit is None else df.limit(limit)


def missing_nodes(report: DataFrame, column: str, nodes: DataFrame) -> DataFrame:
    """Node values of a report that the node report does not list."""
    values = report.select(F.col(column).alias("mrid")).filter("mrid IS NOT NULL").distinct()
    return values.join(nodes.select("mrid"), "mrid", "left_anti")
