"""What the corpus operators share: table access, words, and column-safe row payloads."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ASCII capitals to lower case; every other byte stays.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lowered(column: Column) -> Column:
    """Lower case for A-Z only, as the word rules ask."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: bytes) -> list[bytes]:
    r"""Lower-cased `[^\x20\x09-\x0D]+` words of UTF-8 text; bytes.split() parts at exactly these six bytes."""
    return text.translate(LOWER).split()


def texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [text or b"" for text in batch.column(name).cast(pa.binary()).to_pylist()]


def packed(df: DataFrame, **named: str | Column) -> DataFrame:
    """The named columns beside the whole row as one struct `row`, so that no column of the input can clash."""
    columns = [F.col(c) if isinstance(c, str) else c for c in named.values()]
    return df.select(*[c.alias(name) for name, c in zip(named, columns)], F.struct(*df.columns).alias("row"))


def appended(df: DataFrame, function: Callable[[pa.RecordBatch], list[pa.Array]], fields: str) -> DataFrame:
    """Columns `fields` (DDL) that `function` computes from a batch, behind the columns of `df`."""
    added = T._parse_datatype_string(fields)

    def batches(parts: Batches) -> Batches:
        for part in parts:
            if part.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *function(part)], names=[*part.schema.names, *added.names]
                )

    return df.mapInArrow(batches, T.StructType([*df.schema.fields, *added.fields]))


def remainder(column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor
