"""Scalar helpers. All are built-in Spark expressions, so they stay inside generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
# Everything up to the fragment of an IRI (fixed value).
IRI_HEAD_PATTERN = r"^([^#_|^#]+)(#_|#)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def if_(condition: Column, then: Column, otherwise: Column) -> Column:
    """Conditional where an unknown condition gives an unknown result (a plain CASE takes the else branch)."""
    return F.when(condition.isNull(), F.lit(None)).when(condition, then).otherwise(otherwise)


def default_true(flag: Column | str) -> Column:
    return F.coalesce(_col(flag), F.lit(True))


def bool_of(c: Column | str) -> Column:
    """Parse a boolean literal: 'true' and '1' in any case are true, other texts are false."""
    return F.lower(_col(c)).isin("true", "1")


def truth(c: Column | str) -> Column:
    """True for the text 'true' in any case and for a typed true."""
    return F.lower(_col(c).cast("string")) == "true"


def double_of(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def float32_of(c: Column | str) -> Column:
    """32-bit float value carried in a double column."""
    return _col(c).try_cast("float").cast("double")


def int_of(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def str_after(c: Column | str, separator: str) -> Column:
    """Text after the first separator; the empty text when the separator does not occur."""
    text = _col(c)
    return F.when(F.instr(text, separator) > 0, F.substr(text, F.instr(text, separator) + len(separator))).when(
        text.isNotNull(), F.lit("")
    )


def strip_text(c: Column | str, fixed: str) -> Column:
    """Remove every occurrence of a fixed text."""
    return F.regexp_replace(_col(c), re.escape(fixed), "")


def strip_iri(c: Column | str, pattern: str = IRI_HEAD_PATTERN) -> Column:
    return F.regexp_replace(_col(c), pattern, "")


def is_uuid(c: Column | str) -> Column:
    return _col(c).rlike(UUID_PATTERN)


def md5_uuid(c: Column | str) -> Column:
    return F.regexp_replace(F.md5(_col(c)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def time_of_day(c: Column | str) -> Column:
    """Seconds since midnight of an HH:MM:SS[.fff] text."""
    text = _col(c)
    part = [F.regexp_extract(text, r"^(\d{2}):(\d{2}):(\d{2}(?:\.\d+)?)", i).try_cast("double") for i in (1, 2, 3)]
    return part[0] * 3600 + part[1] * 60 + part[2]


def duration_of(c: Column | str) -> Column:
    """ISO 8601 duration of days, hours, minutes and seconds; other texts (years, months) give NULL."""
    text = _col(c)
    shape = r"^(-?)P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?$"

    def amount(group: int, kind: str) -> Column:
        return F.coalesce(F.regexp_extract(text, shape, group).try_cast(kind), F.lit(0).cast(kind))

    interval = F.make_dt_interval(amount(2, "int"), amount(3, "int"), amount(4, "int"), amount(5, "decimal(18,6)"))
    signed = F.when(F.regexp_extract(text, shape, 1) == "-", -interval).otherwise(interval)
    return F.when(text.rlike(shape), signed)
