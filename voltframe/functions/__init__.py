"""Column expressions with the semantics the grid reports need."""

from voltframe.functions.expr import (
    bool_of,
    default_true,
    double_of,
    duration_of,
    float32_of,
    if_,
    int_of,
    is_uuid,
    md5_uuid,
    str_after,
    strip_iri,
    strip_text,
    time_of_day,
    truth,
)

__all__ = [
    "bool_of",
    "default_true",
    "double_of",
    "duration_of",
    "float32_of",
    "if_",
    "int_of",
    "is_uuid",
    "md5_uuid",
    "str_after",
    "strip_iri",
    "strip_text",
    "time_of_day",
    "truth",
]
