import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from voltframe.functions import duration_of, if_, is_uuid, md5_uuid, str_after, strip_iri, truth
from voltframe.functions.namespaces import cim_version, expand, extended, shorten, version_of
from voltframe.operators.validate import CIM_CASTERS, XSD_CASTERS


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("kind", "text", "expected"),
    [
        ("boolean", "true", True),
        ("boolean", "false", False),
        ("boolean", "1", True),
        ("boolean", "0", False),
        ("boolean", "yes", False),
        ("date", "2021-12-14", datetime.date(2021, 12, 14)),
        ("dateTime", "2002-10-14T12:00:00", datetime.datetime(2002, 10, 14, 12)),
        ("dateTime", "2002-10-14T12:00:00Z", datetime.datetime(2002, 10, 14, 12)),
        ("duration", "P365D", datetime.timedelta(365)),
        ("duration", "-P365D", datetime.timedelta(-365)),
        ("duration", "P3DT5H20M30.123S", datetime.timedelta(days=3, seconds=5 * 3600 + 20 * 60 + 30.123)),
        ("duration", "P1Y", None),
        ("decimal", "2.3", Decimal("2.3")),
        ("time", "21:32:52", 77572.0),
        ("time", "21:32:52Z", 77572.0),
        ("integer", "12", 12),
        ("integer", "x", None),
        ("double", "", None),
    ],
)
def test_xsd_casters(spark, kind, text, expected):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert value(spark, XSD_CASTERS[kind](F.lit(text))) == expected


def test_cim_boolean_is_parsed(spark):
    assert value(spark, CIM_CASTERS["Boolean"](F.lit("false"))) is False


def test_if_unknown_condition(spark):
    unknown = F.lit(None).cast("boolean")
    assert value(spark, if_(unknown, F.lit(1), F.lit(2))) is None


@pytest.mark.parametrize(("text", "expected"), [("a#b#c", "b#c"), ("abc", ""), (None, None), ("#", "")])
def test_str_after(spark, text, expected):
    assert value(spark, str_after(F.lit(text).cast("string"), "#")) == expected


@pytest.mark.parametrize(
    ("text", "expected"), [("17086487-56ba-4979-b8de-064025a6b4da", True), ("1708648756ba-4979-b8de-064025a6b4da", False)]
)
def test_uuid(spark, text, expected):
    assert value(spark, is_uuid(F.lit(text))) is expected
    assert value(spark, is_uuid(md5_uuid(F.lit(text)))) is True


def test_strip_iri(spark):
    assert value(spark, strip_iri(F.lit("http://a/b#_123"))) == "123"
    assert value(spark, strip_iri(F.lit("123"))) == "123"


def test_truth_ignores_case_only(spark):
    assert value(spark, truth(F.lit("True"))) is True
    assert value(spark, truth(F.lit("1"))) is False


def test_namespaces(spark):
    names = extended({"own": "urn:x/"})
    assert value(spark, shorten(F.lit("urn:x/y"), names)) == "own:y"
    assert value(spark, expand(F.lit("own:y"), names)) == "urn:x/y"
    assert value(spark, shorten(F.lit("urn:z#y"), names)) == "urn:z#y"
    assert value(spark, cim_version(F.lit(names["cim"]))) == 16 == version_of()
    assert value(spark, duration_of(F.lit("PT"))) == datetime.timedelta(0)
