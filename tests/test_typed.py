"""Cells with datatypes over quads, and checks counted while rows are written."""

import datetime

import pytest

from tests.grid import CIM, EQ, STATE, quads
from voltframe import GridModel
from voltframe.operators import validate
from voltframe.operators.validate import Field, Schema
from voltframe.sources.quads import QUAD_SCHEMA


def facts(spark, *rows):
    return spark.createDataFrame([("urn:g", *row, None) for row in rows], QUAD_SCHEMA)


def test_columns_get_the_types_of_their_quads(spark):
    found = facts(
        spark,
        ("l1", "rdf:type", CIM + "ACLineSegment", "iri", None),
        ("l1", "cim:IdentifiedObject.name", "L1", "literal", None),
        ("l1", "cim:ACLineSegment.r", "1.50", "literal", "xsd:double"),
        ("l1", "cim:Conductor.length", "10", "literal", "xsd:integer"),
        ("l1", "cim:Equipment.networkAnalysisEnable", "false", "literal", "xsd:boolean"),
        ("l1", "cim:ConductingEquipment.BaseVoltage", "bv1", "iri", None),
        ("l2", "rdf:type", CIM + "ACLineSegment", "iri", None),
        ("l2", "cim:ACLineSegment.x", "2015-03-01", "literal", "xsd:date"),
    )
    model = GridModel.from_quads(found)
    cells = model.typed("ac_line").select("id", "name", "r", "x", "length", "analysis_enabled", "base_voltage")
    done = model.query(cells)
    assert dict(done.dtypes) == {
        "id": "string", "name": "string", "r": "double", "x": "date", "length": "bigint", "analysis_enabled": "boolean", "base_voltage": "string",
    }
    first, second = done.orderBy("id").collect()
    assert tuple(first) == ("l1", "L1", 1.5, None, 10, False, "bv1")
    assert tuple(second) == ("l2", None, None, datetime.date(2015, 3, 1), None, None, None)
    kinds = validate.datatypes_of(cells, ["name", "base_voltage"]).first().asDict()
    assert kinds == {"name": "literal", "base_voltage": "uri"}


def test_several_cells_of_a_property(spark):
    found = facts(
        spark,
        ("b1", "rdf:type", CIM + "BaseVoltage", "iri", None),
        ("b1", "cim:BaseVoltage.nominalVoltage", "132", "literal", "xsd:double"),
        ("b1", "cim:BaseVoltage.nominalVoltage", "420", "literal", "xsd:double"),
        ("b1", "cim:BaseVoltage.nominalVoltage", "420", "literal", "xsd:double"),
    )
    model = GridModel.from_quads(found)
    assert sorted(r.nominal_voltage for r in model.query(model.typed("base_voltage").select("nominal_voltage")).collect()) == [132.0, 420.0]
    assert model.typed("base_voltage").select("id").count() == 1


def test_typed_cells_of_an_empty_table_and_of_replaced_views(spark):
    model = GridModel.from_quads(facts(spark))
    assert model.query(model.typed("terminal").select("mrid", "node")).collect() == []
    with pytest.raises(KeyError):
        model.with_views(terminal=model["terminal"].select("id")).typed("terminal")


def test_breakers_without_a_position(spark):
    """A breaker is a switch by its class; only reports that show the position need one."""
    text = """
b1 a Breaker; IdentifiedObject.mRID "b1"; IdentifiedObject.name "B1"
x1 a Terminal; IdentifiedObject.mRID "x1"; Terminal.ConductingEquipment b1; Terminal.ConnectivityNode cn1; ACDCTerminal.sequenceNumber "1"
x2 a Terminal; IdentifiedObject.mRID "x2"; Terminal.ConductingEquipment b1; Terminal.ConnectivityNode cn2; ACDCTerminal.sequenceNumber "2"
"""
    model = GridModel.from_quads(quads(spark, EQ + text, "urn:graph:EQ").unionByName(quads(spark, STATE, "urn:graph:SV")))
    assert sorted(map(tuple, model.connections().collect())) == [("b1", "x1", "x2"), ("sw1", "s11", "s12")]
    assert "b1" not in {r.mrid for r in model.switches().collect()}


RULES = Schema(
    {"mrid": Field("string", isin=("a", "b")), "n": Field("bigint", above=0), "p": Field("double", nullable=True, least=1.0)}, unique=("mrid", "n")
)


def test_checks_while_rows_are_written(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", 1, 0.5), ("a", 0, None), (None, None, 2.0), ("c", 1, 1.0)], "mrid string, n bigint, p double"
    ).repartition(3)
    found = validate.write_checked(rows, RULES, str(tmp_path / "rows"))
    assert found.columns == ["rule", "column", "violations"]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, validate.violations(rows, RULES).collect()))
    assert {(r.rule, r.column): r.violations for r in found.collect()} == {
        ("not_null", "mrid"): 1, ("isin", "mrid"): 1, ("not_null", "n"): 1, ("gt", "n"): 1, ("ge", "p"): 1, ("unique", "mrid"): 1, ("unique", "n"): 1,
    }
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 4


def test_checks_of_nothing_and_without_rules(spark, tmp_path):
    empty = spark.createDataFrame([], "mrid string, n bigint, p double")
    found = validate.write_checked(empty, RULES, str(tmp_path / "none"))
    assert {r.violations for r in found.collect()} == {0} and found.count() == 7
    free = validate.write_checked(empty, Schema({"p": Field("double", nullable=True)}), str(tmp_path / "free"))
    assert free.collect() == []


def test_rows_are_computed_once(spark, tmp_path):
    """Row rules add no job and no scan: every row passes the accumulator once."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(len(batch))
            yield batch

    rows = spark.range(1000).selectExpr("CAST(id AS STRING) AS mrid").mapInPandas(count, "mrid string")
    found = validate.write_checked(rows, Schema({"mrid": Field("string", isin=("1", "2"))}), str(tmp_path / "once"))
    assert {(r.rule, r.violations) for r in found.collect()} == {("not_null", 0), ("isin", 998)} and passed.value == 1000
