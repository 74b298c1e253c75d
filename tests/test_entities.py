"""Entity views lose nothing silently: second values and bad literals show, or fail the report that uses them."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.grid import CIM, EQ, quads
from voltframe import GridModel
from voltframe.operators.validate import Field, Schema, coerce
from voltframe.session import DELETE_EXCHANGES, written
from voltframe.sources import entities
from voltframe.sources.entities import PROPERTIES, VIEWS, EntityTable, rejected_literals
from voltframe.sources.quads import QUAD_COLUMNS

NAME, POINT = "IdentifiedObject.name", VIEWS["substation"].columns["delivery_point"][0]


def store(spark, text):
    return quads(spark, text, "urn:graph:EQ")


@pytest.mark.parametrize("materialize", [False, True])
def test_several_values_are_rows_only_where_they_are_used(spark, tmp_path, materialize):
    both = store(spark, EQ).unionByName(store(spark, f'ss1 a Substation; {NAME} "Second"; {POINT} dp1; {POINT} dp2'))
    model = GridModel.from_quads(both, materialize=materialize)
    for grid in (model, model.save(f"{tmp_path}/saved", ["substation"])):
        view = grid["substation"]
        assert view.select("id", "region").count() == 2
        assert sorted((r.id, r.name) for r in view.select("id", "name").collect())[:2] == [("ss1", "North"), ("ss1", "Second")]
        found = sorted((r.id, r.name, r.delivery_point) for r in view.collect() if r.id == "ss1")
        assert found == [("ss1", n, p) for n in ("North", "Second") for p in ("dp1", "dp2")]
        # A condition uses its columns too, and a row passes with the value that fulfils it.
        assert [r.id for r in view.filter("delivery_point = 'dp2'").select("id").collect()] == ["ss1"]
        assert view.filter("id = 'ss2' AND delivery_point IS NULL").count() == 1
    with pytest.raises(ValueError, match="no view"):
        GridModel.from_quads(both, several=["No.such"])


def test_no_sort_in_the_plan_of_a_view(spark):
    plan = GridModel.from_quads(store(spark, EQ))["substation"].select("id", "name")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan


def test_bad_literals_fail_and_are_listed(spark):
    bad = store(spark, EQ.replace('ACLineSegment.r "1.5"', 'ACLineSegment.r "1,5"'))
    grid = GridModel.from_quads(bad)
    with pytest.raises(PySparkException, match="ACLineSegment.r of l1: not a number: 1,5"):
        grid["ac_line"].select("id", "r").collect()
    assert [tuple(r) for r in rejected_literals(bad).collect()] == [("ACLineSegment.r", "1,5", 1)]


def test_strict_coercion(spark):
    rows = spark.createDataFrame([("1.5",), (None,), ("x",)], "a string")
    schema = Schema({"a": Field("double", nullable=True)})
    assert [r.a for r in coerce(rows, schema).collect()] == [1.5, None, None]
    with pytest.raises(PySparkException, match="a is no double: x"):
        coerce(rows, schema, strict=True).collect()


def test_query_of_a_user(spark):
    value = "struct<value:string,datatype:string,kind:string>"
    rows = spark.createDataFrame([("a", ("5", "xsd:integer", "literal")), ("b", ("7", "xsd:integer", "literal"))], f"id string, n {value}")
    upper = lambda df: df.selectExpr("upper(id) AS id", "n")
    found = GridModel({}, [upper]).query(rows, Schema({"n": Field("double")}))
    assert sorted((r.id, r.n) for r in found.collect()) == [("A", 5.0), ("B", 7.0)]


def test_a_stored_subject_holds_its_own_properties_only(spark):
    """No column for every property that any view knows: those were 200 to sort, shuffle and write for each subject."""
    table = EntityTable(store(spark, EQ).unionByName(store(spark, f'l1 {NAME} "second"')), materialize=True)
    assert set(table.stored.columns) == {"subject", "types", "facts", "further", "kind"}
    line = table.stored.filter("subject = 'l1'").selectExpr("map_keys(facts) AS held", "facts", "further").first()
    assert line.held == sorted(line.held) and "Terminal.ConnectivityNode" not in line.facts
    assert len(line.further[NAME]) == 2 and table.repeated == {NAME}
    assert {r.name for r in table.view("ac_line").select("id", "name").filter("id = 'l1'").collect()} >= {"second"}


def test_subjects_are_grouped_and_written_with_one_exchange(spark, monkeypatch):
    """The whole table was exchanged a second time, by classes, and each fact of the first carried its property's name."""
    plans = []

    def seen(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, *args, **kwargs)

    monkeypatch.setattr(entities, "written", seen)
    table = EntityTable(store(spark, EQ), materialize=True)
    (plan,) = plans
    assert plan.count("Exchange ") == 1 and "REBALANCE" not in plan and "collect_set(fact" in plan
    # In order of their folders where they are written: the writer needn't sort the finished rows again.
    assert plan.count("Sort [kind") == 1 and plan.index("Sort [kind") > plan.index("facts")
    assert {row.kind for row in table.stored.select("kind").distinct().collect()} == set(table.kinds)


def test_values_of_any_form_come_back_whole(spark):
    texts = ["", "=", "a", "ab=c", "x" * 14, "x" * 15, "x" * 16, "é" * 15, "\U00010948", " a ", "end\x00", "end\x01", "end\x10", "a" * 200]
    rows = [(f"s{k}", "cim:IdentifiedObject.name", text) for k, text in enumerate(texts)]
    rows += [(f"s{k}", "rdf:type", CIM + "ACLineSegment") for k in range(len(texts))]
    # A quad without a value is a value that isn't there; the last property of all has a code of two bytes.
    rows += [("s0", "cim:IdentifiedObject.mRID", None), ("s1", "urn:other#IdentifiedObject.mRID", "m"), ("s2", f"cim:{PROPERTIES[-1]}", "1")]
    rows += [("s3", "rdf:type", None), (None, "rdf:type", CIM + "ACLineSegment"), ("none", "rdf:type", None)]
    quads = spark.createDataFrame([("urn:g", s, p, o, "literal", None, None) for s, p, o in rows], ", ".join(f"{c} string" for c in QUAD_COLUMNS))
    for materialize in (False, True):
        table = EntityTable(quads, materialize)
        found = table.view("ac_line").select("id", "types", "name", "mrid").collect()
        wanted = [(f"s{k}", ["ACLineSegment"], text, "m" if k == 1 else None) for k, text in enumerate(texts)]
        assert sorted(map(tuple, found), key=str) == sorted([*wanted, (None, ["ACLineSegment"], None, None)], key=str)
        assert table.view("power_transformer").select("id").count() == 0 and table.view("ac_line").select("id").count() == len(texts) + 1
    stored = {r.subject: r for r in table.stored.collect()}
    assert stored["s0"].facts == {"IdentifiedObject.mRID": None, "IdentifiedObject.name": ""}
    assert stored["s2"].facts[PROPERTIES[-1]] == "1" and stored["none"].types == [] and stored["none"].facts == {}


def test_exchanges_of_a_written_table_are_deleted(spark):
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        return {files.next().getName() for _ in iter(files.hasNext, False)}

    rows = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()
    rows.write.format("noop").mode("overwrite").save()
    before, setting = held(), spark.conf.get(DELETE_EXCHANGES, None)
    table = written(rows, "rows")
    assert before and not held() - before
    assert table.count() == 7 and spark.conf.get(DELETE_EXCHANGES, None) == setting
