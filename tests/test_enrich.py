import pytest
from pyspark.sql import functions as F

from tests.grid import EQ, STATE, quads
from voltframe import GridModel
from voltframe.operators import enrich


@pytest.fixture(scope="module")
def store(spark):
    return quads(spark, EQ, "urn:graph:A_EQ").unionByName(quads(spark, STATE, "urn:graph:A_SV"))


def test_zero_flows_only_where_missing(store):
    added = enrich.zero_power_flow(store).filter("predicate = 'cim:SvPowerFlow.Terminal'")
    assert sorted(r.object for r in added.collect()) == ["p2", "s11", "s12", "s21", "t22", "t31", "t32"]


def test_names_are_repeatable(store):
    first = {r.subject for r in enrich.zero_power_flow(store).collect()}
    again = {r.subject for r in enrich.zero_power_flow(store.repartition(3)).collect()}
    assert first == again and len(first) == 7


def test_direct_type_prefers_equipment(spark):
    rows = quads(spark, "c1 a VsConverter", "urn:graph:A_SSH").unionByName(quads(spark, "c1 a VoltageSourceConverter", "urn:graph:A_EQ"))
    found = enrich.direct_types(rows).collect()
    assert [(r.subject, r.object.rpartition("#")[2], r.predicate) for r in found] == [("c1", "VoltageSourceConverter", "sesame:directType")]


def test_mrids(spark):
    text = """urn:m#_17086487-56ba-4979-b8de-064025a6b4da a Terminal
x a Terminal; IdentifiedObject.mRID "own"
_:b a Terminal"""
    rows = quads(spark, text, "urn:graph:EQ")
    added = {r.subject: r.object for r in enrich.missing_mrids(rows).collect()}
    assert added == {
        "urn:m#_17086487-56ba-4979-b8de-064025a6b4da": "17086487-56ba-4979-b8de-064025a6b4da",
        "_:b": "92eb5ffe-e6ae-2fec-3ad7-1c777531578f",
    }
    assert sorted(r.object for r in enrich.copy_mrids(rows).collect()) == ["_:b", "urn:m#_17086487-56ba-4979-b8de-064025a6b4da"]
    assert enrich.copy_mrids(rows, graph="urn:graph:SV").collect() == []


def test_datatypes_first_match(store):
    typed = enrich.with_datatypes(store)
    found = {(r.predicate, r.datatype) for r in typed.filter("datatype IS NOT NULL").collect()}
    assert ("cim:BaseVoltage.nominalVoltage", "xsd:double") in found
    assert ("cim:ACDCTerminal.sequenceNumber", "xsd:integer") in found
    assert ("cim:SvPowerFlow.p", "xsd:double") in found
    assert not any(p == "cim:SvPowerFlow.q" for p, _ in found)


def test_all_steps_feed_the_reports(store):
    whole = enrich.adapt(store)
    model = GridModel.from_quads(whole, materialize=True)
    machine = model.synchronous_machines().collect()
    assert [(r.mrid, r.max_p, r.market_code, r.station_group, r.generator_type, r.storage_type) for r in machine] == [
        ("gu1", 50.0, "gen_market_code001", "market001", "HydroGeneratingUnit", "runOfRiver")
    ]
    assert {r.bidzone for r in model.topological_nodes().collect()} == {"10Y1001A1001A48H"}
    # Added flows carry no class, so the flow report leaves them out; the added injections have no reactive part.
    assert model.powerflow().count() == 6
    assert model.sv_injection().count() == 0
    assert {r.mrid for r in model.connectivity_nodes().collect()} == {"cn1", "cn2", "cn3"}
    assert whole.groupBy("subject", "predicate", "object", "graph").count().filter("count > 1").count() == 0


def in_version(rows, namespace):
    """The same quads in another CIM version, read without a prefix for it."""
    other = rows
    for term in ("predicate", "object"):
        other = other.withColumn(term, F.regexp_replace(term, "^(cim:|http://iec.ch/TC57/2013/CIM-schema-cim16#)", namespace))
    return other


def test_every_step_in_another_version_adds_the_same(store):
    namespace = "http://iec.ch/TC57/CIM100#"

    def facts(rows, replaced=""):
        out = set()
        for r in rows.collect():
            terms = [t.replace("http://iec.ch/TC57/2013/CIM-schema-cim16#", "cim:") for t in (r.predicate, r.object)]
            out.add((r.graph, r.subject, *(t.replace(replaced, "cim:") if replaced else t for t in terms)))
        return out

    whole = enrich.adapt(in_version(store, namespace))
    assert facts(whole, namespace) == facts(enrich.adapt(store))
    # Nothing of the old version was put in: the new model has one version only.
    assert not [r for r in whole.select("predicate", "object").collect() if r.predicate.startswith("cim:") or "cim16" in r.object]
    machine = GridModel.from_quads(whole, materialize=True).synchronous_machines().collect()
    assert [(r.mrid, r.market_code, r.station_group) for r in machine] == [("gu1", "gen_market_code001", "market001")]


def test_names_of_other_vocabularies_are_not_taken_for_cim(spark):
    rows = quads(spark, "x a Terminal", "urn:graph:EQ")
    other = rows.withColumn("object", F.lit("http://example.org/own#Terminal")).unionByName(rows.withColumn("subject", F.lit("y")))
    assert {r.object for r in enrich.zero_power_flow(other).filter("predicate LIKE '%SvPowerFlow.Terminal'").collect()} == {"y"}
