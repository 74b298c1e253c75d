"""Sub-plans stored with a saved model: read instead of derived, out of use once an input is written again."""

import re

import pytest

from tests.grid import EQ, STATE, quads
from voltframe import GridModel
from voltframe.plans import REPORTS, shared
from voltframe.sources.stored import STAMPS


@pytest.fixture(scope="module")
def whole(spark):
    both = quads(spark, EQ, "urn:graph:EQ").unionByName(quads(spark, STATE, "urn:graph:SV"))
    return GridModel.from_quads(both, materialize=True)


@pytest.fixture(scope="module")
def saved(whole, tmp_path_factory):
    return whole.save(str(tmp_path_factory.mktemp("saved")))


AREAS = ["substation", "sub_geographical_region", "geographical_region"]


def rows(df):
    return sorted(df.collect(), key=repr)


def scanned(df):
    """Folders that the plan reads."""
    return set(re.findall(r"Location: InMemoryFileIndex.*?/([a-z_]+)\]", df._jdf.queryExecution().executedPlan().toString()))


def test_reports_read_stored_sub_plans(spark, whole, saved, tmp_path):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        for report in (saved.ac_lines(), saved.loads(), saved.synchronous_machines()):
            assert "derived_located_terminals" in scanned(report)
            assert not scanned(report) & {"terminal", "connectivity_node"}
        for report in (saved.loads(), saved.transformers(), saved.bus_data()):
            assert "derived_substations" in scanned(report)
            assert not scanned(report) & {"sub_geographical_region", "geographical_region"}
        assert "derived_placed_nodes" in scanned(saved.borders()) or "derived_placed_nodes" in scanned(saved.branch_node_withdraw())
        assert "derived_substations" not in whole.save(str(tmp_path), AREAS, derive=False)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)


def test_every_report_is_the_same(saved):
    plain = GridModel({name: saved[name] for name in saved.names()})
    for name in sorted(REPORTS):
        arguments = {"region": "N"} if name == "exchange" else {}
        assert rows(saved.report(name, **arguments)) == rows(plain.report(name, **arguments)), name
    assert rows(saved.ac_lines(region="SE")) == rows(plain.ac_lines(region="SE"))
    assert saved.names() == plain.names()


def test_out_of_use_when_an_input_changes(spark, whole, tmp_path):
    folder = str(tmp_path)
    saved = whole.save(folder, AREAS)
    moved = saved["geographical_region"].replace("NO", "FI", "name")
    replaced = saved.with_views(geographical_region=moved)
    assert "derived_substations" not in replaced and "derived_substations" in saved
    assert shared.substation_area(replaced, "FI").count() == 1 and shared.substation_area(saved, "FI").count() == 0
    # Written again through another model: what was derived from the old table is no longer offered.
    GridModel({"geographical_region": spark.createDataFrame(moved.collect(), moved.schema)}).save(
        folder, ["geographical_region"]
    )
    loaded = GridModel.load(spark, folder, AREAS)
    assert "derived_substations" not in loaded
    assert shared.substation_area(loaded, "FI").count() == 1
    # Not all inputs asked for: not offered either.
    assert "derived_substations" not in GridModel.load(spark, folder, ["substation"])
    assert "derived_substations" in loaded.save(str(tmp_path / "again"))


def test_a_write_that_fails_half_way(spark, whole, tmp_path):
    from voltframe.sources import stored

    folder = str(tmp_path)
    assert "derived_substations" in whole.save(folder, AREAS)
    stored.stamp(spark, folder, ["substation"])
    assert "derived_substations" not in GridModel.load(spark, folder, AREAS)
    assert spark.read.parquet(f"{folder}/{STAMPS}").filter("view = 'geographical_region'").count() == 1


def test_several_values_are_not_derived_from(spark, tmp_path):
    extra = quads(spark, 'ss1 a Substation; IdentifiedObject.name "Nord"', "urn:graph:EQ2")
    both = quads(spark, EQ, "urn:graph:EQ").unionByName(quads(spark, STATE, "urn:graph:SV")).unionByName(extra)
    model = GridModel.from_quads(both, materialize=True)
    assert "derived_substations" not in model.save(str(tmp_path), AREAS)
    assert [r.name for r in model.loads().collect()] == ["Load"]
    # Two names give two rows to a report that shows the name.
    assert sorted(r.substation for r in model.topological_nodes().collect()) == ["East", "Nord", "North"]


def test_values_that_a_report_does_not_read(spark, whole):
    """Second names, mRIDs and containers leave the reports alone that read none of them."""
    extra = quads(
        spark,
        """
ss1 a Substation; IdentifiedObject.name "Nord"
t11 a Terminal; IdentifiedObject.name "T11b"; IdentifiedObject.mRID "t11b"
bv1 a BaseVoltage; IdentifiedObject.mRID "bv1b"
vl1 a VoltageLevel; VoltageLevel.BaseVoltage bv2
l1 a ACLineSegment; Equipment.EquipmentContainer vl1; Equipment.EquipmentContainer vl2
te1 a PowerTransformerEnd; TransformerEnd.PhaseTapChanger pc1; TransformerEnd.PhaseTapChanger pc2
""",
        "urn:graph:EQ2",
    )
    both = quads(spark, EQ, "urn:graph:EQ").unionByName(quads(spark, STATE, "urn:graph:SV")).unionByName(extra)
    more = GridModel.from_quads(both, materialize=True)
    for name in ("ac_lines", "loads", "synchronous_machines", "switches", "winding_loss"):
        assert rows(more.report(name)) == rows(whole.report(name)), name
    # The nominal voltage of an end is that of its level, so this one shows both.
    assert sorted((r.mrid, r.un) for r in more.transformer_branches().collect()) == [("te1", 132.0), ("te1", 420.0), ("te2", 132.0)]


def test_saved_without_some_views(whole, tmp_path):
    saved = whole.save(str(tmp_path), ["base_voltage"])
    assert saved.names() == ["base_voltage"] and saved["base_voltage"].count() == 2
