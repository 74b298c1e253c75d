"""Physical properties the reports rely on at scale."""

import os
import re

import pytest
from pyspark.sql import functions as F

from catalog.reports import model
from tests.grid import EQ, STATE, quads
from voltframe import GridModel
from voltframe.plans import REPORTS
from voltframe.plans import shared

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def grid(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    return model(spark, FOLDER)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_no_cross_product_and_no_python(grid, name):
    arguments = {"region": "E"} if name == "exchange" else {}
    text = plan(REPORTS[name](grid, **arguments))
    banned = ["CartesianProduct", "BroadcastNestedLoopJoin", "Python"]
    # The parallel-line report windows over rows it has summed before; no other report needs one.
    banned += [] if name == "hvdc" else ["Window"]
    assert not [operator for operator in banned if operator in text]


def test_scans_read_only_needed_columns(spark, grid):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(grid.powerflow())
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and not any("o_totalprice" in s or "l_shipdate" in s for s in schemas)
    assert "PushedFilters" in plan(grid.ac_lines()) and "EqualTo(o_orderpriority,1-URGENT)" in plan(grid.ac_lines())


def test_bucketed_views_join_without_exchange(spark, tmp_path):
    whole = quads(spark, EQ, "urn:graph:EQ").unionByName(quads(spark, STATE, "urn:graph:SV"))
    stored = GridModel.from_quads(whole, materialize=True).save_buckets(
        str(tmp_path), 4, ["terminal", "sv_power_flow"], "default.plan_"
    )
    flows = shared.power_flow(stored, "p")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = shared.terminals(stored).join(flows, "terminal").select("terminal", "p")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_node_and_hot_equipment(spark):
    """A third of all terminals at one node; results stay whole."""
    n = 30000
    hot = F.when(F.col("id") % 3 == 0, F.lit("cn0"))
    terminal = spark.range(n).select(
        F.concat(F.lit("t"), "id").alias("id"),
        F.array(F.lit("Terminal")).alias("types"),
        F.concat(F.lit("t"), "id").alias("mrid"),
        F.lit("T").alias("name"),
        F.concat(F.lit("e"), F.col("id")).alias("equipment"),
        F.coalesce(hot, F.concat(F.lit("cn"), "id")).alias("node"),
        F.lit(None).cast("string").alias("topological_node"),
        F.lit(1).alias("sequence_number"),
        F.lit(None).cast("int").alias("terminal_sequence_number"),
        F.lit(True).alias("connected"),
        F.lit(None).cast("boolean").alias("terminal_connected"),
    )
    equipment = spark.range(n).select(
        F.concat(F.lit("e"), "id").alias("id"),
        F.array(F.lit("BusbarSection")).alias("types"),
        F.concat(F.lit("e"), "id").alias("mrid"),
        F.lit("x").alias("name"),
    )
    nodes = terminal.select(F.col("node").alias("id"), F.col("node").alias("mrid")).distinct()
    grid = GridModel({"terminal": terminal, "equipment": equipment, "connectivity_node": nodes})
    found = grid.busbar_section()
    assert found.count() == n
    assert found.agg(F.sum("terminal_count")).first()[0] == (n // 3) ** 2 + (n - n // 3)


def test_hot_subject_collapses_before_the_exchange(spark):
    """A third of all quads repeat one value of one subject."""
    copies = spark.range(30000).select(
        F.lit("urn:graph:EQ").alias("graph"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), "id")).alias("subject"),
        F.lit("cim:BaseVoltage.nominalVoltage").alias("predicate"),
        F.lit("420").alias("object"),
        F.lit("literal").alias("object_kind"),
        F.lit(None).cast("string").alias("datatype"),
        F.lit(None).cast("string").alias("lang"),
    )
    for materialize in (False, True):
        view = GridModel.from_quads(copies, materialize=materialize)["base_voltage"]
        assert view.count() == 20001
        assert view.filter("id = 'hot'").first().nominal_voltage == 420.0


def test_quads_stored_by_predicate_are_pruned(spark, tmp_path):
    from voltframe.sources.quads import read_quads, write_quads

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    write_quads(quads(spark, EQ, "urn:graph:EQ"), str(tmp_path / "quads"))
    stored = read_quads(spark, str(tmp_path / "quads"))
    limits = GridModel.from_quads(stored)["operational_limit"]
    assert limits.count() == 2
    text = plan(limits)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text, re.S).group(1)
    assert "substring_index(predicate" in filters and "ActivePowerLimit.value" in filters
    assert "ACLineSegment.r" not in filters and "Terminal.ConductingEquipment" not in filters
