"""One registered query per operator of the inventory, over the star-schema grid."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.grid_sql import grid
from catalog.report_sql import REPORT_SQL
from catalog.reports import Query, model
from voltframe.functions import (
    bool_of,
    default_true,
    double_of,
    float32_of,
    if_,
    int_of,
    is_uuid,
    md5_uuid,
    str_after,
    strip_text,
    truth,
)
from voltframe.functions import namespaces as ns
from voltframe.model import GridModel
from voltframe.operators import aggregates as agg
from voltframe.operators import enrich, joins, validate
from voltframe.plans import shared
from voltframe.plans.branches import ROOT3
from voltframe.plans.schemas import SCHEMAS
from voltframe.session import ensure_checkpoint_dir, scratch_folder
from voltframe.sources import quads as q
from voltframe.sources.entities import VIEWS, rejected_literals
from voltframe.sources.store import QuadStore

POINT_OF_SITE = VIEWS["substation"].columns["delivery_point"][0]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[GridModel], DataFrame]], Callable[[GridModel], DataFrame]]:
    """Register a query over the grid model with its check SQL."""

    def register(build: Callable[[GridModel], DataFrame]) -> Callable[[GridModel], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(model(spark, folder))
        if sql is not None:
            SQL[name] = grid(sql)
        return build

    return register


def table_query(name: str, table: str, sql: str | None = None) -> Callable[[Callable[[DataFrame], DataFrame]], Callable[[DataFrame], DataFrame]]:
    """Register a query over one source table."""

    def register(build: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(spark.read.parquet(f"{folder}/{table}.parquet"))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


# Sources, scans, sinks

PART_LINE = """'<urn:p#' || p_partkey || '> <http://iec.ch/TC57/2013/CIM-schema-cim16#IdentifiedObject.name> "' || p_name || ' \\\\"'
    || p_brand || '\\\\""@en <urn:graph:' || p_type || '> .'"""


@table_query(
    "source_nquads",
    "part",
    """SELECT 'urn:graph:' || p_type AS graph, 'urn:p#' || p_partkey AS subject, 'cim:IdentifiedObject.name' AS predicate,
         p_name || ' "' || p_brand || '"' AS object, 'literal' AS object_kind, CAST(NULL AS VARCHAR) AS datatype, 'en' AS lang
       FROM part
       UNION ALL SELECT NULL, '_:b' || p_partkey, 'cim:BaseVoltage.nominalVoltage', CAST(p_size AS VARCHAR), 'literal',
         'xsd:integer', NULL FROM part""",
)
def _(part: DataFrame) -> DataFrame:
    number = """'_:b' || p_partkey || ' <http://iec.ch/TC57/2013/CIM-schema-cim16#BaseVoltage.nominalVoltage> "' || p_size
                || '"^^<http://www.w3.org/2001/XMLSchema#integer> .'"""
    lines = part.selectExpr(f"{PART_LINE} AS value").unionByName(part.selectExpr(f"{number} AS value"))
    return q.parse_nquads(lines)


@table_query(
    "source_named_graph",
    "part",
    """SELECT 'urn:own' AS graph, 'urn:p#' || p_partkey AS subject, p_name || ' "' || p_brand || '"' AS object FROM part""",
)
def _(part: DataFrame) -> DataFrame:
    return q.parse_nquads(part.selectExpr(f"{PART_LINE} AS value"), graph="urn:own").select("graph", "subject", "object")


@table_query(
    "sink_nquads",
    "part",
    """SELECT '<urn:p#' || p_partkey || '> <http://iec.ch/TC57/2013/CIM-schema-cim16#IdentifiedObject.name> "' || p_name || ' \\"'
         || p_brand || '\\""@en <urn:graph:' || p_type || '> .' AS value FROM part WHERE p_type IN ('SMALL', 'LARGE')""",
)
def _(part: DataFrame) -> DataFrame:
    quads = q.parse_nquads(part.selectExpr(f"{PART_LINE} AS value"))
    return q.format_nquads(q.in_graphs(quads, ["urn:graph:SMALL", "urn:graph:LARGE"]))


@table_query(
    "source_rdf_xml",
    "supplier",
    """SELECT 'urn:model#_ss-' || s_suppkey AS subject, 'rdf:type' AS predicate,
         'http://iec.ch/TC57/2013/CIM-schema-cim16#Substation' AS object, 'iri' AS object_kind FROM supplier
       UNION ALL SELECT 'urn:model#_ss-' || s_suppkey, 'cim:IdentifiedObject.name', s_name || ' <&>', 'literal' FROM supplier
       UNION ALL SELECT 'urn:model#_ss-' || s_suppkey, 'cim:Substation.Region', 'urn:model#_sg-' || s_nationkey, 'iri' FROM supplier""",
)
def _(supplier: DataFrame) -> DataFrame:
    spark = supplier.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/rdf-xml-{uuid.uuid4().hex}"
    record = """'<cim:Substation rdf:ID="_ss-' || s_suppkey || '"><cim:IdentifiedObject.name>' || s_name
        || ' &lt;&amp;&gt;</cim:IdentifiedObject.name><cim:Substation.Region rdf:resource="#_sg-' || s_nationkey
        || '"/></cim:Substation>'"""
    documents = supplier.selectExpr("s_suppkey DIV 1000 AS document", f"{record} AS record").groupBy("document")
    head = """'<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:cim="http://iec.ch/TC57/2013/CIM-schema-cim16#">'"""
    files = documents.agg(F.expr(f"{head} || listagg(record) || '</rdf:RDF>'").alias("value"))
    files.write.partitionBy("document").text(folder)
    return q.read_rdf_xml(spark, folder).select("subject", "predicate", "object", "object_kind")


def _place_quads(m: GridModel) -> DataFrame:
    """Regions, substations and voltages as quads in an equipment graph, nodes and voltages in a state graph."""
    places = m.to_quads("urn:graph:A_EQ_1", ["substation", "voltage_level", "base_voltage", "sub_geographical_region"])
    return places.unionByName(m.to_quads("urn:graph:A_SV_1", ["sv_voltage"]))


@query(
    "scan_quads",
    """SELECT 'ss-' || s_suppkey AS subject, 'sg-' || s_nationkey AS object FROM supplier""",
)
def _(m: GridModel) -> DataFrame:
    return q.scan(_place_quads(m), predicate="cim:Substation.Region").select("subject", "object")


@query(
    "scan_entity",
    """SELECT 'vl-' || s_suppkey || '-0' AS id, 'ss-' || s_suppkey AS substation FROM supplier
       UNION ALL SELECT 'vl-' || s_suppkey || '-1', 'ss-' || s_suppkey FROM supplier""",
)
def _(m: GridModel) -> DataFrame:
    levels = GridModel.from_quads(_place_quads(m))["voltage_level"]
    return levels.filter(joins.has_type("VoltageLevel")).select("id", "substation")


@query(
    "quads_entity_view",
    """SELECT 'tn-' || p_partkey AS node, CASE WHEN p_size = 1 THEN 0 ELSE p_retailprice / 4 END AS v,
         CAST(p_size - 25 AS DOUBLE) AS angle FROM part WHERE p_brand <> 'Brand#1'""",
)
def _(m: GridModel) -> DataFrame:
    return GridModel.from_quads(_place_quads(m))["sv_voltage"].select("node", "v", "angle")


@query("quads_report_substation_voltage_level", REPORT_SQL["substation_voltage_level"])
def _(m: GridModel) -> DataFrame:
    return GridModel.from_quads(_place_quads(m)).substation_voltage_level()


CIM_NAME = "http://iec.ch/TC57/2013/CIM-schema-cim16#"


def _own_quads(rows: DataFrame, *facts: tuple[str, str, str]) -> DataFrame:
    """Quads of one subject per row: SQL for the subject, the property (local name, or type) and the object."""
    entries = [f"struct({s} AS subject, '{p}' AS property, CAST({o} AS string) AS object)" for s, p, o in facts]
    found = rows.select(F.explode(F.expr(f"array({', '.join(entries)})")).alias("x")).select("x.*").filter("object IS NOT NULL")
    is_type = F.col("property") == "type"
    return found.select(
        F.lit("urn:graph:EQ").alias("graph"),
        "subject",
        F.when(is_type, "rdf:type").otherwise(F.concat(F.lit("cim:"), "property")).alias("predicate"),
        F.when(is_type, F.concat(F.lit(CIM_NAME), "object")).otherwise(F.col("object")).alias("object"),
        F.when(is_type, "iri").otherwise("literal").alias("object_kind"),
        F.lit(None).cast("string").alias("datatype"),
        F.lit(None).cast("string").alias("lang"),
    )


@table_query(
    "quads_multi_valued",
    "supplier",
    """SELECT 'ss-' || s_suppkey AS id, name, point, bv.voltage FROM supplier,
         LATERAL (SELECT unnest([s_name, 'second']) AS name),
         LATERAL (SELECT unnest(CASE WHEN s_suppkey % 3 = 0 THEN ['dp-1', 'dp-2'] ELSE ['dp-1'] END) AS point),
         LATERAL (SELECT unnest(CASE WHEN s_suppkey % 2 = 0 THEN [132.0, 420.0] ELSE [420.0] END)::DOUBLE AS voltage) bv""",
)
def _(supplier: DataFrame) -> DataFrame:
    """Two names, delivery points and voltages of one subject: a row for every combination, as in a join of bags."""
    site, level = "'ss-' || s_suppkey", "'bv-' || s_suppkey"
    quads = _own_quads(
        supplier,
        (site, "type", "'Substation'"),
        (site, "IdentifiedObject.name", "s_name"),
        (site, "IdentifiedObject.name", "'second'"),
        (site, POINT_OF_SITE, "'dp-1'"),
        (site, POINT_OF_SITE, "CASE WHEN s_suppkey % 3 = 0 THEN 'dp-2' END"),
        (level, "type", "'BaseVoltage'"),
        (level, "BaseVoltage.nominalVoltage", "'420'"),
        (level, "BaseVoltage.nominalVoltage", "CASE WHEN s_suppkey % 2 = 0 THEN '132.0' END"),
    )
    grid_model = GridModel.from_quads(quads)
    voltage = grid_model["base_voltage"].select(F.expr("'ss-' || substring(id, 4)").alias("id"), F.col("nominal_voltage").alias("voltage"))
    return grid_model["substation"].select("id", "name", F.col("delivery_point").alias("point")).join(voltage, "id")


@table_query(
    "adapted_reports",
    "supplier",
    """SELECT 'connections' AS report, 'sw-' || s_suppkey AS mrid, 'a-' || s_suppkey AS first, 'b-' || s_suppkey AS second, NULL::BOOLEAN AS enabled FROM supplier
       UNION ALL
       SELECT 'switches', 'sw-' || s_suppkey, 'n-' || s_suppkey % 7, 'n-' || s_suppkey % 5, flag
       FROM supplier, LATERAL (SELECT unnest(CASE WHEN s_suppkey % 3 = 0 THEN [true, false] ELSE [true] END) AS flag)""",
)
def _(supplier: DataFrame) -> DataFrame:
    """Switches, a third of them flagged as left out, after the enrichment flags them all as analysed.

    Both flags then hold: a report that asks for the flag keeps each switch once, one that shows it has a row for each.
    """
    switch, a, b = "'sw-' || s_suppkey", "'a-' || s_suppkey", "'b-' || s_suppkey"
    near, far = "'n-' || s_suppkey % 7", "'n-' || s_suppkey % 5"
    facts = [
        (switch, "type", "'Breaker'"), (switch, "IdentifiedObject.mRID", switch), (switch, "IdentifiedObject.name", "s_name"),
        (switch, "Switch.normalOpen", "'false'"), (switch, "Equipment.networkAnalysisEnable", "CASE WHEN s_suppkey % 3 = 0 THEN 'false' END"),
    ]
    for end, node, nr in ((a, near, 1), (b, far, 2)):
        facts += [
            (end, "type", "'Terminal'"), (end, "IdentifiedObject.mRID", end), (end, "Terminal.ConductingEquipment", switch),
            (end, "Terminal.ConnectivityNode", node), (end, "ACDCTerminal.sequenceNumber", f"'{nr}'"),
            (node, "type", "'ConnectivityNode'"), (node, "IdentifiedObject.mRID", node),
        ]
    grid_model = GridModel.from_quads(enrich.adapt(_own_quads(supplier, *facts)), materialize=True)
    none = F.lit(None).cast("boolean")
    pairs = grid_model.connections().select(F.lit("connections").alias("report"), "mrid", F.col("t_mrid_1").alias("first"), F.col("t_mrid_2").alias("second"), none.alias("enabled"))
    shown = grid_model.switches().select(
        F.lit("switches").alias("report"), "mrid", F.col("connectivity_node_1").alias("first"), F.col("connectivity_node_2").alias("second"), F.col("network_enabled").alias("enabled")
    )
    return pairs.unionByName(shown)


@table_query(
    "quads_rejected_literals",
    "part",
    """SELECT 'ACLineSegment.r' AS property, p_size || ',5' AS value, count(*) AS n FROM part WHERE p_size > 25 GROUP BY ALL
       UNION ALL SELECT 'ACDCTerminal.sequenceNumber', p_size || '.0', count(*) FROM part WHERE p_size < 10 GROUP BY ALL""",
)
def _(part: DataFrame) -> DataFrame:
    line, end = "'l-' || p_partkey", "'t-' || p_partkey"
    quads = _own_quads(
        part,
        (line, "ACLineSegment.r", "p_size || CASE WHEN p_size > 25 THEN ',5' ELSE '.5' END"),
        (end, "ACDCTerminal.sequenceNumber", "p_size || CASE WHEN p_size < 10 THEN '.0' ELSE '' END"),
    )
    return rejected_literals(quads)


@query(
    "report_options",
    f"SELECT count(*) AS n FROM (SELECT DISTINCT * FROM ({REPORT_SQL['ac_lines']}) LIMIT 5 OFFSET 2)",
)
def _(m: GridModel) -> DataFrame:
    return m.ac_lines(distinct=True, offset=2, limit=5).agg(F.count("*").alias("n"))


LINE_VIEWS = (
    "ac_line terminal connectivity_node voltage_level substation sub_geographical_region geographical_region base_voltage "
    "operational_limit operational_limit_set sv_status sv_power_flow"
).split()


@query("quads_report_ac_lines", REPORT_SQL["ac_lines"])
def _(m: GridModel) -> DataFrame:
    quads = m.to_quads("urn:graph:A_EQ", LINE_VIEWS)
    return GridModel.from_quads(quads, materialize=True).ac_lines()


@query("stored_report_ac_lines", REPORT_SQL["ac_lines"])
def _(m: GridModel) -> DataFrame:
    """A report over a saved model, with the terminals located when it was saved."""
    return m.save(scratch_folder(m["terminal"].sparkSession, "grid"), LINE_VIEWS).ac_lines()


@query(
    "stored_areas_renewed",
    """SELECT 'ss-' || s_suppkey AS mrid, 'new ' || r_name AS area
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name LIKE 'A%'""",
)
def _(m: GridModel) -> DataFrame:
    """The areas of a saved model after its regions are written again: what was derived from the old ones is out of use."""
    spark = m["substation"].sparkSession
    folder, views = scratch_folder(spark, "grid"), ["substation", "sub_geographical_region", "geographical_region"]
    m.save(folder, views)
    renamed = m["geographical_region"].withColumn("name", F.concat(F.lit("new "), "name"))
    GridModel({"geographical_region": renamed}).save(folder, ["geographical_region"])
    areas = shared.substation_area(GridModel.load(spark, folder, views), "^new A", "substation_mrid")
    return areas.select(F.col("substation_mrid").alias("mrid"), "area")


@table_query(
    "quads_unread_values",
    "supplier",
    """SELECT 'sw-' || s_suppkey AS mrid, 'a-' || s_suppkey AS t_mrid_1, 'b-' || s_suppkey AS t_mrid_2 FROM supplier""",
)
def _(supplier: DataFrame) -> DataFrame:
    """Second names, nodes and topological nodes of terminals, none of which the report reads: one row a switch."""
    switch = "'sw-' || s_suppkey"
    facts = [(switch, "type", "'Breaker'"), (switch, "IdentifiedObject.mRID", switch)]
    for end, nr in (("'a-' || s_suppkey", 1), ("'b-' || s_suppkey", 2)):
        facts += [
            (end, "type", "'Terminal'"), (end, "IdentifiedObject.mRID", end), (end, "Terminal.ConductingEquipment", switch),
            (end, "ACDCTerminal.sequenceNumber", f"'{nr}'"), (end, "IdentifiedObject.name", "s_name"), (end, "IdentifiedObject.name", "'second'"),
            (end, "Terminal.ConnectivityNode", "'n-1'"), (end, "Terminal.ConnectivityNode", "CASE WHEN s_suppkey % 3 = 0 THEN 'n-2' END"),
            (end, "Terminal.TopologicalNode", "'t-1'"), (end, "Terminal.TopologicalNode", "'t-2'"),
        ]
    return GridModel.from_quads(_own_quads(supplier, *facts)).connections().select("mrid", "t_mrid_1", "t_mrid_2")


@query(
    "quads_two_stores",
    """SELECT tm AS mrid, connected, p FROM ends WHERE p IS NOT NULL""",
)
def _(m: GridModel) -> DataFrame:
    both = GridModel.from_quads(m.to_quads("urn:graph:EQ", ["terminal"]), m.to_quads("urn:graph:SV", ["terminal", "sv_power_flow"]))
    flows = both["sv_power_flow"].select(F.col("terminal").alias("id"), "p")
    return both["terminal"].select("id", "mrid", "connected").join(flows, "id").select("mrid", "connected", "p")


def _place_store(m: GridModel) -> QuadStore:
    """A store of the places, its equipment graph loaded again twice with the regions only."""
    places = _place_quads(m)
    spark = places.sparkSession
    store = QuadStore(spark, scratch_folder(spark, "store"), buckets=8)
    store.load(places)
    regions = q.scan(places, predicate="cim:Substation.Region")
    store.load(regions)
    store.load(regions)
    return store


@query(
    "quads_graph_loaded_again",
    """SELECT 'urn:graph:A_EQ_1' AS graph, 'ss-' || s_suppkey AS subject, 'cim:Substation.Region' AS predicate, 'sg-' || s_nationkey AS object
       FROM supplier
       UNION ALL SELECT 'urn:graph:A_SV_1', 'sv-' || p_partkey, 'rdf:type', 'http://iec.ch/TC57/2013/CIM-schema-cim16#SvVoltage'
       FROM part WHERE p_brand <> 'Brand#1'""",
)
def _(m: GridModel) -> DataFrame:
    kept = _place_store(m).quads().filter("graph = 'urn:graph:A_EQ_1' OR predicate = 'rdf:type'")
    return kept.select("graph", "subject", "predicate", "object")


@query(
    "scan_bound_terms",
    """SELECT 'object' AS bound, 'ss-' || s_suppkey AS subject, 'sg-' || s_nationkey AS object FROM supplier WHERE s_nationkey = 3
       UNION ALL SELECT 'subject', 'ss-' || s_suppkey, 'sg-' || s_nationkey FROM supplier WHERE s_suppkey = 7
       UNION ALL SELECT 'class', 'sv-' || p_partkey, 'http://iec.ch/TC57/2013/CIM-schema-cim16#SvVoltage' FROM part WHERE p_brand <> 'Brand#1'""",
)
def _(m: GridModel) -> DataFrame:
    store = _place_store(m)
    found = {
        "object": store.links_to("sg-3"),
        "subject": store.scan(subject="ss-7"),
        "class": store.links_to("http://iec.ch/TC57/2013/CIM-schema-cim16#SvVoltage", predicate="rdf:type"),
    }
    each = [rows.select(F.lit(bound).alias("bound"), "subject", "object") for bound, rows in found.items()]
    return reduce(DataFrame.unionByName, each)


@query("graphs_by_profile", "SELECT 'urn:graph:A_EQ_1' AS graph, true AS equipment, false AS state UNION ALL SELECT 'urn:graph:A_SV_1', false, true")
def _(m: GridModel) -> DataFrame:
    return q.graphs(_place_quads(m)).select("graph", q.equipment_graph().alias("equipment"), q.state_graph().alias("state"))


@query(
    "store_empty",
    """SELECT count(*) = 0 AS empty, 'filled' AS store FROM supplier
       UNION ALL SELECT count(*) = 0, 'none' FROM supplier WHERE s_suppkey IS NULL""",
)
def _(m: GridModel) -> DataFrame:
    places = _place_quads(m)
    stores = {"filled": places, "none": q.scan(places, graph="urn:graph:none")}
    rows = [(q.is_empty(store), name) for name, store in stores.items()]
    return places.sparkSession.createDataFrame(rows, "empty boolean, store string")


@table_query(
    "shorten_expand",
    "part",
    """SELECT CASE WHEN p_size > 25 THEN 'cim:' ELSE 'own:' END || p_type || p_partkey AS short,
         CASE WHEN p_size > 25 THEN 'http://iec.ch/TC57/2013/CIM-schema-cim16#' ELSE 'urn:own/a/' END || p_type || p_partkey AS long,
         'urn:other#' || p_partkey AS other, CASE WHEN p_size > 25 THEN 16 ELSE 0 END AS version FROM part""",
)
def _(part: DataFrame) -> DataFrame:
    names = ns.extended({"own": "urn:own/a/"})
    space = "CASE WHEN p_size > 25 THEN 'http://iec.ch/TC57/2013/CIM-schema-cim16#' ELSE 'urn:own/a/' END"
    rows = part.selectExpr(f"{space} || p_type || p_partkey AS iri", "'urn:other#' || p_partkey AS unknown")
    rows = rows.withColumn("short", ns.shorten(F.col("iri"), names))
    return rows.select(
        "short",
        ns.expand(F.col("short"), names).alias("long"),
        ns.expand(ns.shorten(F.col("unknown"), names), names).alias("other"),
        ns.cim_version(F.col("iri")).alias("version"),
    )


@query("empty_with_schema", REPORT_SQL["exchange"])
def _(m: GridModel) -> DataFrame:
    """Without a region the report is empty, and has the columns of a report with one."""
    return m.exchange(region="E").unionByName(m.exchange())


# Projection, filter, bindings


@query("project_rename", "SELECT te AS winding, tm AS terminal, nr AS end_number FROM windings")
def _(m: GridModel) -> DataFrame:
    return m["transformer_end"].select(F.col("id").alias("winding"), "terminal", "end_number")


@query("select_all", "SELECT 'gr-' || r_regionkey AS id, 'gr-' || r_regionkey AS mrid, r_name AS name, CASE WHEN r_name LIKE 'A%' THEN lower(r_name) END AS alias_name FROM region")
def _(m: GridModel) -> DataFrame:
    return m["geographical_region"].select("*")


@query("computed_constant_columns", "SELECT te AS mrid, (qty + 60) / 100 AS ratio, false AS is_swing_bus, 1 AS direction FROM windings")
def _(m: GridModel) -> DataFrame:
    return m["transformer_end"].select(
        "mrid", (F.col("rated_u") / 100).alias("ratio"), F.lit(False).alias("is_swing_bus"), F.lit(1).alias("direction")
    )


@query("filter_flag", "SELECT eq AS mrid FROM eq WHERE flag")
def _(m: GridModel) -> DataFrame:
    return m["equipment"].filter("analysis_enabled").select("mrid")


@query("filter_default_true", "SELECT eq AS mrid FROM eq WHERE enabled")
def _(m: GridModel) -> DataFrame:
    return m["equipment"].filter(default_true("analysis_enabled")).select("mrid")


@query("filter_region_regex", "SELECT ss AS mrid, area FROM site WHERE regexp_matches(area, 'E.*A|^ASIA')")
def _(m: GridModel) -> DataFrame:
    return shared.substation_area(m, "E.*A|^ASIA").select(F.col("substation_mrid").alias("mrid"), "area")


@query("filter_negative_regex", "SELECT eq AS mrid FROM eq WHERE name NOT LIKE '%HVDC%'")
def _(m: GridModel) -> DataFrame:
    return m["equipment"].filter(~F.col("name").rlike("HVDC")).select("mrid")


@query("filter_comparisons", "SELECT te AS mrid FROM windings WHERE nr <> 1 AND (qty + 60 > 80 OR NOT (disc <= 0.05)) AND nr < 5")
def _(m: GridModel) -> DataFrame:
    ends = m["transformer_end"]
    return ends.filter(
        (F.col("end_number") != 1) & ((F.col("rated_u") > 80) | ~(F.col("b") <= 0.05)) & (F.col("end_number") < 5)
    ).select("mrid")


@query(
    "if_unknown",
    "SELECT eq AS mrid, CASE WHEN flag THEN 'on' WHEN NOT flag THEN 'off' END AS state FROM eq",
)
def _(m: GridModel) -> DataFrame:
    return m["equipment"].select("mrid", if_(F.col("analysis_enabled"), F.lit("on"), F.lit("off")).alias("state"))


@query("coalesce_bound", "SELECT te AS mrid, coalesce(CASE WHEN accepted THEN nr END, 0) AS clock, accepted AS has_clock FROM windings")
def _(m: GridModel) -> DataFrame:
    clock = F.col("phase_angle_clock")
    return m["transformer_end"].select("mrid", F.coalesce(clock, F.lit(0)).alias("clock"), clock.isNotNull().alias("has_clock"))


@query("inline_values", "SELECT eq AS mrid, cls AS type FROM eq WHERE cls IN ('Breaker', 'Disconnector', 'BusbarSection')")
def _(m: GridModel) -> DataFrame:
    rows = m["equipment"].select("mrid", F.explode("types").alias("type"))
    return rows.filter(F.col("type").isin("Breaker", "Disconnector", "BusbarSection"))


@table_query(
    "truth_typed_untyped",
    "events",
    """SELECT event_id, value > 20 AS typed, value > 20 AS upper, value > 20 AS text FROM events""",
)
def _(events: DataFrame) -> DataFrame:
    flag = F.col("value") > 20
    return events.select(
        "event_id",
        truth(flag).alias("typed"),
        truth(F.upper(flag.cast("string"))).alias("upper"),
        truth(flag.cast("string")).alias("text"),
    )


QUERIES["parameters_region_rate"] = lambda spark, folder: (
    model(spark, folder).transformers(region="EUROPE", rate="Warning@20").select("w_mrid", "rate")
)
SQL["parameters_region_rate"] = grid(
    """SELECT te AS w_mrid, CASE WHEN nr = 1 AND limit_name = 'Warning@20' THEN CAST(o_custkey AS DOUBLE) END AS rate
       FROM windings JOIN (SELECT o, limit_name, o_custkey FROM eq) USING (o) JOIN site ON container = ss
       WHERE enabled AND area = 'EUROPE'"""
)


@query(
    "variable_predicate",
    """SELECT gu AS subject, 'GeneratingUnit.ScheduleResource' AS predicate, sr_code AS code
       FROM unit JOIN res ON c_custkey = o_custkey WHERE sr_code IS NOT NULL
       UNION ALL SELECT 'lg-' || c_custkey, 'NonConformLoadGroup.ScheduleResource', sr_code FROM res WHERE sr_code IS NOT NULL""",
)
def _(m: GridModel) -> DataFrame:
    resource = joins.required(m["schedule_resource"].select(F.col("id").alias("object"), F.col("market_code").alias("code")), "code")
    return m["link"].join(resource, "object").select("subject", "predicate", "code")


# Joins


@query("join_star", "SELECT eq AS mrid, name, o_totalprice / 1000 AS r, o_totalprice AS g FROM eq WHERE cls = 'ACLineSegment' AND o_orderstatus = 'F'")
def _(m: GridModel) -> DataFrame:
    return joins.required(m["ac_line"], "mrid", "name", "r", "gch").select("mrid", "name", "r", F.col("gch").alias("g"))


@query("join_association", "SELECT eq.eq AS mrid, un FROM eq JOIN volt USING (bv) WHERE cls IN ('ACLineSegment', 'SeriesCompensator')")
def _(m: GridModel) -> DataFrame:
    owners = m["ac_line"].select("mrid", "base_voltage").unionByName(m["series_compensator"].select("mrid", "base_voltage"))
    return owners.join(shared.line_nominal(m), "base_voltage").select("mrid", "un")


@query(
    "join_optional_compound",
    """SELECT ss AS mrid, zone AS bidzone FROM site""",
)
def _(m: GridModel) -> DataFrame:
    sites = m["substation"].select("mrid", "delivery_point")
    return joins.optional(sites, shared.bid_zones(m), "delivery_point").select("mrid", "bidzone")


@query(
    "join_optional_nested",
    """SELECT gu AS mrid, CASE WHEN min_p IS NOT NULL THEN min_p END AS min_p,
         CASE WHEN min_p IS NOT NULL AND g_code IS NOT NULL THEN sr_code END AS station_group
       FROM unit JOIN res ON c_custkey = o_custkey""",
)
def _(m: GridModel) -> DataFrame:
    units = m["generating_unit"]
    resource = m["schedule_resource"].select(F.col("id").alias("schedule_resource"), F.col("market_code").alias("station_group"))
    inner = joins.required(units, "market_code", "schedule_resource").join(joins.required(resource, "station_group"), "schedule_resource")
    body = joins.optional(joins.required(units, "min_p").select("id", "min_p"), inner.select("id", "station_group"), "id")
    return joins.optional(units.select("id", "mrid"), body, "id").select("mrid", "min_p", "station_group")


@query(
    "join_optional_filtered",
    "SELECT eq AS mrid, CASE WHEN limit_name = 'Normal@20' THEN CAST(o_custkey AS DOUBLE) END AS rate FROM eq WHERE cls = 'ACLineSegment'",
)
def _(m: GridModel) -> DataFrame:
    limit = shared.limits(m, "ActivePowerLimit", "active_power", None, "equipment", "id")
    return joins.optional(m["ac_line"].select("id", "mrid"), limit, "id").select("mrid", "rate")


@query("path_sequence", "SELECT cn, area FROM cn_place")
def _(m: GridModel) -> DataFrame:
    start = m["connectivity_node"].select(F.col("id").alias("cn"), "container").filter("container IS NOT NULL")
    path = joins.walk(
        start,
        (m["voltage_level"], "id", "substation"),
        (m["substation"], "id", "region"),
        (m["sub_geographical_region"], "id", "region"),
        (m["geographical_region"], "id", "name"),
    )
    return path.select("cn", F.col(path.columns[-1]).alias("area"))


@query("path_inverse", "SELECT eq.eq AS mrid, in_service FROM eq WHERE in_service IS NOT NULL")
def _(m: GridModel) -> DataFrame:
    return m["equipment"].select(F.col("id").alias("equipment"), "mrid").join(shared.in_service(m), "equipment").drop("equipment")


@query(
    "path_alternative",
    """SELECT tm AS mrid, connected AS flag FROM ends UNION ALL SELECT tm, connected FROM ends WHERE disc = 0""",
)
def _(m: GridModel) -> DataFrame:
    return joins.alternatives(m["terminal"].select("mrid", "connected", "terminal_connected"), "flag", "connected", "terminal_connected")


@query(
    "path_alternative_containers",
    """SELECT eq.eq AS mrid, lines.area FROM eq JOIN lines ON container = ln
       UNION ALL SELECT eq.eq, places.area FROM eq JOIN places ON container = vl""",
)
def _(m: GridModel) -> DataFrame:
    lines = m["line"].select(F.col("id").alias("container"), F.col("region").alias("sub_region"))
    by_line = lines.join(shared.region_names(m), "sub_region").select("container", "area")
    areas = by_line.unionByName(shared.level_area(m).select("container", "area"))
    return m["equipment"].select("mrid", "container").join(areas, "container").select("mrid", "area")


@query("neighbour_walk", REPORT_SQL["associated_switches"])
def _(m: GridModel) -> DataFrame:
    return m.associated_switches()


@query("semi_join_as_value", "SELECT gu AS mrid, sr_code IS NOT NULL AS traded FROM unit JOIN res ON c_custkey = o_custkey")
def _(m: GridModel) -> DataFrame:
    keys = joins.required(m["schedule_resource"], "market_code").select(F.col("id").alias("schedule_resource")).distinct()
    units = m["generating_unit"].select("mrid", "schedule_resource")
    found = joins.optional(units, keys.withColumn("found", F.lit(True)), "schedule_resource")
    return found.select("mrid", F.col("found").isNotNull().alias("traded"))


@query("anti_join", "SELECT tm AS mrid FROM ends WHERE p IS NULL")
def _(m: GridModel) -> DataFrame:
    measured = m["sv_power_flow"].select(F.col("terminal").alias("id"))
    return joins.without(m["terminal"], measured, "id").select("mrid")


@query("minus_shared", "SELECT eq AS mrid FROM eq WHERE NOT is_switch")
def _(m: GridModel) -> DataFrame:
    return joins.without(m["equipment"].select("id", "mrid"), joins.required(m["switch"], "normal_open").select("id"), "id").select("mrid")


@query(
    "join_aggregated",
    """SELECT ends.tm AS mrid, n FROM ends JOIN (SELECT part, count(*) AS n FROM ends GROUP BY part) USING (part)""",
)
def _(m: GridModel) -> DataFrame:
    ends = m["terminal"].select("mrid", "node")
    return ends.join(ends.groupBy("node").agg(F.count("*").alias("n")), "node").select("mrid", "n")


@query("join_scalar", "SELECT ss AS mrid, zone, (SELECT max(zone) FROM site) AS top FROM site")
def _(m: GridModel) -> DataFrame:
    sites = joins.optional(m["substation"].select("mrid", "delivery_point"), shared.bid_zones(m), "delivery_point")
    top = sites.agg(F.max("bidzone"))
    return sites.select("mrid", F.col("bidzone").alias("zone"), top.scalar().alias("top"))


@query(
    "join_theta",
    """SELECT eq.eq AS mrid, ca.area AS area_1, cb.area AS area_2 FROM eq JOIN ends a ON a.eq = eq.eq AND a.nr = 1
       JOIN ends b ON b.eq = eq.eq AND b.nr = 2 JOIN cn_place ca ON ca.part = a.part JOIN cn_place cb ON cb.part = b.part
       WHERE ca.area <> cb.area""",
)
def _(m: GridModel) -> DataFrame:
    ends = shared.terminal_ends(m).select("equipment", "node", "nr").join(shared.node_area(m).select("node", "area"), "node")
    first = ends.filter("nr = 1").select(F.col("equipment").alias("mrid"), F.col("area").alias("area_1"))
    second = ends.filter("nr = 2").select(F.col("equipment").alias("mrid"), F.col("area").alias("area_2"))
    return first.join(second, "mrid").filter("area_1 <> area_2")


@query("join_across_profiles", "SELECT tm AS mrid, cn AS connectivity_node, connected, p, q FROM ends JOIN cn USING (part) WHERE p IS NOT NULL")
def _(m: GridModel) -> DataFrame:
    equipment_side = m["terminal"].select("id", "mrid", F.col("node")).join(shared.node_mrids(m), "node")
    state_side = m["terminal"].select("id", "connected").join(m["sv_power_flow"].select(F.col("terminal").alias("id"), "p", "q"), "id")
    return equipment_side.join(state_side, "id").select("mrid", "connectivity_node", "connected", "p", "q")


@query("lookup_by_key", "SELECT 'cn-' || part AS node, t.tn_name AS busname FROM cn LEFT JOIN tn t USING (tn)")
def _(m: GridModel) -> DataFrame:
    names = m["topological_node"].select(F.col("id").alias("topological_node"), F.col("name").alias("busname"))
    nodes = m["connectivity_node"].filter("container IS NOT NULL").select(F.col("id").alias("node"), "topological_node")
    return nodes.join(names, "topological_node", "left").select("node", "busname")


@query(
    "overlay_update",
    """SELECT te AS mrid, CASE WHEN accepted THEN 30.0 * nr ELSE (CASE WHEN is_open THEN qty ELSE nr END - 3) * (tax * 10) END AS angle
       FROM windings JOIN (SELECT o FROM eq) USING (o) JOIN site ON container = ss JOIN cn_place USING (part) WHERE enabled""",
)
def _(m: GridModel) -> DataFrame:
    return m.transformer_branches(strict_intent=True).select("mrid", "angle")


# Aggregation


@query("aggregate_max_group", "SELECT eq.eq AS equipment, max(p) AS p, max(nr) AS last FROM eq JOIN ends USING (o) GROUP BY eq.eq")
def _(m: GridModel) -> DataFrame:
    rows = joins.optional(shared.terminal_ends(m), shared.power_flow(m, "p"), "terminal")
    return rows.groupBy("equipment").agg(F.max("p").alias("p"), F.max("nr").alias("last"))


@query(
    "aggregate_pivot_two_rows",
    "SELECT eq AS equipment, max(CASE WHEN nr = 1 THEN 'cn-' || part END) AS node_1, max(CASE WHEN nr = 2 THEN 'cn-' || part END) AS node_2 FROM ends GROUP BY eq",
)
def _(m: GridModel) -> DataFrame:
    return shared.terminal_ends(m).groupBy("equipment").agg(agg.at_end(1, "node").alias("node_1"), agg.at_end(2, "node").alias("node_2"))


@query("aggregate_all_true", "SELECT eq AS equipment, bool_and(connected) AS on_all, bool_or(connected) AS on_any FROM ends GROUP BY eq")
def _(m: GridModel) -> DataFrame:
    ends = m["terminal"].groupBy("equipment")
    return ends.agg(F.bool_and("connected").alias("on_all"), F.bool_or("connected").alias("on_any"))


@query(
    "aggregate_sum_avg_count",
    """SELECT part AS node_key, round(sum(p), 4) AS total, round(avg(p), 8) AS mean, count(*) AS ends, count(p) AS flows,
         count(DISTINCT eq) AS equipments FROM ends GROUP BY part""",
)
def _(m: GridModel) -> DataFrame:
    rows = joins.optional(shared.terminals(m), shared.power_flow(m, "p"), "terminal")
    return rows.groupBy(F.expr("CAST(substr(node, 4) AS BIGINT)").alias("node_key")).agg(
        F.round(F.sum("p"), 4).alias("total"),
        F.round(F.avg("p"), 8).alias("mean"),
        F.count("*").alias("ends"),
        F.count("p").alias("flows"),
        F.count_distinct("equipment").alias("equipments"),
    )


@query("aggregate_sample", "SELECT 'cn-' || part AS node, min(eq) AS any_equipment FROM ends GROUP BY part")
def _(m: GridModel) -> DataFrame:
    return m["terminal"].groupBy("node").agg(F.min("equipment").alias("any_equipment"))


@query("aggregate_group_concat", "SELECT eq AS equipment, string_agg(t_name, '--' ORDER BY t_name) AS names FROM ends GROUP BY eq")
def _(m: GridModel) -> DataFrame:
    return m["terminal"].groupBy("equipment").agg(agg.concat_ordered("name", "--").alias("names"))


@query("aggregate_group_concat_distinct", "SELECT eq AS equipment, string_agg(DISTINCT 'cn-' || part, ',' ORDER BY 'cn-' || part) AS nodes FROM ends GROUP BY eq")
def _(m: GridModel) -> DataFrame:
    return m["terminal"].groupBy("equipment").agg(agg.concat_ordered("node", ",", distinct=True).alias("nodes"))


@query("aggregate_having", "SELECT eq AS equipment, count(*) AS n FROM ends GROUP BY eq HAVING count(*) > 3 AND bool_or(connected)")
def _(m: GridModel) -> DataFrame:
    rows = m["terminal"].groupBy("equipment").agg(F.count("*").alias("n"), F.bool_or("connected").alias("on"))
    return rows.filter("n > 3 AND on").select("equipment", "n")


@query("aggregate_ratio", "SELECT eq AS equipment, round(sum(p) / nullif(sum(CASE WHEN connected THEN 1 ELSE 0 END), 0), 4) AS share FROM ends GROUP BY eq")
def _(m: GridModel) -> DataFrame:
    rows = joins.optional(shared.terminals(m), shared.power_flow(m, "p"), "terminal").groupBy("equipment")
    return rows.agg(F.round(F.try_divide(F.sum("p"), F.sum(F.when(F.col("connected"), 1).otherwise(0))), 4).alias("share"))


@query("aggregate_global", "SELECT max(zone) AS top_zone, count(*) AS sites FROM site")
def _(m: GridModel) -> DataFrame:
    sites = joins.optional(m["substation"].select("delivery_point"), shared.bid_zones(m), "delivery_point")
    return sites.agg(F.max("bidzone").alias("top_zone"), F.count("*").alias("sites"))


@query("aggregate_value_counts", "SELECT cls AS type, count(*) AS n FROM eq GROUP BY cls UNION ALL SELECT 'VsConverter', count(*) FROM eq WHERE cls = 'VoltageSourceConverter'")
def _(m: GridModel) -> DataFrame:
    return m["equipment"].select(F.explode("types").alias("type")).groupBy("type").agg(F.count("*").alias("n"))


# Window, top-k, sort, limit, dedup


@query("row_with_maximum", REPORT_SQL["dc_active_flow"])
def _(m: GridModel) -> DataFrame:
    return m.dc_active_flow()


@query("keep_first_duplicate", REPORT_SQL["station_group_codes_and_names"])
def _(m: GridModel) -> DataFrame:
    return m.station_group_codes_and_names()


@query("report_duplicates", REPORT_SQL["repeated_station_groups"])
def _(m: GridModel) -> DataFrame:
    return m.repeated_station_groups()


@query("global_top_one", "SELECT bv_id AS mrid, un FROM volt ORDER BY un DESC LIMIT 1")
def _(m: GridModel) -> DataFrame:
    return m["base_voltage"].select("mrid", F.col("nominal_voltage").alias("un")).orderBy(F.desc("un")).limit(1)


@query("order_by_text_key", REPORT_SQL["coordinates"])
def _(m: GridModel) -> DataFrame:
    return m.coordinates()


@query("distinct_offset_limit", "SELECT DISTINCT cls AS type FROM (SELECT cls FROM eq UNION ALL SELECT 'VsConverter') ORDER BY 1 OFFSET 2 LIMIT 5")
def _(m: GridModel) -> DataFrame:
    types = m["equipment"].select(F.explode("types").alias("type"))
    ordered = validate.options(types, distinct=True).orderBy("type")
    return validate.options(ordered, offset=2, limit=5)


@query("select_distinct", "SELECT DISTINCT 'eq-' || o AS equipment, 'cn-' || part AS node FROM ends")
def _(m: GridModel) -> DataFrame:
    return m["terminal"].select("equipment", "node").distinct()


# Set operations


@query("union_bag_missing_columns", REPORT_SQL["bus_data"])
def _(m: GridModel) -> DataFrame:
    return m.bus_data()


@query("union_fallback", "SELECT tm AS terminal, 'tn-' || tn AS topological_node FROM ends_tp WHERE tn IS NOT NULL")
def _(m: GridModel) -> DataFrame:
    ends = m["terminal"].select(F.col("id").alias("terminal"), "node", "topological_node")
    nodes = m["connectivity_node"].select(F.col("id").alias("node"), F.col("topological_node").alias("own"))
    by_node = joins.required(ends.join(nodes, "node").select("terminal", F.col("own").alias("topological_node")), "topological_node")
    by_terminal = joins.required(ends.select("terminal", "topological_node"), "topological_node")
    return joins.fallback(by_node, by_terminal, "terminal")


@query(
    "difference_of_quads",
    "SELECT 'ss-' || s_suppkey AS subject, 'cim:Substation.MarketDeliveryPoint' AS predicate, 'mdp-' || s_suppkey AS object FROM supplier WHERE s_acctbal >= 1000",
)
def _(m: GridModel) -> DataFrame:
    whole = m.to_quads("urn:graph:EQ", ["substation"])
    return q.difference(whole, whole.filter("predicate <> 'cim:Substation.MarketDeliveryPoint'")).select("subject", "predicate", "object")


# Scalar functions


@table_query(
    "text_functions",
    "part",
    """SELECT p_partkey, CAST(p_size AS VARCHAR) AS str,
         CASE WHEN instr(p_brand, '#') > 0 THEN substr(p_brand, instr(p_brand, '#') + 1) ELSE '' END AS after,
         '' AS after_none, replace(p_name, 'e', '') AS without_e, p_type || p_brand AS joined, lower(p_type) AS low FROM part""",
)
def _(part: DataFrame) -> DataFrame:
    return part.select(
        "p_partkey",
        F.col("p_size").cast("string").alias("str"),
        str_after("p_brand", "#").alias("after"),
        str_after("p_brand", "::").alias("after_none"),
        strip_text("p_name", "e").alias("without_e"),
        F.concat("p_type", "p_brand").alias("joined"),
        F.lower("p_type").alias("low"),
    )


@table_query(
    "casts_and_arithmetic",
    "part",
    """SELECT p_partkey, TRY_CAST(CASE WHEN p_size > 10 THEN p_size || '.5' ELSE '' END AS DOUBLE) AS dbl,
         CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS flt,
         CAST(CASE WHEN p_size > 10 THEN p_size END AS BIGINT) AS whole,
         -p_retailprice * 2 + p_size / 4 - 1 AS calc, p_retailprice / nullif(p_size - 1, 0) AS quotient,
         CAST('1.7320508075688772' AS DOUBLE) * p_size * p_retailprice / 1000 AS power FROM part""",
)
def _(part: DataFrame) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    return part.select(
        "p_partkey",
        double_of(F.when(size > 10, F.concat(size.cast("string"), F.lit(".5"))).otherwise("")).alias("dbl"),
        float32_of(price.cast("string")).alias("flt"),
        int_of(F.when(size > 10, size.cast("string")).otherwise("")).alias("whole"),
        (-price * 2 + size / 4 - 1).alias("calc"),
        F.try_divide(price, size - 1).alias("quotient"),
        (ROOT3 * size * price / 1000).alias("power"),
    )


@table_query(
    "strip_iri_columns",
    "part",
    "SELECT p_partkey, p_type || p_partkey AS mrid, CAST(p_partkey AS VARCHAR) AS w_mrid, 'urn:x#_' || p_brand AS other FROM part",
)
def _(part: DataFrame) -> DataFrame:
    rows = part.selectExpr("p_partkey", "'urn:x/y#_' || p_type || p_partkey AS mrid", "'http:a#' || p_partkey AS w_mrid", "'urn:x#_' || p_brand AS other")
    return validate.strip_iris(rows)


@table_query(
    "uuid_and_hash",
    "part",
    """WITH h AS (SELECT p_partkey, md5(p_name || p_partkey) AS h FROM part)
       SELECT p_partkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) AS uuid,
         true AS good, false AS bad FROM h""",
)
def _(part: DataFrame) -> DataFrame:
    rows = part.select("p_partkey", F.concat("p_name", F.col("p_partkey").cast("string")).alias("text"))
    rows = rows.withColumn("uuid", md5_uuid("text"))
    return rows.select("p_partkey", "uuid", is_uuid("uuid").alias("good"), is_uuid("text").alias("bad"))


@table_query(
    "boolean_parse",
    "part",
    "SELECT p_partkey, p_size <= 20 AS flag FROM part",
)
def _(part: DataFrame) -> DataFrame:
    text = F.when(F.col("p_size") <= 10, "TRUE").when(F.col("p_size") <= 20, "1").when(F.col("p_size") <= 30, "yes").otherwise("0")
    return part.select("p_partkey", bool_of(text).alias("flag"))


# Typing and validation


@table_query(
    "convert_by_datatype",
    "part",
    """SELECT p_partkey, p_size > 25 AS flag, CAST(p_size AS DOUBLE) AS number, CAST(p_partkey AS BIGINT) AS whole,
         CAST(p_size * 86400.0 + 3600.5 AS DOUBLE) AS seconds, 3661.0 + CAST(p_size AS DOUBLE) AS daytime,
         CAST('1999-01-02' AS DATE) AS day, p_brand AS text FROM part""",
)
def _(part: DataFrame) -> DataFrame:
    rows = part.selectExpr(
        "p_partkey",
        "CASE WHEN p_size > 25 THEN 'true' ELSE '0' END AS flag",
        "CAST(p_size AS STRING) AS number",
        "CAST(p_partkey AS STRING) AS whole",
        "'P' || p_size || 'DT1H0.5S' AS seconds",
        "'01:01:' || lpad(CAST(p_size + 1 AS STRING), 2, '0') AS daytime",
        "'1999-01-02' AS day",
        "p_brand AS text",
    )
    kinds = {
        "flag": "xsd:boolean", "number": "own:Degrees", "whole": "cim:Integer", "seconds": "xsd:duration",
        "daytime": "xsd:time", "day": "xsd:date", "text": "literal",
    }
    known = validate.casters({"own:Volt": "cim:Float"}, {"own:Degrees": lambda c: c.try_cast("double")})
    done = validate.convert(rows, kinds, known)
    microseconds = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2000-01-01 00:00:00', TIMESTAMP_NTZ '2000-01-01 00:00:00' + seconds)")
    return done.withColumn("seconds", microseconds / 1000000)


@query("datatype_map", REPORT_SQL["type_map"])
def _(m: GridModel) -> DataFrame:
    return m.type_map()


@table_query("infer_datatypes", "part", "SELECT 'xsd:integer' AS size, 'uri' AS link, 'literal' AS name")
def _(part: DataFrame) -> DataFrame:
    def value(text: str, datatype: str, kind: str) -> str:
        return f"struct({text} AS value, CAST({datatype} AS STRING) AS datatype, CAST({kind} AS STRING) AS kind)"

    rows = part.selectExpr(
        value("p_size", "CASE WHEN p_size > 49 THEN 'xsd:integer' END", "CASE WHEN p_size > 49 THEN 'literal' END") + " AS size",
        value("p_brand", "NULL", "'uri'") + " AS link",
        value("p_name", "NULL", "CASE WHEN p_size = 3 THEN 'literal' END") + " AS name",
    )
    return validate.datatypes_of(rows, ["size", "link", "name"])


@query(
    "coerce_schema",
    "SELECT eq AS mrid, CAST(nr AS BIGINT) AS end_number, te AS w_mrid FROM windings",
)
def _(m: GridModel) -> DataFrame:
    rows = m.transformer_windings().withColumn("end_number", F.col("end_number").cast("string"))
    return validate.coerce(rows, SCHEMAS["transformer_windings"])


@query(
    "coerce_failures",
    """SELECT 'cast' AS rule, 'end_number' AS "column", count(*) FILTER (WHERE nr = 7) AS violations FROM windings""",
)
def _(m: GridModel) -> DataFrame:
    text = F.when(F.col("end_number") == 7, "seven").otherwise(F.col("end_number").cast("string"))
    return validate.failed_casts(m.transformer_windings().withColumn("end_number", text), SCHEMAS["transformer_windings"])


@query(
    "schema_violations",
    f"""WITH r AS ({REPORT_SQL["loads"]})
       SELECT 'not_null' AS rule, c AS "column", CAST(0 AS BIGINT) AS violations
         FROM (SELECT unnest(['mrid', 'name', 'substation_mrid', 'connectivity_node', 'status', 'load_type']) AS c)
       UNION ALL SELECT 'isin', 'load_type', 0
       UNION ALL SELECT 'unique', 'mrid', count(*) - count(DISTINCT mrid) FROM r""",
)
def _(m: GridModel) -> DataFrame:
    return m.check("loads")


@query(
    "unbound_columns",
    f"""WITH r AS ({REPORT_SQL["borders"]})
       SELECT 'bound' AS rule, 'market_code' AS "column", count(*) FILTER (WHERE market_code IS NULL) AS violations FROM r
       UNION ALL SELECT 'bound', unnest(['mrid', 'name', 'area_1', 'area_2', 't_mrid_1', 't_mrid_2']), 0""",
)
def _(m: GridModel) -> DataFrame:
    return validate.unbound(m.borders())


@query("value_mapper_chain", "SELECT 'sg-' || n_nationkey AS mrid, upper(n_name) AS name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(m: GridModel) -> DataFrame:
    views = {name: m[name] for name in ("sub_geographical_region", "geographical_region")}
    views["sub_geographical_region"] = m["sub_geographical_region"].withColumn("mrid", F.concat(F.lit("urn:m#_"), "mrid"))
    mapped = GridModel(views, [validate.strip_iris, lambda df: df.withColumn("name", F.upper("name"))])
    return mapped.regions().select("mrid", "name")


# Enrichment: each query returns the quads a step adds

BLANK = "'_:' || md5('{rule}' || '|' || {key})"


@query(
    "enrich_zero_power_flow",
    f"""WITH f AS (SELECT tm, {BLANK.format(rule="zero_power_flow", key="tm")} AS b FROM ends WHERE p IS NULL)
       SELECT 'urn:graph:SV' AS graph, b AS subject, 'cim:SvPowerFlow.Terminal' AS predicate, tm AS object FROM f
       UNION ALL SELECT 'urn:graph:SV', b, 'cim:SvPowerFlow.p', '0.0' FROM f
       UNION ALL SELECT 'urn:graph:SV', b, 'cim:SvPowerFlow.q', '0.0' FROM f""",
)
def _(m: GridModel) -> DataFrame:
    quads = m.to_quads("urn:graph:EQ", ["terminal", "sv_power_flow"])
    return enrich.zero_power_flow(quads).select("graph", "subject", "predicate", "object")


@query(
    "enrich_zero_injection",
    f"""WITH f AS (SELECT tn_id, {BLANK.format(rule="zero_injection", key="tn_id")} AS b FROM tn)
       SELECT b AS subject, 'cim:SvInjection.TopologicalNode' AS predicate, tn_id AS object FROM f
       UNION ALL SELECT b, 'cim:SvInjection.pInjection', '0.0' FROM f
       UNION ALL SELECT b, 'rdf:type', 'http://iec.ch/TC57/2013/CIM-schema-cim16#SvInjection' FROM f""",
)
def _(m: GridModel) -> DataFrame:
    return enrich.zero_injection(m.to_quads("urn:graph:TP", ["topological_node"])).select("subject", "predicate", "object")


MACHINE_UNITS = "SELECT 'gu-' || o AS u FROM eq WHERE cls = 'SynchronousMachine' AND o_orderstatus = 'F'"


def _unit_quads(m: GridModel) -> DataFrame:
    """Machines and their units, hydro units described as units of unspecified kind."""
    kinds = F.transform("types", lambda c: F.when(c == "HydroGeneratingUnit", "GeneratingUnit").otherwise(c))
    plain = m.with_views(generating_unit=m["generating_unit"].withColumn("types", kinds))
    return plain.to_quads("urn:graph:X_EQ_1", ["synchronous_machine", "generating_unit"])


@query(
    "enrich_generating_unit",
    f"""WITH u AS ({MACHINE_UNITS}), r AS (SELECT u, {BLANK.format(rule="unit_resource", key="u")} AS r, {BLANK.format(rule="unit_plant", key="u")} AS h FROM u),
       hy AS (SELECT r.* FROM r JOIN unit ON gu = u WHERE kind = 'HydroGeneratingUnit')
       SELECT u AS subject, 'SN:GeneratingUnit.ScheduleResource' AS predicate, r AS object FROM r
       UNION ALL SELECT u, 'SN:GeneratingUnit.marketCode', 'gen_market_code001' FROM r
       UNION ALL SELECT u, 'SN:GeneratingUnit.groupAllocationWeight', '1' FROM r
       UNION ALL SELECT r, 'rdf:type', 'SN:ScheduleResource' FROM r
       UNION ALL SELECT r, 'SN:ScheduleResource.marketCode', 'market001' FROM r
       UNION ALL SELECT r, 'cim:IdentifiedObject.name', 'station group' FROM r
       UNION ALL SELECT u, 'cim:HydroGeneratingUnit.HydroPowerPlant', h FROM hy
       UNION ALL SELECT h, 'rdf:type', 'http://iec.ch/TC57/2013/CIM-schema-cim16#HydroPowerPlant' FROM hy
       UNION ALL SELECT h, 'SN:HydroPowerPlant.hydroPlantStorageType', 'SN:HydroPlantStorageKind.runOfRiver' FROM hy""",
)
def _(m: GridModel) -> DataFrame:
    return enrich.unit_market_data(_unit_quads(m)).select("subject", "predicate", "object")


@query(
    "enrich_retyped_units",
    "SELECT gu AS subject, 'http://iec.ch/TC57/2013/CIM-schema-cim16#' || coalesce(kind, 'NuclearGeneratingUnit') AS object FROM unit",
)
def _(m: GridModel) -> DataFrame:
    changed = enrich.retype_units(_unit_quads(m))
    return changed.filter("predicate = 'rdf:type' AND subject LIKE 'gu-%'").select("subject", "object")


@query(
    "enrich_load_market_code",
    f"""WITH l AS (SELECT eq, {BLANK.format(rule="load_group", key="eq")} AS g, {BLANK.format(rule="load_resource", key="eq")} AS r
                  FROM eq WHERE cls = 'EnergyConsumer')
       SELECT eq AS subject, 'cim:NonConformLoad.LoadGroup' AS predicate, g AS object FROM l
       UNION ALL SELECT g, 'cim:IdentifiedObject.name', 'created_group' FROM l
       UNION ALL SELECT g, 'SN:NonConformLoadGroup.ScheduleResource', r FROM l
       UNION ALL SELECT r, 'SN:ScheduleResource.marketCode', 'market001' FROM l""",
)
def _(m: GridModel) -> DataFrame:
    return enrich.load_market_codes(m.to_quads("urn:graph:EQ", ["load"])).select("subject", "predicate", "object")


@query(
    "enrich_missing_mrid",
    """WITH h AS (SELECT 'sv-' || p_partkey AS s, md5('sv-' || p_partkey) AS h FROM part WHERE p_brand <> 'Brand#1')
       SELECT 'urn:graph:SV' AS graph, s AS subject, 'cim:IdentifiedObject.mRID' AS predicate,
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) AS object
       FROM h""",
)
def _(m: GridModel) -> DataFrame:
    quads = m.to_quads("urn:graph:SV", ["sv_voltage", "substation"])
    return enrich.missing_mrids(quads).select("graph", "subject", "predicate", "object")


@query("enrich_copy_mrid", "SELECT 'urn:graph:SV' AS graph, 'sv-' || p_partkey AS subject, 'sv-' || p_partkey AS object FROM part WHERE p_brand <> 'Brand#1'")
def _(m: GridModel) -> DataFrame:
    quads = m.to_quads("urn:graph:SV", ["sv_voltage"]).unionByName(m.to_quads("urn:graph:EQ", ["substation", "sv_status"]))
    added = enrich.copy_mrids(quads, rdf_type="http://iec.ch/TC57/2013/CIM-schema-cim16#SvVoltage", graph="urn:graph:SV")
    return added.select("graph", "subject", "object")


@query(
    "enrich_datatypes",
    """SELECT te AS subject, CAST(nr AS VARCHAR) AS object, 'xsd:integer' AS datatype FROM windings
       UNION ALL SELECT te, CAST(nr AS VARCHAR), 'xsd:integer' FROM windings WHERE accepted
       UNION ALL SELECT tm, CAST(nr AS VARCHAR), 'xsd:integer' FROM ends
       UNION ALL SELECT tm, CAST(connected AS VARCHAR), 'xsd:boolean' FROM ends
       UNION ALL SELECT tm, CAST(connected AS VARCHAR), 'xsd:boolean' FROM ends WHERE disc = 0""",
)
def _(m: GridModel) -> DataFrame:
    typed = enrich.with_datatypes(m.to_quads("urn:graph:EQ", ["transformer_end", "terminal"]))
    return typed.filter("datatype IS NOT NULL").select("subject", "object", "datatype")


@query(
    "enrich_eic_code",
    f"""WITH s AS (SELECT ss, {BLANK.format(rule="delivery_point", key="ss || '|urn:graph:EQ'")} AS d,
                    {BLANK.format(rule="bidding_area", key="ss || '|urn:graph:EQ'")} AS a FROM site)
       SELECT ss AS subject, 'SN:Substation.MarketDeliveryPoint' AS predicate, d AS object FROM s
       UNION ALL SELECT d, 'SN:MarketDeliveryPoint.BiddingArea', a FROM s
       UNION ALL SELECT a, 'entsoeSecretariat:IdentifiedObject.energyIdentCodeEIC', '10Y1001A1001A48H' FROM s""",
)
def _(m: GridModel) -> DataFrame:
    return enrich.eic_codes(m.to_quads("urn:graph:EQ", ["substation"])).select("subject", "predicate", "object")


@query("enrich_analysis_flag", "SELECT DISTINCT eq AS subject, 'SN:Equipment.networkAnalysisEnable' AS predicate, 'true' AS object FROM ends")
def _(m: GridModel) -> DataFrame:
    return enrich.analysis_flags(m.to_quads("urn:graph:EQ", ["terminal"])).select("subject", "predicate", "object")


@table_query(
    "enrich_two_versions",
    "supplier",
    f"""WITH s AS (SELECT 'tn-' || s_suppkey AS tn, md5('tn-' || s_suppkey) AS h, s_suppkey % 2 = 0 AS old FROM supplier),
       f AS (SELECT tn, h, {BLANK.format(rule="zero_injection", key="tn")} AS b, CASE WHEN old THEN 'cim:' ELSE 'http://iec.ch/TC57/CIM100#' END AS p,
               CASE WHEN old THEN 'http://iec.ch/TC57/2013/CIM-schema-cim16#' ELSE 'http://iec.ch/TC57/CIM100#' END AS ns FROM s)
       SELECT b AS subject, p || 'SvInjection.TopologicalNode' AS predicate, tn AS object FROM f
       UNION ALL SELECT b, p || 'SvInjection.pInjection', '0.0' FROM f
       UNION ALL SELECT b, 'rdf:type', ns || 'SvInjection' FROM f
       UNION ALL SELECT tn, p || 'IdentifiedObject.mRID',
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) FROM f""",
)
def _(supplier: DataFrame) -> DataFrame:
    """Nodes of two CIM versions in one table: what is added carries the version of the node."""
    old = F.col("s_suppkey") % 2 == 0
    none = F.lit(None).cast("string")
    nodes = supplier.select(
        F.when(old, "urn:graph:TP_16").otherwise("urn:graph:TP_100").alias("graph"),
        F.concat(F.lit("tn-"), "s_suppkey").alias("subject"),
        F.lit("rdf:type").alias("predicate"),
        F.concat(F.when(old, enrich.CIM).otherwise("http://iec.ch/TC57/CIM100#"), F.lit("TopologicalNode")).alias("object"),
        F.lit("iri").alias("object_kind"),
        none.alias("datatype"),
        none.alias("lang"),
    )
    added = enrich.zero_injection(nodes).unionByName(enrich.missing_mrids(nodes))
    return added.select("subject", "predicate", "object")


CLASS = "'http://iec.ch/TC57/2013/CIM-schema-cim16#' || "


@query(
    "enrich_direct_type",
    f"""SELECT eq AS subject, {CLASS} CASE WHEN cls = 'VoltageSourceConverter' AND o_orderstatus = 'F' THEN 'VsConverter' ELSE cls END AS object,
         CASE WHEN cls = 'VoltageSourceConverter' AND o_orderstatus = 'F' THEN 'urn:graph:EQ' ELSE 'urn:graph:SSH' END AS graph
       FROM eq WHERE cls = 'VoltageSourceConverter'""",
)
def _(m: GridModel) -> DataFrame:
    """Converters carry two classes in the state graph, and one more description in the equipment graph for some."""
    state = m.to_quads("urn:graph:SSH", ["converter"])
    described = m["converter"].filter("pole_loss IS NOT NULL").withColumn("types", F.array(F.lit("VsConverter")))
    own = m.with_views(converter=described).to_quads("urn:graph:EQ", ["converter"])
    return enrich.direct_types(state.unionByName(own)).select("subject", "object", "graph")


@query(
    "enrich_all_steps",
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (is_open) AS o, count(*) FILTER (disc = 0) AS d, count(DISTINCT eq) AS e FROM ends),
       l AS (SELECT count(*) AS n, count(flag) AS f, count(*) FILTER (cls <> 'ConformLoad') AS g,
               count(*) FILTER (cls = 'EnergyConsumer') AS e
             FROM eq WHERE cls IN ('ConformLoad', 'NonConformLoad', 'EnergyConsumer')),
       s AS (SELECT count(*) AS n, count(mdp) AS m FROM site)
       SELECT predicate, quads FROM (
         SELECT unnest([
           {'predicate': 'rdf:type', 'quads': c.n + l.n + s.n}, {'predicate': 'sesame:directType', 'quads': c.n + l.n + s.n},
           {'predicate': 'cim:IdentifiedObject.mRID', 'quads': c.n + l.n + s.n + c.n + 2 * l.e},
           {'predicate': 'cim:IdentifiedObject.name', 'quads': c.n + l.n + s.n + l.e},
           {'predicate': 'cim:Terminal.ConductingEquipment', 'quads': c.n}, {'predicate': 'cim:Terminal.ConnectivityNode', 'quads': c.n},
           {'predicate': 'cim:Terminal.TopologicalNode', 'quads': c.o},
           {'predicate': 'cim:ACDCTerminal.sequenceNumber', 'quads': c.n - c.d}, {'predicate': 'cim:Terminal.sequenceNumber', 'quads': c.d},
           {'predicate': 'cim:ACDCTerminal.connected', 'quads': c.n}, {'predicate': 'cim:Terminal.connected', 'quads': c.d},
           {'predicate': 'cim:SvPowerFlow.Terminal', 'quads': c.n}, {'predicate': 'cim:SvPowerFlow.p', 'quads': c.n},
           {'predicate': 'cim:SvPowerFlow.q', 'quads': c.n}, {'predicate': 'SN:Equipment.networkAnalysisEnable', 'quads': c.e},
           {'predicate': 'cim:Equipment.networkAnalysisEnable', 'quads': l.f}, {'predicate': 'cim:Equipment.EquipmentContainer', 'quads': l.n},
           {'predicate': 'cim:NonConformLoad.LoadGroup', 'quads': l.g + l.e},
           {'predicate': 'SN:NonConformLoadGroup.ScheduleResource', 'quads': l.e}, {'predicate': 'SN:ScheduleResource.marketCode', 'quads': l.e},
           {'predicate': 'cim:Substation.Region', 'quads': s.n}, {'predicate': 'cim:Substation.MarketDeliveryPoint', 'quads': s.m},
           {'predicate': 'SN:Substation.MarketDeliveryPoint', 'quads': s.n}, {'predicate': 'SN:MarketDeliveryPoint.BiddingArea', 'quads': s.n},
           {'predicate': 'entsoeSecretariat:IdentifiedObject.energyIdentCodeEIC', 'quads': s.n}], recursive := true)
         FROM c CROSS JOIN l CROSS JOIN s)""",
)
def _(m: GridModel) -> DataFrame:
    """Counts per predicate after all steps on terminals without flows, loads and substations."""
    quads = m.to_quads("urn:graph:A_EQ", ["terminal", "load", "substation"])
    return enrich.adapt(quads).groupBy("predicate").agg(F.count("*").alias("quads"))


# Report options and cross-report checks


@query(
    "user_query_over_views",
    "SELECT cls AS type, count(*) AS n, max(o_custkey) AS top FROM eq WHERE is_switch AND enabled GROUP BY cls",
)
def _(m: GridModel) -> DataFrame:
    for view in ("switch", "operational_limit", "operational_limit_set"):
        m[view].createOrReplaceTempView(f"view_{view}")
    rows = m["switch"].sparkSession.sql(
        """SELECT s.types[0] AS type, count(*) AS n, max(l.active_power) AS top
           FROM view_switch s JOIN view_operational_limit_set k ON k.equipment = s.id
           JOIN view_operational_limit l ON l.limit_set = k.id
           WHERE coalesce(s.analysis_enabled, true) GROUP BY s.types[0]"""
    )
    return validate.convert(rows, {"top": "xsd:integer"})


@query(
    "user_query_typed",
    """SELECT tm AS mrid, 'cn-' || part AS node, CAST(seq AS BIGINT) AS nr, connected FROM ends WHERE seq = 1 AND connected IS NOT NULL""",
)
def _(m: GridModel) -> DataFrame:
    """Cells of quads with datatypes, selected in a user's SQL; the columns get the types that the quads tell."""
    quads = enrich.with_datatypes(m.to_quads("urn:graph:EQ", ["terminal"]))
    cells = GridModel.from_quads(quads)
    cells.typed("terminal").createOrReplaceTempView("typed_terminal")
    rows = quads.sparkSession.sql(
        """SELECT mrid, node, sequence_number AS nr, connected FROM typed_terminal
           WHERE sequence_number.value = '1' AND connected IS NOT NULL"""
    )
    return cells.query(rows)


@query(
    "written_report_checks",
    f"""WITH l AS ({REPORT_SQL["loads"]}),
       r AS (SELECT connectivity_node AS mrid, CASE WHEN load_type <> 'ConformLoad' THEN name END AS name,
               CASE WHEN load_type = 'EnergyConsumer' THEN 'other' ELSE load_type END AS load_type FROM l)
       SELECT 'not_null' AS rule, c AS "column", CAST(0 AS BIGINT) AS violations
         FROM (SELECT unnest(['mrid', 'substation_mrid', 'connectivity_node', 'status', 'load_type']) AS c)
       UNION ALL SELECT 'not_null', 'name', count(*) FILTER (WHERE name IS NULL) FROM r
       UNION ALL SELECT 'isin', 'load_type', count(*) FILTER (WHERE load_type = 'other') FROM r
       UNION ALL SELECT 'unique', 'mrid', count(*) - count(DISTINCT mrid) FROM r""",
)
def _(m: GridModel) -> DataFrame:
    """A report with repeated keys, missing names and an undeclared type, counted while it is written."""

    def broken(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "mrid": F.col("connectivity_node"),
            "name": F.when(F.col("load_type") != "ConformLoad", F.col("name")),
            "load_type": F.when(F.col("load_type") == "EnergyConsumer", "other").otherwise(F.col("load_type")),
        })

    mapped = GridModel({name: (lambda n=name: m[n]) for name in m.names()}, [broken])
    return mapped.write("loads", scratch_folder(m["terminal"].sparkSession, "checked"))


@table_query(
    "written_row_rules",
    "part",
    """SELECT 'not_null' AS rule, 'brand' AS "column", count(*) FILTER (WHERE p_size = 1) AS violations FROM part
       UNION ALL SELECT 'isin', 'brand', count(*) FILTER (WHERE p_size <> 1 AND p_brand NOT IN ('Brand#1', 'Brand#2')) FROM part
       UNION ALL SELECT 'not_null', 'size', 0 UNION ALL SELECT 'gt', 'size', count(*) FILTER (WHERE p_size <= 10) FROM part
       UNION ALL SELECT 'not_null', 'price', 0 UNION ALL SELECT 'ge', 'price', count(*) FILTER (WHERE p_retailprice < 1000) FROM part
       UNION ALL SELECT 'unique', 'size', count(*) - count(DISTINCT p_size) FROM part""",
)
def _(part: DataFrame) -> DataFrame:
    rows = part.selectExpr("CASE WHEN p_size <> 1 THEN p_brand END AS brand", "CAST(p_size AS BIGINT) AS size", "p_retailprice AS price")
    rules = validate.Schema(
        {"brand": validate.Field("string", isin=("Brand#1", "Brand#2")), "size": validate.Field("bigint", above=10), "price": validate.Field("double", least=1000.0)},
        unique=("size",),
    )
    return validate.write_checked(rows, rules, scratch_folder(part.sparkSession, "checked"))


@query(
    "route_by_store",
    "SELECT eq AS mrid, in_service FROM eq WHERE in_service IS NOT NULL",
)
def _(m: GridModel) -> DataFrame:
    routed = GridModel.from_quads(m.to_quads("urn:graph:EQ", ["equipment"]), m.to_quads("urn:graph:SV", ["sv_status"]))
    state = shared.in_service(routed)
    return routed["equipment"].select(F.col("id").alias("equipment"), "mrid").join(state, "equipment").select("mrid", "in_service")


@query(
    "check_nodes_listed",
    f"""WITH l AS ({REPORT_SQL["loads"]}), c AS ({REPORT_SQL["connectivity_nodes"]})
       SELECT DISTINCT connectivity_node AS mrid FROM l WHERE connectivity_node NOT IN (SELECT mrid FROM c)""",
)
def _(m: GridModel) -> DataFrame:
    return validate.missing_nodes(m.loads(), "connectivity_node", m.connectivity_nodes())


@query(
    "check_swing_buses",
    f"""WITH b AS ({REPORT_SQL["bus_data"]})
       SELECT count(*) FILTER (WHERE is_swing_bus) AS flagged, (SELECT count(DISTINCT p_type) FROM part WHERE p_type <> 'SMALL') AS islands FROM b""",
)
def _(m: GridModel) -> DataFrame:
    islands = joins.required(m["topological_island"], "angle_ref").agg(F.count("*"))
    return m.bus_data().agg(F.count_if("is_swing_bus").alias("flagged")).select("flagged", islands.scalar().alias("islands"))


@query(
    "check_node_coverage",
    f"""WITH c AS ({REPORT_SQL["connectivity_nodes"]})
       SELECT count(*) AS listed, (SELECT count(DISTINCT part) FROM ends JOIN eq USING (o) WHERE flag) AS active FROM c""",
)
def _(m: GridModel) -> DataFrame:
    flags = m["equipment"].filter("analysis_enabled").select(F.col("id").alias("equipment"))
    active = m["terminal"].join(flags, "equipment", "left_semi").agg(F.count_distinct("node"))
    return m.connectivity_nodes().agg(F.count("*").alias("listed")).select("listed", active.scalar().alias("active"))


# Reports read by their documented intent instead of their literal text


@query(
    "intent_series_compensators",
    f"SELECT * FROM ({REPORT_SQL['series_compensators']}) JOIN (SELECT eq AS mrid FROM eq WHERE enabled) USING (mrid)",
)
def _(m: GridModel) -> DataFrame:
    return m.series_compensators(strict_intent=True)


@query(
    "intent_exchange",
    REPORT_SQL["exchange"].replace("ca.area LIKE '%E%' AND cb.area NOT LIKE '%E%'", "(ca.area LIKE '%E%') <> (cb.area LIKE '%E%')"),
)
def _(m: GridModel) -> DataFrame:
    return m.exchange(region="E", strict_intent=True)


@query(
    "intent_connectivity_nodes",
    """WITH active AS (SELECT DISTINCT part FROM ends JOIN eq USING (o) WHERE flag),
       near AS (SELECT a.part, max(p.zone) AS zone, max(p.un) AS un, max_by(p.bv_id, p.un) AS bv_id
                FROM ends a JOIN ends b ON a.eq = b.eq JOIN cn_place p ON p.part = b.part GROUP BY a.part)
       SELECT cn AS mrid, ss AS container, s_name AS container_name, cn_place.un, cn_place.bv_id AS base_voltage_mrid,
         coalesce(cn_place.zone, near.zone) AS bidzone, 'Substation' AS container_type
       FROM cn_place JOIN active USING (part) LEFT JOIN near USING (part)
       UNION ALL
       SELECT cn, ln, c_name, near.un, near.bv_id, NULL, 'Line'
       FROM cn JOIN active USING (part) JOIN lines ON cn.container = lines.ln JOIN near USING (part)""",
)
def _(m: GridModel) -> DataFrame:
    return m.connectivity_nodes(strict_intent=True)


QUERIES["region_ac_lines"] = lambda spark, folder: model(spark, folder).ac_lines(region="AMERICA|ASIA", rate="Warning@20")
SQL["region_ac_lines"] = grid(
    REPORT_SQL["ac_lines"]
    .replace("WHERE nr IS NOT NULL", "WHERE nr IS NOT NULL AND area IN ('AMERICA', 'ASIA')")
    .replace("'Normal@20'", "'Warning@20'")
)
QUERIES["region_loads"] = lambda spark, folder: model(spark, folder).loads(region="EUROPE")
SQL["region_loads"] = grid(REPORT_SQL["loads"] + " AND places.area = 'EUROPE'")
QUERIES["region_bus_data"] = lambda spark, folder: model(spark, folder).topological_nodes(region="EUROPE")
SQL["region_bus_data"] = grid(REPORT_SQL["topological_nodes"] + " AND places.area = 'EUROPE'")
