"""Reports on nodes, voltages, switches and busbars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions import str_after
from voltframe.model import GridModel
from voltframe.operators.joins import has_type, optional, required, with_match
from voltframe.plans import shared as s

# Classes and texts the report is defined on (fixed values).
SWITCH_CLASSES = (
    "Breaker",
    "Disconnector",
    "GroundDisconnector",
    "LoadBreakSwitch",
    "Recloser",
    "MktSwitch",
    "Fuse",
    "Sectionaliser",
    "Cut",
    "Jumper",
)
UNKNOWN_ISLAND = "Unknown"


def _island_names(m: GridModel) -> DataFrame:
    islands = m["topological_island"].select(F.col("id").alias("island"), F.col("name").alias("island_name"))
    named = m["island_node"].join(required(islands, "island_name"), "island")
    return named.select(F.col("node").alias("topological_node"), "island_name")


def topological_nodes(m: GridModel, region: str | None = None) -> DataFrame:
    """Buses: topological nodes with a voltage."""
    nodes = required(m["topological_node"], "base_voltage", "container", "mrid", "name").select(
        F.col("id").alias("topological_node"), F.col("mrid").alias("node"), F.col("name").alias("busname"), "base_voltage", "container"
    )
    voltage = m["sv_voltage"].select(F.col("node").alias("topological_node"), F.col("v").alias("sv_voltage"))
    places = required(s.level_area(m, region, "substation_mrid", "substation_name", "delivery_point").drop("base_voltage"), "substation_mrid", "substation_name")
    nodes = nodes.join(required(voltage, "sv_voltage"), "topological_node").join(places, "container")
    nodes = nodes.join(required(s.nominal(m), "un", "base_voltage_mrid"), "base_voltage")
    nodes = optional(nodes, s.bid_zones(m), "delivery_point")
    reference = required(m["topological_island"].select(F.col("angle_ref").alias("topological_node")), "topological_node")
    nodes = optional(nodes, _island_names(m), "topological_node")
    nodes = optional(nodes, reference.withColumn("is_reference", F.lit(True)), "topological_node")
    rows = nodes.select(
        "node",
        "busname",
        F.col("substation_name").alias("substation"),
        "un",
        "base_voltage_mrid",
        "substation_mrid",
        "bidzone",
        "sv_voltage",
        F.coalesce("island_name", F.lit(UNKNOWN_ISLAND)).alias("island"),
        F.col("is_reference").isNotNull().alias("is_swing_bus"),
    )
    return m.finish(rows)


def transformer_center_nodes(m: GridModel, region: str | None = None) -> DataFrame:
    """Fictitious centre node of each transformer; `region` has no effect."""
    del region
    owners = required(m["power_transformer"].filter(s.enabled()), "mrid", "name", "container").select(
        F.col("id").alias("transformer"), F.col("mrid").alias("node"), F.col("name").alias("busname"), F.col("container").alias("substation_id")
    )
    sites = required(m["substation"], "mrid", "name", "delivery_point").select(
        F.col("id").alias("substation_id"), F.col("mrid").alias("substation_mrid"), F.col("name").alias("substation"), "delivery_point"
    )
    ends = m["transformer_end"].filter("end_number = 1").select("transformer", "terminal")
    terminal = required(s.terminals(m, "terminal", "node").withColumnRenamed("node", "con_node"), "con_node")
    nodes = required(m["connectivity_node"], "mrid", "container").select(
        F.col("id").alias("con_node"), F.col("mrid").alias("connectivity_node"), "container", "topological_node"
    )
    levels = s.voltage_levels(m, "container", "base_voltage")
    levels = levels.join(required(s.nominal(m), "un", "base_voltage_mrid"), "base_voltage")
    rows = owners.join(sites.join(s.bid_zones(m), "delivery_point"), "substation_id")
    rows = ends.join(rows, "transformer").join(terminal, "terminal").join(nodes.join(levels, "container"), "con_node")
    rows = optional(rows, _island_names(m), "topological_node")
    return m.finish(
        rows.select(
            "node",
            "busname",
            "substation",
            "un",
            "base_voltage_mrid",
            "substation_mrid",
            "bidzone",
            F.coalesce("island_name", F.lit(UNKNOWN_ISLAND)).alias("island"),
            F.lit(False).alias("is_swing_bus"),
            "connectivity_node",
            F.col("un").alias("sv_voltage"),
        )
    )


def bus_data(m: GridModel, region: str | None = None) -> DataFrame:
    """Topological nodes followed by transformer centre nodes."""
    return topological_nodes(m, region).unionByName(transformer_center_nodes(m, region), allowMissingColumns=True)


def connections(m: GridModel, region: str | None = None) -> DataFrame:
    """Breakers and disconnectors with the terminals of both ends; `region` has no effect."""
    del region
    owners = required(m["switch"].filter(s.enabled()), "mrid").select(
        F.col("id").alias("equipment"), "mrid", F.explode("types").alias("type")
    )
    owners = owners.filter(F.col("type").isin("Breaker", "Disconnector"))
    ends = required(s.terminal_ends(m, "equipment", "terminal_mrid"), "terminal_mrid").filter(F.col("nr").isin(1, 2))
    ends = ends.select("equipment", "nr", "terminal_mrid")
    first = ends.filter("nr = 1").select("equipment", F.col("terminal_mrid").alias("t_mrid_1"))
    second = ends.filter("nr = 2").select("equipment", F.col("terminal_mrid").alias("t_mrid_2"))
    rows = owners.join(first, "equipment").join(second, "equipment")
    return m.finish(rows.select("mrid", "t_mrid_1", "t_mrid_2"))


def switches(m: GridModel) -> DataFrame:
    """Switches with both nodes; a switch with one terminal is connected to itself."""
    owners = required(m["switch"], "mrid", "name", "normal_open", "analysis_enabled").select(
        F.col("id").alias("equipment"), "mrid", "name", "normal_open", "open", "analysis_enabled",
        F.explode("types").alias("equipment_type"),
    )
    owners = owners.filter(F.col("equipment_type").isin(*SWITCH_CLASSES))
    ends = with_match(s.numbered_ends(m, "equipment", "node"), owners.select("equipment"), "equipment")
    last = ends.groupBy("equipment").agg(F.max("nr").alias("nr"))
    ends = required(ends, "node").join(s.node_mrids(m), "node").select("equipment", "nr", "connectivity_node")
    first = ends.filter("nr = 1").select("equipment", F.col("connectivity_node").alias("connectivity_node_1"))
    second = ends.withColumnRenamed("connectivity_node", "connectivity_node_2").join(last, ["equipment", "nr"]).drop("nr")
    rows = owners.join(first, "equipment").join(second, "equipment")
    return m.finish(
        rows.select(
            "mrid",
            F.coalesce("open", "normal_open").alias("is_open"),
            "equipment_type",
            "connectivity_node_1",
            "connectivity_node_2",
            F.col("analysis_enabled").alias("network_enabled"),
            "name",
        )
    )


def associated_switches(m: GridModel) -> DataFrame:
    """Switches that share a node with an equipment, as ordered lists.

    The list of a node is built once and then handed to its equipment, so the join never carries one row
    per pair of terminals.
    """
    ends = required(s.terminals(m, "equipment", "node", "sequence_number"), "equipment")
    two_sided = ends.filter("sequence_number = 2").groupBy("equipment").agg(F.count("*").cast("int").alias("copies"))
    switch = required(m["switch"], "normal_open", "mrid", "name").select(F.col("id").alias("equipment"), "mrid", "name")
    at_nodes = required(ends.select("equipment", "node"), "node")
    listed = F.flatten(F.collect_list(F.array_repeat(F.struct("mrid", "name"), F.col("copies"))))
    per_node = at_nodes.join(switch, "equipment").join(two_sided, "equipment").groupBy("node").agg(listed.alias("near"))
    other = required(m["equipment"].filter("normal_open IS NULL"), "mrid", "name")
    other = other.select(F.col("id").alias("equipment"), "mrid", "name")
    lists = at_nodes.join(per_node, "node").groupBy("equipment").agg(F.flatten(F.collect_list("near")).alias("near"))
    rows = other.join(lists, "equipment").withColumn("near", F.array_sort("near"))
    return m.finish(
        rows.select(
            "mrid",
            "name",
            F.array_join("near.mrid", ",").alias("switch_mrids"),
            F.array_join("near.name", ",").alias("switch_names"),
        )
    )


def disconnected(m: GridModel) -> DataFrame:
    """Open disconnectors and disconnected terminals; a terminal flagged by both properties appears twice."""
    opened = m["switch"].filter(has_type("Disconnector") & F.col("open")).select(F.col("id").alias("mrid"))
    flags = F.explode(F.filter(F.array("connected", "terminal_connected"), lambda c: ~c)).alias("flag")
    off = m["terminal"].filter(has_type("Terminal")).select(F.col("id").alias("mrid"), flags).select("mrid")
    return m.finish(opened.unionByName(off))


def _equipment_nodes(m: GridModel) -> DataFrame:
    return required(s.terminals(m, "equipment", "node"), "equipment", "node")


def _spread(ends: DataFrame, values: DataFrame, best: str) -> DataFrame:
    """Per node, the largest value found at the nodes its equipment reaches; two aggregations, no pairs."""
    by_equipment = ends.join(values, "node").groupBy("equipment").agg(F.max(best).alias(best))
    return ends.join(by_equipment, "equipment").groupBy("node").agg(F.max(best).alias(best))


def connectivity_nodes(m: GridModel, region: str | None = None, strict_intent: bool = False) -> DataFrame:
    """Nodes with at least one enabled equipment; `region` has no effect.

    A substation without bid zone, and a line node without voltage, take one value from the whole grid, or
    with `strict_intent` from the nodes their equipment reaches.
    """
    del region
    ends = _equipment_nodes(m)
    flags = m["equipment"].filter("analysis_enabled").select(F.col("id").alias("equipment"))
    active = with_match(ends, flags, "equipment").select("node")
    nodes = required(s.node_containers(m), "connectivity_node").withColumnRenamed("connectivity_node", "mrid")
    nodes = with_match(nodes, active, "node")
    levels = s.voltage_levels(m)
    bases = required(s.nominal(m), "un", "base_voltage_mrid")
    sites = m["substation"].select(F.col("id").alias("substation"), "delivery_point").join(s.bid_zones(m), "delivery_point")

    # Where equipment ends: bid zones and base voltages of the containers its nodes lie in.
    held = s.node_containers(m, "node").join(levels, "container")
    zones = held.join(sites, "substation").select("node", F.col("bidzone").alias("nearby_bidzone"))
    volts = held.join(bases, "base_voltage").select("node", F.struct("un", "base_voltage_mrid").alias("top"))

    places = required(s.level_area(m), "substation_mrid", "substation_name").join(bases, "base_voltage")
    in_site = optional(nodes.join(places, "container"), s.bid_zones(m), "delivery_point")
    area = s.region_names(m)
    lines = required(m["line"], "region", "name", "mrid").select(
        F.col("id").alias("container"), F.col("region").alias("sub_region"), F.col("name").alias("container_name"), F.col("mrid").alias("container_mrid")
    )
    in_line = nodes.join(lines.join(area, "sub_region"), "container")
    if strict_intent:
        in_site = optional(in_site, _spread(ends, zones, "nearby_bidzone"), "node")
        in_line = in_line.join(_spread(ends, volts, "top"), "node")
    else:
        touched = ends.select("node")
        nearby = with_match(zones, touched, "node").agg(F.max("nearby_bidzone"))
        top = with_match(volts, touched, "node").agg(F.max("top"))
        in_site = in_site.withColumn("nearby_bidzone", nearby.scalar())
        in_line = in_line.withColumn("top", top.scalar()).filter("top IS NOT NULL")
    site_rows = in_site.select(
        "mrid",
        F.col("substation_mrid").alias("container"),
        F.col("substation_name").alias("container_name"),
        "un",
        "base_voltage_mrid",
        F.coalesce("bidzone", "nearby_bidzone").alias("bidzone"),
        F.lit("Substation").alias("container_type"),
    )
    line_rows = in_line.select(
        "mrid",
        F.col("container_mrid").alias("container"),
        "container_name",
        "top.un",
        "top.base_voltage_mrid",
        F.lit(None).cast("string").alias("bidzone"),
        F.lit("Line").alias("container_type"),
    )
    return m.finish(site_rows.unionByName(line_rows))


def busbar_section(m: GridModel) -> DataFrame:
    """Nodes of busbars with the number of terminals met there (the busbar's own included)."""
    busbars = m["equipment"].filter(has_type("BusbarSection")).select(F.col("id").alias("equipment"), F.col("mrid").alias("busbar_mrid"))
    ends = required(s.terminals(m, "equipment", "node"), "node")
    own = with_match(required(ends, "equipment"), busbars, "equipment")
    per_node = ends.groupBy("node").agg(F.count("*").alias("terminals"))
    counts = own.join(per_node, "node").groupBy("equipment").agg(F.sum("terminals").alias("terminal_count"))
    rows = required(busbars, "busbar_mrid").join(counts, "equipment").join(own, "equipment").join(s.node_mrids(m), "node")
    return m.finish(rows.select(F.col("connectivity_node").alias("mrid"), "busbar_mrid", "terminal_count"))


def substation_voltage_level(m: GridModel) -> DataFrame:
    """Voltage levels at the highest voltage of their substation; ties keep all."""
    levels = required(m["voltage_level"].filter(has_type("VoltageLevel")), "base_voltage", "substation")
    levels = levels.join(s.line_nominal(m), "base_voltage").select("substation", F.col("mrid").alias("container"), F.col("un").alias("v"))
    top = levels.groupBy("substation").agg(F.max("v").alias("v"))
    sites = required(m["substation"].select(F.col("id").alias("substation"), F.col("mrid").alias("site")), "site")
    rows = required(levels, "container").join(top, ["substation", "v"]).join(sites, "substation")
    return m.finish(rows.select(F.col("site").alias("substation"), "container", "v"))


def base_voltage(m: GridModel) -> DataFrame:
    """Mean operating voltage of the energised nodes of each base voltage."""
    voltage = m["sv_voltage"].filter("v > 0").select(F.col("node").alias("topological_node"), "v")
    nodes = m["topological_node"].select(F.col("id").alias("topological_node"), "base_voltage")
    mean = voltage.join(required(nodes, "base_voltage"), "topological_node").groupBy("base_voltage").agg(
        F.avg("v").alias("operating_voltage")
    )
    bases = required(s.nominal(m), "un", "base_voltage_mrid")
    return m.finish(mean.join(bases, "base_voltage").select(F.col("base_voltage_mrid").alias("mrid"), "un", "operating_voltage"))


def coordinates(m: GridModel) -> DataFrame:
    """Position points of substations and lines, ordered by resource and point number as text."""
    points = required(m["position_point"], "location", "sequence_number", "x", "y")
    systems = m["coordinate_system"].select(F.col("id").alias("coordinate_system"), F.col("crs_urn"))
    places = m["location"].select(F.col("id").alias("location"), "coordinate_system")
    places = places.join(required(systems, "crs_urn"), "coordinate_system")

    def resources(view: str, kind: str) -> DataFrame:
        typed = required(m[view].filter(has_type(kind)), "mrid")
        return typed.select(F.col("id").alias("resource"), "mrid", F.lit(s.CIM_NAMESPACE + kind).alias("rdf_type"))

    owners = resources("substation", "Substation").unionByName(resources("ac_line", "ACLineSegment"))
    owners = m["location_resource"].join(owners, "resource").join(places, "location")
    rows = points.select("location", "sequence_number", "x", "y").join(owners, "location")
    rows = rows.orderBy(F.concat("mrid", F.col("sequence_number").cast("string")))
    return m.finish(rows.select("mrid", "x", "y", str_after("crs_urn", "EPSG::").alias("epsg"), "rdf_type"))
