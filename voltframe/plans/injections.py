"""Reports on loads, machines and flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions import if_, str_after, strip_text
from voltframe.model import GridModel
from voltframe.operators.aggregates import best_per_key, concat_ordered
from voltframe.operators.joins import has_type, optional, required, without
from voltframe.plans import shared as s

# Classes and texts the report is defined on (fixed values).
LOAD_CLASSES = ("ConformLoad", "NonConformLoad", "EnergyConsumer")
BRANCH_CLASSES = ("ACLineSegment", "SeriesCompensator", "PowerTransformer")


def _sites(m: GridModel, region: str | None) -> DataFrame:
    return required(s.level_area(m, region, "substation_mrid"), "substation_mrid").select("container", "substation_mrid")


def _connected_ends(m: GridModel) -> DataFrame:
    """Terminals with a node name, a connected flag and both flows."""
    ends = required(s.node_ends(m, s.stored_terminals(m, "terminal", "equipment", "node", "connected")), "equipment", "node", "connected")
    ends = ends.select("terminal", "equipment", "node", "connected", "connectivity_node")
    return ends.join(s.power_flow(m, "p", "q"), "terminal").drop("terminal", "node")


def loads(m: GridModel, region: str | None = None) -> DataFrame:
    resource = m["schedule_resource"].select(F.col("id").alias("schedule_resource"), F.col("market_code").alias("station_group"))
    group = m["load_group"].select(F.col("id").alias("load_group"), "schedule_resource")
    group = group.join(required(resource, "station_group"), "schedule_resource").select("load_group", "station_group")
    owners = required(m["load"].filter(s.enabled()), "mrid", "name", "container").select(
        F.col("id").alias("equipment"), "mrid", "name", "container", "load_group", F.explode("types").alias("load_type")
    )
    owners = owners.filter(F.col("load_type").isin(*LOAD_CLASSES)).join(_sites(m, region), "container")
    rows = optional(owners, group, "load_group").join(_connected_ends(m), "equipment")
    rows = optional(rows, s.in_service(m), "equipment")
    return m.finish(
        rows.select(
            "mrid",
            "name",
            "substation_mrid",
            F.coalesce("in_service", "connected").alias("status"),
            "p",
            "q",
            "station_group",
            "connectivity_node",
            "load_type",
        )
    )


def _unit_details(m: GridModel) -> DataFrame:
    """Generating units of a known class with limits, market data and storage; each group is all or nothing."""
    units = required(m["generating_unit"], "direct_type").withColumnRenamed("id", "unit")
    resource = required(m["schedule_resource"], "market_code", "mrid", "name").select(
        F.col("id").alias("schedule_resource"),
        F.col("market_code").alias("station_group"),
        F.col("mrid").alias("resource_mrid"),
        F.col("name").alias("station_group_name"),
    )
    plants = m["hydro_power_plant"].select(F.col("id").alias("hydro_power_plant"), "storage_type")
    rows = optional(optional(units, resource, "schedule_resource"), plants, "hydro_power_plant")
    limited = F.col("mrid").isNotNull() & F.col("min_p").isNotNull() & F.col("max_p").isNotNull()
    traded = (
        limited & F.col("market_code").isNotNull() & F.col("allocation_weight").isNotNull() & F.col("station_group").isNotNull()
    )
    return rows.select(
        "unit",
        "direct_type",
        "storage_type",
        F.col("frr_resource").isNotNull().alias("prequalified"),
        *[F.when(limited, F.col(c)).alias(f"unit_{c}") for c in ("mrid", "min_p", "max_p")],
        *[
            F.when(traded, F.col(c)).alias(c)
            for c in ("market_code", "allocation_weight", "station_group", "resource_mrid", "station_group_name")
        ],
    )


def synchronous_machines(m: GridModel, region: str | None = None) -> DataFrame:
    owners = required(m["synchronous_machine"].filter(has_type("SynchronousMachine") & s.enabled()), "mrid", "name", "rated_s", "container")
    owners = owners.withColumnRenamed("id", "equipment").join(_sites(m, region), "container")
    # A machine without a unit of known class stays, with the unit columns unbound.
    unit = F.explode_outer(F.array_compact(F.array("machine_generating_unit", "generating_unit")))
    owners = owners.select("equipment", F.col("mrid").alias("machine_mrid"), "name", "rated_s", "substation_mrid", unit.alias("unit"))
    rows = optional(owners, _unit_details(m), "unit").join(_connected_ends(m), "equipment")
    rows = optional(rows, s.in_service(m), "equipment")
    produced = if_(F.col("p") >= 0.0, F.col("p"), F.lit(0.0))
    consumed = if_(F.col("p") < 0.0, F.col("p"), F.lit(0.0))
    return m.finish(
        rows.select(
            F.coalesce("unit_mrid", "machine_mrid").alias("mrid"),
            "name",
            "market_code",
            F.coalesce("in_service", "connected").alias("status"),
            "station_group",
            "station_group_name",
            "substation_mrid",
            F.coalesce("unit_max_p", produced, F.lit(0.0)).alias("max_p"),
            F.coalesce("unit_min_p", consumed, F.lit(0.0)).alias("min_p"),
            F.col("allocation_weight").alias("merit_order"),
            F.col("rated_s").alias("sn"),
            "p",
            "q",
            "connectivity_node",
            F.coalesce(strip_text("direct_type", s.CIM_NAMESPACE), F.lit("unknown")).alias("generator_type"),
            str_after("storage_type", "HydroPlantStorageKind.").alias("storage_type"),
            F.col("resource_mrid").alias("schedule_resource"),
            F.coalesce("prequalified", F.lit(False)).alias("afrr_prequalified"),
        )
    )


def wind_generating_units(m: GridModel, region: str | None = None) -> DataFrame:
    """Wind units; plant and market columns are bound together or not at all. `region` has no effect."""
    del region
    units = required(
        m["generating_unit"].filter(has_type("WindGeneratingUnit") & s.enabled()), "mrid", "name", "max_p", "min_p"
    )
    plant = m["wind_power_plant"].select(F.col("id").alias("wind_power_plant"), F.col("mrid").alias("_plant"))
    resource = m["schedule_resource"].select(F.col("id").alias("schedule_resource"), F.col("market_code").alias("_group"))
    rows = optional(units, required(plant, "_plant"), "wind_power_plant")
    rows = optional(rows, required(resource, "_group"), "schedule_resource")
    bound = F.col("_plant").isNotNull() & F.col("_group").isNotNull() & F.col("market_code").isNotNull()
    return m.finish(
        rows.select(
            "mrid",
            "name",
            F.when(bound, F.col("market_code")).alias("market_code"),
            F.when(bound, F.col("_group")).alias("station_group"),
            "min_p",
            "max_p",
            F.when(bound, F.col("_plant")).alias("plant_mrid"),
        )
    )


def branch_node_withdraw(m: GridModel, region: str | None = None) -> DataFrame:
    """Flow at every connected branch terminal, with its topological node."""
    branches = m["equipment"].filter(s.enabled()).select(F.col("id").alias("equipment"), F.explode("types").alias("type"))
    branches = branches.filter(F.col("type").isin(*BRANCH_CLASSES)).select("equipment")
    ends = required(
        s.terminals(m, "terminal", "terminal_mrid", "equipment", "node", "terminal_topological_node", "connected").filter("connected"),
        "terminal_mrid", "equipment", "node",
    ).drop("connected")
    nodes = required(s.node_area(m, region, "connectivity_node"), "connectivity_node").select("node", "connectivity_node")
    named = m["topological_node"].select(F.col("id").alias("topological_node"), F.col("mrid").alias("tp_mrid"))
    ends = ends.join(branches, "equipment").join(nodes, "node").join(s.power_flow(m, "p", "q"), "terminal")
    rows = s.terminal_topology(m, ends).join(required(named, "tp_mrid"), "topological_node")
    return m.finish(
        rows.select(F.col("terminal_mrid").alias("mrid"), F.col("tp_mrid").alias("node"), "p", "q", "connectivity_node")
    )


def dc_active_flow(m: GridModel, region: str | None = None) -> DataFrame:
    """Largest signed flow of each branch or winding, positive when measured at end 1."""
    names = s.region_names(m).filter(s.in_region(region))
    sites = m["substation"].select(F.col("id").alias("substation"), F.col("region").alias("sub_region")).join(names, "sub_region")
    sites = sites.select("substation")
    levels = m["voltage_level"].select(F.col("id").alias("container"), "substation").join(sites, "substation")
    lines = m["line"].select(F.col("id").alias("container"), F.col("region").alias("sub_region")).join(names, "sub_region")
    places = levels.select("container").unionByName(lines.select("container"))
    branches = required(m["equipment"], "mrid", "container").select(
        F.col("id").alias("equipment"), "mrid", "container", F.explode("types").alias("type")
    )
    branches = branches.filter(F.col("type").isin("ACLineSegment", "SeriesCompensator")).join(places, "container")
    ends = s.terminal_ends(m, "terminal", "equipment")
    of_branches = ends.join(branches, "equipment").select("terminal", "mrid", F.when(F.col("nr") == 1, 1).otherwise(-1).alias("direction"))
    owners = m["power_transformer"].select(F.col("id").alias("transformer"), F.col("container").alias("substation"))
    windings = required(m["transformer_end"].select("transformer", "terminal", "mrid"), "mrid", "terminal")
    of_windings = windings.join(owners.join(sites, "substation"), "transformer").select("terminal", "mrid", F.lit(1).alias("direction"))
    rows = of_branches.unionByName(of_windings).join(s.power_flow(m, "p"), "terminal")
    best = best_per_key(rows, "mrid", "p", "direction")
    return m.finish(best.select("mrid", (F.col("p") * F.col("direction")).alias("p")))


def powerflow(m: GridModel) -> DataFrame:
    """Flows that carry a class; flows added without one are left out."""
    flows = required(m["sv_power_flow"].filter(has_type("SvPowerFlow")), "terminal", "p", "q").select("terminal", "p", "q")
    ends = required(s.terminals(m, "terminal", "terminal_mrid", "equipment").withColumnRenamed("terminal_mrid", "mrid"), "mrid")
    rows = optional(flows.join(ends, "terminal"), s.in_service(m), "equipment")
    return m.finish(rows.select("mrid", "p", "q", F.coalesce("in_service", F.lit(True)).alias("in_service")))


def sv_injection(m: GridModel) -> DataFrame:
    nodes = m["topological_node"].select(F.col("id").alias("node"), "mrid")
    rows = required(m["sv_injection"], "node", "p", "q").select("node", "p", "q").join(required(nodes, "mrid"), "node")
    return m.finish(rows.select(F.col("mrid").alias("node"), "p", "q"))


def sv_power_deviation(m: GridModel) -> DataFrame:
    """Sum of terminal flows per topological node next to its reported injection."""
    ends = required(
        s.terminals(m, "terminal", "node", "equipment", "terminal_name", "terminal_topological_node"),
        "terminal", "node", "equipment", "terminal_name",
    )
    converters = required(m["converter"].select(F.col("id").alias("equipment"), "p"), "p")
    measured = required(m["sv_power_flow"].select("terminal"), "terminal")
    flows = s.power_flow(m, "p").unionByName(
        without(ends.select("terminal", "equipment").join(converters, "equipment").select("terminal", "p"), measured, "terminal")
    )
    injected = required(m["sv_injection"], "node", "p").select(F.col("node").alias("topological_node"), F.col("p").alias("p_inj"))
    named = required(m["topological_node"], "mrid", "name").select(F.col("id").alias("topological_node"), F.col("mrid").alias("tp_mrid"))
    rows = ends.drop("equipment").join(flows, "terminal").join(s.node_mrids(m), "node")
    rows = s.terminal_topology(m, rows).join(named, "topological_node").join(injected, "topological_node")
    return m.finish(
        rows.groupBy(F.col("tp_mrid").alias("node")).agg(
            F.sum("p").alias("sum_terminal_flow"),
            F.max("p_inj").alias("reported_sv_injection"),
            concat_ordered("connectivity_node", ",", distinct=True).alias("connectivity_nodes"),
            concat_ordered("terminal_name", ",").alias("terminal_names"),
        )
    )


