"""Sub-plans several reports use. Small sides are left to the optimizer's size check for broadcasting."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions import default_true, if_
from voltframe.model import GridModel
from voltframe.operators.joins import alternatives, has_type, required

# Namespace of CIM classes and enumerations (fixed value).
CIM_NAMESPACE = "http://iec.ch/TC57/2013/CIM-schema-cim16#"
DEFAULT_RATE = "Normal@20"


# Sub-plans over whole views that `GridModel.save` writes beside the views.
DERIVED: dict[str, Callable[..., DataFrame]] = {}


def derived(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Read the sub-plan from the model where it is stored there, else derive it from the views."""
    name = f"derived_{build.__name__}"
    DERIVED[name] = build

    @wraps(build)
    def chosen(m: GridModel, *columns: str) -> DataFrame:
        return m[name] if name in m else build(m, *columns)

    return chosen


def picked(view: DataFrame, names: dict[str, str], columns: tuple[str, ...]) -> DataFrame:
    """Columns of a view under the names of a sub-plan: those asked for, or all.

    A report names what it uses, since a property with several values gives a row for each to whoever selects it.
    """
    return view.select(*[F.col(source).alias(name) for name, source in names.items() if not columns or name in columns])


def in_region(region: str | None, area: str = "area") -> Column:
    """Unanchored match of the area name; every bound area matches when no region is given."""
    return F.col(area).rlike(region) if region else F.col(area).isNotNull()


def enabled(flag: str = "analysis_enabled") -> Column:
    return default_true(flag)


def region_names(m: GridModel) -> DataFrame:
    """sub-geographical region -> name of its geographical region."""
    sub = m["sub_geographical_region"].select(F.col("id").alias("sub_region"), F.col("region").alias("_geo"))
    geo = m["geographical_region"].select(F.col("id").alias("_geo"), F.col("name").alias("area"))
    return required(sub.join(geo, "_geo").drop("_geo"), "area")


@derived
def substations(m: GridModel, *columns: str) -> DataFrame:
    """Substation -> name of its area, where it has one."""
    names = {"substation": "id", "substation_mrid": "mrid", "substation_name": "name", "sub_region": "region", "delivery_point": "delivery_point"}
    sub = picked(m["substation"], names, columns and (*columns, "substation", "sub_region"))
    return sub.join(region_names(m), "sub_region").drop("sub_region")


def substation_area(m: GridModel, region: str | None = None, *columns: str) -> DataFrame:
    return substations(m, *columns).filter(in_region(region))


def voltage_levels(m: GridModel, *columns: str) -> DataFrame:
    return picked(m["voltage_level"], {"container": "id", "substation": "substation", "base_voltage": "base_voltage"}, columns)


def nominal(m: GridModel) -> DataFrame:
    return m["base_voltage"].select(
        F.col("id").alias("base_voltage"),
        F.col("mrid").alias("base_voltage_mrid"),
        F.col("nominal_voltage").alias("un"),
    )


def line_nominal(m: GridModel) -> DataFrame:
    return required(m["base_voltage"].select(F.col("id").alias("base_voltage"), F.col("nominal_voltage").alias("un")), "un")


def level_area(m: GridModel, region: str | None = None, *columns: str) -> DataFrame:
    """Voltage level -> substation and area."""
    levels = voltage_levels(m, *(columns and (*columns, "container", "substation")))
    return levels.join(substation_area(m, region, *columns), "substation")


def node_mrids(m: GridModel) -> DataFrame:
    nodes = m["connectivity_node"].select(F.col("id").alias("node"), F.col("mrid").alias("connectivity_node"))
    return required(nodes, "connectivity_node")


def node_containers(m: GridModel, *columns: str) -> DataFrame:
    names = {"node": "id", "connectivity_node": "mrid", "container": "container"}
    return required(picked(m["connectivity_node"], names, columns and (*columns, "node", "container")), "container")


@derived
def placed_nodes(m: GridModel, *columns: str) -> DataFrame:
    """Connectivity node -> voltage level -> substation -> area."""
    return node_containers(m, *columns).join(level_area(m, None, *columns), "container")


def node_area(m: GridModel, region: str | None = None, *columns: str) -> DataFrame:
    return placed_nodes(m, *columns).filter(in_region(region))


TERMINAL = {
    "terminal": "id",
    "types": "types",
    "terminal_mrid": "mrid",
    "terminal_name": "name",
    "equipment": "equipment",
    "node": "node",
    "terminal_topological_node": "topological_node",
    "sequence_number": "sequence_number",
    "terminal_sequence_number": "terminal_sequence_number",
    "connected": "connected",
    "terminal_connected": "terminal_connected",
}


def terminals(m: GridModel, *columns: str) -> DataFrame:
    return picked(m["terminal"], TERMINAL, columns)


def terminal_ends(m: GridModel, *columns: str, located: bool = False) -> DataFrame:
    """Terminals with `nr` from either sequence-number property; `located` takes them from `stored_terminals`."""
    either = ("sequence_number", "terminal_sequence_number")
    return alternatives((stored_terminals if located else terminals)(m, *(columns and (*columns, *either))), "nr", *either)


def numbered_ends(m: GridModel, *columns: str, located: bool = False) -> DataFrame:
    """Terminals with `nr` from the current sequence-number property only; `located` as in `terminal_ends`."""
    rows = (stored_terminals if located else terminals)(m, *(columns and (*columns, "sequence_number")))
    return required(rows.withColumnRenamed("sequence_number", "nr"), "nr")


@derived
def located_terminals(m: GridModel) -> DataFrame:
    """Terminals with the mRID of their node and the area of its substation, where they have them.

    Views have one row per subject, so no join here multiplies rows.
    """
    nodes = m["connectivity_node"].select(F.col("id").alias("node"), F.col("mrid").alias("connectivity_node"), "container")
    areas = level_area(m, None, "container").select("container", "area")
    return terminals(m).join(nodes.join(areas, "container", "left").drop("container"), "node", "left")


def node_ends(m: GridModel, ends: DataFrame) -> DataFrame:
    """Add the mRID of the node to ends that have one."""
    return ends if "connectivity_node" in ends.columns else ends.join(node_mrids(m), "node")


def stored_terminals(m: GridModel, *columns: str) -> DataFrame:
    """Terminals, with the mRID and area of their nodes if these are stored beside them."""
    if "derived_located_terminals" not in m:
        return terminals(m, *columns)
    rows = required(located_terminals(m), "connectivity_node")
    return rows.select(*columns, "connectivity_node", "area") if columns else rows


def terminal_topology(m: GridModel, ends: DataFrame) -> DataFrame:
    """Add `topological_node`: that of the connectivity node, else that of the terminal itself."""
    nodes = m["connectivity_node"].select(F.col("id").alias("node"), F.col("topological_node").alias("_by_node"))
    joined = ends.join(nodes, "node", "left")
    both = F.coalesce("_by_node", "terminal_topological_node").alias("topological_node")
    kept = [c for c in joined.columns if c not in ("_by_node", "terminal_topological_node")]
    return required(joined.select(*kept, both), "topological_node")


def power_flow(m: GridModel, *needed: str) -> DataFrame:
    """terminal -> p, q; rows must bind the needed columns."""
    return required(m["sv_power_flow"].select("terminal", *needed), "terminal", *needed)


def in_service(m: GridModel, key: str = "equipment") -> DataFrame:
    return required(m["sv_status"].select(F.col("equipment").alias(key), "in_service"), key, "in_service")


def limits(m: GridModel, kind: str, value: str, rate: str | None, of: str, key: str) -> DataFrame:
    """key -> `rate`: values of the limits of one class and name, set on an equipment or a terminal."""
    limit = (
        m["operational_limit"]
        .filter(has_type(kind) & (F.col("name") == (rate or DEFAULT_RATE)))
        .select("limit_set", F.col(value).alias("rate"))
    )
    sets = m["operational_limit_set"].select(F.col("id").alias("limit_set"), F.col(of).alias(key))
    return required(limit, "limit_set", "rate").join(required(sets, key), "limit_set").drop("limit_set")


def bid_zones(m: GridModel) -> DataFrame:
    """delivery point -> EIC code of its bidding area."""
    points = m["delivery_point"].select(F.col("id").alias("delivery_point"), "bidding_area")
    areas = m["bidding_area"].select(F.col("id").alias("bidding_area"), F.col("eic_code").alias("bidzone"))
    return required(points.join(areas, "bidding_area").drop("bidding_area"), "bidzone")


def loss(p: str, other: str) -> Column:
    """Loss booked on the end with the smaller flow; unknown when either flow is."""
    return if_(F.col(p) < F.col(other), F.col(p) + F.col(other), F.lit(0.0))


def both(first: str, second: str) -> Column:
    return F.col(first) & F.col(second)
