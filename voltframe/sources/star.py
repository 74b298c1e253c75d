"""A grid model read from a star schema of orders, parts and partners.

Every row of the source tables becomes grid data: orders are equipment (their priority and quarter
give the class), line items are terminals, parts are nodes, suppliers are substations, customers are
market resources. The mapping is described in MAPPING.md.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.model import GridModel
from voltframe.session import written

# Equipment classes by order priority, and by quarter or month where one priority holds several.
AC_LINE = "o_orderpriority = '1-URGENT'"
TRANSFORMER = "o_orderpriority = '2-HIGH'"
SWITCH = "o_orderpriority = '3-MEDIUM'"
SITE = "o_orderpriority = '4-NOT SPECIFIED'"
MACHINE = f"{SITE} AND quarter(o_orderdate) = 1"
LOAD = f"{SITE} AND quarter(o_orderdate) = 2"
COMPENSATOR = f"{SITE} AND quarter(o_orderdate) = 3"
BUSBAR = f"{SITE} AND quarter(o_orderdate) = 4"
CONVERTER = "o_orderpriority = '5-LOW' AND quarter(o_orderdate) <= 2"
DC_LINE = "o_orderpriority = '5-LOW' AND quarter(o_orderdate) > 2"

TYPES = f"""
CASE WHEN {AC_LINE} THEN array('ACLineSegment')
     WHEN {TRANSFORMER} THEN array('PowerTransformer')
     WHEN {SWITCH} THEN array(element_at(array('Breaker', 'Disconnector', 'LoadBreakSwitch', 'GroundDisconnector'),
                                         quarter(o_orderdate)))
     WHEN {MACHINE} THEN array('SynchronousMachine')
     WHEN {LOAD} THEN array(element_at(array('ConformLoad', 'NonConformLoad', 'EnergyConsumer'), month(o_orderdate) - 3))
     WHEN {COMPENSATOR} THEN array('SeriesCompensator')
     WHEN {BUSBAR} THEN array('BusbarSection')
     WHEN {CONVERTER} THEN array('VoltageSourceConverter', 'VsConverter')
     ELSE array('DCLineSegment') END"""
NAME = "CASE WHEN month(o_orderdate) = 12 THEN 'HVDC ' ELSE '' END || o_orderpriority || ' ' || o_orderkey"
ALIAS = "CASE WHEN o_orderstatus <> 'P' THEN 'A-' || o_custkey END"
ANALYSED = "CASE WHEN year(o_orderdate) <> 1996 THEN year(o_orderdate) <> 1997 END"
CONTAINER = f"""
CASE WHEN {AC_LINE} THEN 'ln-' || o_custkey
     WHEN {TRANSFORMER} THEN 'ss-' || (o_custkey % sites)
     ELSE 'vl-' || (o_custkey % sites) || '-' || CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END END"""
NORMAL_OPEN = f"CASE WHEN {SWITCH} THEN o_orderstatus = 'O' END"

EQUIPMENT_COLUMNS = [
    "'eq-' || o_orderkey AS id",
    f"{TYPES} AS types",
    "'eq-' || o_orderkey AS mrid",
    f"{NAME} AS name",
    f"{CONTAINER} AS container",
    f"{ANALYSED} AS analysis_enabled",
]
ON_VOLTAGE = "'bv-' || quarter(o_orderdate) AS base_voltage"

# IRIs of enumeration values (fixed values).
MODE_IRI = "http://iec.ch/TC57/2013/CIM-schema-cim16#RegulatingControlModeKind.activePower"
STORAGE_IRI = "urn:extension#HydroPlantStorageKind."
CLASS_IRI = "http://iec.ch/TC57/2013/CIM-schema-cim16#"


_MAPPED: dict[str, Callable[[StarTables], DataFrame]] = {}


def mapped(build: Callable[[StarTables], DataFrame]) -> Callable[[StarTables], DataFrame]:
    """Register a view under the name of the function that builds it."""
    _MAPPED[build.__name__] = build
    return build


class StarTables:
    """The source tables and the two intermediate frames several views share."""

    def __init__(self, spark: SparkSession, folder: str, materialize: bool = False) -> None:
        self.spark, self.folder, self.materialize = spark, folder, materialize

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def with_sites(self, df: DataFrame) -> DataFrame:
        """Add the number of substations, a one-value subquery, for foreign keys that point at substations."""
        return df.withColumn("sites", self.table("supplier").agg(F.count("*")).scalar())

    @cache
    def orders(self) -> DataFrame:
        return self.with_sites(self.table("orders"))

    @cache
    def ends(self) -> DataFrame:
        """One row per (order, line number); line items repeat that pair."""
        ends = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("nr"))
            .agg(
                F.min("l_partkey").alias("part"),
                F.min("l_suppkey").alias("supp"),
                F.max("l_extendedprice").alias("price"),
                F.min("l_tax").alias("tax"),
                F.max("l_quantity").alias("qty"),
                F.min("l_discount").alias("disc"),
                F.bool_or(F.col("l_returnflag") == "R").alias("returned"),
                F.bool_or(F.col("l_returnflag") == "A").alias("accepted"),
                F.bool_and(F.col("l_linestatus") == "O").alias("open"),
            )
        )
        return written(ends, "ends") if self.materialize else ends

    @cache
    def windings(self) -> DataFrame:
        """Terminals of transformers."""
        keys = self.table("orders").filter(TRANSFORMER).select("o_orderkey")
        return self.ends().join(keys, F.col("o") == F.col("o_orderkey"), "left_semi")


def star_model(
    spark: SparkSession, folder: str, node_of: str = "'cn-' || part", materialize: bool = False
) -> GridModel:
    """The grid model of a star schema; `node_of` gives a terminal's node from its part and supplier.

    With `materialize` the grouped line items, which a dozen views read, are written once.
    """
    t = StarTables(spark, folder, materialize)
    views = {name: (lambda f=f: f(t)) for name, f in _MAPPED.items()}
    views["terminal"] = lambda: terminal(t, node_of)
    return GridModel(views)


@mapped
def geographical_region(t: StarTables) -> DataFrame:
    return t.table("region").selectExpr(
        "'gr-' || r_regionkey AS id",
        "'gr-' || r_regionkey AS mrid",
        "r_name AS name",
        "CASE WHEN r_name LIKE 'A%' THEN lower(r_name) END AS alias_name",
    )


@mapped
def sub_geographical_region(t: StarTables) -> DataFrame:
    return t.table("nation").selectExpr(
        "'sg-' || n_nationkey AS id",
        "array('SubGeographicalRegion') AS types",
        "'sg-' || n_nationkey AS mrid",
        "n_name AS name",
        "CASE WHEN n_regionkey = 3 THEN lower(n_name) END AS alias_name",
        "CASE WHEN n_nationkey >= 10 THEN 'N' || n_nationkey END AS short_name",
        "'gr-' || n_regionkey AS region",
    )


@mapped
def substation(t: StarTables) -> DataFrame:
    return t.table("supplier").selectExpr(
        "'ss-' || s_suppkey AS id",
        "array('Substation') AS types",
        "'ss-' || s_suppkey AS mrid",
        "s_name AS name",
        "'sg-' || s_nationkey AS region",
        "CASE WHEN s_acctbal >= 1000 THEN 'mdp-' || s_suppkey END AS delivery_point",
    )


@mapped
def delivery_point(t: StarTables) -> DataFrame:
    return t.table("supplier").selectExpr("'mdp-' || s_suppkey AS id", "'ba-' || s_nationkey AS bidding_area")


@mapped
def bidding_area(t: StarTables) -> DataFrame:
    return t.table("nation").selectExpr(
        "'ba-' || n_nationkey AS id", "'EIC-' || n_name AS eic_code", "'BZ-' || n_nationkey AS market_code"
    )


@mapped
def base_voltage(t: StarTables) -> DataFrame:
    return t.table("region").selectExpr(
        "'bv-' || r_regionkey AS id",
        "'bv-' || r_regionkey AS mrid",
        "element_at(array(66D, 132D, 220D, 300D, 420D), r_regionkey + 1) AS nominal_voltage",
    )


@mapped
def voltage_level(t: StarTables) -> DataFrame:
    band = "CASE WHEN s_acctbal < 2000 THEN 0 WHEN s_acctbal < 4000 THEN 1 WHEN s_acctbal < 6000 THEN 2 WHEN s_acctbal < 8000 THEN 3 ELSE 4 END"
    return (
        t.table("supplier")
        .withColumn("level", F.explode(F.array(F.lit(0), F.lit(1))))
        .selectExpr(
            "'vl-' || s_suppkey || '-' || level AS id",
            "array('VoltageLevel') AS types",
            "'vl-' || s_suppkey || '-' || level AS mrid",
            f"'bv-' || CASE WHEN level = 0 THEN {band} ELSE 4 - ({band}) END AS base_voltage",
            "'ss-' || s_suppkey AS substation",
        )
    )


@mapped
def line(t: StarTables) -> DataFrame:
    return t.with_sites(t.table("customer")).selectExpr(
        "'ln-' || c_custkey AS id",
        "'ln-' || c_custkey AS mrid",
        "c_name AS name",
        "'sg-' || c_nationkey AS region",
        "CASE WHEN c_acctbal >= 0 THEN 'M-' || c_nationkey END AS market_code",
        "'mdp-' || (c_custkey % sites) AS from_delivery_point",
        "'mdp-' || ((c_custkey + 1) % sites) AS to_delivery_point",
    )


@mapped
def connectivity_node(t: StarTables) -> DataFrame:
    parts = t.with_sites(t.table("part")).selectExpr(
        "'cn-' || p_partkey AS id",
        "'cn-' || p_partkey AS mrid",
        """CASE WHEN p_size = 50 THEN 'ln-' || (p_partkey % sites)
                ELSE 'vl-' || (p_partkey % sites) || '-' || CASE WHEN p_size > 25 THEN 1 ELSE 0 END END AS container""",
        "CASE WHEN p_type <> 'PROMO' THEN 'tn-' || (p_partkey DIV 2) END AS topological_node",
    )
    return parts.unionByName(
        t.table("supplier").selectExpr("'dn-' || s_suppkey AS id", "'dn-' || s_suppkey AS mrid"),
        allowMissingColumns=True,
    )


@mapped
def topological_node(t: StarTables) -> DataFrame:
    return t.with_sites(t.table("part")).selectExpr(
        "'tn-' || p_partkey AS id",
        "array('TopologicalNode') AS types",
        "'tn-' || p_partkey AS mrid",
        "p_name || ' ' || p_partkey AS name",
        "'bv-' || ((p_size - 1) DIV 10) AS base_voltage",
        "'vl-' || (p_partkey % sites) || '-' || CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS container",
    )


@mapped
def topological_island(t: StarTables) -> DataFrame:
    return (
        t.table("part")
        .filter("p_type <> 'SMALL'")
        .groupBy("p_type")
        .agg(F.min("p_partkey").alias("ref"))
        .selectExpr("'ti-' || p_type AS id", "p_type AS name", "'tn-' || ref AS angle_ref")
    )


@mapped
def island_node(t: StarTables) -> DataFrame:
    return (
        t.table("part").filter("p_type <> 'SMALL'").selectExpr("'ti-' || p_type AS island", "'tn-' || p_partkey AS node")
    )


@mapped
def sv_voltage(t: StarTables) -> DataFrame:
    return (
        t.table("part")
        .filter("p_brand <> 'Brand#1'")
        .selectExpr(
            "'sv-' || p_partkey AS id",
            "'tn-' || p_partkey AS node",
            "CASE WHEN p_size = 1 THEN 0D ELSE p_retailprice / 4 END AS v",
            "CAST(p_size - 25 AS DOUBLE) AS angle",
        )
    )


@mapped
def sv_injection(t: StarTables) -> DataFrame:
    return t.table("part").selectExpr(
        "'si-' || p_partkey AS id",
        "'tn-' || p_partkey AS node",
        "p_retailprice - 1000 AS p",
        "CASE WHEN p_type <> 'MEDIUM' THEN CAST(p_size AS DOUBLE) END AS q",
    )


@mapped
def terminal(t: StarTables, node_of: str = "'cn-' || part") -> DataFrame:
    return t.ends().selectExpr(
        "'tm-' || o || '-' || nr AS id",
        "array('Terminal') AS types",
        "'tm-' || o || '-' || nr AS mrid",
        "'T' || nr || '-' || o AS name",
        "'eq-' || o AS equipment",
        f"{node_of} AS node",
        "CASE WHEN open THEN 'tn-' || part END AS topological_node",
        "CASE WHEN disc > 0 THEN nr END AS sequence_number",
        "CASE WHEN disc = 0 THEN nr END AS terminal_sequence_number",
        "NOT returned AS connected",
        "CASE WHEN disc = 0 THEN NOT returned END AS terminal_connected",
    )


@mapped
def sv_power_flow(t: StarTables) -> DataFrame:
    return (
        t.ends()
        .filter("qty >= 5")
        .selectExpr(
            "'pf-' || o || '-' || nr AS id",
            "CASE WHEN open THEN array('SvPowerFlow') ELSE CAST(array() AS array<string>) END AS types",
            "'tm-' || o || '-' || nr AS terminal",
            "price - 50000 AS p",
            "tax AS q",
        )
    )


@mapped
def sv_status(t: StarTables) -> DataFrame:
    known = t.table("orders").filter("o_orderstatus IN ('F', 'O')")
    whole = known.selectExpr(
        "'st-' || o_orderkey AS id", "'eq-' || o_orderkey AS equipment", "o_orderstatus = 'F' AS in_service"
    )
    first_end = known.filter(TRANSFORMER).selectExpr(
        "'sw-' || o_orderkey AS id", "'te-' || o_orderkey || '-1' AS equipment", "o_orderstatus = 'F' AS in_service"
    )
    return whole.unionByName(first_end)


@mapped
def sv_tap_step(t: StarTables) -> DataFrame:
    return (
        t.windings()
        .filter("NOT accepted AND open")
        .selectExpr("'ts-' || o || '-' || nr AS id", "'pt-' || o || '-' || nr AS tap_changer", "qty AS position")
    )


@mapped
def equipment(t: StarTables) -> DataFrame:
    return t.orders().selectExpr(*EQUIPMENT_COLUMNS, f"{ALIAS} AS alias_name", f"{NORMAL_OPEN} AS normal_open")


@mapped
def identified(t: StarTables) -> DataFrame:
    equipment = t.orders().selectExpr("'eq-' || o_orderkey AS id", f"{TYPES} AS types", "'eq-' || o_orderkey AS mrid")
    ends = t.windings().selectExpr(
        "'te-' || o || '-' || nr AS id", "array('PowerTransformerEnd') AS types", "'te-' || o || '-' || nr AS mrid"
    )
    controllers = t.table("customer").selectExpr(
        "'dk-' || c_custkey AS id", "array('DCController') AS types", "'dk-' || c_custkey AS mrid"
    )
    return equipment.unionByName(ends).unionByName(controllers)


@mapped
def ac_line(t: StarTables) -> DataFrame:
    return (
        t.orders()
        .filter(AC_LINE)
        .selectExpr(
            *EQUIPMENT_COLUMNS,
            ON_VOLTAGE,
            "o_totalprice / 1000 AS r",
            "o_totalprice / 100 AS x",
            "o_totalprice / 10 AS bch",
            "CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS gch",
            "CAST(day(o_orderdate) AS DOUBLE) AS length",
        )
    )


@mapped
def series_compensator(t: StarTables) -> DataFrame:
    return (
        t.orders()
        .filter(COMPENSATOR)
        .selectExpr(*EQUIPMENT_COLUMNS, ON_VOLTAGE, "o_totalprice / 1000 AS r", "o_totalprice / 100 AS x")
    )


@mapped
def power_transformer(t: StarTables) -> DataFrame:
    return t.orders().filter(TRANSFORMER).selectExpr(*EQUIPMENT_COLUMNS, f"{ALIAS} AS alias_name")


@mapped
def transformer_end(t: StarTables) -> DataFrame:
    return t.windings().selectExpr(
        "'te-' || o || '-' || nr AS id",
        "array('PowerTransformerEnd') AS types",
        "'te-' || o || '-' || nr AS mrid",
        "'W' || nr || '-' || o AS name",
        "'eq-' || o AS transformer",
        "'tm-' || o || '-' || nr AS terminal",
        "nr AS end_number",
        "qty + 60 AS rated_u",
        "tax * 10 AS r",
        "price / 1000 AS x",
        "disc AS b",
        "disc * 2 AS g",
        "CASE WHEN accepted THEN nr END AS phase_angle_clock",
        "CASE WHEN NOT accepted THEN 'pt-' || o || '-' || nr END AS phase_tap_changer",
    )


@mapped
def ratio_tap_changer(t: StarTables) -> DataFrame:
    return (
        t.windings()
        .filter("accepted")
        .selectExpr(
            "'rt-' || o || '-' || nr AS id",
            "'te-' || o || '-' || nr AS transformer_end",
            "disc * 10 + 0.5D AS increment",
            "4 AS neutral_step",
            "nr AS normal_step",
            "CASE WHEN open THEN CAST(nr + 1 AS DOUBLE) END AS step",
        )
    )


@mapped
def phase_tap_changer(t: StarTables) -> DataFrame:
    return (
        t.windings()
        .filter("NOT accepted")
        .selectExpr(
            "'pt-' || o || '-' || nr AS id",
            "tax * 10 AS increment",
            "3 AS neutral_step",
            "7 AS high_step",
            "0 AS low_step",
            "'rc-' || o || '-' || nr AS control",
            "open AS control_enabled",
            "CAST(nr AS DOUBLE) AS step",
        )
    )


@mapped
def regulating_control(t: StarTables) -> DataFrame:
    return (
        t.windings()
        .filter("NOT accepted")
        .selectExpr(
            "'rc-' || o || '-' || nr AS id",
            f"'{MODE_IRI}' AS mode",
            "'tm-' || o || '-' || nr AS terminal",
            "qty > 10 AS enabled",
            "price AS target_value",
        )
    )


@mapped
def switch(t: StarTables) -> DataFrame:
    return (
        t.orders()
        .filter(SWITCH)
        .selectExpr(
            *EQUIPMENT_COLUMNS,
            f"{NORMAL_OPEN} AS normal_open",
            "CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) >= 1999 END AS open",
        )
    )


@mapped
def load(t: StarTables) -> DataFrame:
    return (
        t.orders()
        .filter(LOAD)
        .selectExpr(*EQUIPMENT_COLUMNS, "CASE WHEN month(o_orderdate) <> 4 THEN 'lg-' || o_custkey END AS load_group")
    )


@mapped
def load_group(t: StarTables) -> DataFrame:
    return t.table("customer").selectExpr(
        "'lg-' || c_custkey AS id",
        "'lg-' || c_custkey AS mrid",
        "'LG ' || c_name AS name",
        "'sr-' || c_custkey AS schedule_resource",
    )


@mapped
def schedule_resource(t: StarTables) -> DataFrame:
    return t.table("customer").selectExpr(
        "'sr-' || c_custkey AS id",
        "'sr-' || c_custkey AS mrid",
        "c_mktsegment || ' ' || c_custkey AS name",
        "CASE WHEN c_acctbal > 5000 THEN c_name END AS alias_name",
        "CASE WHEN c_acctbal >= 0 THEN 'M-' || c_nationkey || '-' || c_mktsegment END AS market_code",
    )


@mapped
def synchronous_machine(t: StarTables) -> DataFrame:
    return (
        t.orders()
        .filter(MACHINE)
        .selectExpr(
            *EQUIPMENT_COLUMNS,
            "o_totalprice AS rated_s",
            "CASE WHEN o_orderstatus = 'F' THEN 'gu-' || o_orderkey END AS generating_unit",
            "CASE WHEN o_orderstatus = 'O' THEN 'gu-' || o_orderkey END AS machine_generating_unit",
        )
    )


@mapped
def generating_unit(t: StarTables) -> DataFrame:
    kind = """element_at(map('MACHINERY', 'HydroGeneratingUnit', 'BUILDING', 'ThermalGeneratingUnit',
                             'AUTOMOBILE', 'WindGeneratingUnit', 'HOUSEHOLD', 'NuclearGeneratingUnit',
                             'FURNITURE', 'SolarGeneratingUnit'), c_mktsegment)"""
    return (
        t.orders()
        .filter(MACHINE)
        .join(t.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .selectExpr(
            "'gu-' || o_orderkey AS id",
            f"array({kind}) AS types",
            "'gu-' || o_orderkey AS mrid",
            "'Unit ' || o_orderkey AS name",
            f"CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN '{CLASS_IRI}' || {kind} END AS direct_type",
            "CASE WHEN day(o_orderdate) <> 1 THEN least(c_acctbal, 0D) END AS min_p",
            "abs(c_acctbal) AS max_p",
            "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'hp-' || c_custkey END AS hydro_power_plant",
            "CASE WHEN c_mktsegment = 'AUTOMOBILE' AND o_orderstatus <> 'F' THEN 'wp-' || c_custkey END AS wind_power_plant",
            "CASE WHEN month(o_orderdate) <> 1 THEN 'G-' || c_nationkey END AS market_code",
            "CAST(day(o_orderdate) AS DOUBLE) AS allocation_weight",
            "'sr-' || c_custkey AS schedule_resource",
            "CASE WHEN month(o_orderdate) = 3 THEN 'fr-' || c_custkey END AS frr_resource",
            f"{ANALYSED} AS analysis_enabled",
        )
    )


@mapped
def hydro_power_plant(t: StarTables) -> DataFrame:
    return t.table("customer").selectExpr(
        "'hp-' || c_custkey AS id",
        f"""CASE WHEN c_acctbal < 3000 THEN '{STORAGE_IRI}storage'
                 WHEN c_acctbal < 6000 THEN '{STORAGE_IRI}runOfRiver' END AS storage_type""",
    )


@mapped
def wind_power_plant(t: StarTables) -> DataFrame:
    return t.table("customer").selectExpr("'wp-' || c_custkey AS id", "'wp-' || c_custkey AS mrid")


@mapped
def converter(t: StarTables) -> DataFrame:
    loss = "CASE WHEN o_orderstatus <> 'P' THEN CAST({} AS DOUBLE) END AS {}"
    return (
        t.orders()
        .filter(CONVERTER)
        .selectExpr(
            *EQUIPMENT_COLUMNS,
            f"{ALIAS} AS alias_name",
            "CASE WHEN quarter(o_orderdate) = 1 THEN 'dp-' || o_custkey END AS vsc_dc_pole",
            "CASE WHEN quarter(o_orderdate) = 2 THEN 'dp-' || o_custkey END AS dc_pole",
            loss.format("day(o_orderdate)", "loss0"),
            loss.format("month(o_orderdate)", "loss1"),
            loss.format("year(o_orderdate)", "loss2"),
            "o_totalprice AS p",
            "-o_totalprice / 10 AS q",
            "CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 1000 END AS pole_loss",
        )
    )


@mapped
def dc_pole(t: StarTables) -> DataFrame:
    return t.with_sites(t.table("customer")).selectExpr(
        "'dp-' || c_custkey AS id",
        "'dk-' || c_custkey AS controller",
        "CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS participation_factor",
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN 'bv-0' END AS base_voltage",
        "'ss-' || (c_custkey % sites) AS container",
    )


@mapped
def dc_controller(t: StarTables) -> DataFrame:
    return t.table("customer").selectExpr("'dk-' || c_custkey AS id", "'dk-' || c_custkey AS mrid")


@mapped
def dc_tie(t: StarTables) -> DataFrame:
    return t.table("customer").selectExpr(
        "'dt-' || c_custkey AS id",
        "'Corridor ' || c_custkey AS name",
        "'dk-' || c_custkey AS controller",
        "abs(c_acctbal) AS max_export",
        "abs(c_acctbal) / 2 AS max_import",
    )


@mapped
def dc_line(t: StarTables) -> DataFrame:
    return (
        t.orders()
        .filter(DC_LINE)
        .selectExpr(
            "'eq-' || o_orderkey AS id",
            "array('DCLineSegment') AS types",
            f"{NAME} AS name",
            "o_totalprice / 1000 AS resistance",
        )
    )


@mapped
def operational_limit(t: StarTables) -> DataFrame:
    return t.table("orders").selectExpr(
        "'ol-' || o_orderkey AS id",
        f"CASE WHEN {COMPENSATOR} THEN array('CurrentLimit') ELSE array('ActivePowerLimit') END AS types",
        "CASE WHEN year(o_orderdate) >= 1998 THEN 'Normal@20' ELSE 'Warning@20' END AS name",
        "'ls-' || o_orderkey AS limit_set",
        f"CASE WHEN NOT ({COMPENSATOR}) THEN CAST(o_custkey AS DOUBLE) END AS active_power",
        f"CASE WHEN {COMPENSATOR} THEN CAST(o_custkey AS DOUBLE) END AS current",
    )


@mapped
def operational_limit_set(t: StarTables) -> DataFrame:
    return t.table("orders").selectExpr(
        "'ls-' || o_orderkey AS id",
        f"CASE WHEN {TRANSFORMER} THEN 'te-' || o_orderkey || '-1' ELSE 'eq-' || o_orderkey END AS equipment",
        f"CASE WHEN {TRANSFORMER} THEN 'tm-' || o_orderkey || '-2' END AS terminal",
    )


@mapped
def protective_action(t: StarTables) -> DataFrame:
    return t.table("events").selectExpr(
        "'pa-' || event_id AS mrid",
        "event_type || ' ' || event_id AS name",
        "CASE WHEN value > 20 THEN 'true' ELSE 'false' END AS flow_shift",
        "CASE WHEN value > 40 THEN 'true' ELSE 'false' END AS flow_shift_flip",
        "CASE WHEN value < 10 THEN 'true' ELSE 'false' END AS load_contribution",
        "'pc-' || user_id AS collection",
        "CASE WHEN event_type = 'error' THEN 'eq-' || user_id END AS equipment",
        "CASE WHEN event_type IN ('click', 'signup') THEN 'eq-' || user_id END AS conducting_equipment",
        "CASE WHEN event_type = 'view' THEN 'dk-' || user_id END AS dc_controller",
        "CASE WHEN event_type IN ('purchase', 'signup') THEN 'te-' || user_id || '-1' END AS transformer_end",
    )


@mapped
def action_collection(t: StarTables) -> DataFrame:
    return t.table("events").select("user_id").distinct().selectExpr("'pc-' || user_id AS id", "'pc-' || user_id AS mrid")


@mapped
def position_point(t: StarTables) -> DataFrame:
    return t.table("events").selectExpr(
        "'pp-' || event_id AS id",
        "'loc-' || user_id AS location",
        "hour(ts) AS sequence_number",
        "value AS x",
        "-value AS y",
    )


@mapped
def location(t: StarTables) -> DataFrame:
    return t.table("customer").selectExpr("'loc-' || c_custkey AS id", "'cs-' || c_nationkey AS coordinate_system")


@mapped
def location_resource(t: StarTables) -> DataFrame:
    sites = t.table("supplier").selectExpr("'loc-' || s_suppkey AS location", "'ss-' || s_suppkey AS resource")
    lines = t.table("orders").filter(AC_LINE)
    return sites.unionByName(lines.selectExpr("'loc-' || o_custkey AS location", "'eq-' || o_orderkey AS resource"))


@mapped
def coordinate_system(t: StarTables) -> DataFrame:
    return t.table("nation").selectExpr(
        "'cs-' || n_nationkey AS id",
        "CASE WHEN n_regionkey = 4 THEN 'local' ELSE 'urn:ogc:def:crs:EPSG::' || (4326 + n_nationkey) END AS crs_urn",
    )


@mapped
def full_model(t: StarTables) -> DataFrame:
    documents, labels = t.table("documents"), t.table("labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id", "left").selectExpr(
        "'md-' || doc_id AS id",
        "CASE WHEN lang <> 'de' THEN 'scenario ' || source END AS scenario_time",
        "CASE WHEN quality IS NOT NULL THEN 'created ' || quality END AS created",
        "CASE WHEN lang <> 'fr' THEN CAST(n_chars AS STRING) END AS version",
        "source AS description",
    )


@mapped
def model_profile(t: StarTables) -> DataFrame:
    return t.table("documents").filter("lang <> 'es'").selectExpr("'md-' || doc_id AS model", "lang AS profile")


@mapped
def model_dependency(t: StarTables) -> DataFrame:
    targets = F.explode(F.array((F.col("doc_id") - 1), F.floor(F.col("doc_id") / 2)))
    return (
        t.table("documents")
        .filter("source <> 'src0'")
        .select("doc_id", targets.alias("target"))
        .distinct()
        .selectExpr("'md-' || doc_id AS model", "'md-' || target AS depends_on")
    )


@mapped
def market_definition_set(t: StarTables) -> DataFrame:
    return (
        t.table("orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first"))
        .selectExpr(
            "'ms-' || o_custkey AS id",
            "array('MarketDefinitionSet') AS types",
            "'ms-' || o_custkey AS mrid",
            "'Market ' || o_custkey AS name",
            "first AS activation_date",
        )
    )


@mapped
def market_unit(t: StarTables) -> DataFrame:
    return generating_unit(t).select("id", "mrid", "name").unionByName(load_group(t).select("id", "mrid", "name"))


@mapped
def link(t: StarTables) -> DataFrame:
    units = generating_unit(t).selectExpr(
        "id AS subject", "'GeneratingUnit.ScheduleResource' AS predicate", "schedule_resource AS object"
    )
    groups = load_group(t).selectExpr(
        "id AS subject", "'NonConformLoadGroup.ScheduleResource' AS predicate", "schedule_resource AS object"
    )
    return units.unionByName(groups)


@mapped
def vocabulary(t: StarTables) -> DataFrame:
    """A class vocabulary: parts are properties of a brand, part types are datatypes."""
    parts = t.table("part")
    stereotype = "CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'MEDIUM') THEN 'CIMDatatype' ELSE 'Primitive' END"
    facts = f"""stack(6,
        'p-' || p_partkey, 'domain', p_brand, CAST(NULL AS STRING),
        'p-' || p_partkey, 'dataType', CASE WHEN p_size = 1 THEN 'NONE' ELSE p_type END, NULL,
        p_type, 'stereotype', {stereotype}, NULL,
        'v-' || p_type, 'domain', p_type, NULL,
        'v-' || p_type, 'dataType', 'UNIT-' || p_type, NULL,
        'v-' || p_type, 'label', 'value', 'en') AS (subject, property, object, lang)"""
    return parts.selectExpr(facts).distinct()
