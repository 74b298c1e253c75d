"""Reports on converters, direct-current lines and their controllers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions import float32_of
from voltframe.model import GridModel
from voltframe.operators.joins import alternatives, has_type, optional, required
from voltframe.plans import shared as s

# Classes and texts the report is defined on (fixed values).
CONVERTER_CLASSES = ("VsConverter", "CsConverter", "DCConvertUnit", "VoltageSourceConverter", "DCConverter")


def _on_poles(m: GridModel) -> DataFrame:
    """Converters with `pole` from either association."""
    return alternatives(m["converter"], "pole", "vsc_dc_pole", "dc_pole")


def converters(m: GridModel, region: str | None = None) -> DataFrame:
    """Converters with losses and controller; `region` has no effect."""
    del region
    poles = m["dc_pole"].select(F.col("id").alias("pole"), "controller", "base_voltage", "participation_factor")
    controllers = required(m["dc_controller"].select(F.col("id").alias("controller"), F.col("mrid").alias("controller_mrid")), "controller_mrid")
    factor = _on_poles(m).select("pole").join(required(poles.select("pole", "participation_factor"), "participation_factor"), "pole")
    factor = factor.groupBy("pole").agg(
        (F.max(float32_of("participation_factor")) / F.count("*")).alias("controller_factor")
    )
    voltage = s.line_nominal(m).withColumnRenamed("un", "pole_un")
    poles = optional(poles.select("pole", "controller", "base_voltage"), voltage, "base_voltage").drop("base_voltage")
    rows = required(_on_poles(m).filter(s.enabled()), "mrid", "name", "p", "q").withColumnRenamed("id", "equipment").drop("types")
    rows = rows.join(poles, "pole").join(controllers, "controller").join(factor, "pole")
    ends = required(s.terminal_ends(m, "equipment", "node", "connected").filter("nr = 1"), "node", "connected").select("equipment", "node", "connected")
    nodes = required(s.node_area(m, None, "connectivity_node", "substation_mrid", "base_voltage"), "connectivity_node", "substation_mrid").join(s.line_nominal(m), "base_voltage")
    rows = rows.join(ends, "equipment").join(nodes.select("node", "connectivity_node", "substation_mrid", "un"), "node")
    rows = optional(rows, s.in_service(m), "equipment")
    # Losses and the pole voltage are bound together or not at all.
    known = F.lit(True)
    for column in ("loss0", "loss1", "loss2", "pole_un"):
        known = known & F.col(column).isNotNull()
    return m.finish(
        rows.select(
            "mrid",
            "name",
            F.col("alias_name").alias("alias"),
            "p",
            "q",
            "substation_mrid",
            F.coalesce("in_service", "connected").alias("status"),
            "connectivity_node",
            F.col("controller_mrid").alias("controller"),
            "controller_factor",
            F.coalesce("pole_loss", F.lit(0.0)).alias("pole_loss"),
            *[F.when(known, F.col(c)).otherwise(0.0).alias(c) for c in ("loss0", "loss1", "loss2")],
            F.when(known, F.col("pole_un")).otherwise(0.0).alias("vdcn"),
            "un",
        )
    )


def transformers_connected_to_converter(m: GridModel, region: str | None = None) -> DataFrame:
    """Transformers that share a node with a converter; both sides are reduced to distinct keys first."""
    ends = required(s.terminals(m, "equipment", "node"), "equipment", "node")
    converter = required(m["converter"].filter(has_type(*CONVERTER_CLASSES) & s.enabled()), "mrid")
    converter = converter.select(F.col("id").alias("equipment"), "mrid")
    owners = required(m["power_transformer"].filter(has_type("PowerTransformer") & s.enabled()), "mrid", "alias_name", "container")
    owners = owners.select(
        F.col("id").alias("equipment"), F.col("mrid").alias("p_mrid"), F.col("alias_name").alias("name"), F.col("container").alias("substation")
    ).join(s.substation_area(m, region, "substation").select("substation"), "substation")
    first = m["transformer_end"].filter("end_number = 1").select(F.col("transformer").alias("equipment"), "terminal")
    terminal = m["terminal"].select(F.col("id").alias("terminal"), F.col("mrid").alias("t_mrid"))
    first = required(first.join(terminal, "terminal").select("equipment", "t_mrid"), "t_mrid")
    near = ends.join(converter, "equipment").select("node", "mrid").distinct()
    there = ends.join(owners.join(first, "equipment"), "equipment").select("node", "p_mrid", "name", "t_mrid").distinct()
    return m.finish(there.join(near, "node").select("mrid", "name", "t_mrid", "p_mrid").distinct())


def hvdc(m: GridModel) -> DataFrame:
    """Parallel direct-current lines between two converters.

    Lines are first summed per pair of nodes, so the join to converters does not grow with the number of
    parallel lines.
    """
    ends = required(s.numbered_ends(m, "equipment", "node"), "equipment", "node")
    source = required(m["converter"].filter(has_type("VoltageSourceConverter")), "mrid")
    source = source.select(F.col("id").alias("equipment"), "mrid")
    at_node = required(s.terminals(m, "equipment", "node"), "equipment", "node").join(source, "equipment")
    at_node = at_node.groupBy("node", "mrid").agg(F.count("*").alias("times"))
    line = required(m["dc_line"].filter(has_type("DCLineSegment")), "resistance", "name")
    line = line.select(F.col("id").alias("equipment"), "name", float32_of("resistance").alias("r"))

    def side(nr: int) -> tuple[DataFrame, DataFrame]:
        lines = ends.filter(F.col("nr") == nr).select("equipment", F.col("node").alias(f"node_{nr}"))
        converters = at_node.select(
            F.col("node").alias(f"node_{nr}"), F.col("mrid").alias(f"converter_mrid_{nr}"), F.col("times").alias(f"times_{nr}")
        )
        return lines, converters

    (line_1, converter_1), (line_2, converter_2) = side(1), side(2)
    spans = line.join(line_1, "equipment").join(line_2, "equipment").groupBy("node_1", "node_2").agg(
        F.sum("r").alias("r"), F.count("*").alias("lines"), F.collect_list("name").alias("names")
    )
    # Every span fans out into pairs of converters, many times the spans. Rows are brought together by their first
    # converter while the second ones are still a list per node, so that pairs are made where they are counted and
    # never travel. A converter's lists have at most one entry per pair of nodes and converter there.
    second = F.struct("converter_mrid_2", "times_2")
    lists = converter_2.groupBy("node_2").agg(F.collect_list(second).alias("second"))
    rows = spans.join(converter_1, "node_1").join(lists, "node_2").select("converter_mrid_1", "times_1", "r", "lines", "names", "second")
    pairs = rows.repartition("converter_mrid_1").select("*", F.explode("second").alias("other"))
    times = (F.col("times_1") * F.col("other.times_2")).alias("times")
    pairs = pairs.select("converter_mrid_1", F.col("other.converter_mrid_2").alias("converter_mrid_2"), "r", "lines", "names", times)
    key = ["converter_mrid_1", "converter_mrid_2"]
    # Most pairs occur once and drop out before any list is built. Counting by a hash of the pair keeps every
    # pair that may stay (a collision only adds candidates); the exact count follows on those.
    pairs = pairs.withColumn("hash", F.xxhash64(*key))
    often = F.sum(F.col("lines") * F.col("times")).over(Window.partitionBy("hash", "converter_mrid_1"))
    pairs = pairs.withColumn("n", often).filter("n > 1").drop("n")
    copies = F.flatten(F.array_repeat("names", F.col("times").cast("int")))
    rows = pairs.groupBy(*key).agg(
        F.sum(F.col("lines") * F.col("times")).alias("n"),
        F.array_join(F.array_sort(F.flatten(F.collect_list(copies))), "--").alias("name"),
        F.sum(F.col("r") * F.col("times")).alias("r"),
    )
    return m.finish(rows.filter("n > 1").drop("n"))


def hvdc_converter_bidzones(m: GridModel) -> DataFrame:
    """Converters at the start of a corridor between two different zones."""
    points = m["delivery_point"].select(F.col("id").alias("point"), "bidding_area")
    areas = m["bidding_area"].select(F.col("id").alias("bidding_area"), F.col("market_code").alias("zone"))
    zones = required(points.join(areas, "bidding_area").select("point", "zone"), "zone")
    # One row per start point and destination zone, however many lines run there.
    corridors = required(m["line"].select("from_delivery_point", "to_delivery_point"), "from_delivery_point", "to_delivery_point")
    corridors = corridors.distinct().select(F.col("from_delivery_point").alias("start"), F.col("to_delivery_point").alias("point"))
    corridors = corridors.join(zones.withColumnRenamed("zone", "bidzone_2"), "point").select(F.col("start").alias("point"), "bidzone_2")
    corridors = corridors.join(zones.withColumnRenamed("zone", "bidzone_1"), "point").filter("bidzone_1 <> bidzone_2").distinct()
    sites = required(m["substation"].select(F.col("id").alias("container"), F.col("delivery_point").alias("point")), "point")
    poles = m["dc_pole"].select(F.col("id").alias("pole"), "container").join(sites, "container").select("pole", "point")
    owners = required(_on_poles(m).select("pole", "mrid"), "mrid").join(poles, "pole")
    return m.finish(owners.join(corridors, "point").select("mrid", "bidzone_1", "bidzone_2").distinct())


def dc_controllers(m: GridModel) -> DataFrame:
    controller = required(m["dc_controller"].select(F.col("id").alias("controller"), "mrid"), "mrid")
    ties = required(m["dc_tie"], "name", "controller", "max_export", "max_import")
    rows = ties.join(controller, "controller")
    return m.finish(rows.select("mrid", "name", F.col("max_export").alias("max_p"), (-F.col("max_import")).alias("min_p")))
