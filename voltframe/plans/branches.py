"""Reports on lines, series compensators and transformers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.model import GridModel
from voltframe.operators.aggregates import at_end
from voltframe.operators.joins import has_type, optional, required, with_match
from voltframe.plans import shared as s

# Square root of three, as the current limits are converted with (fixed value).
ROOT3 = 1.7320508075688772
END_COLUMNS = ("terminal", "equipment", "node", "connected")


def _line_ends(m: GridModel, ends: DataFrame, branches: DataFrame, region: str | None) -> DataFrame:
    """One row per branch from its terminals: flows, flags and nodes of end 1 and end 2."""
    ends = with_match(required(ends, "node", "connected"), branches.select("equipment"), "equipment")
    if "connectivity_node" in ends.columns:
        ends = ends.filter(s.in_region(region))
    else:
        ends = ends.join(required(s.node_area(m, region, "connectivity_node"), "connectivity_node").select("node", "connectivity_node"), "node")
    ends = ends.select("terminal", "equipment", "nr", "connected", "connectivity_node")
    ends = optional(ends, s.power_flow(m, "p"), "terminal")
    return ends.groupBy("equipment").agg(
        F.count("*").alias("ends"),
        at_end(1, "p").alias("p_1"),
        at_end(2, "p").alias("p_2"),
        F.coalesce(at_end(1, "connected"), F.lit(False)).alias("connected_1"),
        F.coalesce(at_end(2, "connected"), F.lit(False)).alias("connected_2"),
        F.coalesce(at_end(1, "connectivity_node"), F.lit("")).alias("connectivity_node_1"),
        F.coalesce(at_end(2, "connectivity_node"), F.lit("")).alias("connectivity_node_2"),
    )


def ac_lines(m: GridModel, region: str | None = None, rate: str | None = None) -> DataFrame:
    lines = required(m["ac_line"], "r", "x", "bch", "mrid", "name", "base_voltage", "length")
    used = ("mrid", "name", "r", "x", "bch", "gch", "length", "base_voltage")
    lines = lines.filter(s.enabled()).select(F.col("id").alias("equipment"), *used)
    lines = lines.join(s.line_nominal(m), "base_voltage")
    ends = _line_ends(m, s.terminal_ends(m, *END_COLUMNS, located=True), lines, region).filter(
        "ends > 1 AND connectivity_node_1 <> connectivity_node_2 AND connectivity_node_1 <> '' AND connectivity_node_2 <> ''"
    )
    limit = s.limits(m, "ActivePowerLimit", "active_power", rate, "equipment", "equipment")
    limit = limit.groupBy("equipment").agg(F.max("rate").alias("rate"))
    status = s.in_service(m).groupBy("equipment").agg(F.max("in_service").alias("in_service"))
    rows = optional(optional(lines.join(ends, "equipment"), limit, "equipment"), status, "equipment")
    return m.finish(
        rows.select(
            "mrid",
            "name",
            s.loss("p_1", "p_2").alias("ploss_1"),
            s.loss("p_2", "p_1").alias("ploss_2"),
            "r",
            "rate",
            F.coalesce("in_service", s.both("connected_1", "connected_2"), F.lit(True)).alias("status"),
            "un",
            "x",
            F.col("bch").alias("b"),
            F.col("gch").alias("g"),
            "length",
            "connectivity_node_1",
            "connectivity_node_2",
        )
    )


def series_compensators(
    m: GridModel, region: str | None = None, rate: str | None = None, strict_intent: bool = False
) -> DataFrame:
    """The analysis flag is only applied with `strict_intent`."""
    branches = required(m["series_compensator"], "r", "x", "mrid", "name", "base_voltage")
    if strict_intent:
        branches = branches.filter(s.enabled())
    branches = branches.select(F.col("id").alias("equipment"), "mrid", "name", "r", "x", "base_voltage")
    branches = branches.join(s.line_nominal(m), "base_voltage")
    # A group needs two rows, and several limits on one compensator multiply its rows.
    limit = s.limits(m, "CurrentLimit", "current", rate, "equipment", "equipment")
    limit = limit.groupBy("equipment").agg(F.max("rate").alias("current"), F.count("*").alias("limits"))
    status = s.in_service(m).groupBy("equipment").agg(F.max("in_service").alias("in_service"), F.count("*").alias("states"))
    ends = _line_ends(m, s.numbered_ends(m, *END_COLUMNS, located=True), branches, region).filter("connectivity_node_1 <> connectivity_node_2")
    rows = optional(optional(branches.join(ends, "equipment"), limit, "equipment"), status, "equipment")
    rows = rows.filter("ends * coalesce(limits, 1) * coalesce(states, 1) > 1")
    return m.finish(
        rows.select(
            "mrid",
            "name",
            s.loss("p_1", "p_2").alias("ploss_1"),
            s.loss("p_2", "p_1").alias("ploss_2"),
            "r",
            (ROOT3 * F.col("un") * F.col("current") / 1000.0).alias("rate"),
            F.coalesce("in_service", s.both("connected_1", "connected_2")).alias("status"),
            "un",
            "x",
            "connectivity_node_1",
            "connectivity_node_2",
        )
    )


def transformers(m: GridModel, region: str | None = None, rate: str | None = None) -> DataFrame:
    owners = (
        required(m["power_transformer"].filter(has_type("PowerTransformer") & s.enabled()), "mrid", "container")
        .select(F.col("id").alias("transformer"), F.col("mrid").alias("p_mrid"), F.col("container").alias("substation"))
        .join(s.substation_area(m, region, "substation").select("substation"), "substation")
    )
    ends = required(m["transformer_end"], "transformer", "rated_u", "r", "x", "mrid", "name", "end_number", "terminal")
    terminal = m["terminal"].select(F.col("id").alias("terminal"), F.col("mrid").alias("t_mrid"))
    ends = ends.select(F.col("id").alias("winding"), "transformer", "rated_u", "r", "x", "mrid", "name", "end_number", "terminal")
    rows = ends.join(owners, "transformer").join(required(terminal, "t_mrid"), "terminal")
    rows = optional(rows, s.limits(m, "ActivePowerLimit", "active_power", rate, "equipment", "winding"), "winding")
    return m.finish(
        rows.select(
            "name", "p_mrid", F.col("mrid").alias("w_mrid"), "end_number", F.col("rated_u").alias("un"), "t_mrid", "r", "x", "rate"
        )
    )


def winding_loss(m: GridModel, region: str | None = None) -> DataFrame:
    """Flow into each transformer divided by its number of windings in operation; `region` has no effect."""
    del region
    return m.finish(_losses(m))


def _losses(m: GridModel) -> DataFrame:
    owners = (
        required(m["power_transformer"].filter(s.enabled()), "mrid", "container")
        .select(F.col("id").alias("transformer"), "mrid", F.col("container").alias("substation"))
        .join(s.substation_area(m, None, "substation").select("substation"), "substation")
    )
    ends = required(m["transformer_end"].select(F.col("id").alias("winding"), "transformer", "terminal"), "terminal")
    connected = required(s.terminals(m, "terminal", "connected"), "connected")
    rows = ends.join(owners, "transformer").join(connected, "terminal")
    rows = optional(optional(rows, s.power_flow(m, "p"), "terminal"), s.in_service(m, "winding"), "winding")
    running = F.when(F.coalesce("in_service", "connected"), 1).otherwise(0)
    sums = rows.groupBy("mrid").agg(F.sum(F.coalesce("p", F.lit(0.0))).alias("p"), F.sum(running).alias("running"))
    return sums.select("mrid", F.try_divide("p", "running").alias("ploss_2"))


def winding_angle(m: GridModel) -> DataFrame:
    """Phase angle of windings with a linear phase changer, from its measured or planned position."""
    return m.finish(_phase_angles(m))


def _phase_angles(m: GridModel) -> DataFrame:
    changers = required(m["phase_tap_changer"], "step", "increment", "neutral_step")
    ends = m["transformer_end"].select(F.col("phase_tap_changer").alias("id"), "mrid")
    position = required(m["sv_tap_step"].select(F.col("tap_changer").alias("id"), "position"), "position")
    rows = optional(changers.join(required(ends, "id", "mrid"), "id"), position, "id")
    offset = F.coalesce("position", "step") - F.col("neutral_step")
    return rows.select("mrid", (offset * F.col("increment")).alias("angle"))


def windings(m: GridModel) -> DataFrame:
    owners = required(m["power_transformer"].select(F.col("id").alias("transformer"), F.col("name").alias("_name")), "_name")
    ends = required(m["transformer_end"].select(F.col("id").alias("winding"), "transformer", "terminal"), "terminal")
    rows = ends.join(owners, "transformer")
    rows = optional(rows, required(s.terminals(m, "terminal", "connected"), "connected"), "terminal")
    rows = optional(optional(rows, s.power_flow(m, "p"), "terminal"), s.in_service(m, "winding"), "winding")
    running = F.when(F.coalesce("in_service", "connected", F.lit(True)), 1).otherwise(0)
    return m.finish(
        rows.groupBy(F.col("transformer").alias("p_transformer")).agg(
            F.count("*").alias("count"),
            F.max("_name").alias("name"),
            F.sum(running).alias("nr_on"),
            F.sum(F.coalesce("p", F.lit(0.0))).alias("p"),
        )
    )


def transformer_windings(m: GridModel) -> DataFrame:
    owners = m["power_transformer"].filter(has_type("PowerTransformer"))
    owners = required(owners, "mrid").select(F.col("id").alias("transformer"), "mrid")
    ends = required(m["transformer_end"].select(F.col("mrid").alias("w_mrid"), "transformer", "end_number"), "w_mrid", "end_number")
    return m.finish(ends.join(owners, "transformer").select("mrid", "end_number", "w_mrid"))


def transformer_branches(
    m: GridModel, region: str | None = None, rate: str | None = None, strict_intent: bool = False
) -> DataFrame:
    """One branch per winding, to a fictitious centre node named after the transformer.

    With `strict_intent`, the phase angle of tap changers replaces the clock angle.
    """
    owners = (
        required(m["power_transformer"].filter(s.enabled()), "mrid", "container")
        .select(F.col("id").alias("transformer"), F.col("mrid").alias("connectivity_node_2"), F.col("container").alias("substation"))
        .join(s.substation_area(m, region, "substation").select("substation"), "substation")
    )
    ends = required(m["transformer_end"], "transformer", "terminal", "mrid", "name", "rated_u", "r", "x", "b", "g")
    used = ("transformer", "terminal", "mrid", "name", "rated_u", "r", "x", "b", "g", "phase_angle_clock")
    ends = ends.select(F.col("id").alias("winding"), *used)
    terminal = required(s.terminals(m, "terminal", "node", "connected"), "node", "connected")
    levels = s.voltage_levels(m, "container", "base_voltage").join(s.line_nominal(m), "base_voltage")
    nodes = required(s.node_containers(m), "connectivity_node").join(levels, "container").select("node", "connectivity_node", "un")
    rows = ends.join(owners, "transformer").join(terminal, "terminal").join(nodes, "node")
    rows = optional(rows, s.limits(m, "ActivePowerLimit", "active_power", rate, "terminal", "terminal"), "terminal")
    changer = m["ratio_tap_changer"].select(
        F.col("transformer_end").alias("winding"), "increment", "neutral_step", "normal_step", "step"
    )
    rows = optional(rows, required(changer, "winding", "increment", "neutral_step", "normal_step"), "winding")
    rows = optional(rows, s.in_service(m, "winding"), "winding")
    step = F.coalesce("step", "normal_step").cast("int")
    tau = F.when(
        F.col("increment").isNotNull(), 1 + (step - F.col("neutral_step")) * F.col("increment") / 100.0
    ).otherwise(1.0)
    rows = optional(rows, _losses(m).withColumnRenamed("mrid", "connectivity_node_2"), "connectivity_node_2")
    angle = 30.0 * F.coalesce(F.col("phase_angle_clock").cast("double"), F.lit(0.0))
    if strict_intent:
        rows = optional(rows, _phase_angles(m).withColumnRenamed("angle", "phase_angle"), "mrid")
        angle = F.coalesce(F.col("phase_angle"), angle)
    return m.finish(
        rows.select(
            "mrid",
            "name",
            F.coalesce("in_service", "connected").alias("status"),
            "un",
            "r",
            "x",
            "b",
            "g",
            "rate",
            angle.alias("angle"),
            F.try_divide(F.col("un") * tau, F.col("rated_u")).alias("ratio"),
            F.col("connectivity_node").alias("connectivity_node_1"),
            "connectivity_node_2",
            F.lit(0.0).alias("ploss_1"),
            "ploss_2",
        )
    )


def phase_tap_changer(m: GridModel) -> DataFrame:
    changer = required(m["phase_tap_changer"], "control_enabled", "increment", "control", "neutral_step", "high_step", "low_step")
    control = required(m["regulating_control"], "enabled", "target_value", "mode", "terminal").select(
        F.col("id").alias("control"), "mode", "terminal", "enabled", "target_value"
    )
    winding = required(m["transformer_end"].select(F.col("phase_tap_changer").alias("id"), "mrid"), "id", "mrid")
    monitored = m["transformer_end"].select("terminal", F.col("mrid").alias("monitored_winding"))
    rows = changer.join(winding, "id").join(control, "control").join(required(monitored, "monitored_winding"), "terminal")
    return m.finish(
        rows.select(
            "mrid",
            F.col("increment").alias("phase_shift_increment"),
            s.both("control_enabled", "enabled").alias("enabled"),
            "neutral_step",
            "high_step",
            "low_step",
            F.replace(F.col("mode"), F.lit(s.CIM_NAMESPACE), F.lit("")).alias("mode"),
            "target_value",
            "monitored_winding",
        )
    )


def sv_branch(m: GridModel) -> DataFrame:
    """Lines with measured flow, voltage and angle at both ends; the length is never bound."""
    lines = required(m["ac_line"], "r", "x", "bch", "gch", "mrid", "name", "base_voltage").filter(s.enabled())
    lines = lines.select(F.col("id").alias("equipment"), "mrid", "name", "r", "x", "bch", "gch", "base_voltage")
    lines = lines.join(s.line_nominal(m), "base_voltage").join(s.in_service(m), "equipment")
    nodes = m["connectivity_node"].select(F.col("id").alias("node"), "topological_node")
    voltage = required(m["sv_voltage"], "node", "v", "angle").select(F.col("node").alias("topological_node"), "v", "angle")
    ends = required(s.terminal_ends(m, *END_COLUMNS, "types", "terminal_connected").filter(has_type("Terminal") & F.col("nr").isin(1, 2)), "node")
    # Either connected property will do; a terminal with both counts twice.
    states = (F.col("connected").isNotNull().cast("int") + F.col("terminal_connected").isNotNull().cast("int")).alias("states")
    ends = with_match(ends.select("terminal", "equipment", "node", "nr", states), lines.select("equipment"), "equipment")
    ends = ends.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("states")))).filter("states > 0")
    ends = ends.join(required(nodes, "topological_node"), "node")
    ends = optional(optional(ends, voltage, "topological_node"), s.power_flow(m, "p", "q"), "terminal")

    def end(nr: int) -> DataFrame:
        values = [F.col(c).alias(f"{c}_{nr}") for c in ("p", "q", "v", "angle")]
        return ends.filter(F.col("nr") == nr).select("equipment", *values)

    rows = lines.join(end(1), "equipment").join(end(2), "equipment")
    return m.finish(
        rows.select(
            "mrid", "name", "r", "x", "bch", "gch", F.col("in_service").alias("status"),
            F.lit(None).cast("double").alias("length"), "un",
            "p_1", "q_1", "p_2", "q_2", "v_1", "angle_1", "v_2", "angle_2",
        )
    )
