"""Reports on borders, market resources, protective actions and model metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.model import GridModel
from voltframe.operators.aggregates import first_per_key, repeated_keys
from voltframe.operators.joins import alternatives, has_type, optional, required, with_match
from voltframe.plans import shared as s

# Classes and texts the report is defined on (fixed values).
EQUIPMENT_PROFILE = "http://entsoe.eu/CIM/EquipmentCore/3/1"
EXCHANGE_SCHEMA = "mrid string, name string, node string, status boolean, p double, market_code string"
BRANCHES_WITH_FLIP = ("ACLineSegment", "PowerTransformerEnd")


def _named_lines(m: GridModel) -> DataFrame:
    """Enabled AC lines, direct-current connections left out by name, with the market code of their container."""
    lines = required(m["ac_line"].filter(has_type("ACLineSegment") & s.enabled()), "mrid", "name")
    lines = lines.filter(~F.col("name").rlike("HVDC"))
    lines = lines.select(F.col("id").alias("equipment"), "mrid", "name", "container")
    codes = required(m["line"].select(F.col("id").alias("container"), "market_code"), "market_code")
    return optional(lines, codes, "container").drop("container")


def _placed_ends(m: GridModel, ends: DataFrame, lines: DataFrame) -> DataFrame:
    areas = s.node_area(m, None, "node").select("node", "area")
    ends = with_match(ends.filter(F.col("nr").isin(1, 2)), lines.select("equipment"), "equipment")
    return ends.join(areas, "node")


def borders(m: GridModel, region: str | None = None) -> DataFrame:
    """Lines between two areas, at least one of which matches the region."""
    lines = _named_lines(m)
    ends = required(s.terminal_ends(m, "types", "equipment", "node", "terminal_mrid").filter(has_type("Terminal")), "terminal_mrid", "node")
    ends = _placed_ends(m, ends.select("equipment", "node", "nr", "terminal_mrid"), lines)

    def end(nr: int) -> DataFrame:
        return ends.filter(F.col("nr") == nr).select(
            "equipment", F.col("area").alias(f"area_{nr}"), F.col("terminal_mrid").alias(f"t_mrid_{nr}")
        )

    rows = lines.join(end(1), "equipment").join(end(2), "equipment").filter("area_1 <> area_2")
    rows = rows.filter(s.in_region(region, "area_1") | s.in_region(region, "area_2"))
    return m.finish(rows.select("mrid", "name", "market_code", "area_1", "area_2", "t_mrid_1", "t_mrid_2"))


def exchange(m: GridModel, region: str | None = None, strict_intent: bool = False) -> DataFrame:
    """Flow on lines that leave the region; with `strict_intent` also on lines that enter it."""
    lines = _named_lines(m)
    if region is None:
        return lines.sparkSession.createDataFrame([], EXCHANGE_SCHEMA)
    ends = required(s.numbered_ends(m, "terminal", "equipment", "node", "connected", "terminal_topological_node"), "node", "connected")
    ends = _placed_ends(m, ends, lines)
    first = ends.filter("nr = 1").withColumnRenamed("area", "area_1").withColumnRenamed("connected", "connected_1")
    second = ends.filter("nr = 2").select("equipment", F.col("area").alias("area_2"), F.col("connected").alias("connected_2"))
    inside, outside = s.in_region(region, "area_1"), s.in_region(region, "area_2")
    crossing = (inside != outside) if strict_intent else (inside & ~outside)
    rows = lines.join(first.drop("nr"), "equipment").join(second, "equipment").filter(crossing)
    rows = s.terminal_topology(m, rows.join(s.power_flow(m, "p"), "terminal"))
    named = m["topological_node"].select(F.col("id").alias("topological_node"), F.col("mrid").alias("tp_mrid"))
    rows = optional(rows.join(required(named, "tp_mrid"), "topological_node"), s.in_service(m), "equipment")
    return m.finish(
        rows.select(
            "mrid",
            "name",
            F.col("tp_mrid").alias("node"),
            F.coalesce("in_service", s.both("connected_1", "connected_2")).alias("status"),
            "p",
            "market_code",
        )
    )


def regions(m: GridModel) -> DataFrame:
    sub = required(m["sub_geographical_region"].filter(has_type("SubGeographicalRegion")), "mrid", "name", "region")
    geo = m["geographical_region"].select(
        F.col("id").alias("geo"), F.col("name").alias("geo_name"), F.col("alias_name").alias("region_name")
    )
    rows = sub.join(required(geo, "geo_name"), F.col("region") == F.col("geo"))
    return m.finish(rows.select("mrid", F.col("geo_name").alias("region"), "short_name", "name", "alias_name", "region_name"))


def _station_groups(m: GridModel) -> DataFrame:
    groups = required(m["schedule_resource"], "market_code", "name")
    return groups.select(F.col("market_code").alias("station_group"), "name", "alias_name")


def station_group_codes_and_names(m: GridModel) -> DataFrame:
    """One row per station group: the first by name where a code occurs more than once."""
    return m.finish(first_per_key(_station_groups(m), ["station_group"], ["name", "alias_name"]))


def repeated_station_groups(m: GridModel) -> DataFrame:
    """All rows of station groups whose code occurs more than once."""
    return repeated_keys(_station_groups(m), ["station_group"])


def station_group_for_power_unit(m: GridModel) -> DataFrame:
    """Physical objects whose unit points, by any property, at a schedule resource."""
    resource = required(m["schedule_resource"].select(F.col("id").alias("object"), "market_code"), "market_code")
    unit = required(m["market_unit"], "mrid", "name").select(
        F.col("id").alias("unit"), F.col("mrid").alias("market_unit_mrid"), F.col("name").alias("resource_name")
    )
    machines = alternatives(
        m["synchronous_machine"].select("mrid", "generating_unit", "machine_generating_unit"),
        "unit", "generating_unit", "machine_generating_unit",
    )
    consumers = m["load"].select("mrid", F.col("load_group").alias("unit"))
    physical = required(machines.unionByName(consumers).withColumnRenamed("mrid", "power_system_model_mrid"), "unit", "power_system_model_mrid")
    # One link per property, in however many graphs it is stated.
    links = m["link"].join(resource, "object").distinct().select(F.col("subject").alias("unit"), "market_code")
    rows = physical.join(links.join(unit, "unit"), "unit")
    return m.finish(rows.select("power_system_model_mrid", "market_unit_mrid", "resource_name", "market_code"))


def gen_unit_and_sync_machine_mrid(m: GridModel) -> DataFrame:
    machines = alternatives(
        m["synchronous_machine"].select(F.col("mrid").alias("sync_machine_mrid"), "generating_unit", "machine_generating_unit"),
        "unit", "generating_unit", "machine_generating_unit",
    )
    units = required(m["generating_unit"].select(F.col("id").alias("unit"), F.col("mrid").alias("gen_unit_mrid")), "gen_unit_mrid")
    return m.finish(required(machines, "sync_machine_mrid").join(units, "unit").select("gen_unit_mrid", "sync_machine_mrid"))


def market_dates(m: GridModel) -> DataFrame:
    sets = m["market_definition_set"].filter(has_type("MarketDefinitionSet"))
    rows = required(sets, "mrid", "name", "activation_date")
    return m.finish(rows.select("mrid", "name", F.col("activation_date").cast("timestamp_ntz").alias("activation_date")))


def ras_equipment(m: GridModel) -> DataFrame:
    """Equipment of protective actions, and whether the action flips a branch flow."""
    actions = required(
        m["protective_action"], "mrid", "name", "flow_shift", "flow_shift_flip", "load_contribution", "collection"
    )
    actions = alternatives(actions, "target", "equipment", "conducting_equipment", "dc_controller", "transformer_end")
    collections = m["action_collection"].select(F.col("id").alias("collection"), F.col("mrid").alias("collection_mrid"))
    targets = required(m["identified"], "mrid").select(
        F.col("id").alias("target"),
        F.col("mrid").alias("equipment_mrid"),
        has_type(*BRANCHES_WITH_FLIP).alias("is_branch"),
        F.explode("types").alias("type"),
    )
    targets = targets.filter("type <> 'PowerTransformer'")
    rows = actions.join(targets, "target").join(required(collections, "collection_mrid"), "collection")
    shifted = (F.col("flow_shift") == "true") & (F.col("flow_shift_flip") == "true")
    flip = F.col("is_branch") & (shifted | (F.col("load_contribution") == "true"))
    return m.finish(
        rows.select("mrid", "equipment_mrid", "name", flip.alias("flip"), F.col("collection_mrid").alias("collection"))
    )


def full_model(m: GridModel) -> DataFrame:
    """State models whose dependencies all exist, followed by all equipment models."""

    def state(name: str) -> DataFrame:
        return m[f"state_{name}"] if f"state_{name}" in m else m[name]

    created = required(m["full_model"], "created").select("id")
    if "state_full_model" in m:
        created = created.unionByName(required(m["state_full_model"], "created").select("id"))
    known = created.distinct().select(F.col("id").alias("depends_on"), F.lit(True).alias("known"))
    complete = optional(state("model_dependency"), known, "depends_on").groupBy("model").agg(
        F.bool_and(F.coalesce("known", F.lit(False))).alias("complete")
    )
    models = state("full_model").withColumnRenamed("id", "model")
    models = required(models, "scenario_time", "version", "description").join(complete.filter("complete"), "model")
    first = models.join(state("model_profile"), "model").select(
        "model", F.col("scenario_time").alias("time"), "profile", "version", "description"
    )
    equipment = required(m["full_model"].withColumnRenamed("id", "model"), "description", "created")
    second = optional(equipment, m["model_profile"], "model").select(
        "model",
        F.col("created").alias("time"),
        F.coalesce("profile", F.lit(EQUIPMENT_PROFILE)).alias("profile"),
        F.coalesce("version", F.lit("")).alias("version"),
        "description",
    )
    return m.finish(first.unionByName(second))


def type_map(m: GridModel) -> DataFrame:
    """Datatype of every class in the vocabulary: primitive, or the range of the datatype's value."""
    facts = m["vocabulary"]

    def pairs(prop: str, subject: str, target: str) -> DataFrame:
        rows = facts.filter(F.col("property") == prop)
        return rows.select(F.col("subject").alias(subject), F.col("object").alias(target)).distinct()

    domains = pairs("domain", "attribute", "sparql_type")
    used = domains.join(pairs("dataType", "attribute", "range"), "attribute").select("sparql_type", "range").distinct()
    kinds = pairs("stereotype", "range", "kind")
    primitive = with_match(used, kinds.filter("kind = 'Primitive'"), "range")
    values = facts.filter("property = 'label' AND object = 'value' AND lang = 'en'").select(F.col("subject").alias("attribute"))
    value_range = with_match(domains, values, "attribute").join(pairs("dataType", "attribute", "value_range"), "attribute")
    value_range = value_range.select(F.col("sparql_type").alias("range"), "value_range")
    composite = with_match(used, kinds.filter("kind = 'CIMDatatype'"), "range").join(value_range, "range")
    composite = composite.select("sparql_type", F.col("value_range").alias("range"))
    return primitive.unionByName(composite).distinct()
