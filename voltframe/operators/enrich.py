"""Derive quads from a quad table: missing identifiers, zero states, market data, datatypes.

Every step returns only the quads it adds (or, where it says so, the changed table). New blank nodes are
named by a hash of the rule and the subject, so a recomputed task gives the same names.

Classes and properties of every CIM version are understood, also of several versions in one table; what a step adds
carries the namespace of the quads that it follows from.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions import is_uuid, md5_uuid
from voltframe.operators.joins import without
from voltframe.session import written
from voltframe.sources.entities import CIM
from voltframe.sources.quads import GRAPH_PREFIX, QUAD_COLUMNS

TYPE = "rdf:type"
MRID = "IdentifiedObject.mRID"
# CIM terms: prefixed, or in the namespace of any version (fixed values).
CIM_ROOT = "http://iec.ch/TC57/"
CIM_TERM = r"^(http://iec\.ch/TC57/[^#]*CIM[^#]*#)[^#]*$"
STATE_GRAPH = GRAPH_PREFIX + "SV"
INJECTION_GRAPH = GRAPH_PREFIX + "SV-injection"

# Values the added market data carries (fixed values).
EIC_CODE = "10Y1001A1001A48H"
UNIT_MARKET_CODE = "gen_market_code001"
RESOURCE_MARKET_CODE = "market001"
RESOURCE_NAME = "station group"
GROUP_NAME = "created_group"

# Predicate part -> literal datatype; the first part that occurs decides (fixed values).
DATATYPES = {
    "endNumber": "integer",
    "sequenceNumber": "integer",
    "phaseAngleClock": "integer",
    "SvPowerFlow.p": "double",
    ".open": "boolean",
    ".connected": "boolean",
    ".nominalVoltage": "double",
}


def blank(rule: str, *key: str) -> Column:
    return F.concat(F.lit("_:"), F.md5(F.concat_ws("|", F.lit(rule), *key)))


def version(term: str) -> Column:
    """What stands before the name of a CIM term: "cim:", or the namespace of another version; NULL for other terms."""
    c = F.col(term)
    found = F.nullif(F.regexp_extract(c, CIM_TERM, 1), F.lit(""))
    return F.when(c.startswith("cim:") | c.startswith(CIM), "cim:").when(c.startswith(CIM_ROOT), found)


def cim(name: str) -> Column:
    """A property in the row's `version`."""
    return F.concat(F.col("version"), F.lit(name))


def cim_class(name: str) -> Column:
    return F.concat(F.when(F.col("version") == "cim:", CIM).otherwise(F.col("version")), F.lit(name))


def is_cim(name: str, term: str = "predicate") -> Column:
    """Whether a term is this property or class in any version."""
    c = F.col(term)
    return (c == f"cim:{name}") | (c.endswith(f"#{name}") & version(term).isNotNull())


def _quad(subject: Column | str, predicate: Column | str, value: Column | str, kind: str, datatype: str | None = None) -> Column:
    return F.struct(
        (F.col(subject) if isinstance(subject, str) else subject).alias("subject"),
        (F.lit(predicate) if isinstance(predicate, str) else predicate).alias("predicate"),
        (F.lit(value) if isinstance(value, str) else value).alias("object"),
        F.lit(kind).alias("object_kind"),
        F.lit(f"xsd:{datatype}" if datatype else None).cast("string").alias("datatype"),
    )


def _iri(subject: Column | str, predicate: Column | str, value: Column | str) -> Column:
    return _quad(subject, predicate, value, "iri")


def _node(subject: Column | str, predicate: Column | str, value: Column) -> Column:
    return _quad(subject, predicate, value, "bnode")


def _text(subject: Column | str, predicate: Column | str, value: str, datatype: str | None = None) -> Column:
    return _quad(subject, predicate, value, "literal", datatype)


def _emit(rows: DataFrame, facts: Sequence[Column], graph: Column) -> DataFrame:
    """Each row gives a few quads; no exchange."""
    exploded = rows.select(graph.alias("graph"), F.explode(F.array(*facts)).alias("fact"))
    return exploded.select("graph", "fact.*", F.lit(None).cast("string").alias("lang")).select(*QUAD_COLUMNS)


def typed(quads: DataFrame, cls: str) -> DataFrame:
    """subject, graph and CIM version of every class quad."""
    return quads.filter((F.col("predicate") == TYPE) & is_cim(cls, "object")).select("subject", "graph", version("object").alias("version"))


def zero_power_flow(quads: DataFrame) -> DataFrame:
    """A zero flow, without a class, for every terminal that has none."""
    measured = quads.filter(is_cim("SvPowerFlow.Terminal")).select(F.col("object").alias("subject"))
    rows = without(typed(quads, "Terminal").select("subject", "version").distinct(), measured, "subject")
    flow = blank("zero_power_flow", "subject")
    facts = [
        _iri(flow, cim("SvPowerFlow.Terminal"), F.col("subject")),
        _text(flow, cim("SvPowerFlow.p"), "0.0", "double"),
        _text(flow, cim("SvPowerFlow.q"), "0.0", "double"),
    ]
    return _emit(rows, facts, F.lit(STATE_GRAPH))


def zero_injection(quads: DataFrame) -> DataFrame:
    """A zero active injection for every topological node."""
    rows = typed(quads, "TopologicalNode").select("subject", "version").distinct()
    injection = blank("zero_injection", "subject")
    facts = [
        _iri(injection, TYPE, cim_class("SvInjection")),
        _iri(injection, cim("SvInjection.TopologicalNode"), F.col("subject")),
        _text(injection, cim("SvInjection.pInjection"), "0.0", "double"),
    ]
    return _emit(rows, facts, F.lit(INJECTION_GRAPH))


def _plain_unit() -> Column:
    return (F.col("predicate") == TYPE) & is_cim("GeneratingUnit", "object") & F.col("graph").contains("EQ")


def retype_units(quads: DataFrame) -> DataFrame:
    """The table with generating units of unspecified kind turned into hydro units."""
    hydro = F.concat(F.substring_index("object", "#", 1), F.lit("#HydroGeneratingUnit"))
    return quads.withColumn("object", F.when(_plain_unit(), hydro).otherwise(F.col("object")))


def unit_market_data(quads: DataFrame) -> DataFrame:
    """Schedule resource, market code and weight of every unit of a machine; a plant for unspecified units."""
    machines = quads.filter(is_cim("RotatingMachine.GeneratingUnit") & F.col("graph").contains("EQ"))
    units = machines.groupBy(F.col("object").alias("unit")).agg(F.min("graph").alias("graph"), F.min(version("predicate")).alias("version"))
    plain = quads.filter(_plain_unit()).select(F.col("subject").alias("unit")).distinct()
    resource, plant = blank("unit_resource", "unit"), blank("unit_plant", "unit")
    market = [
        _node("unit", "SN:GeneratingUnit.ScheduleResource", resource),
        _text("unit", "SN:GeneratingUnit.marketCode", UNIT_MARKET_CODE),
        _text("unit", "SN:GeneratingUnit.groupAllocationWeight", "1", "integer"),
        _iri(resource, TYPE, "SN:ScheduleResource"),
        _text(resource, "SN:ScheduleResource.marketCode", RESOURCE_MARKET_CODE),
        _text(resource, cim("IdentifiedObject.name"), RESOURCE_NAME),
    ]
    hydro = [
        _node("unit", cim("HydroGeneratingUnit.HydroPowerPlant"), plant),
        _iri(plant, TYPE, cim_class("HydroPowerPlant")),
        _iri(plant, "SN:HydroPowerPlant.hydroPlantStorageType", "SN:HydroPlantStorageKind.runOfRiver"),
    ]
    of_plain = _emit(units.join(plain, "unit", "left_semi"), hydro, F.col("graph"))
    return _emit(units, market, F.col("graph")).unionByName(of_plain)


def load_market_codes(quads: DataFrame) -> DataFrame:
    """Load group and schedule resource of every consumer described in an equipment graph."""
    loads = typed(quads, "EnergyConsumer").filter(F.col("graph").contains("EQ"))
    loads = loads.groupBy("subject").agg(F.min("graph").alias("graph"), F.min("version").alias("version"))
    group, resource = blank("load_group", "subject"), blank("load_resource", "subject")
    facts = [
        _node("subject", cim("NonConformLoad.LoadGroup"), group),
        _text(group, cim("IdentifiedObject.name"), GROUP_NAME),
        _node(group, "SN:NonConformLoadGroup.ScheduleResource", resource),
        _text(resource, "SN:ScheduleResource.marketCode", RESOURCE_MARKET_CODE),
    ]
    return _emit(loads, facts, F.col("graph"))


def eic_codes(quads: DataFrame) -> DataFrame:
    """Delivery point and bidding area with a code for every substation."""
    point, area = blank("delivery_point", "subject", "graph"), blank("bidding_area", "subject", "graph")
    facts = [
        _node("subject", "SN:Substation.MarketDeliveryPoint", point),
        _node(point, "SN:MarketDeliveryPoint.BiddingArea", area),
        _text(area, "entsoeSecretariat:IdentifiedObject.energyIdentCodeEIC", EIC_CODE),
    ]
    return _emit(typed(quads, "Substation"), facts, F.col("graph"))


def analysis_flags(quads: DataFrame) -> DataFrame:
    """An enabled flag for every equipment that has a terminal."""
    ends = quads.filter(is_cim("Terminal.ConductingEquipment"))
    rows = ends.groupBy(F.col("object").alias("subject")).agg(F.min("graph").alias("graph"))
    return _emit(rows, [_text("subject", "SN:Equipment.networkAnalysisEnable", "true", "boolean")], F.col("graph"))


def ranked(values: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Different values with a number `rank`, those of equipment graphs first; written, so that the numbers stay.

    Values are graphs, or graphs with classes: files times vocabulary, however many quads there are.
    """
    later = ~F.coalesce(F.col("graph").contains("EQ"), F.lit(False))
    return written(values.distinct().orderBy(later, *order).withColumn("rank", F.monotonically_increasing_id()), "ranks")


def with_ranks(quads: DataFrame, codes: DataFrame) -> DataFrame:
    """The quads with the rank of their values in place of these."""
    columns = [c for c in codes.columns if c != "rank"]
    other = codes.select(*[F.col(c).alias(f"_{c}") for c in columns], "rank")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return quads.join(other, same).drop(*columns, *other.columns[:-1])


def direct_types(quads: DataFrame) -> DataFrame:
    """One class per subject, that of the equipment graph first.

    The minimum of a number per subject is a hash aggregate that combines before the exchange; the classes come back
    from the table of numbers.
    """
    rows = quads.filter(F.col("predicate") == TYPE).select("subject", "graph", "object", "object_kind", "datatype", "lang")
    codes = ranked(rows.drop("subject"), ["object", "graph", "object_kind", "datatype", "lang"])
    first = with_ranks(rows, codes).groupBy("subject").agg(F.min("rank").alias("rank"))
    return first.join(codes, "rank").withColumn("predicate", F.lit("sesame:directType")).select(*QUAD_COLUMNS)


def _mrid_quad(first: DataFrame, value: Column) -> DataFrame:
    predicate = F.concat(F.coalesce("version", F.lit("cim:")), F.lit(MRID))
    rows = first.withColumns({"predicate": predicate, "object": value, "object_kind": F.lit("literal")})
    empty = F.lit(None).cast("string")
    return rows.withColumns({"datatype": empty, "lang": empty}).select(*QUAD_COLUMNS)


def missing_mrids(quads: DataFrame) -> DataFrame:
    """An mRID for every subject without one: the UUID in its IRI, else a hash of the IRI in UUID form.

    It goes to the first graph of the subject, equipment graphs first. One aggregation finds the graph and whether
    there is an mRID, so the quads are exchanged once, combined.
    """
    used = F.when(F.col("predicate") == TYPE, version("object")).otherwise(version("predicate")).alias("version")
    codes = ranked(quads.select("graph", used), ["graph", F.col("version").asc_nulls_last()])
    rows = with_ranks(quads.select("subject", F.coalesce(is_cim(MRID), F.lit(False)).alias("known"), "graph", used), codes)
    first = rows.groupBy("subject").agg(F.min("rank").alias("rank"), F.max("known").alias("known"))
    name = F.substring_index(F.regexp_replace("subject", "^_:", ""), "#_", -1)
    value = F.when(is_uuid(name), name).otherwise(md5_uuid(name))
    return _mrid_quad(first.filter("NOT known").join(codes, "rank"), value)


def copy_mrids(quads: DataFrame, rdf_type: str | None = None, graph: str | None = None) -> DataFrame:
    """The subject itself as mRID, per graph that types it, for subjects without one."""
    known = quads.filter(is_cim(MRID)).select("subject")
    rows = quads.filter(F.col("predicate") == TYPE)
    if rdf_type is not None:
        rows = rows.filter(F.col("object") == rdf_type)
    if graph is not None:
        rows = rows.filter(F.col("graph") == graph)
    each = rows.filter("graph IS NOT NULL").groupBy("graph", "subject").agg(F.min(version("object")).alias("version"))
    return _mrid_quad(without(each, known, "subject"), F.col("subject"))


def with_datatypes(quads: DataFrame) -> DataFrame:
    """The table with literals of known predicates in canonical form and typed; a value that does not parse fails."""
    kind = F.lit(None).cast("string")
    for part, datatype in reversed(DATATYPES.items()):
        kind = F.when(F.col("predicate").contains(part), F.lit(datatype)).otherwise(kind)
    value = F.col("object")
    canonical = (
        F.when(kind == "integer", value.cast("bigint").cast("string"))
        .when(kind == "double", value.cast("double").cast("string"))
        .when(kind == "boolean", F.lower(value).isin("true", "1").cast("string"))
    )
    datatype = F.concat(F.lit("xsd:"), kind)
    is_literal = (F.col("object_kind") == "literal") & kind.isNotNull()
    return quads.withColumns(
        {
            "object": F.when(is_literal, canonical).otherwise(value),
            "datatype": F.when(is_literal, datatype).otherwise(F.col("datatype")),
        }
    )


def adapt(quads: DataFrame) -> DataFrame:
    """All enrichment steps. Quads are written once, and so is what the first half adds, because both are read often."""
    quads = written(quads.select(*QUAD_COLUMNS), "quads")
    added = [step(quads) for step in (zero_power_flow, zero_injection, unit_market_data, load_market_codes)]
    base = retype_units(quads).unionByName(written(reduce(DataFrame.unionByName, added), "added"))
    identified = with_datatypes(base.unionByName(missing_mrids(base)))
    extra = eic_codes(base).unionByName(analysis_flags(base)).unionByName(direct_types(base))
    return identified.unionByName(extra)
