"""Entity views: which columns each view has, and how they are built from a quad table.

A view row is one subject. A column names the CIM property it comes from (local name) and a type.
`STATE` marks properties published by the topology, state-variable and hypothesis profiles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions import bool_of, double_of, int_of
from voltframe.session import written

TEXT, REF, NUMBER, INTEGER, FLAG = "text", "reference", "double", "int", "boolean"

CASTS = {
    TEXT: lambda c: c,
    REF: lambda c: c,
    NUMBER: double_of,
    INTEGER: lambda c: int_of(c).cast("int"),
    FLAG: lambda c: F.when(c.isNotNull(), bool_of(c)),
}


@dataclass(frozen=True)
class View:
    """Columns of one entity view; a subject belongs when it has one of the classes or an anchor value."""

    columns: dict[str, tuple[str, str]]
    classes: tuple[str, ...] = ()
    anchors: tuple[str, ...] = ()


@dataclass(frozen=True)
class Edge:
    """A many-valued association kept as (subject, object) pairs."""

    prop: str
    subject: str
    object: str


MRID = {"mrid": ("IdentifiedObject.mRID", TEXT)}
NAMED = MRID | {"name": ("IdentifiedObject.name", TEXT)}
ALIASED = NAMED | {"alias_name": ("IdentifiedObject.aliasName", TEXT)}
ANALYSED = {"analysis_enabled": ("Equipment.networkAnalysisEnable", FLAG)}
CONTAINED = {"container": ("Equipment.EquipmentContainer", REF)}
ON_VOLTAGE = {"base_voltage": ("ConductingEquipment.BaseVoltage", REF)}

VIEWS: dict[str, View] = {
    "geographical_region": View(ALIASED, ("GeographicalRegion",)),
    "sub_geographical_region": View(
        ALIASED
        | {
            "short_name": ("IdentifiedObject.shortName", TEXT),
            "region": ("SubGeographicalRegion.Region", REF),
        },
        ("SubGeographicalRegion",),
        ("region",),
    ),
    "substation": View(
        NAMED
        | {
            "region": ("Substation.Region", REF),
            "delivery_point": ("Substation.MarketDeliveryPoint", REF),
        },
        ("Substation",),
        ("region", "delivery_point"),
    ),
    "voltage_level": View(
        MRID
        | {
            "base_voltage": ("VoltageLevel.BaseVoltage", REF),
            "substation": ("VoltageLevel.Substation", REF),
        },
        ("VoltageLevel",),
        ("substation", "base_voltage"),
    ),
    "base_voltage": View(
        MRID | {"nominal_voltage": ("BaseVoltage.nominalVoltage", NUMBER)}, ("BaseVoltage",), ("nominal_voltage",)
    ),
    "line": View(
        NAMED
        | {
            "region": ("Line.Region", REF),
            "market_code": ("Line.marketCode", TEXT),
            "from_delivery_point": ("Line.FromMarketDeliveryPoint", REF),
            "to_delivery_point": ("Line.ToMarketDeliveryPoint", REF),
        },
        ("Line",),
        ("region", "market_code", "from_delivery_point"),
    ),
    "delivery_point": View(
        {"bidding_area": ("MarketDeliveryPoint.BiddingArea", REF)}, ("MarketDeliveryPoint",), ("bidding_area",)
    ),
    "bidding_area": View(
        {
            "eic_code": ("IdentifiedObject.energyIdentCodeEIC", TEXT),
            "market_code": ("BiddingArea.marketCode", TEXT),
        },
        ("BiddingArea",),
        ("eic_code", "market_code"),
    ),
    "connectivity_node": View(
        MRID
        | {
            "container": ("ConnectivityNode.ConnectivityNodeContainer", REF),
            "topological_node": ("ConnectivityNode.TopologicalNode", REF),
        },
        ("ConnectivityNode",),
        ("container", "topological_node"),
    ),
    "topological_node": View(
        NAMED
        | {
            "base_voltage": ("TopologicalNode.BaseVoltage", REF),
            "container": ("TopologicalNode.ConnectivityNodeContainer", REF),
        },
        ("TopologicalNode",),
        ("base_voltage", "container"),
    ),
    "topological_island": View(
        {
            "name": ("IdentifiedObject.name", TEXT),
            "angle_ref": ("TopologicalIsland.AngleRefTopologicalNode", REF),
        },
        ("TopologicalIsland",),
        ("angle_ref",),
    ),
    "sv_voltage": View(
        {
            "node": ("SvVoltage.TopologicalNode", REF),
            "v": ("SvVoltage.v", NUMBER),
            "angle": ("SvVoltage.angle", NUMBER),
        },
        ("SvVoltage",),
        ("node",),
    ),
    "sv_injection": View(
        {
            "node": ("SvInjection.TopologicalNode", REF),
            "p": ("SvInjection.pInjection", NUMBER),
            "q": ("SvInjection.qInjection", NUMBER),
        },
        ("SvInjection",),
        ("node",),
    ),
    "sv_power_flow": View(
        {
            "terminal": ("SvPowerFlow.Terminal", REF),
            "p": ("SvPowerFlow.p", NUMBER),
            "q": ("SvPowerFlow.q", NUMBER),
        },
        ("SvPowerFlow",),
        ("terminal",),
    ),
    "sv_status": View(
        {
            "equipment": ("SvStatus.ConductingEquipment", REF),
            "in_service": ("SvStatus.inService", FLAG),
        },
        ("SvStatus",),
        ("equipment",),
    ),
    "sv_tap_step": View(
        {
            "tap_changer": ("SvTapStep.TapChanger", REF),
            "position": ("SvTapStep.position", NUMBER),
        },
        ("SvTapStep",),
        ("tap_changer",),
    ),
    "terminal": View(
        NAMED
        | {
            "equipment": ("Terminal.ConductingEquipment", REF),
            "node": ("Terminal.ConnectivityNode", REF),
            "topological_node": ("Terminal.TopologicalNode", REF),
            "sequence_number": ("ACDCTerminal.sequenceNumber", INTEGER),
            "terminal_sequence_number": ("Terminal.sequenceNumber", INTEGER),
            "connected": ("ACDCTerminal.connected", FLAG),
            "terminal_connected": ("Terminal.connected", FLAG),
        },
        ("Terminal",),
        ("equipment", "node", "topological_node"),
    ),
    "identified": View(MRID, (), ("mrid",)),
    "market_unit": View(NAMED, (), ("mrid",)),
    "dc_controller": View(MRID, (), ("mrid",)),
    "action_collection": View(MRID, (), ("mrid",)),
    "equipment": View(
        ALIASED | CONTAINED | ANALYSED | {"normal_open": ("Switch.normalOpen", FLAG)},
        (),
        ("container", "analysis_enabled", "normal_open", "name"),
    ),
    "ac_line": View(
        NAMED
        | CONTAINED
        | ANALYSED
        | ON_VOLTAGE
        | {
            "r": ("ACLineSegment.r", NUMBER),
            "x": ("ACLineSegment.x", NUMBER),
            "bch": ("ACLineSegment.bch", NUMBER),
            "gch": ("ACLineSegment.gch", NUMBER),
            "length": ("Conductor.length", NUMBER),
        },
        ("ACLineSegment",),
        ("r",),
    ),
    "series_compensator": View(
        NAMED
        | CONTAINED
        | ANALYSED
        | ON_VOLTAGE
        | {"r": ("SeriesCompensator.r", NUMBER), "x": ("SeriesCompensator.x", NUMBER)},
        ("SeriesCompensator",),
        ("r",),
    ),
    "power_transformer": View(ALIASED | CONTAINED | ANALYSED, ("PowerTransformer",)),
    "transformer_end": View(
        NAMED
        | {
            "transformer": ("PowerTransformerEnd.PowerTransformer", REF),
            "terminal": ("TransformerEnd.Terminal", REF),
            "end_number": ("TransformerEnd.endNumber", INTEGER),
            "rated_u": ("PowerTransformerEnd.ratedU", NUMBER),
            "r": ("PowerTransformerEnd.r", NUMBER),
            "x": ("PowerTransformerEnd.x", NUMBER),
            "b": ("PowerTransformerEnd.b", NUMBER),
            "g": ("PowerTransformerEnd.g", NUMBER),
            "phase_angle_clock": ("PowerTransformerEnd.phaseAngleClock", INTEGER),
            "phase_tap_changer": ("TransformerEnd.PhaseTapChanger", REF),
        },
        ("PowerTransformerEnd",),
        ("transformer",),
    ),
    "ratio_tap_changer": View(
        {
            "transformer_end": ("RatioTapChanger.TransformerEnd", REF),
            "increment": ("RatioTapChanger.stepVoltageIncrement", NUMBER),
            "neutral_step": ("TapChanger.neutralStep", INTEGER),
            "normal_step": ("TapChanger.normalStep", INTEGER),
            "step": ("TapChanger.step", NUMBER),
        },
        ("RatioTapChanger",),
        ("transformer_end",),
    ),
    "phase_tap_changer": View(
        {
            "increment": ("PhaseTapChangerLinear.stepPhaseShiftIncrement", NUMBER),
            "neutral_step": ("TapChanger.neutralStep", INTEGER),
            "high_step": ("TapChanger.highStep", INTEGER),
            "low_step": ("TapChanger.lowStep", INTEGER),
            "control": ("TapChanger.TapChangerControl", REF),
            "control_enabled": ("TapChanger.controlEnabled", FLAG),
            "step": ("TapChanger.step", NUMBER),
        },
        ("PhaseTapChangerLinear",),
        ("increment",),
    ),
    "regulating_control": View(
        {
            "mode": ("RegulatingControl.mode", REF),
            "terminal": ("RegulatingControl.Terminal", REF),
            "enabled": ("RegulatingControl.enabled", FLAG),
            "target_value": ("RegulatingControl.targetValue", NUMBER),
        },
        ("RegulatingControl", "TapChangerControl"),
        ("mode", "enabled"),
    ),
    "switch": View(
        NAMED
        | ANALYSED
        | {
            "normal_open": ("Switch.normalOpen", FLAG),
            "open": ("Switch.open", FLAG),
        },
        ("Breaker", "Disconnector"),
        ("normal_open", "open"),
    ),
    "load": View(
        NAMED | CONTAINED | ANALYSED | {"load_group": ("NonConformLoad.LoadGroup", REF)},
        ("ConformLoad", "NonConformLoad", "EnergyConsumer"),
        ("load_group",),
    ),
    "load_group": View(
        NAMED | {"schedule_resource": ("NonConformLoadGroup.ScheduleResource", REF)},
        ("NonConformLoadGroup",),
        ("schedule_resource",),
    ),
    "synchronous_machine": View(
        NAMED
        | CONTAINED
        | ANALYSED
        | {
            "rated_s": ("RotatingMachine.ratedS", NUMBER),
            "generating_unit": ("RotatingMachine.GeneratingUnit", REF),
            "machine_generating_unit": ("SynchronousMachine.GeneratingUnit", REF),
        },
        ("SynchronousMachine",),
        ("generating_unit", "machine_generating_unit"),
    ),
    "generating_unit": View(
        NAMED
        | ANALYSED
        | {
            "direct_type": ("directType", REF),
            "min_p": ("GeneratingUnit.minOperatingP", NUMBER),
            "max_p": ("GeneratingUnit.maxOperatingP", NUMBER),
            "hydro_power_plant": ("HydroGeneratingUnit.HydroPowerPlant", REF),
            "wind_power_plant": ("WindGeneratingUnit.WindPowerPlant", REF),
            "market_code": ("GeneratingUnit.marketCode", TEXT),
            "allocation_weight": ("GeneratingUnit.groupAllocationWeight", NUMBER),
            "schedule_resource": ("GeneratingUnit.ScheduleResource", REF),
            "frr_resource": ("GeneratingUnit.ScheduleFRRResource", REF),
        },
        ("GeneratingUnit", "HydroGeneratingUnit", "ThermalGeneratingUnit", "WindGeneratingUnit"),
        ("min_p", "max_p", "hydro_power_plant", "schedule_resource"),
    ),
    "hydro_power_plant": View(
        {"storage_type": ("HydroPowerPlant.hydroPlantStorageType", REF)}, ("HydroPowerPlant",), ("storage_type",)
    ),
    "wind_power_plant": View(MRID, ("WindPowerPlant",)),
    "schedule_resource": View(
        ALIASED | {"market_code": ("ScheduleResource.marketCode", TEXT)}, ("ScheduleResource",), ("market_code",)
    ),
    "converter": View(
        ALIASED
        | ANALYSED
        | {
            "vsc_dc_pole": ("VoltageSourceConverter.DCPole", REF),
            "dc_pole": ("DCConverter.DCPole", REF),
            "loss0": ("VoltageSourceConverter.loss0", NUMBER),
            "loss1": ("VoltageSourceConverter.loss1", NUMBER),
            "loss2": ("VoltageSourceConverter.loss2", NUMBER),
            "p": ("ACDCConverter.p", NUMBER),
            "q": ("ACDCConverter.q", NUMBER),
            "pole_loss": ("ACDCConverter.poleLossP", NUMBER),
        },
        ("VsConverter", "CsConverter", "DCConvertUnit", "VoltageSourceConverter", "DCConverter"),
        ("vsc_dc_pole", "dc_pole", "p"),
    ),
    "dc_pole": View(
        CONTAINED
        | ON_VOLTAGE
        | {
            "controller": ("DCPole.DCController", REF),
            "participation_factor": ("DCPole.participationFactor", NUMBER),
        },
        ("DCPole",),
        ("controller", "participation_factor"),
    ),
    "dc_tie": View(
        {
            "name": ("IdentifiedObject.name", TEXT),
            "controller": ("DCTieCorridor.DCController", REF),
            "max_export": ("DCTieCorridor.maxDCExportOp", NUMBER),
            "max_import": ("DCTieCorridor.maxDCImportOp", NUMBER),
        },
        ("DCTieCorridor",),
        ("controller",),
    ),
    "dc_line": View(
        {
            "name": ("IdentifiedObject.name", TEXT),
            "resistance": ("DCLineSegment.dcSegmentResistance", NUMBER),
        },
        ("DCLineSegment",),
        ("resistance",),
    ),
    "operational_limit": View(
        {
            "name": ("IdentifiedObject.name", TEXT),
            "limit_set": ("OperationalLimit.OperationalLimitSet", REF),
            "active_power": ("ActivePowerLimit.value", NUMBER),
            "current": ("CurrentLimit.value", NUMBER),
        },
        (),
        ("limit_set",),
    ),
    "operational_limit_set": View(
        {
            "equipment": ("OperationalLimitSet.Equipment", REF),
            "terminal": ("OperationalLimitSet.Terminal", REF),
        },
        ("OperationalLimitSet",),
        ("equipment", "terminal"),
    ),
    "protective_action": View(
        NAMED
        | {
            "flow_shift": ("ProtectiveAction.flowShift", TEXT),
            "flow_shift_flip": ("ProtectiveAction.flowShiftFlip", TEXT),
            "load_contribution": ("ProtectiveAction.loadContribution", TEXT),
            "collection": ("ProtectiveAction.ProtectiveActionCollection", REF),
            "equipment": ("ProtectiveActionEquipment.Equipment", REF),
            "conducting_equipment": ("ProtectiveActionAdjustmentAC.ConductingEquipment", REF),
            "dc_controller": ("ProtectiveActionAdjustmentDCController.DCController", REF),
            "transformer_end": ("ProtectiveActionEquipment.TransformerEnd", REF),
        },
        (),
        ("equipment", "conducting_equipment", "dc_controller", "transformer_end"),
    ),
    "position_point": View(
        {
            "location": ("PositionPoint.Location", REF),
            "sequence_number": ("PositionPoint.sequenceNumber", INTEGER),
            "x": ("PositionPoint.xPosition", NUMBER),
            "y": ("PositionPoint.yPosition", NUMBER),
        },
        ("PositionPoint",),
        ("location",),
    ),
    "location": View({"coordinate_system": ("Location.CoordinateSystem", REF)}, ("Location",), ("coordinate_system",)),
    "coordinate_system": View({"crs_urn": ("CoordinateSystem.crsUrn", TEXT)}, ("CoordinateSystem",), ("crs_urn",)),
    "full_model": View(
        {
            "scenario_time": ("Model.scenarioTime", TEXT),
            "created": ("Model.created", TEXT),
            "version": ("Model.version", TEXT),
            "description": ("Model.description", TEXT),
        },
        ("FullModel",),
        ("created", "description"),
    ),
    "market_definition_set": View(
        NAMED | {"activation_date": ("MarketDefinitionSet.activationDate", TEXT)}, ("MarketDefinitionSet",)
    ),
}

EDGES: dict[str, Edge] = {
    "island_node": Edge("TopologicalIsland.TopologicalNodes", "island", "node"),
    "location_resource": Edge("Location.PowerSystemResources", "location", "resource"),
    "model_dependency": Edge("Model.DependentOn", "model", "depends_on"),
    "model_profile": Edge("Model.profile", "model", "profile"),
}

# Properties taken from the state side when equipment and state are given as two quad tables.
STATE = frozenset(
    {
        "ACDCTerminal.connected",
        "Terminal.connected",
        "Terminal.TopologicalNode",
        "ConnectivityNode.TopologicalNode",
        "Switch.open",
        "TapChanger.step",
        "TapChanger.controlEnabled",
        "RegulatingControl.enabled",
        "RegulatingControl.targetValue",
        "ACDCConverter.p",
        "ACDCConverter.q",
        "ACDCConverter.poleLossP",
    }
)
STATE_VIEWS = frozenset(
    {
        "topological_node",
        "topological_island",
        "sv_voltage",
        "sv_injection",
        "sv_power_flow",
        "sv_status",
        "sv_tap_step",
        "island_node",
    }
)

# Column each stored view is bucketed by where that is not its id: the key its joins use.
BUCKET_KEYS = {
    "sv_power_flow": "terminal",
    "sv_status": "equipment",
    "sv_voltage": "node",
    "sv_injection": "node",
    "sv_tap_step": "tap_changer",
    "ratio_tap_changer": "transformer_end",
    "operational_limit": "limit_set",
    "position_point": "location",
    "island_node": "node",
    "location_resource": "location",
    "model_dependency": "model",
    "model_profile": "model",
    "link": "object",
}

TYPE_PROPERTY = "type"


# Namespace of generated CIM predicates and classes (fixed value).
CIM = "http://iec.ch/TC57/2013/CIM-schema-cim16#"


def local_name(iri: Column) -> Column:
    """The part of an IRI or prefixed name after its namespace."""
    for separator in ("#", "/", ":"):
        iri = F.substring_index(iri, separator, -1)
    return iri


def has_local_name(iri: Column, names: Iterable[str]) -> Column:
    """Whether the local name is one of `names`; plain `cim:` names are compared whole, without being taken apart."""
    names = list(names)
    plain = iri.startswith("cim:") & ~iri.contains("#") & ~iri.contains("/") & ~F.substring(iri, 5, 1 << 30).contains(":")
    return F.when(plain, iri.isin(*[f"cim:{name}" for name in names])).otherwise(local_name(iri).isin(*names))


MANY_VALUED = frozenset(edge.prop for edge in EDGES.values())
PROPERTIES = sorted({prop for view in VIEWS.values() for prop, _ in view.columns.values()} - MANY_VALUED)
ANCHORS = sorted({view.columns[anchor][0] for view in VIEWS.values() for anchor in view.anchors})
# Class combinations of a stored entity table, each a folder; more than a vocabulary can give is an error.
MAX_KINDS = 10_000


def _parsed(kind: str, value: Column, prop: str, subject: Column) -> Column:
    """The typed value; a literal that isn't the declared number fails, naming property and subject."""
    typed = CASTS[kind](value)
    if kind not in (NUMBER, INTEGER):
        return typed
    said = F.concat(F.lit(f"{prop} of "), subject, F.lit(": not a number: "), value)
    return F.when(value.isNotNull() & typed.isNull(), F.raise_error(said)).otherwise(typed)


def _values(prop: str) -> Column:
    """All values of a property of a subject; none is an empty array."""
    return F.coalesce(F.col("facts")[prop], F.array())


# How sets travel: a character for the property, whose name would be most of what they carry, then the value, filled up to
# a few lengths: as a set has no order, texts that differ in length would leave a row nothing to share with the one before
# it when the exchange is compressed. The last character tells how many were filled in; no value is the property alone.
_FILL, _WIDTH = "\x00", 16


def _code(names: list[str], name: str) -> str:
    """The character of a property, in order of `names`, so that coded texts are too; the class property is the first."""
    return chr(1 + names.index(name))


def _text(code: Column, value: Column) -> Column:
    filled = F.pmod(-F.length(value) - 2, F.lit(_WIDTH))
    return F.concat(code, value, F.repeat(F.lit(_FILL), filled), F.char(filled + 1))


def _value(text: Column) -> Column:
    rest = F.length(text) - 1
    return F.when(rest > 0, F.substring(text, F.lit(2), rest - F.ascii(F.right(text, F.lit(1)))))


def _types() -> Column:
    """The classes in `coded`, where they stand first."""
    return F.transform(F.filter("coded", lambda text: text.startswith(_code([TYPE_PROPERTY], TYPE_PROPERTY))), _value)


def _properties_and_values(properties: list[str]) -> tuple[Column, Column]:
    """The property and the value of each text of `coded` behind the `types`."""
    names = F.array(*[F.lit(name) for name in [TYPE_PROPERTY, *properties]])
    texts = F.slice("coded", F.size("types") + 1, F.size("coded"))
    return F.transform(texts, lambda text: F.element_at(names, F.ascii(text))).alias("properties"), F.transform(texts, _value).alias("values")


def _one_each() -> Column:
    """Whether none of a subject's `properties` has a second value; then the map is made without looking for them."""
    return F.size(F.array_distinct("properties")) == F.size("properties")


def _by_property() -> Column:
    """property -> its different values, from a subject's `properties` and `values`, one of each for every fact."""
    names, facts = F.array_distinct("properties"), F.arrays_zip("properties", "values")
    values = F.transform(names, lambda n: F.transform(F.filter(facts, lambda f: f["properties"] == n), lambda f: f["values"]))
    return F.map_from_arrays(names, values)


class EntityView:
    """One row per subject whose columns may hold several values; it becomes rows when columns are chosen from it.

    `rows` has an array for each column in `several`. Filters wait until `select` names the columns that are used;
    then there is a row for every combination of the values of these, as in a join of the properties' quads, while
    columns that nothing uses neither multiply rows nor are read. Any other use takes all columns.
    """

    def __init__(
        self,
        rows: DataFrame,
        kinds: dict[str, tuple[str, str]],
        several: frozenset[str],
        conditions: tuple = (),
        narrow: Callable[[set[str]], DataFrame] | None = None,
    ) -> None:
        """`narrow` gives the same rows read for some columns only; the others are unset there."""
        self._rows, self._kinds, self._several, self._conditions, self._narrow = rows, kinds, several, conditions, narrow

    @property
    def columns(self) -> list[str]:
        return self._rows.columns

    def filter(self, condition: Column | str) -> EntityView:
        return EntityView(self._rows, self._kinds, self._several, (*self._conditions, condition), self._narrow)

    where = filter

    def select(self, *columns: Column | str) -> DataFrame:
        plain = self._with_rows(())
        probe = reduce(DataFrame.filter, self._conditions, plain).select(*columns)
        used = _used(probe, plain)
        rows = self._with_rows(used) if self._narrow is None else EntityView(self._narrow(used), self._kinds, self._several)._with_rows(used)
        return reduce(DataFrame.filter, self._conditions, rows).select(*columns)

    def __getattr__(self, name: str):
        # Everything else a DataFrame can do, over all columns.
        if name.startswith("__"):
            raise AttributeError(name)
        return getattr(reduce(DataFrame.filter, self._conditions, self._with_rows(self._several)), name)

    def __getitem__(self, column: str) -> Column:
        return F.col(column)

    def _with_rows(self, used: Iterable[str]) -> DataFrame:
        """A row for each value of the used columns; of the others the first value stands for all."""
        rows = self._rows
        for column in sorted(self._several & set(used)):
            rows = rows.withColumn(column, F.explode_outer(column))
        rest = [F.get(F.col(c), F.lit(0)).alias(c) if c in self._several.difference(used) else F.col(c) for c in rows.columns]
        rows = rows.select(*rest)
        parsed = [_parsed(self._kinds[c][1], F.col(c), self._kinds[c][0], F.col("id")).alias(c) if c in self._kinds else F.col(c) for c in rows.columns]
        return rows.select(*parsed)

    def stored(self) -> DataFrame:
        """What `save` writes: arrays of texts only where some subject has several values, else the typed value."""
        sizes = [F.max(F.size(F.coalesce(c, F.array()))).alias(c) for c in sorted(self._several)]
        found = self._rows.agg(*sizes).first() if sizes else {}
        many = {c for c in self._several if (found[c] or 0) > 1}
        one = EntityView(self._rows, {c: k for c, k in self._kinds.items() if c not in many}, self._several - many, self._conditions)
        return reduce(DataFrame.filter, self._conditions, one._with_rows(self._several - many))

    @staticmethod
    def loaded(name: str, rows: DataFrame) -> DataFrame | EntityView:
        """A stored view: as it is where every column has one value."""
        many = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.ArrayType) and f.name != "types"}
        if not many or name not in VIEWS:
            return rows
        return EntityView(rows, {c: k for c, k in VIEWS[name].columns.items() if c in many}, frozenset(many))


def _used(probe: DataFrame, plain: DataFrame) -> set[str]:
    """Columns of `plain` that the operators of `probe` above it refer to."""
    node, end = probe._jdf.queryExecution().analyzed(), plain._jdf.queryExecution().analyzed()
    names: set[str] = set()
    while not node.fastEquals(end):
        references = node.references().iterator()
        while references.hasNext():
            names.add(references.next().name())
        node = node.children().head()
    return names


@dataclass
class EntityTable:
    """One row per subject: class names and its properties, each with all its different values.

    A view groups the quads of its own properties only. With `materialize` the rows are written once, a folder per
    combination of classes, with a map of the properties a subject has (further values in a map beside it), and a view
    reads only the folders that can hold its subjects. Properties that never have several values there are read as they are.
    """

    quads: DataFrame
    materialize: bool = False
    several: tuple[str, ...] = ()
    stored: DataFrame | None = field(init=False, default=None)
    kinds: dict[str, set[str]] = field(init=False, default_factory=dict)
    repeated: set[str] = field(init=False, default_factory=set)

    def __post_init__(self) -> None:
        unknown = set(self.several) - set(PROPERTIES)
        if unknown:
            raise ValueError(f"no view has the properties {sorted(unknown)}")
        if self.materialize:
            # Subjects are put in order of their classes while they still are short texts, and written from the tasks that
            # group them: an exchange by classes would carry the whole table a second time.
            coded = self._coded(PROPERTIES).withColumn("types", _types())
            kind = F.coalesce(F.concat(F.lit("is-"), F.array_join("types", "+")), F.lit("is-"))
            ordered = coded.withColumn("kind", kind).sortWithinPartitions("kind", "subject")
            sets = ordered.select("subject", "types", *_properties_and_values(PROPERTIES), "kind")
            # Properties with more than one value, whole; mostly none.
            further = F.when(~_one_each(), F.map_filter(_by_property(), lambda _, values: F.size(values) > 1))
            first = F.transform_values(_by_property(), lambda _, values: F.get(values, F.lit(0)))
            # In order of their names, which then are the same run of bytes in subjects that have the same properties.
            facts = F.when(_one_each(), F.map_from_arrays("properties", "values")).otherwise(first)
            rows = sets.select("subject", "types", facts.alias("facts"), further.alias("further"), "kind")
            self.stored = written(rows, "entities", partition_by="kind", compression="zstd")
            each = self.stored.select("kind", "further", F.explode_outer(F.map_keys("facts")).alias("property"))
            again = F.coalesce(F.col("further")[F.col("property")].isNotNull(), F.lit(False))
            each = each.groupBy("kind", "property").agg(F.max(again).alias("again"))
            held = F.collect_set("property").alias("held"), F.collect_set(F.when(F.col("again"), F.col("property"))).alias("again")
            found = each.groupBy("kind").agg(*held).limit(MAX_KINDS + 1).collect()
            if len(found) > MAX_KINDS:
                raise ValueError(f"more than {MAX_KINDS} combinations of classes")
            self.kinds = {row.kind: set(row.held).intersection(ANCHORS) for row in found}
            self.repeated = {prop for row in found for prop in row.again}

    def _named(self, properties: Iterable[str]) -> DataFrame:
        """Quads of the classes and of these properties; the filter prunes quads stored by predicate."""
        return self.quads.filter(has_local_name(F.col("predicate"), [TYPE_PROPERTY, *properties]))

    def _coded(self, properties: list[str]) -> DataFrame:
        """subject, and `coded`: its different classes, then its different (property, value), in order as `_code` has them."""
        predicate, names = F.col("predicate"), [TYPE_PROPERTY, *properties]
        # Plain `cim:` names are found whole, without being taken apart.
        whole = F.create_map(*[F.lit(t) for name in names for t in (f"cim:{name}", _code(names, name))])
        local = F.create_map(*[F.lit(t) for name in names for t in (name, _code(names, name))])
        code = F.coalesce(F.try_element_at(whole, predicate), F.try_element_at(local, local_name(predicate)))
        typed = F.col("code") == _code(names, TYPE_PROPERTY)
        value = F.when(typed, local_name(F.col("object"))).otherwise(F.col("object"))
        fact = F.when(value.isNotNull(), _text(F.col("code"), value)).when(~typed, F.col("code"))
        rows = self._named(properties).select("subject", code.alias("code"), "object").select("subject", fact.alias("fact"))
        # Sets combine before the only exchange: copies of a value collapse there, so a hot subject never lands in one
        # task as a whole, and quads of a subject that stand together travel as one row.
        return rows.groupBy("subject").agg(F.sort_array(F.collect_set("fact")).alias("coded"))

    def _grouped(self, properties: Iterable[str], cell: Column | None = None) -> DataFrame:
        """subject, types, and `facts`: property -> its different values.

        `cell` takes the place of the object's text as a value.
        """
        properties = list(properties)
        if cell is None:
            coded = self._coded(properties).withColumn("types", _types())
            sets = coded.select("subject", "types", *_properties_and_values(properties))
        else:
            predicate, known = F.col("predicate"), [f"cim:{prop}" for prop in properties]
            prop = F.when(predicate.isin(*known), F.substring(predicate, 5, 1 << 30)).otherwise(local_name(predicate))
            typed = F.col("property") == TYPE_PROPERTY
            sets = self._named(properties).withColumn("property", prop).groupBy("subject").agg(
                F.sort_array(F.collect_set(F.when(typed, local_name(F.col("object"))))).alias("types"),
                F.collect_set(F.when(~typed, F.struct("property", cell.alias("value")))).alias("set"),
            )
            sets = sets.select("subject", "types", F.col("set.property").alias("properties"), F.col("set.value").alias("values"))
        one_each = F.map_from_arrays("properties", F.transform("values", lambda v: F.array(v)))
        facts = F.when(_one_each(), one_each).otherwise(_by_property())
        return sets.select("subject", "types", facts.alias("facts"))

    def _candidates(self, spec: View, properties: list[str], anchors: list[str]) -> tuple[DataFrame, Callable[[str], Column]]:
        """Rows that can belong to a view, and how to get a property of them: an array where it may have several values."""
        if self.stored is None:
            return self._grouped(properties), _values
        chosen = [
            kind
            for kind, present in self.kinds.items()
            if set(kind.removeprefix("is-").split("+")) & set(spec.classes) or present & set(anchors)
        ]

        def found(prop: str) -> Column:
            one = F.col("facts")[prop]
            return F.coalesce(F.col("further")[prop], F.array(one)) if prop in self.repeated else one

        return self.stored.filter(F.col("kind").isin(*chosen)), found

    def view(self, name: str) -> EntityView:
        spec = VIEWS[name]
        used = {c: (prop, kind) for c, (prop, kind) in spec.columns.items() if prop not in MANY_VALUED}
        anchors = [spec.columns[anchor][0] for anchor in spec.anchors]
        several = {c for c, (prop, _) in used.items() if self.stored is None or prop in self.repeated}

        def rows_of(columns: set[str]) -> DataFrame:
            read = {c: prop for c, (prop, _) in used.items() if c in columns}
            rows, found = self._candidates(spec, sorted({*read.values(), *anchors}), anchors)
            belongs = F.lit(False)
            if spec.classes:
                belongs = belongs | F.arrays_overlap("types", F.array(*map(F.lit, spec.classes)))
            for anchor in spec.anchors:
                value = found(spec.columns[anchor][0])
                belongs = belongs | (F.get(value, F.lit(0)) if anchor in several else value).isNotNull()
            unset = [CASTS[kind](F.lit(None).cast("string")).alias(c) for c, (_, kind) in spec.columns.items() if c not in used]
            none = {True: F.lit(None).cast("array<string>"), False: F.lit(None).cast("string")}
            values = [(found(read[c]) if c in read else none[c in several]).alias(c) for c in used]
            return rows.filter(belongs).select(F.col("subject").alias("id"), "types", *values, *unset).select("id", "types", *spec.columns)

        return EntityView(rows_of(set(used)), used, frozenset(several), narrow=rows_of if self.stored is None else None)

    def typed(self, name: str) -> EntityView:
        """A view whose cells are (value, datatype, kind) as in the quads, nothing parsed."""
        spec = VIEWS[name]
        kind = F.when(F.col("object_kind") == "iri", F.lit("uri")).otherwise(F.col("object_kind"))
        cell = F.struct(F.col("object").alias("value"), "datatype", kind.alias("kind"))
        props = {c: prop for c, (prop, _) in spec.columns.items()}
        anchors = [props[anchor] for anchor in spec.anchors]

        def rows_of(columns: set[str]) -> DataFrame:
            read = {c: prop for c, prop in props.items() if c in columns}
            belongs = F.arrays_overlap("types", F.array(*map(F.lit, spec.classes))) if spec.classes else F.lit(False)
            for prop in anchors:
                belongs = belongs | (F.size(_values(prop)) > 0)
            rows = self._grouped(sorted({*read.values(), *anchors}), cell).filter(belongs)
            none = F.lit(None).cast("array<struct<value:string,datatype:string,kind:string>>")
            values = [(_values(props[c]) if c in read else none).alias(c) for c in props]
            return rows.select(F.col("subject").alias("id"), "types", *values)

        return EntityView(rows_of(set(props)), {}, frozenset(props), narrow=rows_of)

    def edge(self, name: str) -> DataFrame:
        spec = EDGES[name]
        return (
            self.quads.filter(local_name(F.col("predicate")) == spec.prop)
            .select(F.col("subject").alias(spec.subject), F.col("object").alias(spec.object))
            .distinct()
        )


def rejected_literals(quads: DataFrame) -> DataFrame:
    """property, value, n: the literals that aren't the number a view declares, on which a report would fail."""
    kinds: dict[str, set[str]] = {}
    for view in VIEWS.values():
        for prop, kind in view.columns.values():
            kinds.setdefault(prop, set()).add(kind)
    numbers = [prop for prop, found in kinds.items() if found & {NUMBER, INTEGER}]
    whole = [prop for prop in numbers if INTEGER in kinds[prop]]
    rows = quads.select(local_name(F.col("predicate")).alias("property"), F.col("object").alias("value"))
    parsed = F.when(F.col("property").isin(*whole), int_of("value").cast("double")).otherwise(double_of("value"))
    return rows.filter(F.col("property").isin(*numbers)).filter(parsed.isNull()).groupBy("property", "value").agg(F.count("*").alias("n"))


def view_quads(name: str, rows: DataFrame, graph: str) -> DataFrame:
    """The quads of one entity view: its classes and every bound column."""
    spec = VIEWS[name]

    def fact(predicate: str, value: Column, reference: bool) -> Column:
        return F.struct(
            F.lit(predicate).alias("predicate"),
            value.cast("string").alias("object"),
            F.lit("iri" if reference else "literal").alias("object_kind"),
        )

    facts = [
        fact(f"cim:{prop}", F.col(column), kind == REF)
        for column, (prop, kind) in spec.columns.items()
        if column in rows.columns
    ]
    subject = F.col("id").alias("subject")
    if "types" not in rows.columns:
        typed = F.array(*[fact("rdf:type", F.lit(CIM + c), True) for c in spec.classes[:1]])
        exploded = rows.select(subject, F.explode(F.concat(F.array(*facts), typed)).alias("fact"))
        return _as_quads(exploded.select("subject", "fact.*"), graph)
    # One more fact stands for all classes, which a second explode gives; both are compiled, as a lambda would not be.
    typed = F.struct(F.lit("rdf:type").alias("predicate"), F.lit(None).cast("string").alias("object"), F.lit("iri").alias("object_kind"))
    each = F.explode(F.array(*facts, typed)).alias("fact")
    exploded = rows.filter("types IS NOT NULL").select(subject, "types", each).select("subject", "types", "fact.*")
    is_type = F.col("predicate") == "rdf:type"
    value = F.explode(F.when(is_type, F.col("types")).otherwise(F.array("object"))).alias("value")
    whole = exploded.select("subject", "predicate", value, "object_kind")
    return _as_quads(whole.withColumn("object", F.when(is_type, F.concat(F.lit(CIM), "value")).otherwise(F.col("value"))), graph)


def edge_quads(name: str, rows: DataFrame, graph: str) -> DataFrame:
    spec = EDGES[name]
    kind = "literal" if spec.prop == "Model.profile" else "iri"
    pairs = rows.select(
        F.col(spec.subject).alias("subject"),
        F.lit(f"cim:{spec.prop}").alias("predicate"),
        F.col(spec.object).alias("object"),
        F.lit(kind).alias("object_kind"),
    )
    return _as_quads(pairs, graph)


def _as_quads(facts: DataFrame, graph: str) -> DataFrame:
    unset = F.lit(None).cast("string")
    return facts.filter("object IS NOT NULL").select(
        F.lit(graph).alias("graph"),
        "subject",
        "predicate",
        "object",
        "object_kind",
        unset.alias("datatype"),
        unset.alias("lang"),
    )
