"""Declared schema of every report: types, nullability, key and value rules."""

from __future__ import annotations

from voltframe.operators.validate import Field, Schema

TEXT, REAL, WHOLE, FLAG, TIME = "string", "double", "bigint", "boolean", "timestamp_ntz"


def _fields(kind: str, names: str, nullable: bool = False) -> dict[str, Field]:
    return {name: Field(kind, nullable) for name in names.split()}


def schema(
    text: str = "", real: str = "", whole: str = "", flag: str = "", time: str = "",
    text_or_null: str = "", real_or_null: str = "", unique: tuple[str, ...] = (), **rules: Field,
) -> Schema:
    fields = _fields(TEXT, text) | _fields(REAL, real) | _fields(WHOLE, whole) | _fields(FLAG, flag) | _fields(TIME, time)
    fields |= _fields(TEXT, text_or_null, True) | _fields(REAL, real_or_null, True)
    return Schema(fields | rules, unique)


_BUS = dict(
    text="node busname substation substation_mrid island base_voltage_mrid",
    real="un sv_voltage",
    flag="is_swing_bus",
    text_or_null="bidzone",
    unique=("node",),
)
_BRANCH = dict(
    text="mrid name connectivity_node_1 connectivity_node_2",
    flag="status",
    real_or_null="ploss_1 ploss_2 rate",
    unique=("mrid",),
)
LOAD_TYPES = ("ConformLoad", "NonConformLoad", "EnergyConsumer")

SCHEMAS: dict[str, Schema] = {
    "full_model": schema(text="model time profile version description"),
    "market_dates": schema(text="mrid name", time="activation_date", unique=("mrid",)),
    "bus_data": schema(**_BUS),
    "transformer_center_nodes": schema(**_BUS),
    "loads": schema(
        text="mrid name substation_mrid connectivity_node",
        flag="status",
        real_or_null="p q",
        text_or_null="station_group",
        unique=("mrid",),
        load_type=Field(TEXT, isin=LOAD_TYPES),
    ),
    "wind_generating_units": schema(
        text="mrid name", real="min_p max_p", text_or_null="market_code station_group plant_mrid", unique=("mrid",)
    ),
    "synchronous_machines": schema(
        text="mrid name substation_mrid connectivity_node generator_type",
        real="max_p min_p sn",
        flag="status afrr_prequalified",
        real_or_null="merit_order p q",
        text_or_null="market_code station_group station_group_name storage_type schedule_resource",
        unique=("mrid",),
    ),
    "connections": schema(text="mrid t_mrid_1 t_mrid_2", unique=("mrid",)),
    "borders": schema(text="mrid name area_1 area_2 t_mrid_1 t_mrid_2", text_or_null="market_code", unique=("mrid",)),
    "exchange": schema(text="mrid name node", real="p", flag="status", text_or_null="market_code", unique=("mrid",)),
    "phase_tap_changer": schema(
        text="mrid mode monitored_winding",
        real="phase_shift_increment target_value",
        whole="neutral_step high_step low_step",
        flag="enabled",
    ),
    "converters": schema(
        text="mrid name substation_mrid connectivity_node controller",
        real="p q controller_factor pole_loss loss0 loss1 loss2 vdcn un",
        flag="status",
        text_or_null="alias",
        unique=("mrid",),
    ),
    "transformers_connected_to_converter": schema(text="mrid name t_mrid p_mrid", unique=("mrid",)),
    "coordinates": schema(text="mrid epsg rdf_type", real="x y"),
    "ac_lines": schema(**_BRANCH | {"real": "r un x b length", "real_or_null": "ploss_1 ploss_2 rate g"}),
    "series_compensators": schema(**_BRANCH | {"real": "r un x"}),
    "transformers": schema(text="name p_mrid w_mrid t_mrid", real="un r x", whole="end_number", real_or_null="rate"),
    "transformer_branches": schema(**_BRANCH | {"real": "r un x b g angle ratio"}),
    "substation_voltage_level": schema(text="substation container", real="v"),
    "disconnected": schema(text="mrid", unique=("mrid",)),
    "powerflow": schema(text="mrid", real="p q", flag="in_service", unique=("mrid",)),
    "branch_node_withdraw": schema(text="mrid node", real="p q", unique=("mrid",)),
    "dc_active_flow": schema(text="mrid", real="p", unique=("mrid",)),
    "regions": schema(text="mrid region name", text_or_null="short_name alias_name region_name", unique=("mrid",)),
    "station_group_codes_and_names": schema(
        text="station_group name", text_or_null="alias_name", unique=("station_group",)
    ),
    "hvdc_converter_bidzones": schema(text="mrid bidzone_1 bidzone_2", unique=("mrid",)),
    "transformer_windings": schema(text="mrid w_mrid", unique=("w_mrid",), end_number=Field(WHOLE, above=0)),
    "sv_injection": schema(text="node", real="p q", unique=("node",)),
    "ras_equipment": schema(text="mrid equipment_mrid name collection", flag="flip", unique=("mrid",)),
    "dc_controllers": schema(text="mrid name", real="max_p min_p", unique=("mrid",)),
    "switches": schema(
        text="mrid equipment_type connectivity_node_1 connectivity_node_2 name", flag="is_open network_enabled", unique=("mrid",)
    ),
    "connectivity_nodes": schema(
        text="mrid container container_name container_type base_voltage_mrid",
        real_or_null="un",
        text_or_null="bidzone",
        unique=("mrid",),
    ),
    "sv_power_deviation": schema(
        text="node connectivity_nodes terminal_names", real="sum_terminal_flow reported_sv_injection", unique=("node",)
    ),
    "hvdc": schema(text="converter_mrid_1 converter_mrid_2 name", r=Field(REAL, least=0)),
    "base_voltage": schema(text="mrid", real="un operating_voltage", unique=("mrid",)),
    "associated_switches": schema(text="mrid name switch_mrids switch_names", unique=("mrid",)),
    "gen_unit_and_sync_machine_mrid": schema(
        text="gen_unit_mrid sync_machine_mrid", unique=("gen_unit_mrid", "sync_machine_mrid")
    ),
    "station_group_for_power_unit": schema(
        text="power_system_model_mrid market_unit_mrid resource_name market_code", unique=("power_system_model_mrid",)
    ),
    "busbar_section": schema(text="mrid busbar_mrid", whole="terminal_count", unique=("mrid",)),
}
