"""The reports, by topic."""

from voltframe.plans.branches import (
    ac_lines,
    phase_tap_changer,
    series_compensators,
    sv_branch,
    transformer_branches,
    transformer_windings,
    transformers,
    winding_angle,
    winding_loss,
    windings,
)
from voltframe.plans.direct_current import (
    converters,
    dc_controllers,
    hvdc,
    hvdc_converter_bidzones,
    transformers_connected_to_converter,
)
from voltframe.plans.injections import (
    branch_node_withdraw,
    dc_active_flow,
    loads,
    powerflow,
    sv_injection,
    sv_power_deviation,
    synchronous_machines,
    wind_generating_units,
)
from voltframe.plans.market import (
    borders,
    exchange,
    full_model,
    gen_unit_and_sync_machine_mrid,
    market_dates,
    ras_equipment,
    regions,
    repeated_station_groups,
    station_group_codes_and_names,
    station_group_for_power_unit,
    type_map,
)
from voltframe.plans.nodes import (
    associated_switches,
    base_voltage,
    bus_data,
    busbar_section,
    connections,
    connectivity_nodes,
    coordinates,
    disconnected,
    substation_voltage_level,
    switches,
    topological_nodes,
    transformer_center_nodes,
)

REPORTS = {
    f.__name__: f
    for f in (
        ac_lines, associated_switches, base_voltage, borders, branch_node_withdraw, bus_data, busbar_section,
        connections, connectivity_nodes, converters, coordinates, dc_active_flow, dc_controllers, disconnected,
        exchange, full_model, gen_unit_and_sync_machine_mrid, hvdc, hvdc_converter_bidzones, loads, market_dates,
        phase_tap_changer, powerflow, ras_equipment, regions, repeated_station_groups, series_compensators,
        station_group_codes_and_names, station_group_for_power_unit, substation_voltage_level, sv_branch,
        sv_injection, sv_power_deviation, switches, synchronous_machines, topological_nodes,
        transformer_branches, transformer_center_nodes, transformer_windings, transformers,
        transformers_connected_to_converter, type_map, wind_generating_units, winding_angle, winding_loss, windings,
    )
}
__all__ = [*REPORTS, "REPORTS"]
