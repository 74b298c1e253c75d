import pytest

from tests.grid import EQ, STATE, quads
from voltframe import GridModel


@pytest.fixture(scope="module", params=["one store", "two stores", "materialized", "stored", "bucketed"])
def model(spark, request, tmp_path_factory):
    eq, state = quads(spark, EQ, "urn:graph:EQ"), quads(spark, STATE, "urn:graph:SV")
    if request.param == "two stores":
        return GridModel.from_quads(eq, state)
    whole = GridModel.from_quads(eq.unionByName(state), materialize=request.param != "one store")
    if request.param == "stored":
        return whole.save(str(tmp_path_factory.mktemp("views")))
    if request.param == "bucketed":
        names = [n for n in whole.names() if n != "vocabulary"]
        return whole.save_buckets(str(tmp_path_factory.mktemp("grid")), 4, names)
    return whole


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_ac_lines(model):
    found = {r.mrid: r for r in model.ac_lines().collect()}
    assert set(found) == {"l1", "l2"}
    line = found["l1"]
    assert (line.ploss_1, line.ploss_2, line.rate, line.status, line.un) == (0.5, 0.0, 900.0, False, 420.0)
    assert (line.connectivity_node_1, line.connectivity_node_2, line.b, line.g, line.length) == ("cn1", "cn2", 3.0, None, 10.0)
    # One flow is missing, so the loss is unknown; the status falls back to the terminals.
    other = found["l2"]
    assert (other.ploss_1, other.ploss_2, other.rate, other.status, other.g) == (None, None, None, False, 4.0)


def test_region_needs_both_ends(model):
    assert model.ac_lines(region="NO").collect() == []
    assert rows(model.ac_lines(region="NO|SE"), "mrid") == [("l1",), ("l2",)]


def test_rate_parameter(model):
    assert rows(model.ac_lines(rate="Other@20"), "mrid", "rate")[0] == ("l1", 9000.0)


def test_transformer_branches(model):
    found = {r.mrid: r for r in model.transformer_branches().collect()}
    assert found["te1"].ratio == 1.0 and found["te1"].angle == 0.0
    assert found["te2"].ratio == 132.0 * (1 + (5 - 4) * 2.5 / 100.0) / 120.0 and found["te2"].angle == 150.0
    assert {r.ploss_2 for r in found.values()} == {3.0}
    assert {r.connectivity_node_2 for r in found.values()} == {"pt1"}


def test_switches_and_connections(model):
    expected = [("sw1", True, "Breaker", "cn1", "cn3", True), ("sw2", True, "Disconnector", "cn1", "cn1", False)]
    columns = ("mrid", "is_open", "equipment_type", "connectivity_node_1", "connectivity_node_2", "network_enabled")
    assert rows(model.switches(), *columns) == expected
    assert rows(model.connections(), "mrid", "t_mrid_1", "t_mrid_2") == [("sw1", "s11", "s12")]


def test_associated_switches_keep_two_sided_only(model):
    found = {r.mrid: r.switch_mrids for r in model.associated_switches().collect()}
    # The transformer meets the switch at both of its nodes.
    assert found == {"l1": "sw1", "l2": "sw1", "l3": "sw1", "ld1": "sw1", "gm1": "sw1", "pt1": "sw1,sw1"}


def test_bus_data(model):
    assert rows(model.topological_nodes(), "node", "island", "is_swing_bus", "sv_voltage") == [
        ("tn1", "Main", False, 410.0),
        ("tn2", "Main", True, 0.0),
    ]
    assert rows(model.base_voltage(), "mrid", "operating_voltage") == [("bv1", 410.0)]


def test_loads_and_machines(model):
    assert rows(model.loads(), "mrid", "status", "p", "station_group", "load_type") == [("ld1", True, 7.0, None, "NonConformLoad")]
    machine = model.synchronous_machines().collect()
    # Without a direct class the unit stays unknown, so the limits come from the flow.
    assert [(r.mrid, r.max_p, r.min_p, r.generator_type, r.afrr_prequalified) for r in machine] == [("gm1", 0.0, -20.0, "unknown", False)]


def test_branch_withdraw_and_deviation(model):
    assert rows(model.branch_node_withdraw(), "mrid", "node", "p") == [("p1", "tn1", 6.0), ("t11", "tn1", -9.5), ("t12", "tn2", 10.0), ("t21", "tn1", 3.0)]
    # Only named terminals count: T11 and T21 meet at the node with a reported injection.
    assert rows(model.sv_power_deviation(), "node", "sum_terminal_flow", "reported_sv_injection", "terminal_names") == [
        ("tn1", -6.5, 4.0, "T11,T21")
    ]


def test_dc_active_flow_sign(model):
    assert rows(model.dc_active_flow(), "mrid", "p") == [("te1", 6.0)]


def test_borders_leave_out_hvdc(model):
    assert rows(model.borders(), "mrid", "area_1", "area_2") == [("l1", "NO", "SE")]
    assert rows(model.exchange(region="NO"), "mrid", "node", "status", "p") == [("l1", "tn1", False, -9.5)]
    assert model.exchange(region="SE").collect() == []
    assert rows(model.exchange(region="SE", strict_intent=True), "mrid") == [("l1",)]
    assert model.exchange().collect() == []


def test_voltage_levels(model):
    assert rows(model.substation_voltage_level(), "substation", "container", "v") == [("ss1", "vl1", 420.0), ("ss2", "vl2", 420.0)]


def test_disconnected(model):
    assert rows(model.disconnected(), "mrid") == [("t22",)]


def test_schema_checks(model):
    found = {(r.rule, r.column): r.violations for r in model.check("ac_lines").collect()}
    assert found[("unique", "mrid")] == 0 and set(found.values()) == {0}


def test_subject_with_a_class_only(spark):
    store = quads(spark, "x a Breaker\ny a PowerTransformer\nx a Switch", "urn:graph:EQ")
    for materialize in (False, True):
        grid = GridModel.from_quads(store, materialize=materialize)
        assert [(r.id, r.types) for r in grid["power_transformer"].collect()] == [("y", ["PowerTransformer"])]


def test_mappers_strip_identifiers_before_and_after_joins(spark):
    from voltframe.operators.validate import strip_iris

    text = EQ.replace('IdentifiedObject.mRID "', 'IdentifiedObject.mRID "http://m#_')
    text += "pc2 a PhaseTapChangerLinear; PhaseTapChangerLinear.stepPhaseShiftIncrement \"1.5\"; TapChanger.neutralStep \"3\"; TapChanger.step \"5\"\n"
    text += "te2 a PowerTransformerEnd; TransformerEnd.PhaseTapChanger pc2\n"
    store = quads(spark, text, "urn:graph:EQ").unionByName(quads(spark, STATE, "urn:graph:SV"))
    grid = GridModel.from_quads(store, mappers=[strip_iris], materialize=True)
    found = {r.mrid: (r.angle, r.ploss_2) for r in grid.transformer_branches(strict_intent=True).collect()}
    assert found == {"te1": (0.0, 3.0), "te2": (3.0, 3.0)}
    assert rows(grid.winding_angle(), "mrid", "angle") == [("te2", 3.0)]
    assert rows(grid.winding_loss(), "mrid", "ploss_2") == [("pt1", 3.0)]
