"""Neighbour reports against brute force over pairs of terminals, on random grids with shared nodes."""

import random
from collections import Counter, defaultdict

import pytest

from tests.grid import quads
from voltframe import GridModel

TERMINAL = "id string, types array<string>, mrid string, name string, equipment string, node string, topological_node string, sequence_number int, terminal_sequence_number int, connected boolean, terminal_connected boolean"


@pytest.fixture(scope="module", params=[1, 2, 3])
def grid(spark, request):
    rnd = random.Random(request.param)
    kinds = ["converter"] * 4 + ["line"] * 6 + ["switch"] * 5 + ["busbar"] * 3 + ["load"] * 4
    equipment = [(f"{kind}{i}", kind) for i, kind in enumerate(kinds)]
    ends = []
    for name, _ in equipment:
        for nr in range(1, rnd.choice([1, 2, 2, 3]) + 1):
            ends.append((name, f"n{rnd.randrange(5)}", nr))
    terminal = [(f"t{i}", ["Terminal"], f"t{i}", f"T{i}", e, n, None, nr, None, True, None) for i, (e, n, nr) in enumerate(ends)]
    classes = {"converter": "VoltageSourceConverter", "line": "DCLineSegment", "switch": "Breaker", "busbar": "BusbarSection", "load": "EnergyConsumer"}

    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    views = {
        "terminal": table(terminal, TERMINAL),
        "equipment": table(
            [(e, [classes[k]], e, e.upper(), False if k == "switch" else None) for e, k in equipment],
            "id string, types array<string>, mrid string, name string, normal_open boolean",
        ),
        "switch": table([(e, e, e.upper(), False) for e, k in equipment if k == "switch"], "id string, mrid string, name string, normal_open boolean"),
        "converter": table([(e, ["VoltageSourceConverter"], e) for e, k in equipment if k == "converter"], "id string, types array<string>, mrid string"),
        "dc_line": table([(e, ["DCLineSegment"], e.upper(), 1.5) for e, k in equipment if k == "line"], "id string, types array<string>, name string, resistance double"),
        "connectivity_node": table([(f"n{i}", f"n{i}") for i in range(5)], "id string, mrid string"),
    }
    return GridModel(views), dict(equipment), ends


def test_associated_switches(grid):
    model, kind, ends = grid
    expected = defaultdict(list)
    two_sided = Counter(e for e, _, nr in ends if nr == 2)
    for e, n, _ in ends:
        for other, m, _ in ends:
            if kind[e] != "switch" and kind[other] == "switch" and n == m:
                expected[e] += [other] * two_sided[other]
    found = {r.mrid: r.switch_mrids for r in model.associated_switches().collect()}
    assert found == {e: ",".join(sorted(s)) for e, s in expected.items() if s}


def test_hvdc(grid):
    model, kind, ends = grid
    expected = defaultdict(list)
    for line, n1, nr1 in ends:
        for same, n2, nr2 in ends:
            if kind[line] == "line" and same == line and nr1 == 1 and nr2 == 2:
                for c1, m1, _ in ends:
                    for c2, m2, _ in ends:
                        if kind[c1] == kind[c2] == "converter" and m1 == n1 and m2 == n2:
                            expected[c1, c2].append(line.upper())
    wanted = {pair: ("--".join(sorted(names)), 1.5 * len(names)) for pair, names in expected.items() if len(names) > 1}
    found = {(r.converter_mrid_1, r.converter_mrid_2): (r.name, r.r) for r in model.hvdc().collect()}
    assert found == wanted


def test_busbars(grid):
    model, kind, ends = grid
    at_node = Counter(n for _, n, _ in ends)
    total = Counter()
    for e, n, _ in ends:
        total[e] += at_node[n]
    expected = Counter((n, e, total[e]) for e, n, _ in ends if kind[e] == "busbar")
    assert Counter((r.mrid, r.busbar_mrid, r.terminal_count) for r in model.busbar_section().collect()) == expected


def test_full_model_needs_all_dependencies(spark):
    eq = """eq1 a FullModel; Model.created "c1"; Model.description "EQ"
eq2 a FullModel; Model.description "never created\""""
    state = """sv1 a FullModel; Model.created "c"; Model.scenarioTime "t"; Model.version "3"; Model.description "SV"; Model.profile "p1"; Model.profile "p2"; Model.DependentOn eq1; Model.DependentOn tp1
tp1 a FullModel; Model.created "c"; Model.scenarioTime "t"; Model.version "1"; Model.description "TP"; Model.profile "p"; Model.DependentOn eq2
ss1 a FullModel; Model.created "c"; Model.scenarioTime "t"; Model.version "1"; Model.description "no dependency"; Model.profile "p\""""
    model = GridModel.from_quads(quads(spark, eq, "urn:graph:EQ"), quads(spark, state, "urn:graph:SV"))
    found = sorted((r.model, r.time, r.profile, r.version) for r in model.full_model().collect())
    assert found == [
        ("eq1", "c1", "http://entsoe.eu/CIM/EquipmentCore/3/1", ""),
        ("sv1", "t", "p1", "3"),
        ("sv1", "t", "p2", "3"),
    ]
