"""Plans and jobs that must not grow faster than the rows they read."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalog import reports
from tests.grid import CIM
from voltframe import GridModel
from voltframe.operators.enrich import adapt
from voltframe.sources.star import star_model

TERMINAL = (
    "id string, types array<string>, mrid string, name string, equipment string, node string, topological_node string, "
    "sequence_number int, terminal_sequence_number int, connected boolean, terminal_connected boolean"
)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_pairs_of_converters_do_not_travel(spark):
    ends, converters, lines = [], [], []

    def end(equipment, nr, node):
        ends.append((f"{equipment}-{nr}-{node}", ["Terminal"], None, None, equipment, node, None, nr, None, True, None))

    for c in range(6):
        converters.append((f"c{c}", ["VoltageSourceConverter"], f"m{c}"))
        end(f"c{c}", 1, f"n{c % 3}")
        if c < 2:
            end(f"c{c}", 2, "n1")
    for k, (a, b) in enumerate([(0, 1), (0, 1), (0, 2), (1, 1), (2, 0)]):
        lines.append((f"l{k}", ["DCLineSegment"], f"L{k}", float(k + 1)))
        end(f"l{k}", 1, f"n{a}")
        end(f"l{k}", 2, f"n{b}")
    model = GridModel({
        "terminal": spark.createDataFrame(ends, TERMINAL),
        "converter": spark.createDataFrame(converters, "id string, types array<string>, mrid string"),
        "dc_line": spark.createDataFrame(lines, "id string, types array<string>, name string, resistance double"),
    })
    at = Counter((e[5], f"m{e[4][1:]}") for e in ends if e[4].startswith("c"))
    wanted = {}
    for name, _, text, r in lines:
        nodes = {e[7]: e[5] for e in ends if e[4] == name}
        for (n, first), t1 in at.items():
            for (o, second), t2 in at.items():
                if (n, o) == (nodes[1], nodes[2]):
                    names, total = wanted.get((first, second), ([], 0.0))
                    wanted[first, second] = (names + [text] * (t1 * t2), total + r * t1 * t2)
    wanted = {(*key, "--".join(sorted(names)), r) for key, (names, r) in wanted.items() if len(names) > 1}
    found = model.hvdc()
    assert {(r.converter_mrid_1, r.converter_mrid_2, r["name"], r.r) for r in found.collect()} == wanted and wanted
    plan = physical(model.hvdc())
    assert "hashpartitioning(hash" not in plan and plan.count("hashpartitioning(converter_mrid_1") == 1


def store(spark):
    """Three lines with names, two of one value each and one of two."""
    rows = [(f"l{k}", p, o) for k in range(3) for p, o in (("rdf:type", CIM + "ACLineSegment"), ("cim:ACLineSegment.r", str(k)), ("cim:IdentifiedObject.name", f"L{k}"))]
    rows += [("l2", "cim:IdentifiedObject.name", "second")] * 2
    schema = "graph string, subject string, predicate string, object string, object_kind string, datatype string, lang string"
    return spark.createDataFrame([("urn:EQ", s, p, o, "iri" if p == "rdf:type" else "literal", None, None) for s, p, o in rows], schema)


def test_quads_of_a_view_are_exchanged_once_and_only_what_is_selected(spark):
    rows = GridModel.from_quads(store(spark))["ac_line"].select("id", "name")
    assert sorted(map(tuple, rows.collect())) == [("l0", "L0"), ("l1", "L1"), ("l2", "L2"), ("l2", "second")]
    plan = physical(rows)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "IdentifiedObject.name" in plan and "Conductor.length" not in plan


def test_rows_with_typed_cells_are_grouped_once(spark):
    model = GridModel.from_quads(store(spark))
    done = model.query(model.typed("ac_line").select("id", "r"))
    assert sorted(r.id for r in done.collect()) == ["l0", "l1", "l2"]
    assert "ObjectHashAggregate" not in physical(done)
    ordered = model.query(model.typed("ac_line").select("id", "r").orderBy(F.desc("id")))
    assert [r.id for r in ordered.collect()] == ["l2", "l1", "l0"]


def test_enrichment_reads_its_quads_once(spark):
    quads = store(spark)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    found = adapt(quads.mapInPandas(counted, quads.schema))
    assert found.filter("predicate = 'cim:IdentifiedObject.mRID'").count() == 3
    assert read.value == quads.count()


@pytest.mark.parametrize("name", sorted(reports.GROUPED_ONCE))
def test_line_items_are_grouped_once_for_a_report(spark, tmp_path, name):
    """Each view of the report grouped and shuffled all line items again, six times."""
    date = "timestamp '1998-02-03'"
    rows = {
        "region": "SELECT CAST(id AS int) AS r_regionkey, 'A' || id AS r_name FROM range(5)",
        "nation": "SELECT CAST(id AS int) AS n_nationkey, 'N' || id AS n_name, CAST(id % 5 AS int) AS n_regionkey FROM range(25)",
        "supplier": "SELECT id AS s_suppkey, 'S' || id AS s_name, CAST(id % 25 AS int) AS s_nationkey, 5000D AS s_acctbal FROM range(4)",
        "part": "SELECT id AS p_partkey, 'P' || id AS p_name, 'Brand#2' AS p_brand, 'SMALL' AS p_type, 7 AS p_size, 900D AS p_retailprice FROM range(9)",
        "customer": "SELECT id AS c_custkey, 'C' || id AS c_name, CAST(id % 25 AS int) AS c_nationkey, 1D AS c_acctbal, 'M' AS c_mktsegment FROM range(12)",
        "orders": f"SELECT id AS o_orderkey, id AS o_custkey, 'F' AS o_orderstatus, 10D AS o_totalprice, {date} AS o_orderdate, '2-HIGH' AS o_orderpriority FROM range(12)",
        "lineitem": "SELECT o.id AS l_orderkey, o.id % 9 AS l_partkey, 1L AS l_suppkey, CAST(n.id + 1 AS int) AS l_linenumber, 9D AS l_quantity, 60000D AS l_extendedprice, 0D AS l_discount, 0.1D AS l_tax, 'A' AS l_returnflag, 'O' AS l_linestatus FROM range(12) o, range(3) n",
    }
    for table, sql in rows.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{table}.parquet")
    found = reports.QUERIES[f"report_{name}"](spark, str(tmp_path))
    assert "lineitem.parquet" not in " ".join(found.inputFiles())
    plain = star_model(spark, str(tmp_path)).report(name)
    assert sorted(map(str, found.collect())) == sorted(map(str, reports.rounded(plain, reports.ROUNDED.get(name, {})).collect())) != []
