from pyspark.sql import functions as F

from voltframe import GridModel
from voltframe.operators import aggregates as agg
from voltframe.operators import joins, validate
from voltframe.operators.validate import Field, Schema
from voltframe.sources.quads import QUAD_SCHEMA


def test_violations_and_coercion(spark):
    rows = spark.createDataFrame([("a", "1"), ("a", "0"), (None, "x"), ("b", None)], "mrid string, n string")
    schema = Schema({"mrid": Field("string", isin=("a",)), "n": Field("bigint", above=0)}, unique=("mrid",))
    assert {(r.column, r.violations) for r in validate.failed_casts(rows, schema).collect()} == {("n", 1)}
    done = validate.coerce(rows, schema)
    assert dict(done.dtypes)["n"] == "bigint"
    found = {(r.rule, r.column): r.violations for r in validate.violations(done, schema).collect()}
    assert found == {("not_null", "mrid"): 1, ("isin", "mrid"): 1, ("not_null", "n"): 2, ("gt", "n"): 1, ("unique", "mrid"): 1}


def test_coerce_without_rows(spark):
    empty = spark.createDataFrame([], "v string")
    assert validate.coerce(empty, Schema({"v": Field("double")})).dtypes == [("v", "double")]


def test_convert_keeps_unknown_types(spark):
    rows = spark.createDataFrame([("1.0", "true", "2", None)], "angle string, on string, n string, t string")
    kinds = {"angle": "own:Degrees", "on": "own:Status", "n": "nowhere", "t": "literal"}
    known = validate.casters({"own:Degrees": "cim:Float", "own:Text": "unknown"}, {"own:Status": lambda c: c == "true"})
    assert validate.convert(rows, kinds, known).first().asDict() == {"angle": 1.0, "on": True, "n": "2", "t": None}


def test_datatypes_of_sparse_columns(spark):
    rows = spark.range(3).selectExpr(
        "named_struct('value', '1', 'datatype', IF(id = 2, 'xsd:integer', NULL), 'kind', IF(id = 2, 'literal', NULL)) AS a",
        "named_struct('value', 'u', 'datatype', CAST(NULL AS STRING), 'kind', 'uri') AS b",
    )
    assert validate.datatypes_of(rows, ["a", "b"]).first().asDict() == {"a": "xsd:integer", "b": "uri"}


def test_best_per_key_on_a_hot_key(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("double").alias("p"),
        F.lit(1).alias("d"),
    )
    best = agg.best_per_key(rows, "k", "p", "d")
    assert best.filter("k = 'hot'").first().p == 19999.0
    nan = spark.createDataFrame([("a", float("nan"), 1), ("a", 2.0, 3), ("b", None, 4)], "k string, p double, d int")
    assert [tuple(r) for r in agg.best_per_key(nan, "k", "p", "d").collect()] == [("a", 2.0, 3)]


def test_first_and_repeated(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, n int, t string")
    assert sorted(map(tuple, agg.first_per_key(rows, ["k"], ["n"]).collect())) == [("a", 1, "y"), ("b", 5, None)]
    assert agg.repeated_keys(rows, ["k"]).count() == 2


def test_walk_keeps_duplicates(spark):
    start = spark.createDataFrame([("s", "a")], "id string, at string")
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", None)], "f string, t string")
    end = spark.createDataFrame([("b", "z")], "f string, t string")
    path = joins.walk(start, (edges, "f", "t"), (end, "f", "t"))
    assert [r[path.columns[-1]] for r in path.collect()] == ["z", "z"]


def test_options(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    assert validate.options(rows, distinct=True).count() == 2
    assert validate.options(rows.orderBy("v"), offset=2, limit=5).collect()[0].v == 2


def test_vocabulary_drives_conversion(spark):
    cims, rdfs = "cims:", "rdfs:"
    cim = "http://iec.ch/TC57/2013/CIM-schema-cim16#"
    facts = [
        ("p1", rdfs + "domain", cim + "Power", "iri", None),
        ("p1", cims + "dataType", cim + "ActivePower", "iri", None),
        (cim + "ActivePower", cims + "stereotype", "CIMDatatype", "literal", None),
        ("v", rdfs + "domain", cim + "ActivePower", "iri", None),
        ("v", rdfs + "label", "value", "literal", "en"),
        ("v", cims + "dataType", cim + "Float", "iri", None),
        ("p2", rdfs + "domain", cim + "Switch", "iri", None),
        ("p2", cims + "dataType", cim + "Boolean", "iri", None),
        (cim + "Boolean", cims + "stereotype", "Primitive", "literal", None),
    ]
    rows = [("urn:g", s, p, o, k, None, lang) for s, p, o, k, lang in facts]
    ranges = validate.vocabulary_ranges(GridModel.from_quads(spark.createDataFrame(rows, QUAD_SCHEMA)).type_map())
    assert ranges == {"cim:Power": "cim:Float", "cim:Switch": "cim:Boolean"}
    table = spark.createDataFrame([("1.5", "false")], "p string, open string")
    done = validate.convert(table, {"p": "cim:Power", "open": "cim:Switch"}, validate.casters(ranges))
    assert done.first().asDict() == {"p": 1.5, "open": False}
