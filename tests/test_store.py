"""A quad store: graphs loaded again, look-ups that open little, hot terms."""

import re

import pytest
from pyspark.sql import functions as F

from voltframe import GridModel
from voltframe.operators import enrich
from voltframe.sources import quads as q
from voltframe.sources.store import QuadStore
from tests.grid import EQ, STATE, quads

COLUMNS = "graph string, subject string, predicate string, object string, object_kind string, datatype string, lang string"


def many(spark, n=40_000):
    """A third of all quads of one subject, a third with one object, over three graphs."""
    subject = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5000))
    object_ = F.when(F.col("id") % 3 == 1, "class").otherwise(F.concat(F.lit("o"), "id"))
    return spark.range(n).select(
        F.concat(F.lit("urn:graph:"), F.col("id") % 2).alias("graph"),
        subject.alias("subject"),
        F.concat(F.lit("p"), F.col("id") % 4).alias("predicate"),
        object_.alias("object"),
        F.when(F.col("id") % 5 == 0, "literal").otherwise("iri").alias("object_kind"),
        F.lit(None).cast("string").alias("datatype"),
        F.lit(None).cast("string").alias("lang"),
    )


def rows(df):
    return sorted(df.select(*q.QUAD_COLUMNS).collect(), key=str)


def read(df):
    """Files opened and rows produced by the scans of a query."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(k) for k in range(leaves.size())]
    return tuple(sum(scan.metrics().apply(name).value() for scan in scans) for name in ("numFiles", "numOutputRows"))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    built = QuadStore(spark, str(tmp_path_factory.mktemp("store")), buckets=16)
    built.load(many(spark))
    return built


def test_a_store_holds_what_was_loaded_and_finds_it(spark, store):
    whole = many(spark)
    assert rows(store.quads()) == rows(whole)
    for terms in ({"subject": "s17"}, {"subject": "hot", "predicate": "p2"}, {"object": "o5"}, {"graph": "urn:graph:1", "subject": "s4"}, {"subject": "none"}):
        assert rows(store.scan(**terms)) == rows(q.scan(whole, **terms)), terms
    links = whole.filter("object_kind <> 'literal'")
    assert rows(store.links_to("class")) == rows(q.scan(links, object="class"))
    # o5 is a literal: found by a scan, never as a link.
    assert store.scan(object="o5").count() == 1 and store.links_to("o5").count() == 0


def test_look_ups_open_one_bucket_of_sixteen(store):
    files, produced = read(store.quads())
    assert files >= 16 and produced >= 40_000
    for found in (store.scan(subject="s17"), store.links_to("o7")):
        text = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = \d+", text)
        opened, some = read(found)
        assert opened <= files // 8 and some < produced / 4


def test_bloom_filters_skip_row_groups_of_the_other_end(spark, store):
    """No object is sorted in this copy, and no bucket is known: only bloom filters can leave out row groups."""
    _, all_rows = read(store.quads())
    _, some = read(store.scan(object="o39998"))
    assert some < all_rows / 4
    assert read(store.scan(object="never"))[1] < all_rows / 10


def test_a_graph_is_replaced_whole_and_twice_is_once(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "quads"), buckets=4)
    first = [(g, f"s{k}", "p", f"o{k}", kind, None, None) for g in ("a", "b", None) for k in range(20) for kind in ("iri", "literal")]
    store.load(spark.createDataFrame(first, COLUMNS))
    assert rows(store.quads()) == rows(spark.createDataFrame(first, COLUMNS))
    # Most buckets of graph a become empty, and it has no links any more.
    again = spark.createDataFrame([("a", "new", "p", "text", "literal", None, None)], COLUMNS)
    for _ in range(2):
        store.load(again)
        assert rows(store.quads()) == rows(again.union(spark.createDataFrame([r for r in first if r[0] != "a"], COLUMNS)))
        assert {r.graph for r in store.links_to("o3").collect()} == {"b", None}
    store.load(spark.createDataFrame(first, COLUMNS), graphs=["a"])
    assert rows(store.quads()) == rows(spark.createDataFrame(first, COLUMNS))
    store.empty(["b", "unknown"])
    assert {r.graph for r in store.quads().select("graph").collect()} == {"a", None}
    assert store.links_to("o3").count() == 2


def test_a_graph_can_be_loaded_from_the_store_itself(spark, tmp_path):
    """Reports run over a store, and its own enriched quads can be loaded as a graph of their own."""
    store = QuadStore(spark, str(tmp_path / "quads"), buckets=4)
    store.load(quads(spark, EQ, "urn:graph:EQ").unionByName(quads(spark, STATE, "urn:graph:SV")))
    before = GridModel.from_quads(store.quads()).loads().count()
    store.load(q.into_graph(enrich.direct_types(store.quads()), "urn:graph:types"))
    assert store.scan(graph="urn:graph:types").count() == store.scan(predicate="rdf:type").select("subject").distinct().count()
    assert GridModel.from_quads(store.quads()).loads().count() == before


def test_first_graph_and_class_by_hash_aggregates_without_a_sort(spark):
    """One quad per subject, equipment graphs first; a hot subject is combined before the exchange."""
    whole = many(spark)
    typed = whole.withColumn("predicate", F.lit("rdf:type")).withColumn("graph", F.when(F.col("object") < "o2", "urn:EQ").otherwise("urn:SV"))
    types, ids = enrich.direct_types(typed), enrich.missing_mrids(typed)
    for found in (types, ids):
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in text and text.count("HashAggregate") >= 2
    best = {}
    for r in typed.collect():
        rank = ("EQ" not in r.graph, r.object)
        best[r.subject] = min(best.get(r.subject, (rank, r.graph)), (rank, r.graph))
    assert {r.subject: (r.object, r.graph) for r in types.collect()} == {s: (rank[1], graph) for s, (rank, graph) in best.items()}
    assert {r.subject: r.graph for r in ids.collect()} == {s: graph for s, (_, graph) in best.items()}
    known = typed.limit(1).withColumn("subject", F.lit("hot")).withColumn("predicate", F.lit("cim:IdentifiedObject.mRID"))
    left = {r.subject for r in enrich.missing_mrids(typed.unionByName(known)).collect()}
    assert left == set(best) - {"hot"}
