"""Quads in files that are re-loaded graph by graph and looked up from either end.

Two copies are kept: all quads in buckets of their subject, and the links (quads whose object is a node) in buckets of
their object. Inside a bucket's folder of a graph rows are sorted by that end and carry Parquet bloom filters, so a
look-up opens one bucket and reads the row groups that can hold the term; the other end and a literal have the bloom
filters alone.

A load replaces exactly the graphs it brings, by dynamic partition overwrite. Every graph of a load has a marker row (no
subject) in each bucket, so that a bucket that became empty is replaced too, and so that a graph can be emptied. A
load that fails or is repeated is run again with the same outcome; the two copies are written one after the other, by
two jobs.

A graph that holds a third of all quads, or a node that a third of them link to (a class), is spread over many files of
its folder by the rebalancing exchange. Choose `buckets` so that a bucket of a large graph is some hundred megabytes.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.sources.quads import QUAD_COLUMNS, in_graphs, scan

SCHEMA = ", ".join(f"{c} string" for c in QUAD_COLUMNS if c != "graph") + ", bucket int, graph string"


@dataclass(frozen=True)
class QuadStore:
    spark: SparkSession
    folder: str
    buckets: int = 64

    def load(self, quads: DataFrame, graphs: Iterable[str] | None = None) -> None:
        """Replace the graphs of `quads`; with `graphs` those, also the ones that `quads` has no rows of."""
        named = None if graphs is None else list(graphs)
        rows = in_graphs(quads.select(*QUAD_COLUMNS), named)
        found = rows.select("graph").distinct()
        if named is not None:
            found = found.union(self.spark.createDataFrame([(name,) for name in named], "graph string")).distinct()
        self._replace(rows, "subject", found)
        self._replace(rows.filter("object_kind <> 'literal'"), "object", found)

    def empty(self, graphs: Iterable[str]) -> None:
        """Take out all quads of some graphs."""
        self.load(self.spark.createDataFrame([], SCHEMA), graphs)

    def quads(self) -> DataFrame:
        return self._copy("subject").select(*QUAD_COLUMNS)

    def scan(self, subject: str | None = None, predicate: str | None = None, object: str | None = None, graph: str | None = None) -> DataFrame:  # noqa: A002
        """As `quads.scan`; a given subject opens one bucket."""
        copy = self._copy("subject")
        if subject is not None:
            copy = copy.filter(F.col("bucket") == self._bucket(F.lit(subject)))
        return scan(copy, subject, predicate, object, graph).select(*QUAD_COLUMNS)

    def links_to(self, node: str, predicate: str | None = None, graph: str | None = None) -> DataFrame:
        """The quads whose object is the node (never a literal of the same text); opens one bucket."""
        copy = self._copy("object").filter(F.col("bucket") == self._bucket(F.lit(node)))
        return scan(copy, None, predicate, node, graph).select(*QUAD_COLUMNS)

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _path(self, end: str) -> str:
        return f"{self.folder}/by-{end}-{self.buckets}"

    def _copy(self, end: str) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self._path(end)).filter("subject IS NOT NULL")

    def _replace(self, rows: DataFrame, end: str, graphs: DataFrame) -> None:
        every = F.explode(F.sequence(F.lit(0), F.lit(self.buckets - 1))).alias("bucket")
        blank = [F.lit(None).cast("string").alias(c) for c in QUAD_COLUMNS if c != "graph"]
        markers = graphs.select("graph", *blank, every)
        whole = rows.withColumn("bucket", self._bucket(F.col(end))).unionByName(markers)
        sorted_ = whole.hint("rebalance", "bucket", "graph").sortWithinPartitions("bucket", "graph", end, "predicate")
        writer = sorted_.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        for term in ("subject", "object"):
            writer = writer.option(f"parquet.bloom.filter.enabled#{term}", "true")
        writer.partitionBy("bucket", "graph").parquet(self._path(end))
