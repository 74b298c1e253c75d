"""Quad tables: reading and writing N-Quads, reading CIM RDF/XML, scans and graph groups.

Columns: graph, subject, predicate (prefixed), object, object_kind ('iri', 'bnode' or 'literal'),
datatype (prefixed), lang.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.functions.namespaces import expand, extended, shorten
from voltframe.sources.rdf_xml import RDF, Document

QUAD_COLUMNS = ["graph", "subject", "predicate", "object", "object_kind", "datatype", "lang"]
QUAD_SCHEMA = ", ".join(f"{c} string" for c in QUAD_COLUMNS)
GRAPH_PREFIX = "urn:graph:"
BASE_IRI = "urn:model#"

# One N-Quads statement (the line grammar of the W3C recommendation), after escaped backslashes and quotes have
# been set aside: what is left of a literal then has no quote in it, so that texts of any length match without
# nested repetition.
_TERM = r"<([^>]*)>"
# A blank node's label may hold dots, but not end with one.
_BLANK = r'(_:[^\s.<>"#]+(?:\.+[^\s.<>"#]+)*)'
_STATEMENT = (
    rf"^\s*(?:{_TERM}|{_BLANK})\s*{_TERM}\s*"
    rf'(?:{_TERM}|{_BLANK}|"([^"]*)"(?:\^\^{_TERM}|@([A-Za-z0-9-]+))?)'
    rf"\s*(?:{_TERM}|{_BLANK})?\s*\.\s*(?s:#.*)?$"
)
_SET_ASIDE = {"\\\\": "\n1", '\\"': "\n2"}
_GROUP_END = "\n|"
_TOKEN = r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.|[^\\]+"
_ESCAPES = {"\\t": "\t", "\\b": "\b", "\\n": "\n", "\\r": "\r", "\\f": "\f", '\\"': '"', "\\'": "'", "\\\\": "\\"}


def _unescape(text: Column) -> Column:
    """Resolve the escapes of a literal or an IRI; texts without a backslash are left alone."""
    named = F.create_map(*[F.lit(t) for pair in _ESCAPES.items() for t in pair])

    def token(t: Column) -> Column:
        code = F.unhex(F.lpad(F.substring(t, 3, 8), 8, "0"))
        return F.when(t.rlike(r"^\\[uU]"), F.decode(code, "UTF-32")).otherwise(F.coalesce(F.try_element_at(named, t), t))

    # A pair of \\u escapes for one character outside the basic plane is put together by the UTF-16 decoder.
    pair = r"((?:\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}))"
    tokens = F.regexp_extract_all(text, F.lit(f"{pair}|{_TOKEN}"), 0)

    def any_token(t: Column) -> Column:
        units = F.unhex(F.regexp_replace(t, r"\\u", ""))
        return F.when(t.rlike(f"^{pair}$"), F.decode(units, "UTF-16BE")).otherwise(token(t))

    return F.when(F.instr(text, "\\") == 0, text).otherwise(F.array_join(F.transform(tokens, any_token), ""))


def parse_nquads(lines: DataFrame, prefixes: Mapping[str, str] | None = None, graph: str | None = None) -> DataFrame:
    """Statements of a `value` column; blank lines and comments are skipped, a malformed line fails the job.

    `graph` replaces the graph of every statement.
    """
    names = extended(prefixes)
    # One match per line. Its groups are laid out between marks that start with a line feed, which no line
    # contains, and split again.
    line = F.col("value")
    for escape, mark in _SET_ASIDE.items():
        line = F.replace(line, F.lit(escape), F.lit(mark))
    layout = _GROUP_END.join(f"${i}" for i in range(1, 11))
    groups = F.split(F.regexp_replace(line, _STATEMENT, layout), "\n[|]", -1)
    checked = (
        F.when(F.size("groups") == 10, F.col("groups"))
        .when(F.col("value").rlike(r"^\s*(?:#.*)?$"), F.lit(None))
        .otherwise(F.raise_error(F.concat(F.lit("not an N-Quads statement: "), F.col("value"))))
    )
    rows = lines.select("value", groups.alias("groups")).select(checked.alias("groups")).filter("groups IS NOT NULL")

    def group(index: int) -> Column:
        return F.nullif(F.col("groups")[index - 1], F.lit(""))

    literal = F.col("groups")[5]
    for escape, mark in _SET_ASIDE.items():
        literal = F.replace(literal, F.lit(mark), F.lit(escape))
    resource = F.coalesce(group(4), group(5))
    own_graph = _unescape(F.coalesce(group(9), group(10)))
    return rows.select(
        (F.lit(graph) if graph else own_graph).alias("graph"),
        _unescape(F.coalesce(group(1), group(2))).alias("subject"),
        shorten(_unescape(group(3)), names).alias("predicate"),
        _unescape(F.when(resource.isNull(), literal).otherwise(resource)).alias("object"),
        F.when(group(4).isNotNull(), "iri").when(group(5).isNotNull(), "bnode").otherwise("literal").alias("object_kind"),
        shorten(_unescape(group(7)), names).alias("datatype"),
        group(8).alias("lang"),
    )


def read_nquads(
    spark: SparkSession, paths: str | list[str], prefixes: Mapping[str, str] | None = None, graph: str | None = None
) -> DataFrame:
    """N-Quads and N-Triples files; a line format, so large files split."""
    return parse_nquads(spark.read.text(paths), prefixes, graph)


def format_nquads(quads: DataFrame, prefixes: Mapping[str, str] | None = None) -> DataFrame:
    """One `value` line per quad."""
    names = extended(prefixes)

    def resource(c: Column) -> Column:
        return F.when(c.startswith("_:"), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))

    text = F.col("object")
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    suffix = F.coalesce(
        F.concat(F.lit("^^<"), expand(F.col("datatype"), names), F.lit(">")), F.concat(F.lit("@"), F.col("lang")), F.lit("")
    )
    value = F.when(F.col("object_kind") == "literal", F.concat(F.lit('"'), text, F.lit('"'), suffix)).otherwise(
        resource(F.col("object"))
    )
    terms = [resource(F.col("subject")), resource(expand(F.col("predicate"), names)), value, resource(F.col("graph")), F.lit(".")]
    return quads.select(F.concat_ws(" ", *terms).alias("value"))


def write_nquads(
    quads: DataFrame, path: str, graphs: Iterable[str] | None = None, prefixes: Mapping[str, str] | None = None
) -> None:
    """Write all quads, or those of some graphs, as N-Quads."""
    format_nquads(in_graphs(quads, graphs), prefixes).write.mode("overwrite").text(path)


def in_graphs(quads: DataFrame, graphs: Iterable[str] | None) -> DataFrame:
    return quads if graphs is None else quads.filter(F.col("graph").isin(*graphs))


def scan(
    quads: DataFrame,
    subject: str | None = None,
    predicate: str | None = None,
    object: str | None = None,  # noqa: A002
    graph: str | None = None,
) -> DataFrame:
    """Quads that equal the given positions; an open position matches everything."""
    for column, value in (("subject", subject), ("predicate", predicate), ("object", object), ("graph", graph)):
        if value is not None:
            quads = quads.filter(F.col(column) == value)
    return quads


def into_graph(quads: DataFrame, graph: str) -> DataFrame:
    return quads.withColumn("graph", F.lit(graph))


def graphs(quads: DataFrame) -> DataFrame:
    return quads.select("graph").filter("graph IS NOT NULL").distinct()


def equipment_graph(graph: Column | str = "graph") -> Column:
    """Equipment and geography graphs, by name."""
    return (F.col(graph) if isinstance(graph, str) else graph).rlike("EQ|GL")


def state_graph(graph: Column | str = "graph") -> Column:
    """State-variable, topology and hypothesis graphs, by name."""
    return (F.col(graph) if isinstance(graph, str) else graph).rlike("SV|TP|SSH")


def is_empty(quads: DataFrame) -> bool:
    return quads.isEmpty()


def difference(quads: DataFrame, other: DataFrame) -> DataFrame:
    """Quads of the first table that are not in the second, as a set."""
    return quads.select(*QUAD_COLUMNS).subtract(other.select(*QUAD_COLUMNS))


def write_quads(quads: DataFrame, path: str) -> None:
    """Columnar store: one folder per predicate, so a report reads only the predicates it names.

    Rows are rebalanced first: a hot predicate is split over many files, rare ones share a task.
    """
    quads.hint("rebalance", "predicate").write.mode("overwrite").partitionBy("predicate").parquet(path)


def read_quads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*QUAD_COLUMNS)


# RDF/XML


def read_rdf_xml(
    spark: SparkSession,
    paths: str | list[str],
    prefixes: Mapping[str, str] | None = None,
    base: str = BASE_IRI,
    properties: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """RDF/XML files as quads, one graph per file, named after the file.

    One scan and one pass, whatever the number of classes: an XML parser runs over each file in the task that reads
    it, so a file (at most 2 GB) is the unit of parallelism. Relative references are taken from `base`.
    `properties` (element name -> property names, with the prefixes of the file) keeps only those classes and
    properties. Malformed XML, a file without records, and forms that aren't read (collections, XML literals,
    containers, reified statements) fail, naming the file.
    """
    names = extended(prefixes)
    wanted = None if properties is None else {name: tuple(found) for name, found in properties.items()}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)

    def facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"]):
                for found in Document(file, base, wanted).statements(content):
                    yield pd.DataFrame(found, columns=QUAD_COLUMNS[1:], dtype=object).assign(graph=file)

    rows = files.select(F.col("_metadata.file_name").alias("file"), "content").mapInPandas(facts, QUAD_SCHEMA)
    stem = F.regexp_extract("graph", r"^(.*?)(?:\.[^.]*)?$", 1)
    return rows.select(
        F.concat(F.lit(GRAPH_PREFIX), stem).alias("graph"),
        "subject",
        F.when(F.col("predicate") == f"{RDF}type", "rdf:type").otherwise(shorten(F.col("predicate"), names)).alias("predicate"),
        "object",
        "object_kind",
        shorten(F.col("datatype"), names).alias("datatype"),
        "lang",
    )
