import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from voltframe.sources import quads as q

XML = """<?xml version="1.0" encoding="UTF-8"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:cim="http://iec.ch/TC57/2013/CIM-schema-cim16#"
  xmlns:own="urn:own#" xmlns:md="http://iec.ch/TC57/61970-552/ModelDescription/1#">
  <md:FullModel rdf:about="urn:uuid:1">
    <md:Model.DependentOn rdf:resource="urn:uuid:2"/>
    <md:Model.DependentOn rdf:resource="urn:uuid:3"/>
    <md:Model.version>03</md:Model.version>
  </md:FullModel>
  <cim:Terminal rdf:ID="_t1"><cim:IdentifiedObject.name>a &amp; b</cim:IdentifiedObject.name>
    <cim:Terminal.ConductingEquipment rdf:resource="#_l1"/></cim:Terminal>
  <cim:Terminal rdf:about="#_t2"><own:flag>true</own:flag></cim:Terminal>
</rdf:RDF>"""


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse_terms(spark):
    found = q.parse_nquads(
        lines(
            spark,
            r'<a:s> <urn:p#x> "q\"\\n\n\u00e9\U0001F600\uD83D\uDE00"@en <urn:g> .',
            "_:b <urn:p#x> _:c .",
            "# comment",
            "",
            '<a:s><urn:p#x>"5"^^<http://www.w3.org/2001/XMLSchema#integer>.',
        )
    ).collect()
    assert [(r.graph, r.subject, r.object, r.object_kind, r.datatype, r.lang) for r in found] == [
        ("urn:g", "a:s", 'q"\\n\né😀😀', "literal", None, "en"),
        (None, "_:b", "_:c", "bnode", None, None),
        (None, "a:s", "5", "literal", "xsd:integer", None),
    ]


def test_long_literals_and_quotes_in_comments(spark):
    long = "x" * 500_000 + '\\"\\\\\\n' * 100_000
    found = q.parse_nquads(lines(spark, f'<a:s> <b:p> "{long}" .', r'<a:s> <b:q> "a\\" . # "b\" \\ .')).collect()
    assert found[0].object == "x" * 500_000 + '"\\\n' * 100_000
    assert found[1].object == "a\\"


def test_malformed_line_fails(spark):
    with pytest.raises(PySparkException):
        q.parse_nquads(lines(spark, "<a:s> <b:p> oops .")).collect()
    with pytest.raises(PySparkException):
        q.parse_nquads(lines(spark, r'<a:s> <b:p> "open \" .')).collect()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc", "Zl", "Zp")), max_size=20), min_size=1, max_size=20))
def test_literals_round_trip(spark, texts):
    rows = [("urn:g", f"urn:s{i}", "urn:p#x", t, "literal", None, None) for i, t in enumerate(texts)]
    quads = spark.createDataFrame(rows, q.QUAD_SCHEMA)
    again = q.parse_nquads(q.format_nquads(quads))
    assert sorted(r.object for r in again.collect()) == sorted(texts)


def test_files_and_graph_groups(spark, tmp_path):
    rows = [(f"urn:graph:{g}", "urn:s", "urn:p#x", g, "literal", None, None) for g in ("A_EQ", "A_GL", "A_SV", "A_SSH", "A_TP")]
    quads = spark.createDataFrame(rows, q.QUAD_SCHEMA)
    q.write_nquads(quads, str(tmp_path / "nq"), graphs=["urn:graph:A_EQ", "urn:graph:A_SV"])
    back = q.read_nquads(spark, str(tmp_path / "nq"))
    assert sorted(r.object for r in back.collect()) == ["A_EQ", "A_SV"]
    q.write_quads(quads, str(tmp_path / "pq"))
    stored = q.read_quads(spark, str(tmp_path / "pq"))
    assert stored.filter(q.equipment_graph()).count() == 2 and stored.filter(q.state_graph()).count() == 3
    assert q.difference(stored, back).count() == 3
    assert q.scan(stored, subject="urn:s", graph="urn:graph:A_TP").count() == 1
    assert not q.is_empty(stored)
    assert q.graphs(q.into_graph(stored, "urn:one")).collect()[0].graph == "urn:one"


@pytest.mark.parametrize("listed", [False, True])
def test_rdf_xml(spark, tmp_path, listed):
    (tmp_path / "A_EQ_1.xml").write_text(XML)
    properties = {
        "cim:Terminal": ["cim:IdentifiedObject.name", "cim:Terminal.ConductingEquipment", "own:flag"],
        "md:FullModel": ["md:Model.DependentOn", "md:Model.version"],
    }
    quads = q.read_rdf_xml(spark, str(tmp_path / "*.xml"), base="urn:m#", properties=properties if listed else None)
    found = sorted((r.subject, r.predicate, r.object, r.object_kind) for r in quads.collect())
    cim, md = "http://iec.ch/TC57/2013/CIM-schema-cim16#", "http://iec.ch/TC57/61970-552/ModelDescription/1#"
    assert found == [
        ("urn:m#_t1", "cim:IdentifiedObject.name", "a & b", "literal"),
        ("urn:m#_t1", "cim:Terminal.ConductingEquipment", "urn:m#_l1", "iri"),
        ("urn:m#_t1", "rdf:type", cim + "Terminal", "iri"),
        ("urn:m#_t2", "rdf:type", cim + "Terminal", "iri"),
        ("urn:m#_t2", "urn:own#flag", "true", "literal"),
        ("urn:uuid:1", "md:Model.DependentOn", "urn:uuid:2", "iri"),
        ("urn:uuid:1", "md:Model.DependentOn", "urn:uuid:3", "iri"),
        ("urn:uuid:1", "md:Model.version", "03", "literal"),
        ("urn:uuid:1", "rdf:type", md + "FullModel", "iri"),
    ]
    assert {r.graph for r in quads.collect()} == {"urn:graph:A_EQ_1"}


def test_literal_text_keeps_its_blanks(spark, tmp_path):
    (tmp_path / "m.xml").write_text(
        '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:cim="http://iec.ch/TC57/2013/CIM-schema-cim16#">\n'
        '  <cim:Substation rdf:ID="_s1">\n    <cim:IdentifiedObject.name> a b </cim:IdentifiedObject.name>\n  </cim:Substation>\n</rdf:RDF>'
    )
    found = q.read_rdf_xml(spark, str(tmp_path)).filter("object_kind = 'literal'").collect()
    assert [row.object for row in found] == [" a b "]


FORMS = """<?xml version="1.0"?>
<r:RDF xmlns:r="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:c="http://iec.ch/TC57/2013/CIM-schema-cim16#">
  <!-- <c:Breaker r:ID="_gone"/> -->
  <c:Substation
      r:ID="_s1"
      c:IdentifiedObject.aliasName="x"><c:IdentifiedObject.name xml:lang="en">A</c:IdentifiedObject.name></c:Substation><c:Substation r:about="#_s2"/>
  <r:Description r:about="#_s3"><r:type r:resource="http://iec.ch/TC57/2013/CIM-schema-cim16#Substation"/>
    <c:IdentifiedObject.name r:datatype="http://www.w3.org/2001/XMLSchema#string"><![CDATA[<b>]]></c:IdentifiedObject.name></r:Description>
  <c:Location r:nodeID="p"><c:Location.mainAddress><c:StreetAddress><c:StreetAddress.poBox/></c:StreetAddress></c:Location.mainAddress></c:Location>
  <c:Substation r:ID="_s4"><c:PowerSystemResource.Location r:nodeID="p"/></c:Substation>
</r:RDF>"""


def test_rdf_xml_forms(spark, tmp_path):
    (tmp_path / "f.xml").write_text(FORMS)
    rows = q.read_rdf_xml(spark, str(tmp_path), base="urn:m#").collect()
    cim = "http://iec.ch/TC57/2013/CIM-schema-cim16#"
    types = sorted((r.subject, r.object.removeprefix(cim)) for r in rows if r.predicate == "rdf:type")
    place = next(r.subject for r in rows if r.object == cim + "Location")
    street = next(r.subject for r in rows if r.object == cim + "StreetAddress")
    assert types == sorted([(f"urn:m#_s{i}", "Substation") for i in (1, 2, 3, 4)] + [(place, "Location"), (street, "StreetAddress")])
    others = {(r.subject, r.predicate, r.object, r.object_kind, r.datatype, r.lang) for r in rows if r.predicate != "rdf:type"}
    assert others == {
        ("urn:m#_s1", "cim:IdentifiedObject.aliasName", "x", "literal", None, None),
        ("urn:m#_s1", "cim:IdentifiedObject.name", "A", "literal", None, "en"),
        ("urn:m#_s3", "cim:IdentifiedObject.name", "<b>", "literal", "xsd:string", None),
        (place, "cim:Location.mainAddress", street, "bnode", None, None),
        (street, "cim:StreetAddress.poBox", "", "literal", None, None),
        ("urn:m#_s4", "cim:PowerSystemResource.Location", place, "bnode", None, None),
    }


@pytest.mark.parametrize("text", ["<a>", "<r:RDF xmlns:r='http://www.w3.org/1999/02/22-rdf-syntax-ns#'/>", FORMS.replace('<c:Substation r:about="#_s2"/>', '<c:S><c:x r:parseType="Collection"/></c:S>')])
def test_rdf_xml_that_is_not_read_fails(spark, tmp_path, text):
    (tmp_path / "f.xml").write_text(text)
    with pytest.raises(PySparkException, match="f.xml"):
        q.read_rdf_xml(spark, str(tmp_path)).collect()


def test_rdf_xml_is_one_scan(spark, tmp_path):
    (tmp_path / "f.xml").write_text(XML)
    text = q.read_rdf_xml(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1


def test_blank_nodes_with_dots_and_escaped_iris(spark):
    found = q.parse_nquads(lines(spark, r"_:a.1 <urn:p#x> _:b.1 _:g..2 .", r"<urn:s\u00e9> <urn:p#x> <urn:o\u00e9>.", "_:a <urn:p#x> _:c.")).collect()
    assert [(r.graph, r.subject, r.object) for r in found] == [("_:g..2", "_:a.1", "_:b.1"), (None, "urn:sé", "urn:oé"), (None, "_:a", "_:c")]
