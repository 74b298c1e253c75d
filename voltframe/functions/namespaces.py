"""Prefixes of the public vocabularies, and shortening of IRIs to prefixed names."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public namespaces (fixed values). Vendor extensions are added by the caller, e.g. {"SN": "http://..."}.
PREFIXES: dict[str, str] = {
    "cim": "http://iec.ch/TC57/2013/CIM-schema-cim16#",
    "cims": "http://iec.ch/TC57/1999/rdf-schema-extensions-19990926#",
    "dc": "http://purl.org/dc/elements/1.1/",
    "entsoe": "http://entsoe.eu/CIM/SchemaExtension/3/1#",
    "entsoeSecretariat": "http://entsoe.eu/Secretariat/ProfileExtension/1#",
    "foaf": "http://xmlns.com/foaf/0.1/",
    "md": "http://iec.ch/TC57/61970-552/ModelDescription/1#",
    "owl": "http://www.w3.org/2002/07/owl#",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "sesame": "http://www.openrdf.org/schema/sesame#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
}


def extended(extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """The default prefixes with additions; an addition replaces a default of the same name."""
    return PREFIXES | dict(extra or {})


def _lookup(mapping: Mapping[str, str], key: Column) -> Column:
    entries = [F.lit(text) for pair in mapping.items() for text in pair]
    return F.try_element_at(F.create_map(*entries), key)


def _after_namespace(iri: Column) -> Column:
    return F.substring_index(F.substring_index(iri, "#", -1), "/", -1)


def namespace(iri: Column) -> Column:
    """Everything up to and including the last '#' or '/'."""
    return F.substr(iri, F.lit(1), F.length(iri) - F.length(_after_namespace(iri)))


def shorten(iri: Column, prefixes: Mapping[str, str] | None = None) -> Column:
    """Prefixed name where the namespace is known, else the IRI itself."""
    known = {uri: prefix for prefix, uri in (prefixes or PREFIXES).items()}
    prefix = _lookup(known, namespace(iri))
    return F.when(prefix.isNotNull(), F.concat(prefix, F.lit(":"), _after_namespace(iri))).otherwise(iri)


def expand(name: Column, prefixes: Mapping[str, str] | None = None) -> Column:
    """IRI of a prefixed name where the prefix is known, else the text itself."""
    uri = _lookup(prefixes or PREFIXES, F.regexp_extract(name, r"^([\w.-]*):", 1))
    return F.when(uri.isNotNull(), F.concat(uri, F.regexp_extract(name, r"^[^:]*:(.*)$", 1))).otherwise(name)


def cim_version(iri: Column) -> Column:
    """Version number in a CIM namespace, 0 where there is none."""
    return F.coalesce(F.regexp_extract(iri, r"cim(\d+)", 1).try_cast("int"), F.lit(0))


def version_of(prefixes: Mapping[str, str] | None = None) -> int:
    found = re.search(r"cim(\d+)", (prefixes or PREFIXES)["cim"])
    return int(found.group(1)) if found else 0
