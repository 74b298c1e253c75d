"""RDF/XML documents to statements: a small push parser over expat, fed in slices so that a document's facts are
handed on while it is read."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping, Sequence
from xml.parsers import expat

# Namespaces of the RDF/XML syntax (fixed values).
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XML = "http://www.w3.org/XML/1998/namespace"

# (subject, predicate, object, object_kind, datatype, lang)
Statement = tuple[str, str, str, str, str | None, str | None]
SLICE = 1 << 20
_ABSOLUTE = re.compile(r"[A-Za-z][\w+.-]*:")


class _Node:
    """An open element that describes a subject."""

    def __init__(self, subject: str, wanted: frozenset[str] | None, lang: str | None) -> None:
        self.subject, self.wanted, self.lang = subject, wanted, lang


class _Property:
    """An open property element; its object is known at its end."""

    def __init__(self, predicate: str, kept: bool, lang: str | None, datatype: str | None) -> None:
        self.predicate, self.kept, self.lang, self.datatype = predicate, kept, lang, datatype
        self.target: str | None = None
        self.text: list[str] = []


class Document:
    """Statements of one document. `properties` (element name -> property names, both with a prefix that the document
    declares) keeps only those."""

    def __init__(self, name: str, base: str, properties: Mapping[str, Sequence[str]] | None = None) -> None:
        self.name, self.base, self.properties = name, base, properties
        self.scope = hashlib.md5(name.encode()).hexdigest()[:12]
        self.prefixes: dict[str, set[str]] = {}
        self.open: list[_Node | _Property | None] = []
        self.found: list[Statement] = []
        self.nameless = self.records = 0
        self.parser = expat.ParserCreate(namespace_separator=" ")
        self.parser.buffer_text = True
        self.parser.StartElementHandler = self._start
        self.parser.EndElementHandler = self._end
        self.parser.CharacterDataHandler = self._characters
        self.parser.StartNamespaceDeclHandler = lambda prefix, uri: self.prefixes.setdefault(uri, set()).add(prefix or "")

    def statements(self, content: bytes) -> Iterator[list[Statement]]:
        """Statements, a list for each slice of the document; malformed XML or a document without records fails."""
        try:
            for start in range(0, max(len(content), 1), SLICE):
                self.parser.Parse(content[start : start + SLICE], start + SLICE >= len(content))
                if self.found:
                    yield self.found
                    self.found = []
        except expat.ExpatError as error:
            raise ValueError(f"{self.name}: {error}") from error
        if not self.records:
            raise ValueError(f"{self.name}: no RDF record")

    def _names(self, uri: str, local: str) -> set[str]:
        return {f"{prefix}:{local}" for prefix in self.prefixes.get(uri, ())}

    def _iri(self, reference: str) -> str:
        """`#_x` and `_x` name the same subject; absolute IRIs stay."""
        return reference if _ABSOLUTE.match(reference) else self.base + reference.removeprefix("#")

    def _blank(self, label: str | None = None) -> str:
        """A blank node of this document; nameless ones are numbered, the same in every attempt of a task."""
        if label is None:
            self.nameless += 1
            return f"_:n{self.scope}-{self.nameless}"
        return f"_:b{self.scope}-{label}"

    def _start(self, tag: str, attributes: dict[str, str]) -> None:
        uri, _, local = tag.rpartition(" ")
        parent = self.open[-1] if self.open else None
        lang = attributes.get(f"{XML} lang", parent.lang if parent else None) or None
        if not self.open and (uri, local) == (RDF, "RDF"):
            self.open.append(None)
        elif isinstance(parent, _Node):
            self.open.append(self._property(parent, uri, local, attributes, lang))
        else:
            self.open.append(self._node(parent, uri, local, attributes, lang))

    def _node(self, parent: _Property | None, uri: str, local: str, attributes: dict[str, str], lang: str | None) -> _Node:
        """An element that stands for a subject; inside a property it is also that property's object."""
        self.records += 1
        if f"{RDF} nodeID" in attributes:
            subject = self._blank(attributes[f"{RDF} nodeID"])
        else:
            reference = attributes.get(f"{RDF} ID", attributes.get(f"{RDF} about"))
            subject = self._blank() if reference is None else self._iri(reference)
        if parent is not None:
            if parent.target is not None:
                raise ValueError(f"{self.name}: {parent.predicate} of one element has several objects")
            parent.target = subject
        wanted = None
        if self.properties is not None:
            names = self._names(uri, local) & set(self.properties)
            wanted = frozenset(p for name in names for p in self.properties[name])
            if not names:
                return _Node(subject, wanted, lang)
        if (uri, local) != (RDF, "Description"):
            self.found.append((subject, f"{RDF}type", uri + local, "iri", None, None))
        for key, value in attributes.items():
            space, _, name = key.rpartition(" ")
            if space == RDF and name == "type":
                self.found.append((subject, f"{RDF}type", self._iri(value), "iri", None, None))
            elif space not in ("", RDF, XML) and (wanted is None or self._names(space, name) & wanted):
                self.found.append((subject, space + name, value, "literal", None, lang))
        return _Node(subject, wanted, lang)

    def _property(self, parent: _Node, uri: str, local: str, attributes: dict[str, str], lang: str | None) -> _Node | _Property:
        special = {key.rpartition(" ")[2]: value for key, value in attributes.items() if key.startswith(f"{RDF} ")}
        unknown = [key for key in attributes if not key.startswith((f"{RDF} ", f"{XML} "))]
        kind = special.pop("parseType", None)
        if kind not in (None, "Resource") or set(special) - {"resource", "nodeID", "datatype"} or unknown or (uri, local) == (RDF, "li"):
            raise ValueError(f"{self.name}: {local} of {parent.subject} has a form that isn't read: {attributes}")
        kept = parent.wanted is None or bool(self._names(uri, local) & parent.wanted)
        if kind == "Resource":
            subject = self._blank()
            if kept:
                self.found.append((parent.subject, uri + local, subject, "bnode", None, None))
            return _Node(subject, None if kept else frozenset(), lang)
        opened = _Property(uri + local, kept, lang, special.get("datatype"))
        if "resource" in special:
            opened.target = self._iri(special["resource"])
        elif "nodeID" in special:
            opened.target = self._blank(special["nodeID"])
        return opened

    def _characters(self, text: str) -> None:
        if self.open and isinstance(self.open[-1], _Property):
            self.open[-1].text.append(text)

    def _end(self, tag: str) -> None:
        closed = self.open.pop()
        if not isinstance(closed, _Property) or not closed.kept:
            return
        subject = self.open[-1].subject
        if closed.target is not None:
            kind = "bnode" if closed.target.startswith("_:") else "iri"
            self.found.append((subject, closed.predicate, closed.target, kind, None, None))
        else:
            lang = None if closed.datatype else closed.lang
            self.found.append((subject, closed.predicate, "".join(closed.text), "literal", closed.datatype, lang))
