"""Exact deduplication by Grace hash partitioning.

Texts are equal when identical after every run of white space becomes one space. Each input task first merges
its own copies, so that a text of which a third of all rows are copies reaches the shuffle at most a few times
per task. The survivors are partitioned by content hash; a task reads its partition through an open-addressing
table that compares complete contents. Contents beyond the table's byte limit go to spill files, one per next
digit of the hash, and each spill file is treated the same way until everything has fitted. Tables hold a text once, as
bytes, and the rows of `keepers` packed; `groups` holds nothing else. Batches are read and returned in slices of bytes.

Defined results: a null text counts as the empty text. Null ids sort behind all others. Rows that repeat both
id and text are one document for `groups` and share its decision; `keepers` returns one row of them. Columns of
any name pass through `keepers` unchanged. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm import chunks
from voltframe.llm.common import Batches, packed, texts
from voltframe.session import written

# Bytes of distinct content that one table holds before it spills (or, in an input task, is handed on).
TABLE_BYTES = 64 << 20
FAN_OUT_BITS = 4
WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: bytes) -> bytes:
    """Every run of white space as one space. bytes.split() drops a leading and a trailing run; they are put back."""
    inner = b" ".join(text.split())
    if not inner:
        return b" " if text else b""
    return b" " * text[:1].isspace() + inner + b" " * text[-1:].isspace()


class ContentTable:
    """Linear probing from complete contents to [hash, content, rows, best id, payload]."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.entries: list[list] = []
        self.bytes = 0

    def _slot(self, digest: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        place = digest & mask
        while (number := self.slots[place]) >= 0:
            entry = self.entries[number]
            if entry[0] == digest and entry[1] == content:
                break
            place = (place + 1) & mask
        return place

    def merge(self, digest: int, content: bytes, rows: int, best, payload, limit: int) -> bool:
        """Add a record to the entry of its content; False if that would be a new entry beyond `limit` bytes."""
        place = self._slot(digest, content)
        if (number := self.slots[place]) >= 0:
            entry = self.entries[number]
            entry[2] += rows
            if _rank(best) < _rank(entry[3]):
                self.bytes += _size(payload) - _size(entry[4])
                entry[3:] = best, payload
            return True
        size = len(content) + _size(payload)
        if self.entries and self.bytes + size > limit:
            return False
        self.slots[place] = len(self.entries)
        self.entries.append([digest, content, rows, best, payload])
        self.bytes += size + 200
        if 3 * len(self.entries) > 2 * len(self.slots):
            self._grow()
        return True

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for number, entry in enumerate(self.entries):
            place = entry[0] & mask
            while self.slots[place] >= 0:
                place = (place + 1) & mask
            self.slots[place] = number


def _size(payload) -> int:
    return len(payload) if isinstance(payload, bytes) else 0


def _rank(identifier) -> tuple:
    return (identifier is None, identifier if identifier is not None else 0)


def merged_here(records: Iterable[tuple], limit: int) -> Iterator[list]:
    """Best effort in an input task: equal records become one; a full table is handed on and begun anew."""
    held = ContentTable()
    for record in records:
        if not held.merge(*record, limit):
            yield from held.entries
            held = ContentTable()
            held.merge(*record, limit)
    yield from held.entries


def merged(records: Iterable[tuple], limit: int, depth: int = 0) -> Iterator[list]:
    """All records of a partition, one entry per content, with at most `limit` bytes of content held at a time.

    What doesn't fit is spilled by the next digit of its hash. The files are private to the task, have no name,
    and go with the task; a task that is run again writes its own.
    """
    held, spilled = ContentTable(), {}
    for record in records:
        if not held.merge(*record, limit):
            digit = (record[0] >> (64 - FAN_OUT_BITS * (1 + depth % 16))) & ((1 << FAN_OUT_BITS) - 1)
            if digit not in spilled:
                spilled[digit] = tempfile.TemporaryFile()
            pickle.dump(record, spilled[digit])
    yield from held.entries
    del held
    for file in spilled.values():
        file.seek(0)
        with file:
            yield from merged(_read(file), limit, depth + 1)


def _read(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _digest(content: bytes) -> int:
    return xxhash.xxh3_64_intdigest(content)


def _distinct(df: DataFrame, limit: int, out: T.StructType, finish) -> DataFrame:
    """One row per distinct content of (id, text) or (id, text, row); `finish` turns an entry into a row of `out`.

    What is exchanged as `text` is the normalised content.
    """
    records = T.StructType([T.StructField("digest", T.LongType()), T.StructField("rows", T.LongType()), *df.schema.fields])

    def first(parts: Batches) -> Batches:
        shape = None

        def each():
            nonlocal shape
            for part in _sliced(parts):
                shape = part.schema
                for content, identifier, payload in zip(texts(part, "text"), part.column("id").to_pylist(), _payloads(part)):
                    content = normalised(content)
                    yield _digest(content), content, 1, identifier, payload

        for entries in _chunks(merged_here(each(), limit)):
            # The digest is unsigned; Spark's long keeps the same 64 bits.
            columns = {
                "digest": pa.array([_signed(e[0]) for e in entries], pa.int64()),
                "rows": pa.array([e[2] for e in entries], pa.int64()),
                "id": pa.array([e[3] for e in entries], shape.field("id").type),
                "text": pa.array([e[1] for e in entries], pa.binary()).cast(shape.field("text").type),
            }
            if "row" in shape.names:
                columns["row"] = pa.array([pickle.loads(e[4]) for e in entries], shape.field("row").type)
            yield pa.RecordBatch.from_pydict(columns)

    def second(parts: Batches) -> Batches:
        shape = None

        def each():
            nonlocal shape
            for part in _sliced(parts):
                shape = part.schema
                own = zip(*[part.column(n).to_pylist() for n in ("digest", "rows", "id")])
                for content, (digest, rows, identifier), payload in zip(texts(part, "text"), own, _payloads(part)):
                    yield digest % (1 << 64), content, rows, identifier, payload

        for entries in _chunks(merged(each(), limit)):
            yield pa.RecordBatch.from_pylist([finish(e) for e in entries], schema=_arrow(out, shape))

    return df.mapInArrow(first, records).repartition("digest").mapInArrow(second, out)


def _sliced(parts: Batches) -> Batches:
    for part in parts:
        yield from chunks.slices(part, "text")


def _payloads(part: pa.RecordBatch) -> Iterator[bytes | None]:
    """The column `row` packed, where there is one."""
    if "row" not in part.schema.names:
        return (None for _ in range(part.num_rows))
    return (pickle.dumps(row, pickle.HIGHEST_PROTOCOL) for row in part.column("row").to_pylist())


def _arrow(out: T.StructType, shape: pa.Schema) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return pa.schema([
        pa.field(f.name, shape.field(f.name).type if f.name in ("id", "row") else kinds[f.dataType.simpleString()])
        for f in out.fields
    ])


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def _chunks(entries: Iterable[list], size: int = 500, limit: int = chunks.SLICE_BYTES) -> Iterator[list]:
    """So many entries at a time, or fewer where they hold `limit` bytes."""
    chunk, held = [], 0
    for entry in entries:
        chunk.append(entry)
        held += len(entry[1]) + _size(entry[4])
        if len(chunk) == size or held >= limit:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def distinct_texts(docs: DataFrame, id: str = "doc_id", text: str = "text", limit: int = TABLE_BYTES) -> DataFrame:
    """text_sha256, keep_id and group_size of every distinct text."""
    narrow = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    out = T.StructType([
        T.StructField("text_sha256", T.StringType()),
        T.StructField("id", narrow.schema["id"].dataType),
        T.StructField("group_size", T.LongType()),
    ])
    found = _distinct(
        narrow, limit, out,
        lambda e: {"text_sha256": hashlib.sha256(e[1]).hexdigest(), "id": e[3], "group_size": e[2]},
    )
    return found.withColumnRenamed("id", "keep_id")


def groups(docs: DataFrame, id: str = "doc_id", text: str = "text", limit: int = TABLE_BYTES) -> DataFrame:
    """Per document: its id, keep_id, group_size, kept, text_sha256.

    The decisions are written once and joined back on the digest with both sides exchanged for the join, so that
    run-time planning can split a digest that very many documents share.
    """
    decided = written(distinct_texts(docs, id, text, limit), "texts")
    member = docs.select(
        F.col(id),
        F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ").cast("binary"), 256).alias("text_sha256"),
    )
    return member.join(decided, "text_sha256").select(
        F.col(id), "keep_id", "group_size", F.col(id).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keepers(docs: DataFrame, id: str = "doc_id", text: str = "text", limit: int = TABLE_BYTES) -> DataFrame:
    """The rows of `docs` that stay, one for each distinct text, with all their columns."""
    whole = packed(docs, id=id, text=text)
    out = T.StructType([whole.schema["row"]])
    return _distinct(whole, limit, out, lambda e: {"row": pickle.loads(e[4])}).select("row.*")
