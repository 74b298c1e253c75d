r"""Aligning two tokenizers over a corpus by external spill counting.

A text's tokens of both tokenizers are laid on its bytes. Where tokens of both end together a group ends; a pair of
tokens whose byte ranges overlap is a link. A pair's count is the number of documents that hold it linked.

Tasks work through their documents in groups of bounded bytes. The (pair, document, links) records of a group are
sorted side-major - by radix of the first side's id, that id, the other side's id - and leave as one zstd run a radix
partition: a head of pairs with their numbers of documents, and a body of documents and links. Heads are merged by a
k-way heap in two levels, first within salted parts of a partition and then over these; what a task cannot hold it
spills to nameless files in Spark's local folders. As pairs come side-major, the highest count of an id is known after
its last pair. The counts of a partition then meet the bodies again, a bounded share of them in each salted part, so
that an id which occurs in every document is many tasks; what each run contributes to its group's documents streams
back as one block, and the blocks of a group are added up.

Distinct parts of texts are tokenized once a task as long as they are short (see `chunks`).

Defined results: null and empty texts, and texts whose tokens' bytes of either side aren't the blank and the text, have
no tokens: zeros and an empty text for the groups. Every row is a document of its own, also where ids or texts repeat
or are null. Columns of any name pass through. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm import chunks
from voltframe.llm.common import Batches, texts
from voltframe.session import written

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Bytes of text whose records are sorted together, and bytes of runs that a task holds before it spills them.
GROUP_BYTES, HELD_BYTES = 4 << 20, 64 << 20
# Bytes of bodies, compressed, that one salted part of a partition has about.
PART_BYTES = 16 << 20
# Pairs that are decoded at a time from each run, and that leave together as one block of counts.
BLOCK = 4096
# Bits of an id; a key is radix, first side's id, other side's id.
BITS = 20
BLANK = "▁"

COUNTS = "partition int, keys binary, counts binary, best binary"


class Sides:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, first: str, other: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(first)
        # Special tokens' strings are ordinary text.
        self.first.encode_special_tokens = True
        self.other = sentencepiece.SentencePieceProcessor(model_file=other)
        with open(first, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.entries = model["vocab"]
        byte_of = {chr(sign): byte for byte, sign in byte_signs().items()}
        special = {str(added) for added in self.first.get_added_tokens_decoder().values()}
        self.first_bytes = [b""] * (max(self.entries.values()) + 1)
        for entry, number in self.entries.items():
            if entry not in special and all(sign in byte_of for sign in entry):
                self.first_bytes[number] = bytes(byte_of[sign] for sign in entry)
        self.first_lengths = np.array([len(token) for token in self.first_bytes], np.int64)
        self.ranked = self._by_rank(model["merges"])
        model = self.other
        self.other_bytes = [
            bytes([int(model.id_to_piece(k)[3:5], 16)]) if model.is_byte(k) else model.id_to_piece(k).replace(BLANK, " ").encode()
            for k in range(model.vocab_size())
        ]
        self.blank = model.piece_to_id(BLANK)
        self.other_lengths = np.array([len(token) for token in self.other_bytes], np.int64)

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; every part begins with a blank, which the piece model puts in front itself.

        Where a side's tokens don't have a part's bytes the part has no ids.
        """
        if self.ranked is not None:
            ours = [self.ranked.encode_ordinary(part) for part in parts]
        else:
            ours = [found.ids for found in self.first.encode_batch(parts, add_special_tokens=False)]
        theirs = self.other.encode([part[1:] for part in parts], num_threads=1)
        theirs = [ids if part != " " else [self.blank] for part, ids in zip(parts, theirs)]
        contents = [part.encode() for part in parts]
        if self._same(contents, ours, self.first_bytes, self.first_lengths) and self._same(contents, theirs, self.other_bytes, self.other_lengths):
            return ours, theirs
        good = [
            content == b"".join([self.first_bytes[k] for k in a]) == b"".join([self.other_bytes[k] for k in b])
            for content, a, b in zip(contents, ours, theirs)
        ]
        return [a if ok else [] for a, ok in zip(ours, good)], [b if ok else [] for b, ok in zip(theirs, good)]

    @staticmethod
    def _same(contents: list[bytes], each: list[list[int]], token: list[bytes], lengths: np.ndarray) -> bool:
        """True if the tokens of every part have its bytes: all laid end to end, and each part's length."""
        flat = list(chain.from_iterable(each))
        ends = np.concatenate([[0], np.cumsum(lengths[flat])])[np.cumsum([len(ids) for ids in each])]
        return bool((ends == np.cumsum([len(c) for c in contents])).all()) and b"".join(map(token.__getitem__, flat)) == b"".join(contents)

    def _by_rank(self, merges: list) -> tiktoken.Encoding | None:
        """A faster coder of the same vocabulary, where its ids are the ranks of its merges."""
        pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in merges]
        ranks = {token: number for number, token in enumerate(self.first_bytes) if token}
        number = {entry: k for entry, k in self.entries.items()}
        if [number.get(a + b) for a, b in pairs] != list(range(256, 256 + len(pairs))) or set(ranks.values()) != set(range(256 + len(pairs))):
            return None
        return tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def byte_signs() -> dict[int, int]:
    """The code point that stands for each byte in a byte-level vocabulary: itself if printable, else from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in printable]
    return {byte: byte for byte in printable} | {byte: 256 + number for number, byte in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def sides(first: str, other: str) -> Sides:
    return Sides(first, other)


def place(name: str) -> str:
    return name if "/" in name else public_tokenizers.path(name)


class Parts:
    """What is known of the distinct parts of texts: numbers of tokens and groups, the groups' text, the links."""

    def __init__(self, own: Sides) -> None:
        self.own = own
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        # Per part: tokens of the first side, of the other, groups, and whether both sides have the part's bytes.
        self.sizes = np.empty((0, 4), np.int64)
        self.keys, self.ends = np.empty(0, np.int64), np.zeros(1, np.int64)

    def numbers(self, each: list[list[str]]) -> list[np.ndarray]:
        """The parts' numbers, of all documents of a group; unknown ones are tokenized together."""
        if len(self.number) > chunks.KEPT_PARTS:
            self.clear()
        known = self.number
        new = list({part: None for parts in each for part in parts if part not in known})
        if new:
            first = len(known)
            known.update(zip(new, range(first, first + len(new))))
            self._learn(new)
        return [np.fromiter(map(known.__getitem__, parts), np.int64, len(parts)) for parts in each]

    def drop_long(self) -> None:
        """Long parts aren't kept for later groups; they are seldom met again."""
        if any(len(part) > chunks.KEPT_LENGTH for part in self.number):
            long = [part for part in self.number if len(part) > chunks.KEPT_LENGTH]
            if len(long) > 1000 or sum(map(len, long)) > 1 << 20:
                self.clear()

    def _learn(self, new: list[str]) -> None:
        """All new parts at once, laid end to end on their bytes."""
        own = self.own
        contents = [part.encode() for part in new]
        each = own.encode(new)
        flat = [np.fromiter(chain.from_iterable(side), np.int64, sum(map(len, side))) for side in each]
        ends = [np.cumsum(lengths[ids]) for lengths, ids in zip((own.first_lengths, own.other_lengths), flat)]
        cuts = np.unique(np.concatenate(ends))
        both = np.intersect1d(*ends, assume_unique=True)
        # Every stretch between two ends, of whichever side, is the overlap of one pair.
        links = (flat[0][np.searchsorted(ends[0], cuts)] << BITS) | flat[1][np.searchsorted(ends[1], cuts)] if len(cuts) else np.empty(0, np.int64)
        held = np.array([len(content) if ids else 0 for content, ids in zip(contents, each[0])], np.int64)
        stops = np.cumsum(held)
        at = [np.concatenate([[0], np.searchsorted(places, stops, side="right")]) for places in (*ends, both, cuts)]
        self.sizes = np.concatenate([self.sizes, np.stack([*(np.diff(a) for a in at[:3]), held > 0], axis=1)])
        self.keys = np.concatenate([self.keys, links])
        self.ends = np.concatenate([self.ends, self.ends[-1] + at[3][1:]])
        ours, theirs = ([str(number) for number in ids.tolist()] for ids in flat)
        inside = [[0, *np.searchsorted(places, both, side="right").tolist()] for places in ends]
        named = [
            ",".join(ours[i:k]) + "|" + ",".join(theirs[j:m]) for (i, k), (j, m) in zip(pairwise(inside[0]), pairwise(inside[1]))
        ]
        self.groups += [";".join(named[start:stop]) for start, stop in pairwise(at[2].tolist())]


@functools.lru_cache(maxsize=2)
def kept_parts(first: str, other: str) -> Parts:
    """One for all tasks of a worker, so that a part is learned once a worker while it is kept."""
    return Parts(sides(first, other))


def records(parts: Parts, each: list[np.ndarray], radices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """key, document and links, in the order of key and document, of a group's documents given as part numbers."""
    doc = np.repeat(np.arange(len(each)), [len(numbers) for numbers in each])
    size = len(parts.sizes)
    where, times = np.unique(doc * size + np.concatenate(each), return_counts=True) if each else (np.empty(0, np.int64), np.empty(0, np.int64))
    doc, part = np.divmod(where, max(size, 1))
    start, count = parts.ends[part], np.diff(parts.ends)[part]
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    key = parts.keys[np.repeat(start, count) + inside]
    key |= (key >> BITS) % radices << 2 * BITS
    doc, times = np.repeat(doc, count), np.repeat(times, count)
    order = np.lexsort((doc, key))
    key, doc, times = key[order], doc[order], times[order]
    fresh = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(key) else np.empty(0, np.int64)
    return key[fresh], doc[fresh], np.add.reduceat(times, fresh) if len(fresh) else times


def zipped(array: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(array).tobytes(), 1)


def unzipped(content: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(content), kind)


def _shaped(docs: DataFrame, text: str) -> tuple[DataFrame, T.StructType]:
    rest = [name for name in docs.columns if name != text] or [text]
    whole = docs.select(F.col(text).alias("text"), F.struct(*[f"`{name}`" for name in rest]).alias("row"))
    fields = T._parse_datatype_string(
        "place long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string,"
        "partition int, base long, size int, keys binary, counts binary, docs binary, links binary, kind string"
    )
    return whole, T.StructType([T.StructField("row", whole.schema["row"].dataType), *fields.fields])


def laid_out(docs: DataFrame, text: str, first: str, other: str, with_groups: bool, radices: int, group_bytes: int) -> DataFrame:
    """Documents with their own figures, and the runs of their records, written once."""
    whole, out = _shaped(docs, text)

    def each(batches: Batches) -> Batches:
        parts = kept_parts(place(first), place(other))
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            kinds = pa.schema([("row", batch.schema.field("row").type), *ARROW])
            for group in chunks.slices(batch, "text", group_bytes):
                contents = [content.decode("utf-8", "replace") for content in texts(group, "text")]
                numbers = parts.numbers([chunks.parts(" " + content) if content else [] for content in contents])
                # A document of which one part differs has no tokens.
                sound = [bool(parts.sizes[n, 3].all()) for n in numbers]
                numbers = [n if ok else n[:0] for n, ok in zip(numbers, sound)]
                sizes = np.array([parts.sizes[n, :3].sum(axis=0) for n in numbers], np.int64).reshape(-1, 3)
                named = [";".join(map(parts.groups.__getitem__, n.tolist())) for n in numbers]
                yield _rows(kinds, {
                    "row": group.column("row"),
                    "place": pa.array(range(at, at + len(numbers)), pa.int64()),
                    "n_a": pa.array(sizes[:, 0]), "n_b": pa.array(sizes[:, 1]), "n_groups": pa.array(sizes[:, 2]),
                    "n_links": pa.array(sizes[:, 0] + sizes[:, 1] - sizes[:, 2]),
                    "groups": pa.array(named if with_groups else [None] * len(named), pa.string()),
                    "groups_sha256": pa.array([hashlib.sha256(n.encode()).hexdigest() if n else "" for n in named]),
                    "kind": pa.array(["document"] * len(numbers)),
                })
                yield from _runs(kinds, *records(parts, numbers, radices), at, len(numbers))
                at += len(numbers)
                parts.drop_long()

    return written(whole.mapInArrow(each, out), "aligned", partition_by="kind")


ARROW = [
    ("place", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups", pa.string()), ("groups_sha256", pa.string()), ("partition", pa.int32()), ("base", pa.int64()), ("size", pa.int32()),
    ("keys", pa.binary()), ("counts", pa.binary()), ("docs", pa.binary()), ("links", pa.binary()), ("kind", pa.string()),
]


def _rows(kinds: pa.Schema, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    count = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(count, f.type)) for f in kinds], schema=kinds)


def _runs(kinds: pa.Schema, key: np.ndarray, doc: np.ndarray, links: np.ndarray, base: int, size: int) -> Iterator[pa.RecordBatch]:
    """A run for every radix partition that has records."""
    radix = key >> 2 * BITS
    for start, stop in pairwise([*np.flatnonzero(np.diff(radix, prepend=-1)).tolist(), len(key)]):
        mine = key[start:stop]
        fresh = np.flatnonzero(np.diff(mine, prepend=-1))
        yield _rows(kinds, {
            "partition": pa.array([radix[start]], pa.int32()), "base": pa.array([base], pa.int64()), "size": pa.array([size], pa.int32()),
            "keys": pa.array([zipped(np.diff(mine[fresh], prepend=0))], pa.binary()),
            "counts": pa.array([zipped(np.diff([*fresh, len(mine)]).astype(np.int64))], pa.binary()),
            "docs": pa.array([zipped(doc[start:stop].astype(np.uint32))], pa.binary()),
            "links": pa.array([zipped(links[start:stop].astype(np.uint32))], pa.binary()),
            "kind": pa.array(["run"]),
        })


class Spool:
    """Runs of a task, in memory up to a limit and in a nameless file of the task beyond it."""

    def __init__(self, limit: int) -> None:
        self.limit, self.held, self.bytes, self.places, self.file = limit, [], 0, [], None

    def add(self, keys: bytes, counts: bytes) -> None:
        if self.bytes + len(keys) + len(counts) <= self.limit:
            self.held.append((keys, counts))
            self.bytes += len(keys) + len(counts)
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        self.places.append(self.file.tell())
        pickle.dump((keys, counts), self.file)

    def runs(self) -> Iterator[Iterator[tuple[int, int]]]:
        for run in self.held:
            yield _decoded(*run)
        for place in self.places:
            yield self._spilled(place)

    def _spilled(self, place: int) -> Iterator[tuple[int, int]]:
        # Read when the merge first asks for it, and then held: a run's size has a bound.
        self.file.seek(place)
        yield from _decoded(*pickle.load(self.file))


def _decoded(keys: bytes, counts: bytes) -> Iterator[tuple[int, int]]:
    every, each = np.cumsum(unzipped(keys, np.int64)), unzipped(counts, np.int64)
    for start in range(0, len(every), BLOCK):
        yield from zip(every[start : start + BLOCK].tolist(), each[start : start + BLOCK].tolist())


def counted(runs: Iterable[Iterator[tuple[int, int]]]) -> Iterator[tuple[int, int]]:
    """Keys in order with the sum of their counts, by a heap over the runs."""
    before, total = None, 0
    for key, count in heapq.merge(*runs):
        if key != before:
            if before is not None:
                yield before, total
            before, total = key, 0
        total += count
    if before is not None:
        yield before, total


def with_best(pairs: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int, bool]]:
    """Whether a pair's count is the highest of its first id; no more than one id's pairs are held."""
    held: list[tuple[int, int]] = []

    def ended() -> Iterator[tuple[int, int, bool]]:
        top = max((count for _, count in held), default=0)
        return ((key, count, count == top) for key, count in held)

    for key, count in pairs:
        if held and held[0][0] >> BITS != key >> BITS:
            yield from ended()
            held = []
        held.append((key, count))
    yield from ended()


def _merge(limit: int):
    def merge(batches: Batches) -> Batches:
        spool = Spool(limit)
        for part in batches:
            for keys, counts in zip(part.column("keys").to_pylist(), part.column("counts").to_pylist()):
                spool.add(keys, counts)
        held: list[tuple[int, int, bool]] = []
        for record in with_best(counted(spool.runs())):
            if held and (len(held) >= 16 * BLOCK or held[0][0] >> 2 * BITS != record[0] >> 2 * BITS):
                yield _block(held)
                held = []
            held.append(record)
        if held:
            yield _block(held)

    return merge


def _block(held: list[tuple[int, int, bool]]) -> pa.RecordBatch:
    keys = np.array([record[0] for record in held], np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([keys[0] >> 2 * BITS], pa.int32()),
            pa.array([zipped(np.diff(keys, prepend=0))], pa.binary()),
            pa.array([zipped(np.array([record[1] for record in held], np.int64))], pa.binary()),
            pa.array([zipped(np.array([record[2] for record in held], np.int8))], pa.binary()),
        ],
        ["partition", "keys", "counts", "best"],
    )


def pair_counts(runs: DataFrame, parts: int, limit: int = HELD_BYTES) -> DataFrame:
    """Blocks of a partition's pairs with their counts and whether each is its first id's highest."""
    heads = runs.select("partition", "keys", "counts")
    if parts > 1:
        salt = F.pmod(F.xxhash64("base"), F.lit(parts))
        heads = runs.select("partition", salt.alias("salt"), "keys", "counts").repartition("partition", "salt")
        heads = heads.select("keys", "counts").mapInArrow(_merge(limit), COUNTS)
    heads = heads.select("partition", "keys", "counts").repartition("partition")
    return written(heads.select("keys", "counts").mapInArrow(_merge(limit), COUNTS), "counts")


def contributions(runs: DataFrame, counts: DataFrame, parts: int) -> DataFrame:
    """Per run, what its pairs add to its group's documents: base, size, documents, n_best and count_sum as blocks."""
    none = F.lit(None)
    known = counts.select("partition", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("salt"), "keys", "counts", "best").select(
        "*", none.cast("long").alias("base"), none.cast("int").alias("size"), none.cast("binary").alias("docs"), none.cast("binary").alias("links"), F.lit(0).alias("turn")
    )
    mine = runs.select(
        "partition", F.pmod(F.xxhash64("base"), F.lit(parts)).alias("salt"), "keys", "counts", none.cast("binary").alias("best"),
        "base", "size", "docs", "links", F.lit(1).alias("turn"),
    )
    # The counts of a part come first, then its runs, one at a time.
    dealt = known.unionByName(mine).repartition("partition", "salt").sortWithinPartitions("partition", "salt", "turn")

    def each(batches: Batches) -> Batches:
        at, held = None, []
        for part in batches:
            for row in part.to_pylist():
                if (row["partition"], row["salt"]) != at:
                    at, held, table = (row["partition"], row["salt"]), [], None
                keys = np.cumsum(unzipped(row["keys"], np.int64))
                number = unzipped(row["counts"], np.int64)
                if row["turn"] == 0:
                    held.append((keys, number, unzipped(row["best"], np.int8)))
                    continue
                if table is None:
                    table = [np.concatenate(column) for column in zip(*held)]
                    order = np.argsort(table[0])
                    table, held = [column[order] for column in table], []
                found = np.repeat(np.searchsorted(table[0], keys), number)
                docs, links = unzipped(row["docs"], np.uint32), unzipped(row["links"], np.uint32).astype(np.int64)
                best, total = np.zeros(row["size"], np.int64), np.zeros(row["size"], np.int64)
                np.add.at(best, docs, links * table[2][found])
                np.add.at(total, docs, links * table[1][found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["base"]], pa.int64()), pa.array([row["size"]], pa.int32()), pa.array([zipped(best)], pa.binary()), pa.array([zipped(total)], pa.binary())],
                    ["base", "size", "best", "total"],
                )

    return dealt.mapInArrow(each, "base long, size int, best binary, total binary")


def added_up(blocks: DataFrame) -> DataFrame:
    """place, n_best and count_sum of every document that has links: the blocks of a group together."""
    dealt = blocks.repartition("base").sortWithinPartitions("base")

    def out(base: int, best: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.arange(base, base + len(best))), pa.array(best), pa.array(total)], ["place", "n_best", "count_sum"])

    def each(batches: Batches) -> Batches:
        at = None
        for part in batches:
            for row in part.to_pylist():
                mine = unzipped(row["best"], np.int64), unzipped(row["total"], np.int64)
                if row["base"] == at:
                    best, total = best + mine[0], total + mine[1]
                    continue
                if at is not None:
                    yield out(at, best, total)
                at, (best, total) = row["base"], mine
        if at is not None:
            yield out(at, best, total)

    return dealt.mapInArrow(each, "place long, n_best long, count_sum long")


def align(
    docs: DataFrame, text: str = "text", first: str = BYTE_LEVEL, other: str = PIECES, with_groups: bool = False,
    group_bytes: int = GROUP_BYTES, part_bytes: int = PART_BYTES, held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """Per document: `row` (its columns without the text), n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    With `with_groups` the groups' text, whose digest groups_sha256 is, comes too.
    """
    spark = docs.sparkSession
    radices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = laid_out(docs, text, first, other, with_groups, radices, group_bytes)
    runs = table.filter("kind = 'run'").select("partition", "base", "size", "keys", "counts", "docs", "links")
    largest = runs.groupBy("partition").agg(F.sum(F.length("docs") + F.length("links")).alias("bytes")).agg(F.max("bytes")).first()[0]
    parts = 1 + (largest or 0) // part_bytes
    counts = pair_counts(runs, parts, held_bytes)
    sums = added_up(contributions(runs, counts, parts))
    named = ["groups"] if with_groups else []
    return (
        table.filter("kind = 'document'")
        .join(sums, "place", "left")
        .select(
            "row", "n_a", "n_b", "n_groups", "n_links",
            F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"), F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"),
            "groups_sha256", *named,
        )
    )
