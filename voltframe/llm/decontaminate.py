"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of ten consecutive words; an item of fewer words is one window. A document word is
hit when it lies inside any occurrence of a window. As a window must be contained whole, one shingle is a
sufficient prefix: each window is filed under its rarest three-word shingle, rarity being counted over all
documents. A document shingle that is some window's prefix names where that window would have to start; the
bounds of position and length are applied, and the words of the window are compared one by one.

The windows are the query set and the documents stream past them without a shuffle. Windows are broadcast in
blocks of at most `BLOCK_WINDOWS`, so what is broadcast has a bound; further blocks are further passes.

Defined results: null and empty texts have no words and no hits. Repeated items count once per item id; an item
without id is reported under the empty text. Rows of any other columns pass through unchanged.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from voltframe.llm.common import Batches, appended, packed, texts
from voltframe.session import written

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
# At most so many (window, item) rows are held on the driver and broadcast at a time: some 30 MB.
BLOCK_WINDOWS = 200_000
# Capitals to lower case, every byte that is no word byte to a blank.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    r"""Lower-cased words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`."""
    return text.translate(WORD_BYTES).split()


def windows(benchmark: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """Every distinct (item, window), the words of a window joined by blanks."""

    def cut(parts: Batches) -> Batches:
        for part in parts:
            items, found = [], []
            for item, content in zip(part.column("item").to_pylist(), texts(part, "text")):
                each = words(content)
                for start in range(max(1, len(each) - WINDOW_WORDS + 1) if each else 0):
                    items.append(item)
                    found.append(b" ".join(each[start : start + WINDOW_WORDS]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(found, pa.binary())], ["item", "window"])

    narrow = benchmark.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return narrow.mapInArrow(cut, "item string, window binary").distinct()


class Block:
    """A bounded set of windows with their vocabulary; what a task needs to find them."""

    def __init__(self, rows: list[Row]) -> None:
        items = defaultdict(list)
        for row in rows:
            items[bytes(row["window"])].append(row["item"])
        self.windows = [w.split(b" ") for w in sorted(items)]
        self.items = [items[w] for w in sorted(items)]
        self.number = {word: n for n, word in enumerate(sorted({word for w in self.windows for word in w}))}
        self.base = len(self.number) + 1
        if self.base**SHINGLE_WORDS >= 2**63:
            raise ValueError("too many different words in one block; lower BLOCK_WINDOWS")
        self.words = [np.array([self.number[word] for word in w], np.int64) for w in self.windows]
        self.sizes = sorted({min(SHINGLE_WORDS, len(w)) for w in self.windows})
        self.codes = {
            size: np.unique(np.concatenate([_shingles(w, size, self.base)[0] for w in self.words if min(SHINGLE_WORDS, len(w)) == size]))
            for size in self.sizes
        }
        self.prefixes: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def file_under(self, counts: dict[tuple[int, int], int]) -> None:
        """Each window under its rarest shingle; of equally rare ones the first."""
        prefixes = defaultdict(list)
        for number, window in enumerate(self.words):
            size = min(SHINGLE_WORDS, len(window))
            codes = _shingles(window, size, self.base)[0].tolist()
            offset = min(range(len(codes)), key=lambda k: (counts.get((size, codes[k]), 0), k))
            prefixes[size, codes[offset]].append((number, offset))
        self.prefixes = dict(prefixes)
        self.codes = {size: np.array(sorted(c for s, c in prefixes if s == size), np.int64) for size in self.sizes}

    def shingles(self, each: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Size, places and codes of the document's shingles that some window asks for."""
        for size in self.sizes:
            codes, places = _shingles(each, size, self.base)
            wanted = self.codes[size]
            at = np.searchsorted(wanted, codes)
            at[at == len(wanted)] = 0
            hit = wanted[at] == codes
            yield size, places[hit], codes[hit]

    def numbered(self, content: bytes) -> np.ndarray:
        get = self.number.get
        return np.array([get(word, -1) for word in words(content)], np.int64)

    def matches(self, each: np.ndarray) -> list[tuple[int, int]]:
        """(start, window) of every occurrence."""
        found = []
        for size, places, codes in self.shingles(each):
            for place, code in zip(places.tolist(), codes.tolist()):
                for number, offset in self.prefixes[size, code]:
                    window, start = self.words[number], place - offset
                    if 0 <= start <= len(each) - len(window) and (each[start : start + len(window)] == window).all():
                        found.append((start, number))
        return found


def _shingles(each: np.ndarray, size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and places of all runs of `size` known words."""
    count = len(each) - size + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, known = np.zeros(count, np.int64), np.ones(count, bool)
    for k in range(size):
        part = each[k : k + count]
        codes = codes * base + part + 1
        known &= part >= 0
    places = np.flatnonzero(known)
    return codes[places], places


def _rarity(docs: DataFrame, block) -> dict[tuple[int, int], int]:
    """How often each shingle of the block's windows occurs in all documents; no more entries than the block has."""

    def count(parts: Batches) -> Batches:
        seen: Counter = Counter()
        for part in parts:
            for content in texts(part, "text"):
                for size, _, codes in block.value.shingles(block.value.numbered(content)):
                    seen.update((size, code) for code in codes.tolist())
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([seen[k] for k in keys], pa.int64())],
            ["size", "code", "n"],
        )

    total = docs.select("text").mapInArrow(count, "size long, code long, n long").groupBy("size", "code").agg(F.sum("n").alias("n"))
    return {(row["size"], row["code"]): row["n"] for row in total.toLocalIterator()}


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """`row` (the document's own columns), n_words, spans (first word, word behind the last) and items.

    `spans` are disjoint and in order; `items` are the ids of items with an occurring window, sorted as texts.
    """
    found = written(windows(benchmark, item_id, item_text), "windows")
    blocks = max(1, math.ceil(found.count() / block_windows))
    marked = packed(docs, text=text)
    for number in range(blocks):
        chosen = found.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == number)
        part = Block(chosen.collect())
        share = docs.sparkSession.sparkContext.broadcast
        if part.windows:
            part.file_under(_rarity(packed(docs, text=text), share(part)))
        marked = _mark(marked, share(part), first=number == 0)
        if number + 1 < blocks:
            marked = written(marked, "marked")
    return marked.drop("text")


def _mark(docs: DataFrame, block, first: bool) -> DataFrame:
    fields = "n_words long, spans array<struct<start: long, stop: long>>, items array<string>"
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def mark(part: pa.RecordBatch) -> list[pa.Array]:
        columns = of(part)
        return columns if first else [pa.StructArray.from_arrays(columns, ["n_words", "spans", "items"])]

    def of(part: pa.RecordBatch) -> list[pa.Array]:
        own = block.value
        before = [([], [])] * part.num_rows
        if not first:
            before = [
                ([(s["start"], s["stop"]) for s in spans], items)
                for spans, items in zip(part.column("spans").to_pylist(), part.column("items").to_pylist())
            ]
        lengths, spans, items = [], [], []
        for content, (old, named) in zip(texts(part, "text"), before):
            each = own.numbered(content)
            hits = own.matches(each) if own.windows else []
            lengths.append(len(each))
            spans.append(joined(old + [(start, start + len(own.words[w])) for start, w in hits]))
            items.append(sorted({*named, *(item for _, w in hits for item in own.items[w])}))
        return [
            pa.array(lengths, pa.int64()),
            pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], pa.list_(span)),
            pa.array(items, pa.list_(pa.string())),
        ]

    if first:
        return appended(docs, mark, fields)
    # A later block replaces the columns of the one before.
    again = appended(docs, mark, f"after struct<{fields}>")
    return again.select("text", "row", "after.*")


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans in order that cover the same words."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(stop, out[-1][1])
        else:
            out.append((start, stop))
    return out


def hit_words(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` without any occurrence of a benchmark window."""
    return decontaminate(docs, benchmark, text).filter(F.size("spans") == 0).select("row.*")
