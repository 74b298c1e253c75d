r"""Near-duplicate documents by MinHash with banding, and connected components by alternating stars.

A document's set holds its distinct five-word shingles (words are lower-cased `[^\x20\x09-\x0D]+`); with fewer
words the whole sequence is one shingle; without words it is empty and linked with nothing. Documents are linked
when 100 * |intersection| >= 75 * |union|, which is always decided on the full sets.

1. Equal sets are one class, represented by its smallest id, before anything else is compared: copies, however
   many, are one node.
2. A signature holds the minima of 128 universal hashes; 32 bands of four give bucket keys. Two sets at the
   threshold share no bucket with probability (1 - 0.75**4)**32, about 5 in a million.
3. In each bucket the most central representative (whose buckets are the fullest) is compared with all others: as
   many pairs as members, not their square. Signatures refuse pairs far below the threshold, full sets decide.
4. Buckets that still hold several components are taken up again: all pairs across components where a bucket
   is small, the next central ones against all members where it is large, until a pass finds no link.
5. What large buckets then still hold in several components is joined exactly: two linked sets share one of their
   rarest shingles, so a set is filed under its rarest quarter and compared across components where it meets others
   at a place from which the threshold can still be reached.
6. Links become components by alternating large-star and small-star steps over written tables.

Defined results: null texts are empty. Documents without id are in the class of their set, but never represent
one; a class in which nobody has an id has a null component. Rows that repeat an id are one node. Extra columns
of any name pass through `representatives`. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.llm.common import Batches, texts, words
from voltframe.session import written

SHINGLE_WORDS = 5
HASHES = 128
BANDS = 32
SIMILARITY = (75, 100)
# Signatures refuse a pair more than five standard deviations below the threshold.
SIGNATURE_FLOOR = 0.75 - 5 * (0.75 * 0.25 / HASHES) ** 0.5
# Buckets up to this size compare all pairs of different components, larger ones this many leaders a pass.
SMALL_BUCKET = 24
LEADERS = 4
# Counters by which shingles are ordered from rare to common (8 MB); any order gives the same links.
COUNTERS = 1 << 20
# Ids up to this many (32 MB) are broadcast to pick rows; beyond, the join is shuffled.
BROADCAST_IDS = 4_000_000
# Words whose hashes a task keeps at a time.
CACHED_WORDS = 500_000

_random = np.random.default_rng(20240501)
MULTIPLIERS = _random.integers(0, 2**64, HASHES, np.uint64) | np.uint64(1)
OFFSETS = _random.integers(0, 2**64, HASHES, np.uint64)
BASE = 0x9E3779B97F4A7C15
POWERS = np.array([pow(BASE, SHINGLE_WORDS - 1 - k, 2**64) for k in range(SHINGLE_WORDS)], np.uint64)


class WordHashes(dict):
    """Hash of a word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    each = words(text)
    if not each:
        return np.empty(0, np.uint64)
    values = np.fromiter((hashes[w] for w in each), np.uint64, len(each))
    with np.errstate(over="ignore"):
        if len(each) < SHINGLE_WORDS:
            mixed = np.uint64(len(each))
            for value in values:
                mixed = mixed * np.uint64(BASE) + value
            mixed = np.array([mixed], np.uint64)
        else:
            count = len(each) - SHINGLE_WORDS + 1
            mixed = np.zeros(count, np.uint64)
            for k, power in enumerate(POWERS):
                mixed += values[k : k + count] * power
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of the universal hashes (a * x + b) >> 32."""
    least = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(found), 2048):
        part = found[start : start + 2048, None]
        least = np.minimum(least, ((part * MULTIPLIERS + OFFSETS) >> np.uint64(32)).min(axis=0))
    return least.astype(np.uint32)


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    common = len(np.intersect1d(left, right, assume_unique=True))
    return SIMILARITY[1] * common >= SIMILARITY[0] * (len(left) + len(right) - common)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def sketches(docs: DataFrame, id: str, text: str) -> DataFrame:
    """id, n (set size), the set's 128-bit hash in two halves and its signature."""

    def sketch(parts: Batches) -> Batches:
        hashes = WordHashes()
        for part in parts:
            sizes, low, high, minima = [], [], [], []
            for content in texts(part, "text"):
                found = shingles(content, hashes)
                digest = xxhash.xxh3_128_intdigest(found.tobytes())
                sizes.append(len(found))
                low.append(digest & (2**64 - 1))
                high.append(digest >> 64)
                minima.append(signature(found).tobytes() if len(found) else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(sizes, pa.int64()),
                    _signed(np.array(low, np.uint64)),
                    _signed(np.array(high, np.uint64)),
                    pa.array(minima, pa.binary()),
                ],
                ["id", "n", "low", "high", "minima"],
            )

    narrow = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(sketch, f"id {kind}, n long, low long, high long, minima binary")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(key, node) for every band of every signature."""
    rows = HASHES // BANDS

    def cut(parts: Batches) -> Batches:
        for part in parts:
            minima = np.frombuffer(b"".join(part.column("minima").to_pylist()), np.uint32).reshape(-1, BANDS, rows)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), minima.shape[:2]).copy()
            for row in range(rows):
                key = key * np.uint64(BASE) + minima[:, :, row]
                key ^= key >> np.uint64(31)
            for band in range(BANDS):
                yield pa.RecordBatch.from_arrays([_signed(key[:, band].copy()), part.column("node")], ["key", "node"])

    kind = nodes.schema["node"].dataType.simpleString()
    return nodes.select("node", "minima").mapInArrow(cut, f"key long, node {kind}")


def picked(df: DataFrame, ids: DataFrame, on: str, how: str) -> DataFrame:
    """Semi or anti join on an id; the ids are broadcast while they are few, else both sides are shuffled."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, on, how)


def _sets(docs: DataFrame, live: DataFrame, id: str, text: str) -> DataFrame:
    """Full sets of the documents that share a bucket with another one."""

    def full(parts: Batches) -> Batches:
        hashes = WordHashes()
        for part in parts:
            found = [shingles(content, hashes) for content in texts(part, "text")]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)]).astype(np.int32)
            values = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.ListArray.from_arrays(pa.array(offsets), _signed(values))], ["node", "items"]
            )

    chosen = picked(docs.select(F.col(id).alias("node"), F.col(text).alias("text")), live, "node", "left_semi")
    kind = chosen.schema["node"].dataType.simpleString()
    return written(chosen.mapInArrow(full, f"node {kind}, items array<long>"), "sets")


def _matched(pairs: DataFrame, left: str, right: str, test) -> DataFrame:
    """The pairs (a, b) whose two columns pass `test`."""

    def check(parts: Batches) -> Batches:
        for part in parts:
            yield part.select(["a", "b"]).filter(pa.array(test(part.column(left), part.column(right)), pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.mapInArrow(check, f"a {kind}, b {kind}")


def _close(left: pa.Array, right: pa.Array) -> list[bool]:
    one, other = (np.frombuffer(b"".join(c.to_pylist()), np.uint32).reshape(-1, HASHES) for c in (left, right))
    return ((one == other).mean(axis=1) >= SIGNATURE_FLOOR).tolist()


def _linked(left: pa.Array, right: pa.Array) -> list[bool]:
    def views(column: pa.Array) -> list[np.ndarray]:
        values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
        return [values[a:b] for a, b in zip(offsets, offsets[1:])]

    return [similar(a, b) for a, b in zip(views(left), views(right))]


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among candidate pairs: signatures first, then full sets."""

    def beside(table: DataFrame, end: str, column: str) -> DataFrame:
        return table.select(F.col("node").alias(end), F.col(column).alias(f"{column}_{end}"))

    signed = pairs.join(beside(nodes, "a", "minima"), "a").join(beside(nodes, "b", "minima"), "b")
    close = _matched(signed, "minima_a", "minima_b", _close).distinct()
    whole = close.join(beside(sets, "a", "items"), "a").join(beside(sets, "b", "items"), "b")
    return _matched(whole, "items_a", "items_b", _linked).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); the component is its smallest node.

    Large-star hangs each larger neighbour on the smallest node around; small-star does the same among the smaller
    ones. Both are repeated until the links are stars. Minima are aggregated with a partial step, written, and
    joined back with both sides exchanged, so that a node with very many neighbours can be split.
    """
    edges = written(links.select("a", "b").filter("a <> b").distinct(), "edges")
    state = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = written(large, "large")
        # Each edge points from the larger to the smaller end.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = down.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = written(small.select("e.*").filter("a <> b").distinct(), "edges")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return written(ends.union(roots), "components")


def _first_pairs(live: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's most central one."""
    centre = written(live.groupBy("key").agg(F.max_by("node", F.struct("centrality", "node")).alias("leader")), "leaders")
    return _ordered(live.join(centre, "key").select("leader", "node"))


def _ordered(pairs: DataFrame) -> DataFrame:
    one, other = pairs.columns
    return pairs.filter(F.col(one) != F.col(other)).select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def _open(live: DataFrame, parts: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component."""
    held = live.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    held = written(held, "held")
    mixed = held.groupBy("key").agg(F.min("component").alias("one"), F.max("component").alias("other")).filter("one <> other")
    return written(held.join(written(mixed.select("key"), "mixed"), "key"), "open")


def _next_pairs(held: DataFrame, turn: int) -> DataFrame:
    """All pairs across components in small buckets; in large ones more leaders against the other components.

    The leaders are the most central members of as many random parts of the bucket, dealt anew each turn.
    """
    many = held.filter(F.col("size") > SMALL_BUCKET)
    deal = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(LEADERS * (turn + 1)))
    lead = many.groupBy("key", deal.alias("deal")).agg(
        F.max_by(F.struct("node", "component"), F.struct("centrality", "node")).alias("top")
    )
    lead = written(lead.select("key", F.col("top.node").alias("peer"), F.col("top.component").alias("part")), "leaders")
    far = many.join(lead, "key").filter("component <> part").select("node", "peer")
    if turn:
        return _ordered(far)
    few = held.filter(F.col("size") <= SMALL_BUCKET).select("key", "node", "component")
    other = few.select("key", F.col("node").alias("peer"), F.col("component").alias("part"))
    return _ordered(far.union(few.join(other, "key").filter("node < peer AND component <> part").select("node", "peer")))


def _heads(held: DataFrame, sets: DataFrame) -> DataFrame:
    """(item, node, component, n, place): the rarest shingles of the members of large buckets, of which linked sets share one."""
    many = held.filter(F.col("size") > SMALL_BUCKET).select("node", "component").distinct()
    each = written(many.join(sets, "node"), "open-sets")
    counted = each.select(F.explode("items").alias("item")).groupBy(F.pmod("item", F.lit(COUNTERS)).alias("slot")).count().toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[counted.column("slot").to_numpy()] = counted.column("count").to_numpy()
    shared = held.sparkSession.sparkContext.broadcast(counts)

    def head(parts: Batches) -> Batches:
        for part in parts:
            values, offsets = part.column("items").values.to_numpy(), part.column("items").offsets.to_numpy()
            first = []
            for a, b in zip(offsets, offsets[1:]):
                own, n = values[a:b], b - a
                length = n + (-n * SIMILARITY[0]) // SIMILARITY[1] + 1
                first.append(own[np.lexsort((own, shared.value[own % COUNTERS]))[:length]])
            sizes = np.array([len(f) for f in first], np.int64)
            rows = pa.array(np.repeat(np.arange(len(first)), sizes))
            columns = {
                "item": pa.array(np.concatenate(first) if first else np.empty(0, np.int64), pa.int64()),
                "node": part.column("node").take(rows),
                "component": part.column("component").take(rows),
                "n": pa.array(np.repeat(np.diff(offsets), sizes), pa.int64()),
                "place": pa.array(np.concatenate([np.arange(k) for k in sizes]) if first else [], pa.int64()),
            }
            for start in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([c.slice(start, 50_000) for c in columns.values()], list(columns))

    kind = each.schema["node"].dataType.simpleString()
    return written(each.mapInArrow(head, f"item long, node {kind}, component {kind}, n long, place long"), "heads")


def _far_pairs(held: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs across components of large buckets that may be linked; the largest component of an item meets the others only."""
    heads = _heads(held, sets)
    sizes = heads.groupBy("item", "component").count()
    most = sizes.groupBy("item").agg(F.max_by("component", F.struct("count", "component")).alias("most"), F.count("*").alias("parts"))
    posted = written(heads.join(written(most.filter("parts > 1").select("item", "most"), "mixed"), "item"), "posted")
    other = posted.filter("component <> most").select("item", *[F.col(c).alias(f"other_{c}") for c in ("node", "component", "n", "place")])
    # The places of the first common item leave room for enough common ones behind them.
    whole = F.col("n") + F.col("other_n")
    room = F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place"))
    near = (F.col("component") != F.col("other_component")) & (room * sum(SIMILARITY) >= whole * SIMILARITY[0])
    return _ordered(posted.join(other, "item").filter(near).select("node", "other_node"))


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The sketches of all documents, and per class (low, high) its representative and component."""
    drawn = written(sketches(docs, id, text), "sketches")
    one = drawn.filter("n > 0 AND id IS NOT NULL").groupBy("low", "high")
    nodes = written(one.agg(F.min("id").alias("node"), F.min_by("minima", "id").alias("minima")), "nodes")
    keys = _buckets(nodes)
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    centrality = F.sum("size").over(Window.partitionBy("node")).alias("centrality")
    live = written(keys.join(written(shared, "shared"), "key").select("*", centrality), "live")
    sets = _sets(docs, live.select("node").distinct(), id, text)
    links = written(_verified(_first_pairs(live), nodes, sets), "links")
    parts = components(links)
    turn = 0
    while True:
        held = _open(live, parts)
        new = written(_verified(_next_pairs(held, turn), nodes, sets), "links")
        found = new.limit(1).count()
        if found:
            parts = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(new))
        turn += 1
        if not found and turn > 1:
            break
    if held.filter(F.col("size") > SMALL_BUCKET).limit(1).count():
        new = written(_verified(_far_pairs(held, sets), nodes, sets), "links")
        parts = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(new))
    named = nodes.join(parts, "node", "left").select("low", "high", F.coalesce("component", "node").alias("component"))
    return drawn, written(named, "classes")


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, n_shingles, component_id, kept."""
    drawn, named = classes(docs, id, text)
    # A set without shingles belongs to its document alone.
    alone = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return drawn.select("id", "n", "low", "high").join(named, ["low", "high"], "left").select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), alone.alias("component_id"), F.col("id").eqNullSafe(alone).alias("kept")
    )


def representatives(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` whose document stands for its component, with all their columns."""
    decided = written(near_groups(docs, id, text).filter("NOT kept").select(id).distinct(), "dropped")
    return picked(docs, decided, id, "left_anti").select(*docs.columns)
