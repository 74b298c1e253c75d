r"""Language-model scores from a subword lattice.

The pieces of an existing public vocabulary (its file is a parameter; it is only read) form a unigram model. All
segmentations of a word are weighted: a forward recursion in log space over the lattice of its pieces gives the
marginal probability. The vocabulary's own scores are the first weights; expectation-maximisation re-estimates them as expected piece counts
over all segmentations of the distinct training words, each once, because the pieces are asked about new words.

A text is its `[^\x20\x09-\x0D]+` words, A-Z lower-cased, and one end. In the text's lattice a word seen in training
is also one arc of its own: it gets its count less a discount, and the mass so saved is spread over the subword
paths, P(w) = max(c - d, 0) / N + d V / N * sum of the paths, with d = n1 / (n1 + 2 n2) from the words seen once and twice. This is a distribution over all words, and the log10
probability of a text is the sum over its words and end.

Counts are gathered over all documents, and each distinct word is scored once. The commonest words, at most
`BROADCAST_WORDS`, are sent to the tasks that score texts; the other words of a text are joined with the word table.

Defined results: null and empty texts are one end. Characters without a piece are spelled in bytes. A null id counts
as the empty text in the split. Without training words the subword paths alone count. Repeated rows each get a
score. Other columns pass through.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import Batches, appended, packed, texts, words
from voltframe.session import written

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS = 3
BROADCAST_WORDS = 100_000
# Distinct words that a task counts before it hands them on, and words that are put through the lattice together.
COUNTED_WORDS, LATTICE_WORDS = 400_000, 20_000
START = "▁"
END = b""
END_SHARE = 1e-3
HASH = np.uint64(0x9E3779B97F4A7C15)


def pieces(path: str) -> tuple[list[str], np.ndarray]:
    """The pieces without special ones, and weights from their scores.

    The vocabulary was built by merges, so a score is a negated rank; rank r gets Zipf's weight 1 / (r + 1). The 256
    byte pieces share one weight, entry 0.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names, weights = ["<byte>"], [1e-4]
    for k in range(model.get_piece_size()):
        name = model.id_to_piece(k)
        if model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or START in name[1:]:
            continue
        names.append(name)
        weights.append(1 / (1 - model.get_score(k)))
    return names, normalised(np.array(weights))


def normalised(weights: np.ndarray) -> np.ndarray:
    """Log weights that sum to one less the end's share; no piece falls to nothing."""
    weights = weights + 1e-9 * weights.sum()
    return np.log(weights / weights.sum() * (1 - END_SHARE))


class Lattice:
    """Piece look-up by rolling hash, and forward and backward recursions over many words of one length at a time."""

    SLOTS = 18

    def __init__(self, names: list[str]) -> None:
        self.longest = max(map(len, names[1:]))
        number = {name: k for k, name in enumerate(names) if k}
        longer = {name[:k] for name in number for k in range(1, len(name))}
        each = sorted({*number, *longer})
        # Each piece and each beginning of one: its number or -1, and whether a longer piece begins with it.
        left = {_rolled(name): (number.get(name, -1), name in longer) for name in each}
        if len(left) != len(each):
            raise ValueError("two pieces have one hash")
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray, np.ndarray]] = []
        # Pieces that meet in a slot go on to a further table.
        for turn in itertools.count():
            if not left:
                break
            factor = int(HASH) * (2 * turn + 3) % 2**64 | 1
            held, owner, more = np.zeros(1 << self.SLOTS, np.uint64), np.full(1 << self.SLOTS, -1, np.int32), np.zeros(1 << self.SLOTS, bool)
            met = {}
            for value, (piece, extended) in left.items():
                slot = (value * factor % 2**64) >> (64 - self.SLOTS)
                if held[slot]:
                    met[value] = piece, extended
                else:
                    held[slot], owner[slot], more[slot] = value, piece, extended
            self.tables.append((np.uint64(factor), held, owner, more))
            left = met

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of hashes, -1 where there is none, and whether a longer piece begins so."""
        found, more = np.full(len(value), -1, np.int32), np.zeros(len(value), bool)
        open_ = np.arange(len(value))
        for factor, held, owner, extended in self.tables:
            asked = value[open_]
            slot = ((asked * factor) >> np.uint64(64 - self.SLOTS)).astype(np.int64)
            there = held[slot]
            hit = there == asked
            found[open_[hit]], more[open_[hit]] = owner[slot[hit]], extended[slot[hit]]
            # Only what met another hash in its slot can be in a further table.
            open_ = open_[~hit & (there != 0)]
        return found, more

    def arcs(self, points: np.ndarray, weights: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(start, stop, words, piece numbers, log weights) in order of start; spelled characters have number 0."""
        length = points.shape[1]
        size = _bytes(points)
        for start in range(length):
            rows, value = np.arange(len(points)), np.zeros(len(points), np.uint64)
            for stop in range(start + 1, min(length, start + self.longest) + 1):
                value = value * HASH + points[rows, stop - 1] + np.uint64(1)
                found, more = self.find(value)
                if stop == start + 1:
                    weight = np.where(found >= 0, weights[found], size[:, start] * (weights[0] - np.log(256.0)))
                    yield start, stop, rows, np.maximum(found, 0), weight
                else:
                    hit = found >= 0
                    if hit.any():
                        yield start, stop, rows[hit], found[hit], weights[found[hit]]
                rows, value = rows[more], value[more]
                if not len(rows):
                    break

    def marginal(self, points: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Natural log of the summed weight of all segmentations of each word."""
        ahead = _borders(points, first=True)
        for start, stop, rows, _, weight in self.arcs(points, weights):
            ahead[stop, rows] = np.logaddexp(ahead[stop, rows], ahead[start, rows] + weight)
        return ahead[-1]

    def expected(self, points: np.ndarray, weights: np.ndarray, counts: np.ndarray, pieces: int) -> np.ndarray:
        """Expected number of uses of each piece in `counts` occurrences of each word."""
        each = list(self.arcs(points, weights))
        ahead, behind = _borders(points, first=True), _borders(points, first=False)
        for start, stop, rows, _, weight in each:
            ahead[stop, rows] = np.logaddexp(ahead[stop, rows], ahead[start, rows] + weight)
        for start, stop, rows, _, weight in reversed(each):
            behind[start, rows] = np.logaddexp(behind[start, rows], behind[stop, rows] + weight)
        total = np.zeros(pieces)
        size = _bytes(points)
        for start, stop, rows, found, weight in each:
            share = counts[rows] * np.exp(ahead[start, rows] + weight + behind[stop, rows] - ahead[-1, rows])
            total += np.bincount(found, np.where(found == 0, share * size[rows, start], share), pieces)
        return total


def _rolled(name: str) -> int:
    value = 0
    for char in name:
        value = (value * int(HASH) + ord(char) + 1) % 2**64
    return value


def _bytes(points: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of each character."""
    return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)


def _borders(points: np.ndarray, first: bool) -> np.ndarray:
    """Log sums at every border between characters: 0 at the first or last one, nothing elsewhere yet."""
    sums = np.full((points.shape[1] + 1, len(points)), -np.inf)
    sums[0 if first else -1] = 0
    return sums


def _by_length(each: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and code points (with the mark of a word's start) of words of equal length."""
    names = [START + word.decode("utf-8", "replace") for word in each]
    lengths = np.fromiter(map(len, names), np.int64, len(names))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        points = np.frombuffer("".join([names[k] for k in at]).encode("utf-32-le", "surrogatepass"), np.uint32)
        yield at, points.reshape(len(at), length).astype(np.uint64)


def log_marginals(lattice: Lattice, weights: np.ndarray, each: list[bytes]) -> np.ndarray:
    out = np.empty(len(each))
    for at, points in _by_length(each):
        out[at] = lattice.marginal(points, weights)
    for place, word in enumerate(each):
        if word == END:
            out[place] = np.log(END_SHARE)
    return out


def _merged(parts: Batches, size: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least `size` rows, but for the last."""
    held: list[pa.RecordBatch] = []
    for part in parts:
        held.append(part)
        if sum(p.num_rows for p in held) >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(p.num_rows for p in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def word_counts(docs: DataFrame, train: Column, text: str = "text") -> DataFrame:
    """(word, c): every distinct word of all texts, and the end, with its count in training texts."""

    def count(parts: Batches) -> Batches:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for part in parts:
            for content, learned in zip(texts(part, "text"), part.column("train").to_pylist()):
                each = words(content) + [END]
                if learned:
                    seen.update(each)
                else:
                    for word in each:
                        seen.setdefault(word, 0)
                if len(seen) > COUNTED_WORDS:
                    yield rows()
                    seen.clear()
        yield rows()

    narrow = docs.select(F.col(text).alias("text"), train.alias("train"))
    return narrow.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def piece_weights(counts: DataFrame, path: str = VOCABULARY, rounds: int = ROUNDS) -> tuple[Broadcast, np.ndarray]:
    """The lattice of the pieces, as sent to the tasks, and log weights after expectation-maximisation over all
    training words."""
    names, weights = pieces(path)
    context = counts.sparkSession.sparkContext
    # Some 15 MB, as large as the vocabulary makes it.
    lattice = context.broadcast(Lattice(names))
    for _ in range(rounds):
        shared = context.broadcast(weights)

        def expect(parts: Batches) -> Batches:
            now = shared.value
            total = np.zeros(len(now))
            for part in _merged(parts, LATTICE_WORDS):
                for at, points in _by_length(part.column("word").to_pylist()):
                    total += lattice.value.expected(points, now, np.ones(len(at)), len(now))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["piece", "n"])

        seen = counts.filter("c > 0").filter(F.length("word") > 0).select("word")
        # No more rows than the vocabulary has pieces.
        rows = seen.mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        if not rows:
            break
        total = np.zeros(len(names))
        for row in rows:
            total[row["piece"]] = row["n"]
        weights = normalised(total)
    return lattice, weights


def word_scores(counts: DataFrame, lattice: Broadcast, weights: np.ndarray, tokens: int, distinct: int, discount: float) -> DataFrame:
    """(word, c, base, score): log10 of the add-one estimate and of the model's probability."""
    shared = counts.sparkSession.sparkContext.broadcast(weights)

    def score(parts: Batches) -> Batches:
        for part in _merged(parts, LATTICE_WORDS):
            many = np.array(part.column("c").to_pylist(), np.float64)
            paths = log_marginals(lattice.value, shared.value, part.column("word").to_pylist())
            if tokens:
                seen = np.maximum(many - discount, 0) / tokens
                with np.errstate(divide="ignore"):
                    paths = np.logaddexp(np.log(seen), np.log(discount * distinct / tokens) + paths)
            base = np.log10((many + 1) / (tokens + distinct + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("word"), part.column("c"), pa.array(base), pa.array(paths / np.log(10.0))], ["word", "c", "base", "score"]
            )

    return counts.mapInArrow(score, "word binary, c long, base double, score double")


def scored(docs: DataFrame, train: Column, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """`row` (the document's own columns), n_tokens, n_known, train_tokens, base_score and score."""
    counts = written(word_counts(docs, train, text), "words")
    tokens, distinct, once, twice = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
    ).first()
    # Held away from the ends, where tiny corpora would put it.
    discount = min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.0))
    lattice, weights = piece_weights(counts, path)
    table = written(word_scores(counts, lattice, weights, tokens, distinct, discount), "word-scores")
    shared = docs.sparkSession.sparkContext.broadcast(_commonest(table))
    index: dict[bytes, int] = {}

    def add(part: pa.RecordBatch) -> list[pa.Array]:
        known, base, score = shared.value
        if not index:
            index.update((word, k) for k, word in enumerate(known))
        sums, rare = [], []
        for content in texts(part, "text"):
            each = words(content) + [END]
            at = np.array([index.get(word, -1) for word in each], np.int64)
            common = at[at >= 0]
            sums.append((len(each), len(common), float(base[common].sum()), float(score[common].sum())))
            other = Counter(word for word, k in zip(each, at.tolist()) if k < 0)
            rare.append([{"word": word, "n": n} for word, n in other.items()])
        columns = list(zip(*sums))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        pair = pa.struct([("word", pa.binary()), ("n", pa.int64())])
        return [*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array(rare, pa.list_(pair))]

    fields = "n_tokens long, common long, base double, score double, rare array<struct<word: binary, n: long>>"
    part = appended(packed(docs, text=text), add, fields).drop("text").withColumn("place", F.monotonically_increasing_id())
    # Written once, so that the places are the same on both sides of the join below.
    part = written(part, "scored")
    words_left = part.select("place", F.explode("rare").alias("r")).select("place", "r.word", "r.n")
    joined = words_left.join(table, "word").groupBy("place").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"),
        F.sum(F.col("n") * F.col("base")).alias("more_base"),
        F.sum(F.col("n") * F.col("score")).alias("more_score"),
    )
    return part.join(joined, "place", "left").select(
        "row",
        "n_tokens",
        (F.col("common") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def _commonest(table: DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words seen at least 2^k times in training, for the least k that leaves no more than the bound."""
    sizes = table.filter("c > 0").groupBy(F.floor(F.log2("c")).alias("k")).count().orderBy(F.desc("k")).collect()
    least, held = None, 0
    for row in sizes:
        held += row["count"]
        if held > BROADCAST_WORDS:
            break
        least = row["k"]
    if least is None:
        return [], np.empty(0), np.empty(0)
    found = table.filter(F.col("c") >= 2**least).select("word", "base", "score").toArrow()
    return found["word"].to_pylist(), found["base"].to_numpy(), found["score"].to_numpy()
