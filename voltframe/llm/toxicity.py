"""Toxicity by a support vector machine over a gapped-subsequence string kernel with Nystroem landmarks.

A text is as toxic as its worst segment. Segments are white-space words (runs of single characters, as in
"i d i o t", are put together; long words are cut into overlapping windows). The kernel of two segments sums, over
all subsequences of three characters, lambda to the power of the spans they take in both, and is normalised; so
gaps and inserted characters lower it but don't void it. Landmarks are segments of labelled training texts; the
Nystroem map K(x, L) K(L, L)^(-1/2) gives features to a linear machine with squared hinge loss. Only whole texts
carry labels, so the segment that speaks for a toxic text is chosen anew by the machine in each round, and clean
texts contribute their most suspicious segments. Logistic calibration of the worst segment gives the score.

The decision is linear in the kernels and each kernel is linear in weighted subsequences, so the trained machine
folds exactly into one table of 64^3 subsequence weights (1 MB, whatever the corpus) that is sent to the tasks.

Training uses at most `TEXTS_PER_LABEL` texts of each label, picked by hash. Defined results: null and empty
texts get the score of a text without segments; without training texts of both labels every score is the share
of toxic ones among them (0 if there are none). Repeated labels of one id count as toxic if any is.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from voltframe.llm.chunks import spans
from voltframe.llm.common import Batches, appended, remainder, texts
from voltframe.session import written

TEXTS_PER_LABEL = 1500
LANDMARKS = 160
ROUNDS = 4
DECAY = 0.6
WINDOW, STEP = 16, 8
SYMBOLS = 64
START, END, SIGN = 62, 63, 61
PENALTY = 10.0
# A character run counts as a sign of toxic texts from this log-odds ratio on, if so many toxic ones among its texts are
# chance with at most this probability, for any of all runs together; how strong other signs are does not matter.
LEAST_ODDS, CHANCE = 3.0, 0.01
# Distinct segments whose scores a task keeps at a time.
KEPT_SEGMENTS = 200_000
EDGES = "\"'`.,;:!?()[]{}<>|/\\*_-+=~#$%&@^"


def _code(point: int) -> int:
    char = chr(point)
    if "a" <= char <= "z":
        return point - 96
    if "0" <= char <= "9":
        return point - 21
    return 37 + point % 24 if char.isalpha() else SIGN


CODES = np.array([_code(point) for point in range(0x10000)], np.int64)


def segments(text: str) -> set[str]:
    """The distinct segments of a text."""
    each = text.lower().split()
    found = set()
    for word in set(each):
        if len(word) <= WINDOW:
            found.add(word.strip(EDGES))
        else:
            found.update(part.strip(EDGES) for part in _windows(word))
    single: list[str] = []
    if sum(len(word) == 1 for word in each) > 2:
        for word in [*each, ""]:
            if len(word) == 1:
                single.append(word)
            elif single:
                if len(single) > 2:
                    found.update(part.strip(EDGES) for part in _windows("".join(single)))
                single = []
    found.discard("")
    return found


def _windows(word: str) -> list[str]:
    if len(word) <= WINDOW:
        return [word]
    return [word[k : k + WINDOW] for k in range(0, len(word) - WINDOW, STEP)] + [word[-WINDOW:]]


def encoded(each: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Segments of equal length together: their places in `each`, and their symbols with marks at both ends."""
    lengths = np.fromiter(map(len, each), np.int64, len(each))
    out = []
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        points = np.frombuffer("".join([each[k] for k in at]).encode("utf-32-le"), np.uint32).reshape(-1, length)
        symbols = np.empty((len(at), length + 2), np.int64)
        symbols[:, 0], symbols[:, -1] = START, END
        symbols[:, 1:-1] = CODES[np.minimum(points, 0xFFFF)]
        out.append((at, symbols))
    return out


_PLACES: dict[int, tuple[np.ndarray, ...]] = {}


def _places(length: int) -> tuple[np.ndarray, ...]:
    """All subsequences of three places, with their weights."""
    if length not in _PLACES:
        each = np.array(list(combinations(range(length), 3)))
        _PLACES[length] = each[:, 0], each[:, 1], each[:, 2], DECAY ** (each[:, 2] - each[:, 0] + 1.0)
    return _PLACES[length]


def subsequences(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, second, third, weight = _places(symbols.shape[1])
    return (symbols[:, first] * SYMBOLS + symbols[:, second]) * SYMBOLS + symbols[:, third], weight


def norms(symbols: np.ndarray) -> np.ndarray:
    """Square root of the kernel of each segment with itself, by dynamic programming over pairs of prefixes."""
    length = symbols.shape[1]
    steps = np.arange(length)
    fade = np.where(steps[:, None] >= steps, DECAY ** np.maximum(steps[:, None] - steps, 0.0), 0.0)
    same = (symbols[:, :, None] == symbols[:, None, :]) * DECAY**2
    paths = same
    for _ in range(2):
        total = fade @ paths @ fade.T
        paths = np.zeros_like(same)
        paths[:, 1:, 1:] = same[:, 1:, 1:] * total[:, :-1, :-1]
    return np.sqrt(paths.sum(axis=(1, 2)))


def kernels(each: list[str], tables: np.ndarray, columns: np.ndarray | None = None) -> np.ndarray:
    """For each segment and each table, the sum of normalised subsequence weights times the table's entries.

    `columns` names each subsequence's column where the tables hold only some of them.
    """
    out = np.empty((len(each), len(tables)))
    for at, symbols in encoded(each):
        for start in range(0, len(at), 2048):
            part = symbols[start : start + 2048]
            codes, weight = subsequences(part)
            scale = norms(part)
            if columns is not None:
                codes = columns[codes]
            for number, table in enumerate(tables):
                out[at[start : start + 2048], number] = table[codes] @ weight / scale
    return out


def profiles(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The landmarks' normalised tables over the subsequences that occur in any, these, and each one's column.

    Column 0 stands for all other subsequences.
    """
    parts = []
    for segment in landmarks:
        [(_, symbols)] = encoded([segment])
        codes, weight = subsequences(symbols)
        parts.append((codes[0], weight / norms(symbols)[0]))
    known = np.unique(np.concatenate([codes for codes, _ in parts]))
    columns = np.zeros(SYMBOLS**3, np.int32)
    columns[known] = np.arange(1, len(known) + 1)
    tables = np.stack([np.bincount(columns[codes], weight, len(known) + 1).astype(np.float32) for codes, weight in parts])
    return tables, known, columns


class Machine:
    """The folded decision: subsequence weights, offset, and the calibration of a text's worst segment."""

    def __init__(self, weights: np.ndarray, offset: float) -> None:
        self.weights, self.offset = weights.astype(np.float32), offset
        self.slope, self.shift = 1.0, 0.0

    def decide(self, each: list[str]) -> np.ndarray:
        return kernels(each, self.weights[None])[:, 0] + self.offset

    def score(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.shift, -30, 30)))


def fitted(toxic: list[str], clean: list[str], landmarks: list[str]) -> Machine:
    """Nystroem features of the segments, then the machine, folded into subsequence weights."""
    tables, known, columns = profiles(landmarks)
    each = toxic + clean
    near, own = kernels(each, tables, columns), kernels(landmarks, tables, columns)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    sure = values > 1e-6 * values.max()
    root = vectors[:, sure] / np.sqrt(values[sure])
    features = np.hstack([near @ root, np.ones((len(each), 1))])
    target = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    share = np.where(target > 0, 0.5 / len(toxic), 0.5 / len(clean)) * len(target)
    found = squared_hinge(features, target, PENALTY * share)
    weights = np.zeros(SYMBOLS**3)
    weights[known] = (tables.T @ (root @ found[:-1]))[1:]
    return Machine(weights, float(found[-1]))


def squared_hinge(features: np.ndarray, target: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Linear support vector machine in the primal: damped Newton steps on the rows inside the margin."""
    found = np.zeros(features.shape[1])
    ridge = np.ones(features.shape[1])
    ridge[-1] = 1e-3

    def loss(at: np.ndarray) -> float:
        return ridge @ at**2 + cost @ np.maximum(0, 1 - target * (features @ at)) ** 2

    for _ in range(60):
        slack = np.maximum(0, 1 - target * (features @ found))
        inside = slack > 0
        part, weight = features[inside], cost[inside]
        slope = ridge * found - part.T @ (weight * target[inside] * slack[inside])
        step = np.linalg.solve((part.T * weight) @ part + np.diag(ridge), slope)
        size, before = 1.0, loss(found)
        while size > 1e-6 and loss(found - size * step) > before - 0.1 * size * (slope @ step):
            size /= 2
        found = found - size * step
        if before - loss(found) < 1e-7 * before:
            break
    return found


def calibrated(machine: Machine, worst: np.ndarray, toxic: np.ndarray, odds: float) -> None:
    """Logistic slope and shift of the worst segments' decisions, lightly held to slope 4.

    `odds` is how many clean training texts there are to a toxic one; the sample is weighted to that.
    """
    found = np.array([4.0, 0.0])
    x = np.stack([worst, np.ones(len(worst))], axis=1)
    share = np.where(toxic > 0, 1.0, odds * toxic.sum() / max(1, (1 - toxic).sum()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        slope = x.T @ (share * (p - toxic)) + 0.1 * (found - [4.0, 0.0])
        bend = (x.T * (share * p * (1 - p))) @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        found -= np.clip(step, -2, 2)
    machine.slope, machine.shift = max(0.5, float(found[0])), float(found[1])


def _marks(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the ids that may be learned from."""
    each = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    return each.agg((F.max("toxic") > 0).cast("int").alias("toxic")).filter(remainder(F.col("doc_id"), 5) != 0)


def sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """(text, toxic) of labelled training texts, at most about `per_label` of each label, picked by hash."""
    marks = _marks(labels)
    sizes = {row["toxic"]: row["count"] for row in marks.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return docs.limit(0).select(F.col("text"), F.lit(0).alias("toxic"))
    part = F.when(F.col("toxic") == 1, per_label / sizes[1]).otherwise(per_label / sizes[0])
    chosen = marks.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000)) < part * 1_000_000)
    # The sample has a bound, so it may be sent to all documents.
    return written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "sample")


def _associated(train: DataFrame) -> dict[str, float]:
    """Character runs (whole segments, and five long, marks at the ends included) that tell toxic texts, with the strength of the evidence.

    Equal texts of one label count once. The chance of so many toxic texts is bounded by Chernoff's exp(-n KL(share,
    toxic share of all)), and multiplied by the number of runs that are tested.
    """
    train = written(train.distinct(), "distinct-texts")
    totals = {row["toxic"]: row["count"] for row in train.groupBy("toxic").count().collect()}

    def counted(parts: Batches) -> Batches:
        seen: Counter = Counter()
        for part in parts:
            for content, toxic in zip(texts(part, "text"), part.column("toxic").to_pylist()):
                runs = set()
                for segment in segments(content.decode("utf-8", "replace")):
                    runs.update(_runs(segment))
                seen.update((run, toxic) for run in runs)
        keys = list(seen)
        for start in range(0, len(keys), 50_000):
            some = keys[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in some]), pa.array([k[1] for k in some], pa.int32()), pa.array([seen[k] for k in some], pa.int64())],
                ["run", "toxic", "n"],
            )

    each = train.mapInArrow(counted, "run string, toxic int, n long").groupBy("run").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"),
    )
    each = written(each, "runs")
    odds = F.log(((F.col("bad") + 0.5) / (totals[1] + 1)) / ((F.col("good") + 0.5) / (totals[0] + 1)))
    whole, part = F.col("bad") + F.col("good"), totals[1] / (totals[0] + totals[1])
    clean = F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / whole / (1 - part))).otherwise(0.0)
    surprise = F.col("bad") * F.log(F.col("bad") / whole / part) + clean
    sure = surprise > F.lit(math.log(max(1, each.count()) / CHANCE))
    top = each.filter("bad > 0").withColumn("odds", odds).filter((F.col("odds") > LEAST_ODDS) & sure)
    return {row["run"]: row["bad"] * row["odds"] for row in top.orderBy("run").collect()}


def _runs(segment: str) -> set[str]:
    marked = f"^{segment}$"
    return {marked, *(marked[k : k + 5] for k in range(len(marked) - 4))}


def _spokesmen(train: DataFrame, choose, per_text: int) -> list[Row]:
    """For each training text its highest segments under `choose`, one for a toxic and `per_text` for a clean one."""

    def chosen(parts: Batches) -> Batches:
        for part in parts:
            marks, names, values, firsts = [], [], [], []
            for content, toxic in zip(texts(part, "text"), part.column("toxic").to_pylist()):
                each = sorted(segments(content.decode("utf-8", "replace")))
                scores = choose(each) if each else np.empty(0)
                order = np.argsort(-scores, kind="stable")[: 1 if toxic else per_text]
                marks += [toxic] * max(1, len(order))
                names += [each[k] for k in order] or [""]
                values += [float(scores[k]) for k in order] or [-1.0]
                firsts += [True] + [False] * (len(order) - 1) if len(order) else [True]
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks, pa.int32()), pa.array(names), pa.array(values, pa.float64()), pa.array(firsts)], ["toxic", "segment", "value", "first"]
            )

    return train.mapInArrow(chosen, "toxic int, segment string, value double, first boolean").collect()


def disguised(segment: str) -> list[str]:
    """The segment with characters put in, as insults are written to get past filters."""
    middle = max(1, len(segment) // 2)
    return [".".join(segment), segment[:middle] + "*" + segment[middle:], segment[:1] + "-" + segment[1:]]


def train(docs: DataFrame, labels: DataFrame, per_label: int = TEXTS_PER_LABEL) -> Machine | float:
    """A machine, or the share of toxic texts where only one label occurs."""
    chosen = sample(docs, labels, per_label)
    sizes = {row["toxic"]: row["count"] for row in chosen.groupBy("toxic").count().collect()}
    evidence = _associated(chosen) if len(sizes) == 2 else {}
    if not evidence:
        return min(0.49, float(_marks(labels).agg(F.avg("toxic")).first()[0] or 0.0))

    def told(each: list[str]) -> np.ndarray:
        return np.array([max((evidence.get(run, 0.0) for run in _runs(s)), default=0.0) for s in each])

    # Clean texts speak with ordinary segments at first: those at the end of the order have no evidence.
    rows = _spokesmen(chosen, told, 3)
    machine = None
    for turn in range(ROUNDS):
        # A toxic text without any evidence, as a wrong label makes them, has no spokesman.
        toxic = sorted({r["segment"] for r in rows if r["toxic"] and r["value"] > 0 and told([r["segment"]])[0] > 0})
        toxic = sorted({*toxic, *(run[1:-1] for run in evidence if run[0] == "^" and run[-1] == "$" and len(run) > 2)})
        clean = sorted({r["segment"] for r in rows if not r["toxic"] and r["segment"]}.difference(toxic))
        if turn:
            clean = sorted({*clean, *before})
        if not toxic or not clean:
            break
        before = clean
        if turn == 0:
            votes = Counter(r["segment"] for r in rows if r["toxic"] and r["value"] > 0)
            votes.update(toxic)
            common = [s for s, _ in sorted(votes.items(), key=lambda v: (-v[1], v[0]))[: LANDMARKS * 3 // 4]]
            step = max(1, len(clean) // (LANDMARKS - len(common)))
            landmarks = sorted({*common, *clean[::step][: LANDMARKS - len(common)]})
        more = [d for s in toxic for d in disguised(s)]
        plain = [d for s in clean[:: max(1, len(clean) // 400)] for d in disguised(s)]
        machine = fitted(toxic + more, clean + plain, landmarks)
        rows = _spokesmen(chosen, machine.decide, 4)
    if machine is None:
        return min(0.49, sizes[1] / sum(sizes.values()))
    first = [r for r in rows if r["first"]]
    known = {r["toxic"]: r["count"] for r in _marks(labels).groupBy("toxic").count().collect()}
    calibrated(machine, np.array([r["value"] for r in first]), np.array([float(r["toxic"]) for r in first]), known[0] / known[1])
    return machine


def scored(docs: DataFrame, machine: Machine | float, text: str = "text") -> DataFrame:
    """`row` (the document's own columns) and score.

    A text travels once, inside its row, and a task holds the segments of some megabytes of text at a time.
    """
    whole = docs.select(F.struct(*[f"`{name}`" for name in docs.columns]).alias("row"))
    if not isinstance(machine, Machine):
        return whole.select("row", F.lit(float(machine)).alias("score"))
    shared, number = docs.sparkSession.sparkContext.broadcast(machine), docs.columns.index(text)
    kept: dict[str, float] = {}

    def score(part: pa.RecordBatch) -> list[pa.Array]:
        column = part.column("row").field(number).cast(pa.binary())
        worst = [_worst(column.slice(start, stop - start).to_pylist(), shared.value, kept) for start, stop in spans(column)]
        return [pa.array(shared.value.score(np.concatenate(worst)), pa.float64())]

    return appended(whole, score, "score double")


def _worst(contents: list[bytes | None], machine: Machine, kept: dict[str, float]) -> np.ndarray:
    """The decision on the worst segment of each text; what segments get is kept for the next ones."""
    each = [segments((content or b"").decode("utf-8", "replace")) for content in contents]
    new = list({s for found in each for s in found if s not in kept})
    if len(kept) + len(new) > KEPT_SEGMENTS:
        kept.clear()
        new = list({s for found in each for s in found})
    kept.update(zip(new, machine.decide(new).tolist()))
    return np.array([max(map(kept.__getitem__, found), default=-1.0) for found in each])


def clean(docs: DataFrame, machine: Machine | float, text: str = "text") -> DataFrame:
    """The rows of `docs` that are not judged toxic."""
    return scored(docs, machine, text).filter("score < 0.5").select("row.*")
