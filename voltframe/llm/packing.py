r"""Packing sequences into optimal length buckets and token-budget batches.

Lengths are counted once over all documents. Dynamic programming over that histogram chooses the bucket boundaries
for which padding every sequence up to its bucket's boundary wastes the fewest tokens. Inside a bucket a batch
holds as many sequences as fit the token budget at the padded length; a sequence longer than the budget is a batch
of its own, never cut.

Sequences are numbered within their bucket in the order of their ids. The numbering is distributed: rows are dealt
by ranges of (bucket, id), each range counts its rows, and the running count of the ranges before is added, so a
bucket with most of the rows is still many tasks.

A sequence's tokens are its `[^\x20\x09-\x0D]+` words and one end, unless a length column is given. Defined
results: null and empty texts are one token; null ids are numbered first; rows that repeat id and length are
numbered in any order; an empty table gives no buckets and an empty result.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.session import written

BUCKETS = 16
BATCH_TOKENS = 65_536


def tokens(text: str) -> Column:
    gaps = F.split(F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")), " ")
    return F.size(F.filter(gaps, lambda word: word != "")).cast("long") + 1


def boundaries(lengths: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Boundaries, ascending, that minimise the padding of `counts` sequences with `totals` tokens up to `lengths`.

    best[j]: the least padded size of the first j lengths in the buckets so far; the tokens themselves are constant.
    """
    cells = len(lengths)
    if not cells:
        return []
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    padded = lengths.astype(np.float64)
    best = np.concatenate([[0.0], padded * before[1:]])
    cuts = []
    for _ in range(1, min(buckets, cells)):
        best, cut = _with_one_more(best, padded, before)
        cuts.append(cut)
    out, j = [], cells
    for cut in reversed(cuts):
        out.append(int(lengths[j - 1]))
        j = int(cut[j])
        if j == 0:
            break
    if j:
        out.append(int(lengths[j - 1]))
    return sorted(out)


def _with_one_more(best: np.ndarray, padded: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least padded sizes with one more bucket, and where the last bucket starts.

    A later end never wants an earlier start (the cost is Monge), so the best start of the middle end bounds those on
    both sides of it. All middles of a level are taken at once, at twice the number of lengths at most.
    """
    cells = len(padded)
    new, cut = best.copy(), np.zeros(cells + 1, np.int64)
    ends, starts = np.array([[1, cells]]), np.array([[0, cells - 1]])
    while len(ends):
        middle = ends.sum(axis=1) // 2
        sizes = np.minimum(starts[:, 1], middle - 1) - starts[:, 0] + 1
        offsets = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(ends)), sizes)
        start = np.arange(len(owner)) - (offsets - starts[:, 0])[owner]
        cost = best[start] + padded[middle - 1][owner] * (before[middle][owner] - before[start])
        least = np.minimum.reduceat(cost, offsets)
        hits = np.flatnonzero(cost == least[owner])
        chosen = start[hits[np.unique(owner[hits], return_index=True)[1]]]
        new[middle], cut[middle] = least, chosen
        ends = np.concatenate([np.stack([ends[:, 0], middle - 1], 1), np.stack([middle + 1, ends[:, 1]], 1)])
        starts = np.concatenate([np.stack([starts[:, 0], chosen], 1), np.stack([chosen, starts[:, 1]], 1)])
        open_ = ends[:, 0] <= ends[:, 1]
        ends, starts = ends[open_], starts[open_]
    return new, cut


def pack(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: str | None = None,
    buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """Per sequence: its id, n_tokens, bucket (the length it is padded to), batch (number within the bucket), slot."""
    size = F.greatest(F.lit(1), F.coalesce(F.col(length), F.lit(1))).cast("long") if length else tokens(text)
    sized = written(docs.select(F.col(id).alias("id"), size.alias("n_tokens")), "lengths")
    # All lengths, told apart one by one. As d different lengths have over d * d / 2 tokens together, there are at most
    # some millions of them in 10 ** 13 tokens.
    lengths = sized.groupBy("n_tokens").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("total")).orderBy("n_tokens").toArrow()
    marks = boundaries(*(lengths.column(name).to_numpy() for name in ("n_tokens", "n", "total")), buckets)
    bucket = F.lit(None).cast("long")
    for mark in reversed(marks):
        bucket = F.when(F.col("n_tokens") <= mark, F.lit(mark).cast("long")).otherwise(bucket)
    batch = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("bucket")))
    numbered = _numbered(sized.withColumn("bucket", bucket))
    return numbered.select(
        F.col("id").alias(id),
        "n_tokens",
        "bucket",
        F.floor(F.col("number") / batch).cast("long").alias("batch"),
        F.pmod(F.col("number"), batch).cast("long").alias("slot"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """`number` from 0 on within each bucket, by id and length."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, "bucket", "id", "n_tokens").sortWithinPartitions("bucket", "id", "n_tokens")
    # Written once, so that the ranges are the same wherever they are read.
    dealt = written(dealt.withColumn("place", F.monotonically_increasing_id()), "dealt")
    part = F.shiftright("place", 33)
    counts = dealt.groupBy("bucket", part.alias("part")).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = F.sum("n").over(Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # At most one row for each range and bucket boundary in it: ranges + buckets rows.
    starts = counts.select("bucket", "part", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"))
    return dealt.withColumn("part", part).join(F.broadcast(starts), ["bucket", "part"]).withColumn("number", F.col("place") + F.col("shift"))


def padding(lengths: list[int], marks: list[int]) -> int:
    """Tokens wasted by padding each length to the first boundary that holds it."""
    spans = list(pairwise([0, *marks]))
    return sum(stop - n for n in lengths for start, stop in spans if start < n <= stop)
