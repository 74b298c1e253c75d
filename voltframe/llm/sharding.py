"""Sharding by extendible hashing.

A document's hash bits come from its id and text. The directory is indexed by a prefix of the bits; a bucket is a
prefix whose documents fit the byte limit, and only prefixes that don't fit are told apart by one more bit. Bytes
are summed once for cells that are a few bits finer than needed; every coarser prefix is a sum of cells, so all
depths are decided together from that small table. Cells that are still too large are looked at again, twelve bits
deeper. What is equal in all bits (copies of one row, or one text over the limit) is dealt to overflow pages.

Defined results: null texts are empty and null ids the empty text in the hash; a text over the limit is a page of
its own; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.session import written

BITS = 60
SHARD_BYTES = 2 << 20
# Cells are this many bits finer than buckets of even size would be.
FINER, DEEPER = 5, 12


def _bits(id: str, text: str) -> Column:
    content = F.concat(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(" "), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(content.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def assign(docs: DataFrame, id: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """Per document: its id, n_bytes, shard (its bits, and a page number for overflow), depth, shard_bytes, shard_docs."""
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    rows = written(docs.select(F.col(id).alias("id"), size.alias("n_bytes"), _bits(id, text).alias("bits")), "bits")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    done, rest, depth, top = [], rows, min(BITS, max(0, math.ceil(math.log2(max(1, total) / limit))) + FINER), 0
    while True:
        depths = _depths(rest, top, depth, limit)
        placed = rest.withColumn("cell", F.shiftright("bits", BITS - depth)).join(depths, "cell")
        done.append(placed.filter("depth IS NOT NULL").drop("cell"))
        left = written(placed.filter("depth IS NULL").select(*rows.columns), "oversized")
        if depth == BITS or left.isEmpty():
            break
        rest, top, depth = left, depth + 1, min(BITS, depth + DEEPER)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    name = F.expr(f"lpad(bin(shiftright(bits, {BITS} - depth)), depth, '0')")
    out = out.withColumn("shard", F.when(F.col("depth") == 0, "").otherwise(name))
    out = out.unionByName(_pages(left, limit))
    return out.select(F.col("id").alias(id), "n_bytes", "shard", "depth", "shard_bytes", "shard_docs")


def _depths(rows: DataFrame, top: int, depth: int, limit: int) -> DataFrame:
    """For every cell of `depth` bits: the least depth from `top` on whose prefix fits (null if none), with its sums."""
    cells = rows.groupBy(F.shiftright("bits", BITS - depth).alias("cell")).agg(F.sum("n_bytes").alias("size"), F.count("*").alias("n"))
    cells = written(cells, "cells")
    each = cells.withColumn("d", F.explode(F.sequence(F.lit(top), F.lit(depth))))
    each = each.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - d)"))
    fits = each.groupBy("d", "prefix").agg(F.sum("size").alias("shard_bytes"), F.sum("n").alias("shard_docs")).filter(F.col("shard_bytes") <= limit)
    first = each.select("cell", "d", "prefix").join(fits, ["d", "prefix"]).groupBy("cell").agg(
        F.min(F.struct(F.col("d").alias("depth"), "shard_bytes", "shard_docs")).alias("s")
    )
    return written(cells.select("cell").join(first, "cell", "left").select("cell", "s.*"), "directory")


def _pages(rows: DataFrame, limit: int) -> DataFrame:
    """Rows equal in all bits, as many to a page as fit the limit, at least one. They are numbered by counting the
    rows of each task and adding those of the tasks before, so copies of one row may be any number."""
    placed = written(rows.withColumn("place", F.monotonically_increasing_id()), "overflow")
    part = F.shiftright("place", 33)
    each = placed.select("*", part.alias("part"))
    largest = placed.groupBy("bits").agg(F.max("n_bytes").alias("largest"))
    order = Window.partitionBy("bits", "part").orderBy("place")
    before = F.sum("n").over(Window.partitionBy("bits").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = each.groupBy("bits", "part").agg(F.count("*").alias("n")).select("bits", "part", F.coalesce(before, F.lit(0)).alias("start"))
    numbered = each.withColumn("nth", F.row_number().over(order) - 1).join(starts, ["bits", "part"]).join(largest, "bits")
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.col("largest"))))
    page = numbered.withColumn("page", F.floor((F.col("nth") + F.col("start")) / per).cast("long"))
    page = written(page, "pages")
    sums = page.groupBy("bits", "page").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_docs"))
    name = F.concat(F.lpad(F.bin("bits"), BITS, "0"), F.lit("-"), F.col("page"))
    return page.join(sums, ["bits", "page"]).select("id", "n_bytes", "bits", F.lit(BITS).alias("depth"), "shard_bytes", "shard_docs", name.alias("shard"))
