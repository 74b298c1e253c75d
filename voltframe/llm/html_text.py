"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. A word scores positive, unless it stands in a container (navigation, footer,
a div of some class) whose words labelled pages show to be outside the article; a tag scores negative, the more the
more often it occurs outside. One linear scan finds the contiguous region with the greatest sum. Blocks of the
region that stand in such a container themselves (adverts, forms, comments inside an article) are left out, also parts
of a block (a span of an advert); scripts, styles, buttons and other unseen elements never are text and part no block.

Weights are learned from labelled pages: those that mark their text themselves, with exactly one article (or main)
element. They are shares of word and tag counts over all such pages, drawn towards the fallback while little was seen;
keys not seen in training fall back on the names below, and what is named as furniture is so wherever it stands. The `MOST_KEYS` keys seen most often are sent to the tasks; where more are learned, the other keys of a page
are joined with the table of all keys.

Defined results: null and empty pages have empty text; white space in a block becomes one space; blocks are joined
by an empty line; character references are decoded, also without a semicolon where HTML allows that; a page cut
off inside a tag loses only that tag. Repeated rows are extracted alike.
"""

from __future__ import annotations

import html
import re
from collections import ChainMap, Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import Batches, appended, packed, texts
from voltframe.session import written

MOST_KEYS = 5000
# So many words or tags as the fallback says are added to what was seen.
PRIOR = 20

# Element and class names of the HTML standard and of common page furniture.
UNSEEN = frozenset("script style noscript template head title svg math iframe object canvas select option textarea button audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("nav header footer aside form div section article main menu dialog figure ul ol table".split())
FURNITURE = frozenset("nav footer aside form menu dialog".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "form header login menu menus modal nav navbar navigation newsletter notice notices pagination popup promo promoted related reply "
    "replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
ARTICLE = frozenset({"article", "main"})
NAMELESS = frozenset("html body h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<(script|style|textarea|title|noscript|iframe)\b[^>]*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|<[!?/a-zA-Z][^<>]*(?:>|$)",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def sequence(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", content, ""), ("open", tag, attributes) and ("close", tag, "") in page order."""
    at = 0
    for match in TOKEN.finditer(page):
        if match.start() > at:
            yield "text", page[at : match.start()], ""
        at = match.end()
        if match[3]:
            yield "close" if match[2] else "open", match[3].lower(), match[4] or ""
    if at < len(page):
        yield "text", page[at:], ""


def keys(tag: str, attributes: str) -> list[str]:
    """What an element is known by: its tag with each of its names, or a container's tag alone; headings have none."""
    if tag in NAMELESS:
        return []
    names = [n.lower() for m in NAMES.findall(attributes) for n in re.split(r"\s+", "".join(m)) if n]
    return [f"{tag}.{name}" for name in names] or ([tag] if tag in CONTAINERS and tag != "div" else [])


def _named_furniture(key: str) -> bool:
    tag, _, name = key.partition(".")
    return tag in FURNITURE or not FURNITURE_NAMES.isdisjoint(re.split(r"[^a-z]+", name))


class Page:
    """Words and tags of a page with their holders, cut into blocks.

    A holder is an element with keys; it knows the holder around it, so that depth costs nothing.
    """

    def __init__(self, page: str) -> None:
        self.blocks: list[list[tuple[str, int]]] = [[]]  # texts with their holders
        self.around, self.own = [0], [()]  # of holders; the first is the page
        self.items: list[tuple[int, int, str, int, bool]] = []  # (block, words, tag, holder, inside an article): a text or a tag
        stack: list[tuple[str, int]] = []
        opened: Counter = Counter()
        held = unseen = articles = 0
        for kind, name, attributes in sequence(page):
            if kind == "text":
                if not unseen:
                    self.blocks[-1].append((name, held))
                    if count := len(name.split()):
                        self.items.append((len(self.blocks) - 1, count, "", held, articles > 0))
                continue
            if name == "br":
                self.blocks[-1].append((" ", 0))
            self.items.append((len(self.blocks) - 1, 0, name, held, articles > 0))
            if name in VOID:
                continue
            if kind == "open":
                stack.append((name, held))
                opened[name] += 1
                unseen += name in UNSEEN
                # The header of an article is part of it.
                if own := () if name == "header" and articles else tuple(keys(name, attributes)):
                    self.around.append(held)
                    self.own.append(own)
                    held = len(self.own) - 1
                articles += name in ARTICLE
            elif opened[name]:
                tag = ""
                while tag != name:
                    tag, held = stack.pop()
                    opened[tag] -= 1
                    unseen -= tag in UNSEEN
                    articles -= tag in ARTICLE
            if name not in INLINE and name not in UNSEEN and not unseen:
                self.blocks.append([])

    def keys(self) -> set[str]:
        return {key for own in self.own for key in own} | {f"<{tag}" for _, words, tag, _, _ in self.items if not words}

    def text(self, weights: Mapping[str, float]) -> str:
        good = [True]
        for around, own in zip(self.around[1:], self.own[1:]):
            good.append(good[around] and all(_word(weights, key) > 0 for key in own))
        # What is left out of an article doesn't part it.
        scores = [
            words * (1 if good[held] else 0 if inside else -1) if words else weights.get(f"<{tag}", -0.02)
            for _, words, tag, held, inside in self.items
        ]
        first, last = best_region(scores)
        chosen = dict.fromkeys(block for block, words, *_ in self.items[first:last] if words)
        joined = (" ".join(html.unescape("".join(text for text, held in self.blocks[block] if good[held])).split()) for block in chosen)
        return "\n\n".join(block for block in joined if block)


def _word(weights: Mapping[str, float], key: str) -> float:
    return -1.0 if _named_furniture(key) else weights.get(key, 1.0)


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous range with the greatest sum, in one pass; the first of equal ones, empty if none is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for place, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, place
        total += score
        if total > best:
            best, found = total, (start, place + 1)
    return found


class Weights(dict):
    """The weights of the keys seen most often, and the table (key, good, n) of all if there are more."""

    table: DataFrame | None = None


def _weight(key: str, good: int, n: int) -> float:
    if key[0] == "<":
        return -0.02 - (n - good) / (n + PRIOR)
    return (2 * good - n + PRIOR) / (n + PRIOR) or -0.01


def learn(pages: DataFrame, payload: str = "html") -> Weights:
    """Weights of containers' words and of tags from pages that mark exactly one article.

    A container's words weigh the share inside the article less the share outside; it is the container itself, so
    that what an article holds is not judged by what the article is in. A tag weighs less than nothing, more so the
    larger its share outside.
    """

    def count(parts: Batches) -> Batches:
        seen: Counter = Counter()
        for part in parts:
            for content in texts(part, "html"):
                _count(content.decode("utf-8", "replace"), seen)
        names = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in names], pa.string()), pa.array([k[1] for k in names], pa.bool_()), pa.array([seen[k] for k in names], pa.int64())],
            ["key", "inside", "n"],
        )

    each = pages.select(F.col(payload).alias("html")).mapInArrow(count, "key string, inside boolean, n long").groupBy("key").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("good"), F.sum("n").alias("n")
    )
    known = written(each, "keys")
    rows = known.orderBy(F.desc("n"), "key").limit(MOST_KEYS + 1).collect()
    weights = Weights({row["key"]: _weight(*row) for row in rows[:MOST_KEYS]})
    if len(rows) > MOST_KEYS:
        weights.table = known
    return weights


def _count(page: str, seen: Counter) -> None:
    """Words by their containers below (or outside) the article, and tags, inside and outside of it."""
    if len(re.findall(r"<article\b", page, re.I)) != 1 and len(re.findall(r"<main\b", page, re.I)) != 1:
        return
    mark = "article" if len(re.findall(r"<article\b", page, re.I)) == 1 else "main"
    around, own, words, sides = [-1], [()], [0], [False]
    stack: list[tuple] = []
    opened: Counter = Counter()
    known: Counter = Counter()
    held = unseen = 0
    inside = False
    for kind, name, attributes in sequence(page):
        if kind == "text":
            words[held] += 0 if unseen else len(name.split())
            continue
        seen[f"<{name}", inside] += 1
        if name in VOID:
            continue
        if kind == "open":
            # A key that an element around it has already counts there.
            fresh = [] if name == mark else [key for key in dict.fromkeys(keys(name, attributes)) if not known[key]]
            stack.append((name, held, known, inside, fresh))
            opened[name] += 1
            unseen += name in UNSEEN
            if name == mark:
                known, inside = Counter(), True
            if fresh or name == mark:
                known.update(fresh)
                around.append(-1 if name == mark else held)
                own.append(tuple(fresh))
                words.append(0)
                sides.append(inside)
                held = len(own) - 1
        elif opened[name]:
            tag = ""
            while tag != name:
                tag, held, before, inside, fresh = stack.pop()
                known.subtract(fresh)
                known = before
                opened[tag] -= 1
                unseen -= tag in UNSEEN
    for place in range(len(own) - 1, 0, -1):
        if around[place] >= 0:
            words[around[place]] += words[place]
        if words[place]:
            seen.update({(key, sides[place]): words[place] for key in own[place]})


def extract(pages: DataFrame, weights: dict[str, float], payload: str = "html") -> DataFrame:
    """`row` (the page's own columns), text and n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(dict(weights))
    whole = packed(pages, html=payload)
    table = getattr(weights, "table", None)
    if table is not None:
        whole = _with_rest(whole, shared, table)

    def main(part: pa.RecordBatch) -> list[pa.Array]:
        rest = part.column("rest").to_pylist() if "rest" in part.schema.names else [None] * part.num_rows
        found = []
        for content, more in zip(texts(part, "html"), rest):
            own = {r["key"]: _weight(r["key"], r["good"], r["n"]) for r in more or ()}
            found.append(Page(content.decode("utf-8", "replace")).text(ChainMap(own, shared.value) if own else shared.value))
        return [pa.array(found, pa.string()), pa.array([len(f) for f in found], pa.int64())]

    return appended(whole, main, "text string, n_chars long").drop("html", "digest", "rest")


def _with_rest(whole: DataFrame, shared, table: DataFrame) -> DataFrame:
    """`whole` with digest and rest, the learned keys of the page that were not sent; equal pages are looked up once."""
    content = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    whole = whole.withColumn("digest", F.sha2(content, 256))

    def other(parts: Batches) -> Batches:
        for part in parts:
            pairs = [
                (digest, key)
                for digest, content in zip(part.column("digest").to_pylist(), texts(part, "html"))
                for key in Page(content.decode("utf-8", "replace")).keys()
                if key not in shared.value
            ]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["digest", "key"])

    found = whole.select("digest", "html").mapInArrow(other, "digest string, key string").distinct()
    rest = found.join(table, "key").groupBy("digest").agg(F.collect_list(F.struct("key", "good", "n")).alias("rest"))
    return whole.join(written(rest, "rest"), "digest", "left")
