"""URL verdicts: given rules, else association rules mined from labelled URLs.

A URL is a set of tokens: host labels and suffixes, words of the path and keys of the query. Tokens under the support
are in no rule and are left out before mining; tokens of exactly the same rows (a label beside its host suffix) are
mined as one and told apart again in the rules; a token of all rows makes no longer rule surer and is judged alone.
None of this loses a rule. FP-growth then mines the sets of tokens and label; a rule is a set with a label that
reaches the confidence, and is kept if it is surer than every kept rule it contains. Sets and rules stay distributed
until they are pruned. Matching files each rule under its rarest token, so that a URL looks only at rules of its own
tokens. The surest fitting rule decides, of equals the longer one, then the later label; without one the verdict is
allow.

Given rules fit a host with all its subdomains and a prefix of the path; the longest one wins. Mining and
matching look at all tokens of a URL.

Defined results: null URLs and those without "://" have empty host and path, fit no given rule, and are allowed
unless a mined rule fits. Repeated rows are judged alike. Without labels no rule is mined.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import product

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from voltframe.llm.common import Batches, appended, lowered, packed, texts
from voltframe.session import written

# The given rules, host and path prefix with their verdict.
GIVEN = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}
SUPPORT, CONFIDENCE = 0.01, 0.8
# A rule holds in at least so many labelled rows, whatever share of them that is.
LEAST_ROWS = 20
# Mined rules up to this many are sent to the tasks (some 30 MB); the support bounds them in practice.
MOST_RULES = 100_000


def host(url: str) -> Column:
    return lowered(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: dict = GIVEN) -> Column:
    """The longest given rule that fits, as host and path together, else null."""
    found = F.lit(None).cast("string")
    for name, prefix in sorted(rules, key=lambda rule: len(rule[0]) + len(rule[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        found = F.when(fits, F.lit(name + prefix)).otherwise(found)
    return found


def tokens(url: str) -> list[str]:
    """Distinct tokens in order: host suffixes, path words (numbers as one token), query keys."""
    _, mark, rest = url.partition("://")
    if not mark:
        return []
    name, where, query = re.match(r"(?s)([^/?#]*)([^?#]*)(?:\?([^#]*))?", rest).groups()
    labels = [label for label in name.lower().split(".") if label]
    out = [f"host {'.'.join(labels[k:])}" for k in range(len(labels) - 1, -1, -1)] + [f"label {label}" for label in labels[:-1]]
    out += ["path #" if word.isdigit() else f"path {word}" for word in re.split(r"[^0-9a-z]+", where.lower()) if word]
    out += [f"key {pair.split('=')[0]}" for pair in (query or "").split("&") if pair]
    return list(dict.fromkeys(out))


def _tokenised(df: DataFrame) -> DataFrame:
    return appended(df, lambda part: [pa.array([tokens(u.decode("utf-8", "replace")) for u in texts(part, "url")], pa.list_(pa.string()))], "tokens array<string>")


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> list[tuple[frozenset, str, float]]:
    """Rules (tokens, label, confidence) from rows (url, label)."""
    tokenised = _tokenised(labelled.filter("label IS NOT NULL").select("url", "label")).select("tokens", "label")
    items = written(tokenised.withColumn("place", F.monotonically_increasing_id()), "tokens")
    count = items.count()
    if count < LEAST_ROWS:
        return []
    least = max(LEAST_ROWS, math.ceil(support * count))
    # Tokens with the same rows have the same fingerprint: their number and two 64-bit sums of row hashes.
    each = items.select(F.explode("tokens").alias("token"), "label", "place").groupBy("token", "label").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("place")).alias("one"), F.bit_xor(F.xxhash64("place", F.lit(1))).alias("two")
    )
    often = each.groupBy("token").agg(
        F.sum("n").alias("total"), F.max("n").alias("most"), F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"),
        F.collect_list(F.struct("label", "n")).alias("labels"),
    )
    # At most the tokens of one mean URL divided by the support, however many URLs there are.
    rows = often.filter(F.col("most") >= least).orderBy("token").collect()
    alike = defaultdict(list)
    for row in rows:
        alike[row["total"], row["one"], row["two"]].append(row)
    everywhere = [row for same in alike.values() for row in same if row["total"] == count]
    rules = [
        (frozenset([row["token"]]), each["label"], each["n"] / count)
        for row in everywhere for each in row["labels"] if each["n"] >= least and each["n"] / count >= confidence
    ]
    classes = [[row["token"] for row in same] for (total, *_), same in alike.items() if total < count]
    labels = sorted({each["label"] for row in rows for each in row["labels"]})
    if classes:
        found = _frequent(items, classes, labels, least, count, confidence)
        for row in found:
            members = product(*(classes[k] for k in row["own"]))
            rules += [(frozenset(own), labels[-1 - row["label"]], row["sure"]) for own in members]
    return pruned(rules)


def _frequent(items: DataFrame, classes: list[list[str]], labels: list[str], least: int, count: int, confidence: float) -> list[Row]:
    """Rules (own, label, sure) over numbers of classes; labels are numbered from -1 downwards."""
    numbers = {same[0]: k for k, same in enumerate(classes)}
    names = {label: -1 - k for k, label in enumerate(labels)}
    shared = items.sparkSession.sparkContext.broadcast((numbers, names))

    def placed(part: pa.RecordBatch) -> list[pa.Array]:
        known, marks = shared.value
        pairs = zip(part.column("tokens").to_pylist(), part.column("label").to_pylist())
        return [pa.array([[known[t] for t in own if t in known] + [marks[m] for m in (label,) if m in marks] for own, label in pairs], pa.list_(pa.int32()))]

    baskets = written(appended(items, placed, "items array<int>").select("items"), "baskets")
    # Half a row less than the least number, so that no rounding of the share asks for one row more.
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / count).fit(baskets)
    parts = model.freqItemsets.select(
        F.array_sort(F.filter("items", lambda item: item >= 0)).alias("own"), F.array_min(F.filter("items", lambda item: item < 0)).alias("label"), "freq"
    )
    sets = written(parts.filter(F.size("own") > 0), "sets")
    totals = sets.filter("label IS NULL").select("own", F.col("freq").alias("total"))
    sure = (F.col("freq") / F.col("total")).alias("sure")
    rules = written(sets.filter("label IS NOT NULL").join(totals, "own").select("own", "label", sure).filter(F.col("sure") >= confidence), "rules")
    # Most needless rules are so by a rule of one item less; what longer ones remain is pruned below.
    shorter = rules.select(F.col("own").alias("less"), F.col("label").alias("mark"), F.col("sure").alias("other"))
    less = rules.withColumn("less", F.explode(F.transform("own", lambda item: F.array_remove("own", item))))
    needless = less.join(shorter, (less["less"] == shorter["less"]) & (F.col("label") == F.col("mark")) & (F.col("other") >= F.col("sure")))
    kept = written(rules.join(needless.select("own", "label").distinct(), ["own", "label"], "left_anti"), "kept")
    most = kept.select(F.sum(_expanded(F.col("own"), classes))).first()[0] or 0
    if most > MOST_RULES:
        raise ValueError("more rules than may be sent to the tasks; raise the support")
    return kept.orderBy("own", "label").collect()


def _expanded(own: Column, classes: list[list[str]]) -> Column:
    """How many rules over tokens a rule over classes stands for."""
    sizes = F.array(*[F.lit(float(len(same))) for same in classes])
    return F.aggregate(own, F.lit(1.0), lambda n, k: n * F.get(sizes, k))


def pruned(rules: list[tuple[frozenset, str, float]]) -> list[tuple[frozenset, str, float]]:
    """Without rules that a shorter kept rule with the same label and no less confidence makes needless."""
    kept: list[tuple[frozenset, str, float]] = []
    index = defaultdict(list)
    for rule in sorted(rules, key=lambda r: (len(r[0]), -r[2], sorted(r[0]))):
        shorter = (other for token in rule[0] for other in index[token])
        if not any(o[0] < rule[0] and o[1] == rule[1] and o[2] >= rule[2] for o in shorter):
            kept.append(rule)
            for token in rule[0]:
                index[token].append(rule)
    return kept


def indexed(rules: list[tuple[frozenset, str, float]]) -> dict[str, list]:
    """Each rule under that of its tokens which the fewest rules hold."""
    common = Counter(token for rule in rules for token in rule[0])
    index = defaultdict(list)
    for rule in rules:
        index[min(rule[0], key=lambda token: (common[token], token))].append(rule)
    return dict(index)


def judged_by(index: dict[str, list], url: str) -> str:
    each = set(tokens(url))
    fitting = [(r[2], len(r[0]), r[1]) for token in each for r in index.get(token, ()) if r[0] <= each]
    return max(fitting)[2] if fitting else "allow"


def judge(pages: DataFrame, rules: list[tuple[frozenset, str, float]], url: str = "url", given: dict = GIVEN) -> DataFrame:
    """`row` (the page's own columns), host, path, rule, verdict."""
    whole = packed(pages, url=url)
    index = pages.sparkSession.sparkContext.broadcast(indexed(rules))
    mined = appended(whole, lambda part: [pa.array([judged_by(index.value, u.decode("utf-8", "replace")) for u in texts(part, "url")])], "mined string")
    split = mined.withColumn("host", host("url")).withColumn("path", path("url"))
    ruled = split.withColumn("rule", given_rule(F.col("host"), F.col("path"), given))
    verdict = F.col("mined")
    for (name, prefix), word in given.items():
        verdict = F.when(F.col("rule") == name + prefix, word).otherwise(verdict)
    return ruled.select("row", "host", "path", "rule", verdict.alias("verdict"))
