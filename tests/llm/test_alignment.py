"""Alignment of two tokenizers against brute force over whole texts, spilled and salted runs, and edge cases."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from voltframe.llm import alignment
from voltframe.llm import catalog as queries

ODD = [
    None, "", " ", "  ", "\n", "foo ", " foo", "foo  ", "a\n b", "<s> x </s> <unk>", "<|endoftext|>", "<0x41>", "a▁b", "▁", "x" * 900,
    "don't we'll", "日本 語", "\U0001f600 a", "ab " * 800, "ab " * 800, " x 　y", "a\x00b", "12345 678", "\x1c a\x85 b",
]


def brute(rows):
    """By whole texts, pair by pair."""
    own = alignment.Sides(alignment.place(alignment.BYTE_LEVEL), alignment.place(alignment.PIECES))
    laid, counts = [], Counter()
    for text in rows:
        whole = (" " + (text or "")).encode()
        a = own.first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = own.other.encode(text) if text else []
        a_bytes, b_bytes = [own.first_bytes[k] for k in a], [own.other_bytes[k] for k in b]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        spans = []
        for tokens in (a_bytes, b_bytes):
            at, mine = 0, []
            for token in tokens:
                mine.append((at, at + len(token)))
                at += len(token)
            spans.append(mine)
        links, j = [], 0
        for i, (start, stop) in enumerate(spans[0]):
            while spans[1][j][1] <= start:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < stop:
                links.append((a[i], b[k]))
                k += 1
        both = sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]})
        groups, i, j = [], 0, 0
        for end in both:
            k, m = i, j
            while spans[0][k][1] != end:
                k += 1
            while spans[1][m][1] != end:
                m += 1
            groups.append(",".join(map(str, a[i : k + 1])) + "|" + ",".join(map(str, b[j : m + 1])))
            i, j = k + 1, m + 1
        laid.append((len(a), len(b), groups, links))
        counts.update(set(links))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for n_a, n_b, groups, links in laid
    ]


def texts(seed, count):
    rng = random.Random(seed)
    signs = "ab c'ls \n\té日 =-  re''d12 \U0001F600\x1c\x85"
    words = ["the", "The", "insult", "Straße", "42", "it's", "naïve", "日本語", "a.b.c", "http://x.y/z"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(50))) for _ in range(count)] + [" ".join(rng.choice(words) for _ in range(30)) for _ in range(count // 2)]


def shown(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


@pytest.mark.parametrize("tight", [False, True])
def test_whole_results_match_brute_force(spark, tight):
    rows = [(k, t, "p", 1) for k, t in enumerate(ODD + texts(1, 200))] + [(None, "null id", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string, base int").repartition(3)
    limits = {}
    if tight:
        # Many groups, runs spilled to files, partitions in many salted parts.
        limits = {"group_bytes": 3000, "part_bytes": 2000, "held_bytes": 100}
    got = {r.row.doc_id: r for r in alignment.align(docs, with_groups=True, **limits).collect()}
    assert len(got) == len(rows)
    for (doc, *_), want in zip(rows, brute([r[1] for r in rows])):
        assert shown(got[doc]) == want, rows[doc or -1]
        assert got[doc].groups_sha256 == (hashlib.sha256(got[doc].groups.encode()).hexdigest() if got[doc].groups else "")


def test_query_on_a_given_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_alignment(spark, folder).collect()}
    assert [shown(got[d.doc_id]) for d in docs] == brute([d.text for d in docs])


def test_empty_tables_and_texts_without_tokens(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty).count() == 0
    none = spark.createDataFrame([(1, None), (1, "")], "doc_id long, text string")
    assert [shown(r) for r in alignment.align(none).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
