"""The byte-level coder against a public tokenizer library, its edits against encoding anew, and its edge cases."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from voltframe.llm import byte_bpe, chunks
from voltframe.llm import catalog as queries

SIGNS = "ab c'ls \n\té日本 =-  re''d1234\U0001F600\x1c\x85"
ODD = [None, "", " ", "\n", "<|endoftext|>", "a" * 3000, "=" * 700, " " * 900, "\n" * 300 + " x", "x" * 20_000, "ab " * 4000, "日" * 500, "don't we'll"]


@pytest.fixture(scope="module")
def own():
    return byte_bpe.vocabulary(byte_bpe.place(byte_bpe.VOCABULARY))


@pytest.fixture(scope="module")
def plain(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def texts(count, longest, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(longest))) for _ in range(count)]


def test_whole_results_match_the_public_library(spark, plain):
    rows = [(k, t, "r", "i") for k, t in enumerate(ODD + texts(400, 80) + ODD)] + [(None, "null id", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, ids string")
    got = {(r.row["doc_id"], tuple(r.ids)): r for r in byte_bpe.encode(docs).collect()}
    assert set(got) == {(k, tuple(plain.encode_ordinary(t or ""))) for k, t, *_ in rows}
    back = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert {(r.row["row"]["doc_id"], bytes(r.decoded)) for r in back} == {(k, (t or "").encode()) for k, t, *_ in rows}
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0))).count() == 0
    assert byte_bpe.encode(docs.select("text")).count() == len(rows)


def test_query_matches_the_public_library(spark, plain, tmp_path):
    rows = [(k, t) for k, t in enumerate(ODD + texts(100, 60, 2))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op12_byte_bpe(spark, str(tmp_path)).collect()}
    for k, text in rows:
        ids = plain.encode_ordinary(text or "")
        joined = " ".join(map(str, ids)).encode()
        assert got[k] == (len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_appends_and_edits_are_exact(own, plain):
    rng = random.Random(4)
    for _ in range(200):
        content = bytes(rng.choice(b"abcdethion =") for _ in range(rng.randrange(1, 400)))
        start = rng.randrange(len(content) + 1)
        stop, new = min(len(content), start + rng.randrange(5)), bytes(rng.choice(b"abc =") for _ in range(rng.randrange(4)))
        edited = byte_bpe.Prefixes(own, content)
        edited.replace(start, stop, new)
        edited.append(b"tion")
        assert edited.last == byte_bpe.Prefixes(own, content[:start] + new + content[stop:] + b"tion").last
    for text in texts(500, 80, 5):
        start = rng.randrange(len(text) + 1)
        stop, new = min(len(text), start + rng.randrange(5)), "".join(rng.choice(SIGNS) for _ in range(rng.randrange(4)))
        held = byte_bpe.Encoded(own, text)
        held.replace(start, stop, new)
        held.append("re s")
        assert held.text == text[:start] + new + text[stop:] + "re s"
        assert held.ids() == plain.encode_ordinary(held.text)


def test_an_edit_computes_only_its_surroundings(own):
    content = b"abcdefghij" * 3000
    held = byte_bpe.Prefixes(own, content)
    assert held.replace(100, 103, b"xyz") < 3 * own.widest
    text = byte_bpe.Encoded(own, "some words here " * 500)
    assert text.replace(4000, 4001, "b") < 10


def test_a_vocabulary_with_tokens_that_no_merge_makes():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"cd": 257, b"abcd": 258, b"bcx": 259, b"xy": 260, b"xyab": 261}
    own = byte_bpe.Vocabulary(ranks)
    plain = tiktoken.Encoding("few", pat_str=r"[^ ]+| +", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice("abcdxy") for _ in range(rng.randrange(1, 14)))
        assert byte_bpe.encoded_match(own, text) == plain.encode_ordinary(text)


def test_parts_put_together_are_the_text_and_cut_only_behind_what_is_not_blank():
    for text in texts(2000, 60, 7):
        parts = chunks.parts(text)
        assert "".join(parts) == text
        assert all(a[-1:].strip() and b[0] == " " for a, b in zip(parts, parts[1:]))


def test_new_matches_are_encoded_together(own, plain, monkeypatch):
    rng, alone, encode = random.Random(8), [], byte_bpe.Vocabulary.lasts
    monkeypatch.setattr(byte_bpe.Vocabulary, "lasts", lambda self, content: alone.append(content) or encode(self, content))
    found = [" ".join("".join(rng.choices("abcdeghinorst", k=rng.randrange(6, 14))) for _ in range(500)) for _ in range(10)]
    ids, ends = byte_bpe.Coder(own)(found)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [plain.encode_ordinary(text) for text in found]
    assert len(alone) < 10


def test_matches_of_all_lengths_together_are_as_each_alone(own):
    rng = random.Random(9)
    contents = [bytes(rng.choice(b"abcdethion =") for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    contents += [bytes(rng.choice(b"aeht =") for _ in range(size)) for size in (31, 200, 5000)] + [b"=" * 700, b"a" * 300, b"\xff\x80 \x00" * 20]
    for some in (contents, contents[:: -1], contents[-7:], contents * 2, [b"abcabc"] * 300, []):
        ids, sizes = own.encoded(some)
        ends = [0, *sizes.cumsum().tolist()]
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [byte_bpe.Prefixes(own, each).tokens() for each in some]
        assert len(ids) == ends[-1]


def test_together_with_tokens_that_no_merge_makes():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"cd": 257, b"abcd": 258, b"bcx": 259, b"xy": 260, b"xyab": 261}
    own = byte_bpe.Vocabulary(ranks)
    rng = random.Random(3)
    contents = ["".join(rng.choice("abcdxy") for _ in range(rng.randrange(1, 14))).encode() for _ in range(2000)]
    ids, sizes = own.encoded(contents)
    ends = [0, *sizes.cumsum().tolist()]
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [byte_bpe.Prefixes(own, each).tokens() for each in contents]


def test_what_is_kept_changes_nothing(own, plain, monkeypatch):
    monkeypatch.setattr(chunks, "KEPT_PARTS", 50)
    monkeypatch.setattr(byte_bpe, "PARTS_AT_ONCE", 70)
    code = byte_bpe.Coder(own)
    for some in (ODD[1:], texts(300, 80, 10), [], [""], texts(300, 80, 10), ODD[1:]):
        ids, ends = code(some)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [plain.encode_ordinary(text) for text in some]
    with pytest.raises(TypeError), monkeypatch.context() as broken:
        broken.setattr(byte_bpe.Vocabulary, "encoded", None)
        code(["neverseen before"])
    ids, ends = code(["neverseen before", "a neverseen"])
    assert ids.tolist() == plain.encode_ordinary("neverseen before") + plain.encode_ordinary("a neverseen")


def test_decoding_ids_that_are_null_empty_or_unknown(spark, plain, monkeypatch):
    known = plain.encode_ordinary("some words é日")
    rows = [(1, known), (2, None), (3, []), (4, known[:3] * 2), (5, None)]
    got = byte_bpe.decode(spark.createDataFrame(rows, "k int, ids array<int>")).collect()
    assert {r.row.k: bytes(r.decoded) for r in got} == {k: plain.decode_bytes(ids or []) for k, ids in rows}
    for wrong in (50_999, 16_000_000, -1, None):
        with pytest.raises(Exception):
            byte_bpe.decode(spark.createDataFrame([(1, [known[0], wrong])], "k int, ids array<int>")).collect()
