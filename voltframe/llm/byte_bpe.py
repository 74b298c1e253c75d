r"""Byte-level BPE by dynamic programming over prefixes, and back.

Of all tokens that end a byte prefix exactly one is the last token of the prefix's encoding. A token t ending at e is
that one if t and the stored last token of the prefix before t stand beside each other unmerged when the bytes of both
are encoded. So one stored token a prefix determines every encoding: the tokens of the whole are read off backwards.
Appending continues from the stored tokens, exactly, and after an edit positions are only computed until as many in a
row as the longest token has bytes agree with what was stored before.

Whether two tokens stay apart is told by undoing their merges from the latest on: they don't if, at some time, the
tokens then facing each other had a merge of their own that came first. Results are kept per pair.

Texts are cut by the public pattern and every match is encoded separately; a match that is itself a token is that
token. Distinct parts of texts are encoded once a worker while they are kept (see `chunks`).

The matches that are new in a slice of texts are encoded together: the last tokens of their prefixes of one byte, then of
two bytes and so on, in arrays over all of these matches. Where only few are that long, and in edits, it goes byte by byte.

Defined results: null and empty texts have no ids, and decode to no bytes; special tokens' strings are ordinary text;
bytes that are no UTF-8 count as U+FFFD; null ids, repeated rows and columns of any name pass through; an empty
table gives an empty result. An id without bytes is an error when decoding; null ids decode to no bytes.
"""

from __future__ import annotations

import base64
import functools
from collections import defaultdict
from collections.abc import Callable, Iterable
from itertools import count, islice, pairwise, repeat

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm import chunks
from voltframe.llm.common import Batches, texts

VOCABULARY = "byte_bpe_50k.tiktoken"
MATCH = regex.compile(public_tokenizers.PATTERN)
# Pairs of tokens whose compatibility a task keeps.
KEPT_PAIRS = 250_000
# Slots, as a power of two, for the same where many pairs are looked up together.
PAIR_SLOTS = 20
# Matches are encoded together as far as so many of them reach; the longer ones go on alone.
FEW = 256
# Bytes of texts that a task encodes at a time; a longer text is encoded alone.
ENCODED_BYTES = 1 << 19
# Parts of texts that are looked up at a time.
PARTS_AT_ONCE = 100_000
# Ids that a task decodes at a time, or one row's.
DECODED_IDS = 500_000
NONE = -1
# Bits of an id.
BITS = 24


class Table:
    """Numbers by whole-number keys, from 0 on, many looked up at a time; NONE where there is none."""

    def __init__(self, held: dict[int, int]) -> None:
        self.bits = max(8, (4 * len(held)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, NONE, np.int64), np.full(1 << self.bits, NONE, np.int32)
        keys, values = np.fromiter(held, np.int64, len(held)), np.fromiter(held.values(), np.int32, len(held))
        at = slots(keys, self.bits)
        while len(keys):
            free = self.keys[at] == NONE
            self.keys[at[free]] = keys[free]
            # Of several that want a slot one got it.
            placed = self.keys[at] == keys
            self.values[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], self._next(at[~placed])

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = slots(keys, self.bits)
        held, out = self.keys[at], self.values[at]
        # Where another key is held, the next slots are looked at until an empty one.
        going = np.flatnonzero(held != keys)
        out[going] = NONE
        going = going[held[going] != NONE]
        at = at[going]
        while len(going):
            at = self._next(at)
            held = self.keys[at]
            same = held == keys[going]
            out[going[same]] = self.values[at[same]]
            more = ~same & (held != NONE)
            going, at = going[more], at[more]
        return out


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    """A slot of 2 ** bits for every key (Fibonacci hashing)."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class Lists:
    """Lists of numbers in one array, added at the end and put together by their places."""

    def __init__(self) -> None:
        self.flat, self.used, self.ends = np.empty(1 << 10, np.int32), 0, np.zeros(1, np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        if self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(self.used + 2 * len(flat), np.int32)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the lists at these places in a row, and how many each list has."""
        starts = self.ends[places]
        lengths = self.ends[places + 1] - starts
        before = np.cumsum(lengths) - lengths
        return self.flat[np.arange(lengths.sum()) + np.repeat(starts - before, lengths)], lengths


class Vocabulary:
    """Ranks of byte strings; a rank is the token's id and the time of its merge."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes = {number: token for token, number in ranks.items()}
        self.widest = max(map(len, ranks))
        self.late = max(self.bytes) + 1
        self.halves: dict[int, tuple[int, int] | None] = {}
        # Whether two tokens stay apart, by both ids in one number.
        self.apart: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, number in ranks.items():
            # Tokens that no merge makes only stand for whole matches. One character a byte, as the automaton takes texts.
            if self.made(number):
                self.automaton.add_word(token.decode("latin-1"), (number, len(token)))
        self.automaton.make_automaton()
        self._arrays()

    def _arrays(self) -> None:
        """The tokens as a trie, the parts that a merge joins, and the ranks of joined pairs, for many at a time."""
        edges: dict[int, int] = {}
        ends: dict[int, int] = {}
        pairs: dict[int, int] = {}
        self.sizes, self.lefts, self.rights = np.zeros(self.late, np.int64), *np.full((2, self.late), NONE, np.int64)
        for token, number in self.ranks.items():
            self.sizes[number] = len(token)
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << BITS | right] = number
            if self.made(number):
                node = 0
                for byte in token:
                    node = edges.setdefault(node << 8 | byte, len(edges) + 1)
                ends[node] = number
                if len(token) > 1:
                    self.lefts[number], self.rights[number] = self.split(number)
        self.edges, self.joined = Table(edges), Table(pairs)
        self.first = self.edges.get(np.arange(256)).astype(np.int64)
        self.token_at = np.full(len(edges) + 1, NONE, np.int32)
        self.token_at[list(ends)] = list(ends.values())
        # Pairs and, in the lowest bit, whether they stay apart; a later pair takes the slot.
        self.pairs = np.full(1 << PAIR_SLOTS, NONE, np.int64)

    def merged(self, content: bytes, before: int) -> list[bytes]:
        """What merges of a rank under `before` make of the bytes, lowest rank and then leftmost first."""
        parts = [content[k : k + 1] for k in range(len(content))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, before), k) for k, (a, b) in enumerate(pairwise(parts)))
            if rank >= before:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a single byte, or where no merge makes it."""
        if token not in self.halves:
            parts = self.merged(self.bytes[token], token)
            self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[token]

    def made(self, token: int) -> bool:
        return len(self.bytes[token]) == 1 or self.split(token) is not None

    def stand(self, left: int, right: int) -> bool:
        """True if the bytes of both tokens together are encoded as these two."""
        if len(self.apart) >= KEPT_PAIRS:
            self.apart.clear()
        found = self.apart[left << BITS | right] = self._stand(left, right)
        return found

    def lasts(self, content: bytes) -> list[int]:
        """The last token of every prefix, from one byte on."""
        apart, last = self.apart, [NONE] * len(content)
        for place, (token, size) in self.automaton.iter(content.decode("latin-1")):
            # One token is the right one, so the others needn't be looked at.
            if last[place] == NONE:
                before = place - size
                if before < 0:
                    last[place] = token
                else:
                    found = apart.get(last[before] << BITS | token)
                    if found or (found is None and self.stand(last[before], token)):
                        last[place] = token
        if NONE in last:
            raise ValueError("the vocabulary does not hold every byte")
        return last

    def stands(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`stand` for many."""
        left, right = left.astype(np.int64), right.astype(np.int64)
        pair = left << BITS | right
        at = slots(pair, PAIR_SLOTS)
        held = self.pairs[at]
        found, new = (held & 1).astype(bool), np.flatnonzero(held >> 1 != pair)
        if len(new):
            found[new] = self._stands(left[new], right[new])
            self.pairs[at[new]] = pair[new] << 1 | found[new]
        return found

    def _stands(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        # As in `_stand`; `going` are the places not yet told.
        found, going, soon = np.zeros(len(left), bool), np.arange(len(left)), np.full(len(left), self.late)
        while len(going):
            across, wide_left, wide_right = self.joined.get(left << BITS | right), self.sizes[left] > 1, self.sizes[right] > 1
            stay = (across == NONE) | (across >= soon)
            more = wide_left | wide_right
            found[going[stay & ~more]] = True
            more &= stay
            undo = (wide_left & (~wide_right | (left > right)))[more]
            left, right, going = left[more], right[more], going[more]
            soon = np.where(undo, left, right + 1)
            left, right = np.where(undo, self.rights[left], left), np.where(undo, right, self.lefts[right])
        return found

    def encoded(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all matches in a row, and how many each has."""
        runs = [self._encoded(matches[start:stop]) for start, stop in chunks.runs(list(map(len, matches)), chunks.SLICE_BYTES)]
        return joined(ids for ids, _ in runs), joined(lengths for _, lengths in runs)

    def _encoded(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, matches), np.int64, len(matches))
        order = np.argsort(-lengths, kind="stable")
        # As far as FEW reach, all go together.
        widest = int(lengths[order[FEW - 1]]) if len(order) >= FEW else 0
        longer = int(np.count_nonzero(lengths > widest))
        reach = np.minimum(lengths[order], widest)
        last = self._lasts([matches[k][:widest] for k in order.tolist()], reach)
        alone = [Prefixes(self, matches[k], [int(each[at]) for each in last]).tokens() for at, k in enumerate(order[:longer].tolist())]
        # Tokens of the others, read off backwards: whose, the how manyth from the end, and which.
        flat, starts = joined(last), np.cumsum([0, *map(len, last)])
        who, end, found = np.arange(longer, len(order)), reach[longer:], []
        while len(who):
            token = flat[starts[end - 1] + who]
            found.append((order[who], np.full(len(who), len(found)), token))
            end = end - self.sizes[token]
            who, end = who[end > 0], end[end > 0]
        whose, turn, token = map(joined, zip(*found)) if found else [joined([])] * 3
        sizes = np.bincount(whose, minlength=len(matches))
        sizes[order[:longer]] = list(map(len, alone))
        ends = np.cumsum(sizes)
        ids = np.empty(sizes.sum(), np.int64)
        ids[ends[whose] - 1 - turn] = token
        for k, own in zip(order[:longer].tolist(), alone):
            ids[ends[k] - len(own) : ends[k]] = own
        return ids, sizes

    def _lasts(self, matches: list[bytes], lengths: np.ndarray) -> list[np.ndarray]:
        """The last tokens of all prefixes of one byte, of two, and so on, of matches that are sorted, longest first."""
        widest = int(lengths[0]) if len(lengths) else 0
        held = len(lengths) - np.cumsum(np.bincount(lengths, minlength=widest + 1))
        data, starts = np.frombuffer(b"".join(matches), np.uint8), np.cumsum(lengths) - lengths
        content = [data[starts[: held[end]] + end] for end in range(widest)]
        last = [np.full(held[end], NONE, np.int32) for end in range(widest)]
        for start in range(widest):
            # All tokens from here on, so that of those with the same end the longest came first.
            who, node = np.arange(held[start]), self.first[content[start]]
            for end in range(start, widest):
                if end > start:
                    inside = np.searchsorted(who, held[end])
                    who = who[:inside]
                    node = self.edges.get(node[:inside] << 8 | content[end][who])
                on = node != NONE
                who, node = who[on], node[on].astype(np.int64)
                if not len(who):
                    break
                token = self.token_at[node]
                fits = np.flatnonzero((token != NONE) & (last[end][who] == NONE))
                place, token = who[fits], token[fits]
                # One token is the right one: at the start any, and the single byte where no longer one was.
                if 0 < start < end:
                    apart = self.stands(last[start - 1][place], token)
                    place, token = place[apart], token[apart]
                last[end][place] = token
            if (last[start] == NONE).any():
                raise ValueError("the vocabulary does not hold every byte")
        return last

    def _stand(self, left: int, right: int) -> bool:
        # `soon` is the first rank that is too late for a merge across the border to take place at this stage.
        soon = self.late
        while True:
            across = self.ranks.get(self.bytes[left] + self.bytes[right])
            if across is not None and across < soon:
                return False
            whole = [side for side in (left, right) if len(self.bytes[side]) > 1]
            if not whole:
                return True
            if max(whole) == left and left > right or len(self.bytes[right]) == 1:
                # Undo the left token's merge; of equal ranks a merge across, further right, would have come later.
                soon, left = left, self.split(left)[1]
            else:
                # A merge across of the same rank would have come first, being further left.
                soon, right = right + 1, self.split(right)[0]


def joined(arrays: Iterable[np.ndarray], kind: type = np.int64) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *arrays])


class Prefixes:
    """The last token of every prefix of some bytes, from one byte on; the first of them may be known."""

    def __init__(self, vocabulary: Vocabulary, content: bytes = b"", known: list[int] | None = None) -> None:
        self.vocabulary, self.content, self.last = vocabulary, content, known or vocabulary.lasts(content)
        if known:
            self._further()

    def _further(self, stop_early=None) -> None:
        """Fill in `last` from its end to the end of the content; `stop_early(end)` may end it before."""
        own, last = self.vocabulary, self.last
        # Tokens that end behind what is known begin here at the earliest.
        base = max(0, len(last) - own.widest + 1)
        known, token_of, at = len(last), NONE, len(last)
        for place, (token, size) in own.automaton.iter(self.content[base:].decode("latin-1")):
            end = base + place + 1
            if end <= known:
                continue
            if end > at:
                # A new position: the one before is complete.
                if at > known:
                    last.append(token_of)
                    if stop_early is not None and stop_early(len(last)):
                        return
                at, token_of = end, NONE
            if token_of == NONE and (end == size or own.stand(last[end - size - 1], token)):
                token_of = token
        if at > known:
            last.append(token_of)

    def append(self, content: bytes) -> None:
        self.content += content
        self._further()

    def replace(self, start: int, stop: int, content: bytes) -> int:
        """Put `content` in place of the bytes from `start` to `stop`; returns how many positions were computed."""
        old, shift = self.last, start + len(content) - stop
        self.content = self.content[:start] + content + self.content[stop:]
        self.last = old[:start]
        edited, agreeing = start + len(content), 0

        def agrees(end: int) -> bool:
            nonlocal agreeing
            same = end > edited and self.last[-1] == old[end - shift - 1]
            agreeing = agreeing + 1 if same else 0
            return agreeing >= self.vocabulary.widest

        self._further(agrees)
        computed = len(self.last) - start
        self.last += old[len(self.last) - shift :]
        return computed

    def tokens(self) -> list[int]:
        out, end = [], len(self.last)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.bytes[out[-1]])
        return out[::-1]


class Encoded:
    """A text under edits: its matches of the pattern, each with its ids."""

    # A match may depend on so many characters behind it (as in 'll).
    AHEAD = 3

    def __init__(self, vocabulary: Vocabulary, text: str) -> None:
        self.vocabulary, self.text = vocabulary, text
        self.matches = MATCH.findall(text)
        self.own = [encoded_match(vocabulary, match) for match in self.matches]

    def ids(self) -> list[int]:
        return [token for each in self.own for token in each]

    def append(self, text: str) -> int:
        return self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, stop: int, text: str) -> int:
        """Put `text` in place of the characters from `start` to `stop`; returns how many matches were encoded."""
        starts = np.cumsum([0, *map(len, self.matches)])
        # Whole matches before the edit that cannot see it stay.
        first = int(np.searchsorted(starts, max(0, start - self.AHEAD), side="right")) - 1
        first = max(0, first - 1)
        self.text = self.text[:start] + text + self.text[stop:]
        shift, edited = start + len(text) - stop, start + len(text)
        old = {int(place): number for number, place in enumerate(starts)}
        fresh, after = [], len(self.matches)
        for found in MATCH.finditer(self.text, int(starts[first])):
            if found.start() >= edited and found.start() - shift in old:
                after = old[found.start() - shift]
                break
            fresh.append(found.group())
        self.matches[first:after], self.own[first:after] = fresh, [encoded_match(self.vocabulary, match) for match in fresh]
        return len(fresh)


def encoded_match(vocabulary: Vocabulary, match: str) -> list[int]:
    content = match.encode()
    whole = vocabulary.ranks.get(content)
    return [whole] if whole is not None else Prefixes(vocabulary, content).tokens()


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary({token: rank for rank, token in token_bytes(path).items()})


@functools.lru_cache(maxsize=4)
def token_bytes(path: str) -> dict[int, bytes]:
    """All that decoding needs."""
    with open(path, "rb") as file:
        return {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}


def place(name: str) -> str:
    """The file of a public tokenizer's vocabulary; a path stays as it is."""
    return name if "/" in name else public_tokenizers.path(name)


class Coder:
    """Encodes texts, keeping the ids of parts and of matches."""

    def __init__(self, own: Vocabulary) -> None:
        self.own, self.parts, self.matches = own, Kept(), Kept()

    def __call__(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's end, after a 0."""
        parts, ends = [], [0]
        for text in texts:
            parts += chunks.parts(text)
            ends.append(len(parts))
        starts = range(0, len(parts), PARTS_AT_ONCE)
        found = [self.parts.take(parts[start : start + PARTS_AT_ONCE], self._parts) for start in starts]
        return joined((ids for ids, _ in found), np.int32), np.cumsum(joined([[0], *(lengths for _, lengths in found)]))[ends]

    def _parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Where a cut of a text may be (see `chunks`) no match crosses, so parts are matched in a row up to any other joint.
        joints = [at for at, (a, b) in enumerate(pairwise(parts), 1) if b[0] != " " or a[-1].isspace()]
        matches = []
        for start, stop in pairwise([0, *joints, len(parts)]):
            matches += MATCH.findall("".join(parts[start:stop]))
        ids, lengths = self.matches.take(matches, self._matches)
        match_ends, part_ends = (np.cumsum(np.fromiter(map(len, each), np.int64, len(each))) for each in (matches, parts))
        ends = np.searchsorted(match_ends, part_ends, side="right")
        return ids, np.diff(np.cumsum(joined([[0], lengths]))[ends], prepend=0)

    def _matches(self, matches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        contents = [match.encode() for match in matches]
        whole = np.fromiter(map(self.own.ranks.get, contents, repeat(NONE)), np.int64, len(contents))
        new = whole == NONE
        found, lengths = self.own.encoded([contents[k] for k in np.flatnonzero(new).tolist()])
        sizes = np.ones(len(matches), np.int64)
        sizes[new] = lengths
        ids = np.repeat(whole, sizes)
        ids[ids == NONE] = found
        return ids, sizes


class Kept:
    """Ids of strings, found once while they are kept."""

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self.places, self.ids, self.held = defaultdict(count().__next__), Lists(), 0

    def take(self, strings: list[str], find: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all strings in a row, and how many each has; `find` tells them of new strings."""
        full = len(self.places) > chunks.KEPT_PARTS or self.held > chunks.KEPT_PARTS * chunks.KEPT_LENGTH
        # After an error there are places without ids.
        if full or len(self.places) >= len(self.ids.ends):
            self._forget()
        old = len(self.places)
        places = np.fromiter(map(self.places.__getitem__, strings), np.int64, len(strings))
        new = list(islice(self.places, old, None))
        if new:
            self.held += sum(map(len, new))
            self.ids.add(*find(new))
        return self.ids.take(places)


@functools.lru_cache(maxsize=4)
def coder(path: str) -> Coder:
    """One for all tasks of a worker, so that a part is encoded once a worker while it is kept."""
    return Coder(vocabulary(path))


def encode(docs: DataFrame, text: str = "text", tokenizer: str = VOCABULARY) -> DataFrame:
    """`row` (the document's own columns without the text) and `ids`, the text's tokens."""
    rest = [name for name in docs.columns if name != text]
    whole = docs.select(F.col(text).alias("text"), F.struct(*[f"`{name}`" for name in rest or [text]]).alias("row"))

    def each(batches: Batches) -> Batches:
        code = coder(place(tokenizer))
        for batch in batches:
            for part in chunks.slices(batch, "text", ENCODED_BYTES):
                ids, ends = code(content.decode("utf-8", "replace") for content in texts(part, "text"))
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("row"), column], ["row", "ids"])

    return whole.mapInArrow(each, T.StructType([whole.schema["row"], *T._parse_datatype_string("ids array<int>").fields]))


def decode(rows: DataFrame, ids: str = "ids", tokenizer: str = VOCABULARY) -> DataFrame:
    """The columns of `rows` as a struct `row`, and `decoded`, the bytes of the ids."""
    whole, number = rows.select(F.struct(*[f"`{name}`" for name in rows.columns]).alias("row")), rows.columns.index(ids)

    def each(batches: Batches) -> Batches:
        held = token_bytes(place(tokenizer))
        known = pa.array([held.get(number) for number in range(max(held) + 1)], pa.binary())
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("row").field(number)), 0)
            for start, stop in chunks.runs(lengths.to_pylist(), DECODED_IDS):
                part = batch.slice(start, stop - start)
                tokens = known.take(part.column("row").field(number).flatten())
                if tokens.null_count:
                    raise KeyError("an id without bytes")
                # A row's bytes are those of its tokens in a row, as they lie there.
                token_ends = np.cumsum(np.concatenate([[0], pc.binary_length(tokens).to_numpy()]))
                row_ends = token_ends[np.cumsum([0, *lengths[start:stop].to_pylist()])].astype(np.int32)
                buffers = [None, pa.py_buffer(row_ends), tokens.buffers()[2] or pa.py_buffer(b"")]
                decoded = pa.BinaryArray.from_buffers(pa.binary(), len(part), buffers)
                yield pa.RecordBatch.from_arrays([part.column("row"), decoded], ["row", "decoded"])

    return whole.mapInArrow(each, T.StructType([whole.schema["row"], *T._parse_datatype_string("decoded binary").fields]))
