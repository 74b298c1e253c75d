r"""Cutting texts where no public tokenizer's tokens can cross, so that each distinct part is tokenized once.

A cut is put before every blank U+0020 that follows a character that is not white space. The byte-level pattern ends
every match there, and the piece model has no piece that goes on behind a blank, so tokens of the parts in a row are
the tokens of the text. `\s` here includes every character that the tokenizers hold to be white space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

# White space that does not begin with a blank stays inside a part.
PART = re.compile(r"\s*\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*)?|\s+")
# Bytes of text that a task works on at a time; a longer text is worked on alone.
SLICE_BYTES = 2 << 20
# Parts up to so many characters are kept, and so many of them.
KEPT_LENGTH, KEPT_PARTS = 48, 150_000


def parts(text: str) -> list[str]:
    return PART.findall(text)


def slices(batch: pa.RecordBatch, name: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most `limit` bytes of the named text column, or of one row."""
    for start, stop in spans(batch.column(name), limit):
        yield batch.slice(start, stop - start)


def spans(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    return runs(pc.fill_null(pc.binary_length(column), 0).to_pylist(), limit)


def runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Neighbours whose sizes add up to at most `limit`, or one alone."""
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and held + size > limit:
            yield start, at
            start, held = at, 0
        held += size
    if len(sizes) > start:
        yield start, len(sizes)
