"""Words and white-space chunks of texts, for tasks that run in Python."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Generic, TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space by Unicode beyond the space and \t \n \v \f \r.
_WIDE = "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                          0x205F, 0x3000]))
# The four separators that str.split() takes for white space but Unicode does not.
_FOUR = "".join(map(chr, range(0x1C, 0x20)))
_RARE_SPACE = re.compile(f"[{_WIDE}{_FOUR}]")
_WORD = re.compile("[^\x20\x09-\x0d]+")


def words_of(text: str) -> list[str]:
    """Runs of characters other than the space and \\t \\n \\v \\f \\r."""
    return _WORD.findall(text) if _RARE_SPACE.search(text) else text.split()


# Text a task works on at a time, apart from a single longer text.
SLICE_BYTES, SLICE_ROWS = 8 << 20, 4096


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut where their texts reach a size."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // size
        cuts = np.flatnonzero(np.diff(part)) + 1
        ends = sorted({*cuts.tolist(), *range(SLICE_ROWS, batch.num_rows, SLICE_ROWS), batch.num_rows})
        at = 0
        for end in ends:
            if end > at:
                yield batch.slice(at, end - at)
            at = end


# A Latin letter or digit, then signs up to white space or the end. The letters are those that
# neither normalization nor lower case turns into more than a letter (so not U+0130). Apostrophes
# and the characters of special tokens take no part, as what they are parts of must stay together.
_TAIL = (
    r"([A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])"
    r"([^\s\pL\pN\pM'<>|]+)(\s|$)"
)


def folded(texts: pa.Array) -> pa.Array:
    """Texts with ASCII letters in lower case and a space before marks that end a chunk.

    For a tokenizer that lowers case, drops white space and splits marks from letters the tokens
    stay the same, and there are far fewer distinct chunks. Texts that may hold a special token
    stay as they are, and so do texts with combining marks, which may join the letter before.
    """
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), _TAIL, r"\1 \2\3")
    return pc.if_else(pc.match_substring_regex(texts, r"\pM|<\|"), texts, plain)


class Chunks:
    """Texts cut at ASCII white space: the distinct chunks, and which of them each text has."""

    def __init__(self, texts: pa.Array) -> None:
        # A copy that begins at 0: some kernels misread an array that is part of another.
        whole = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts))))
        lists = pc.ascii_split_whitespace(folded(whole.fill_null("")))
        coded = lists.flatten().dictionary_encode()
        self.distinct: list[str] = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._codes = coded.indices
        ends = lists.offsets.to_numpy()
        self._bounds = ends - ends[0]

    def joined(self, parts: list[bytes]) -> list[memoryview]:
        """Each text with its chunks replaced; `parts` has one replacement per distinct chunk."""
        found = pa.array(parts, pa.large_binary()).take(self._codes)
        if not len(found):
            return [memoryview(b"")] * (len(self._bounds) - 1)
        _, offsets, data = found.buffers()
        at = np.frombuffer(offsets, np.int64)[self._bounds].tolist()
        whole = memoryview(data) if data is not None else memoryview(b"")
        return [whole[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


Value = TypeVar("Value")


class Recent(Generic[Value]):
    """What is known of recent strings, at most twice `size` of them.

    Two generations: when the young one is full it becomes the old one, and what is used again
    moves back. So frequent strings stay, and rare ones go without bookkeeping per use.
    """

    def __init__(self, size: int) -> None:
        self.size = size
        self.young: dict[str, Value] = {}
        self.old: dict[str, Value] = {}

    def values(self, wanted: list[str]) -> tuple[list[Value | None], list[int]]:
        """The value of each of some distinct strings, and the places of those not known."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, wanted))
        new = []
        for i in [i for i, v in enumerate(found) if v is None]:
            value = old.get(wanted[i])
            if value is None:
                new.append(i)
            else:
                found[i] = young[wanted[i]] = value
        return found, new

    def learn(self, strings: list[str], values: list[Value], longest: int) -> None:
        """Remembers the strings that are not too long."""
        self.young.update(
            (s, v) for s, v in zip(strings, values, strict=True) if len(s) <= longest)

    def clear(self) -> None:
        self.young, self.old = {}, {}
