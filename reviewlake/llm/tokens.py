"""Words of Arrow text batches as numpy arrays: places, documents and 64-bit hashes.

Everything works on the UTF-8 bytes of a whole slice of texts at once; nothing loops over words. What
a task holds at once is bounded by ``SLICE_BYTES`` or the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SPACE = 0x20


def space_table(lower: bool = False, punctuation: bool = False) -> np.ndarray:
    """A table of bytes: ASCII white space becomes a space, capitals small, punctuation a space."""
    table = np.arange(256, dtype=np.uint8)
    table[[*range(0x09, 0x0E), 0x20]] = SPACE
    if lower:
        table[0x41:0x5B] += 0x20
    if punctuation:
        kept = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
        table[[b for b in range(256) if b not in kept]] = SPACE
    return table


@dataclass
class Texts:
    """Some texts: their bytes on end, and where each begins and ends."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Cuts a batch into runs of rows; null is empty. First and last row are counted in the batch."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last, Texts(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """The words of some texts. ``of``: where each text's words begin; one entry more than texts."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.of)


def split(texts: Texts, table: np.ndarray) -> Words:
    data = table[texts.data]
    n = len(data)
    inside = data != SPACE
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    closes[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return Words(data, starts, ends, np.searchsorted(starts, texts.offsets))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit; works in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.empty(max(n, 1024), np.uint64)
        known[0], known[1:] = 1, base
        np.multiply.accumulate(known, out=known)
        if n <= 1 << 20:
            _POWERS[base] = known
    return known[:n]


BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def word_hashes(words: Words, base: int = BASES[0]) -> np.ndarray:
    """A hash of each word's bytes."""
    if not len(words):
        return np.zeros(0, np.uint64)
    lengths = words.ends - words.starts
    # Bytes of words on end, without the space between them.
    firsts = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    values = words.data[np.repeat(words.starts, lengths) + within].astype(np.uint64)
    values += np.uint64(1)
    values *= powers(base, int(lengths.max()))[within]
    return mixed(np.add.reduceat(values, firsts))


def gram_hashes(values: np.ndarray, k: int, base: int = BASES[1]) -> np.ndarray:
    """A hash of every ``k`` values on end; it does not heed where texts end."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = values[:n].copy()
    for j in range(1, k):
        out *= np.uint64(base)
        out += values[j:j + n]
    return mixed(out)
