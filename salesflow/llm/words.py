"""Words of texts as 64-bit hashes, for the operators that work on word sequences inside tasks.

Arrow hands a task its texts as one buffer; words are cut and hashed there with numpy, a few
megabytes at a time, without an object per word. A word is a run of bytes that are no breaks, by
default space and ``\\x09-\\x0D``; ``lower`` folds A-Z.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
SEGMENT_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Everything in ASCII that is neither a letter nor a digit; bytes of other characters belong to words.
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
TAIL = np.zeros(256, dtype=bool)
TAIL[[*b",."]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64))
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[65:91] = BYTE[97:123]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, BASE, dtype=np.uint64)
    down = np.full(n, np.uint64(pow(int(BASE), -1, 1 << 64)), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` at least."""
    return _powers(max(SEGMENT_BYTES, 1 << int(n).bit_length()))


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``SLICE_BYTES`` of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, ends = 0, np.cumsum(sizes)
    while at < len(ends):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the offsets of each text in them; null: empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or not len(texts):
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


class Words:
    """Words of some texts: ``hashes``, ``starts`` and ``ends`` (bytes) of all, and ``offsets``, where
    each text's words begin among them (one more than texts). ``tails``: a comma or full stop that ends a word after an
    ASCII letter is a word of its own."""

    def __init__(self, texts: pa.Array, lower: bool = False, breaks: np.ndarray = SPACE, tails: bool = False):
        self.data, at = text_bytes(texts)
        n = len(self.data)
        space = breaks[self.data]
        fresh = np.zeros(n + 1, dtype=bool)  # where a text begins
        fresh[at] = True
        cut = np.ones(n + 1, dtype=bool)  # no word reaches across
        cut[1:n] = space[1:] | space[:-1] | fresh[1:n]
        if tails:
            cut[1:n] |= TAIL[self.data[1:]] & LETTER[self.data[:-1]] & cut[2:n + 1]
        values = (BYTE_LOWER if lower else BYTE)
        starts, ends, hashes = [], [], []
        a = 0
        while a < n:
            b = a + SEGMENT_BYTES
            if b < n:
                back = np.flatnonzero(cut[a + 1:b + 1])
                b = a + 1 + int(back[-1]) if len(back) else b + int(np.argmax(cut[b:]))
            b = min(b, n)
            word = ~space[a:b]
            first = np.flatnonzero(word & cut[a:b])
            last = np.flatnonzero(word & cut[a + 1:b + 1])
            up, down = powers(b - a + 1)
            sums = np.zeros(b - a + 1, dtype=np.uint64)
            np.cumsum(values[self.data[a:b]] * up[:b - a], out=sums[1:])
            hashes.append(mix((sums[last + 1] - sums[first]) * down[first]))
            starts.append(first + a)
            ends.append(last + 1 + a)
            a = b
        none = np.empty(0, np.int64)
        self.starts = np.concatenate(starts or [none])
        self.ends = np.concatenate(ends or [none])
        self.hashes = np.concatenate(hashes or [none.astype(np.uint64)])
        self.text_at = at
        self.offsets = np.searchsorted(self.starts, at, "left")
        self.offsets[-1] = len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owner(self) -> np.ndarray:
        """Index of the text of every word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` words from every word on, and whether they lie in one text."""
        return window_hashes(self.hashes, n), self.room() >= n

    def room(self) -> np.ndarray:
        """Words of the same text from each word to the text's end."""
        return np.repeat(self.offsets[1:], self.counts) - np.arange(len(self.hashes))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` values from each place on; shorter at the end."""
    size = len(hashes)
    up, down = powers(size + 1)
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:size], out=sums[1:])
    upto = np.minimum(np.arange(size) + n, size)
    return mix((sums[upto] - sums[:-1]) * down[:size] + np.uint64(n))


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the runs of ``n`` that begin at ``starts``."""
    step = np.zeros(size + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + n, size), -1)
    return np.cumsum(step[:-1]) > 0
