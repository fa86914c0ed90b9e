"""Quality rules: counts on words and lines, then bands of zstandard compression ratios.

A text that compresses far better than prose of its length repeats itself; one that compresses
far worse is noise. The ratio (bytes before and after) depends on length, so every class of
length has limits of its own, for whole texts and for fixed chunks of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from salesflow.llm.ship import ship_package
from salesflow.llm.words import Words, covered, slices


@dataclass(frozen=True)
class Band:
    """Limits of the ratio for texts of up to ``max_bytes``."""

    max_bytes: float
    low: float
    high: float


#: Natural prose at zstandard level 3 lies inside with room on both sides. Texts below 128 bytes hardly
#: compress at all, so nothing is too dense there.
BANDS = (Band(128, 0.0, 2.0), Band(256, 0.9, 2.1), Band(512, 1.15, 2.15), Band(1024, 1.25, 2.25),
         Band(2048, 1.35, 2.4), Band(4096, 1.45, 2.5), Band(8192, 1.5, 2.65), Band(16384, 1.5, 2.75),
         Band(65536, 1.5, 2.9), Band(1 << 20, 1.5, 3.3), Band(float("inf"), 1.5, 3.7))

SIGNALS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
           "n_repeat_words bigint, ratio double, n_chunks bigint, n_bad_chunks bigint, "
           "base_failed boolean, kept boolean")


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    repeat_window: int = 8
    max_repeat_percent: int = 30
    symbols: str = "#*$%&|<>"
    bands: Sequence[Band] = BANDS
    chunk_bytes: int = 1024
    max_bad_chunk_percent: int = 30
    level: int = 3


def in_band(n_bytes: int, ratio: float, bands: Sequence[Band]) -> bool:
    band = next(b for b in bands if n_bytes <= b.max_bytes)
    return band.low <= ratio <= band.high


def compression(data: bytes, rules: Rules, packer: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """Ratio of the whole, chunks and how many of them are outside their band, and the verdict.

    Chunks have ``chunk_bytes`` bytes; a shorter rest is no chunk. An empty text has ratio 1."""
    if not data:
        return 1.0, 0, 0, True
    ratio = len(data) / len(packer.compress(data))
    size = rules.chunk_bytes
    n = len(data) // size
    bad = sum(not in_band(size, size / len(packer.compress(data[i * size:(i + 1) * size])), rules.bands)
              for i in range(n))
    good = in_band(len(data), ratio, rules.bands) and 100 * bad <= rules.max_bad_chunk_percent * n
    return ratio, n, bad, good


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def repeated_words(words: Words, window: int) -> np.ndarray:
    """For each text, its words inside windows found twice or more in it."""
    owner = words.owner()
    hashes, whole = words.windows(window)
    at = np.flatnonzero(whole)
    keys = np.empty(len(at), dtype=[("text", np.int64), ("hash", np.uint64)])
    keys["text"], keys["hash"] = owner[at], hashes[at]
    order = np.lexsort((keys["hash"], keys["text"]))
    ordered = keys[order]
    same = np.zeros(len(at) + 1, dtype=bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    twice = at[order[same[:-1] | same[1:]]]
    hit = covered(twice, window, len(owner))
    return np.bincount(owner[hit], minlength=len(words.offsets) - 1)


def _signals(batch: pa.RecordBatch, rules: Rules, packer: zstandard.ZstdCompressor) -> list[pa.Array]:
    words = Words(batch.column("text"))
    data = words.data.tobytes()
    texts = [data[a:b] for a, b in zip(words.text_at[:-1], words.text_at[1:], strict=True)]
    n_words = words.counts
    lead = np.cumsum(np.concatenate([[0], (words.data & 0xC0) != 0x80]))  # code points before a byte
    chars = np.zeros(len(texts), np.int64)
    np.add.at(chars, words.owner(), lead[words.ends] - lead[words.starts])
    strip = rules.symbols.encode()
    symbols = [len(t) - len(t.translate(None, strip)) for t in texts]
    repeats = repeated_words(words, rules.repeat_window)
    failed = (n_words < rules.min_words) | (100 * repeats > rules.max_repeat_percent * n_words)
    ratio, chunks, bad, good = zip(*(compression(t, rules, packer) for t in texts), strict=True)
    return [pa.array(n_words, pa.int64()), pa.array(chars), pa.array(symbols, pa.int64()),
            pa.array([duplicate_lines(t) for t in texts], pa.int64()), pa.array(repeats, pa.int64()),
            pa.array(ratio, pa.float64()), pa.array(chunks, pa.int64()), pa.array(bad, pa.int64()),
            pa.array(failed), pa.array(~failed & np.array(good, dtype=bool))]


def quality_signals(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with the columns of ``SIGNALS``; a column of ``docs`` by such a name is replaced.

    One pass, no shuffle, whole texts. A null text counts as empty: no words, so its base rules fail.
    Repeated rows are judged alike; other columns, null or not, pass through. ``kept`` is false if the
    base rules fail, else it is the verdict of the compression bands.
    """
    ship_package(docs.sparkSession)
    signals = StructType.fromDDL(SIGNALS)
    docs = docs.drop(*signals.names)
    schema = StructType([*docs.schema.fields, *signals.fields])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, *_signals(part, rules, packer)],
                                                 names=schema.names)

    return docs.mapInArrow(judge, schema)


def keep_quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns, whatever their names."""

    ship_package(docs.sparkSession)
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            for part in slices(batch):
                yield part.filter(_signals(part, rules, packer)[-1])

    return docs.mapInArrow(keep, docs.schema)
