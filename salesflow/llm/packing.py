"""Packing: tokenize, concatenate and cut into sequences of one length.

First pass: every input partition tokenizes its documents and adds up its own tokens; the token
table is written once. The partition totals, one row each, are summed to the offset where each
partition begins. Second pass: a document's place in the stream is its partition's offset plus its
own, so every task cuts its documents at the multiples of the length without seeing any other. Only
the last sequence is not full. A document cut by a boundary leaves a record on either side.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tokenizers import Tokenizer

from salesflow.llm.ship import ship_package
from salesflow.llm.words import Words, slices, text_bytes
from salesflow.session import stage

KNOWN_WORDS = 200_000  # some 50 bytes each
LETTERS = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+").fullmatch  # one code point each in every normal form and case
WORD_PATTERN = r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

TOKENS = "part int, part_offset bigint, doc_id bigint, ids array<int>"
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, continued boolean, continues boolean, ids array<int>")


def _byte_characters() -> dict[int, str]:
    """The printable characters that byte-level tokenizers write bytes as."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_CHARACTERS = _byte_characters()


def splits_words(tokenizer: Tokenizer) -> bool:
    """Whether a tokenizer drops white space, lower-cases, and cuts runs of letters from the rest, so that
    the ids of a text are those of its words in a row."""
    spec = json.loads(tokenizer.to_str())
    normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (normal == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in steps] == ["Split", "ByteLevel"]
            and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["add_prefix_space"]
            and steps[0]["pattern"].get("Regex", "").endswith(WORD_PATTERN))


class KnownWords:
    """Ids of words by the words' 64-bit hashes, as sorted arrays: ``hashes``, ``lengths`` (bytes of the words), ``starts`` and
    ``sizes`` of their ids in ``ids``."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, ids: np.ndarray):
        self.hashes, self.lengths, self.sizes, self.ids = hashes, lengths, sizes, ids
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def none(cls) -> KnownWords:
        return cls(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4"))

    def find(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words stand, and which of them do."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        if not len(self.hashes):
            return at, np.zeros(len(at), bool)
        return at, (self.hashes[at] == hashes) & (self.lengths[at] == lengths)

    def take(self, at: np.ndarray) -> np.ndarray:
        """Ids of words in a row."""
        sizes = self.sizes[at]
        upto = np.cumsum(sizes)
        return self.ids[np.arange(upto[-1] if len(upto) else 0) + np.repeat(self.starts[at] - (upto - sizes), sizes)]

    def pick(self, at: np.ndarray) -> KnownWords:
        return KnownWords(self.hashes[at], self.lengths[at], self.sizes[at], self.take(at))

    def union(self, *others: KnownWords) -> KnownWords:
        """All words; of one hash the first."""
        tables = (self, *others)
        whole = KnownWords(*(np.concatenate([getattr(t, c) for t in tables]) for c in ("hashes", "lengths", "sizes", "ids")))
        return whole.pick(np.unique(whole.hashes, return_index=True)[1])


class TextTokenizer:
    """A tokenizer applied to whole texts, or word by word where that is the same.

    Words recur, in a slice of texts and later: each is looked up once a slice, and words met lately are
    kept in two generations of ``KNOWN_WORDS`` at least. A word that does not return goes with its generation. A comma or
    full stop behind a letter is a word of its own, and A-Z are as a-z, so a word is learned once in all these forms. Words
    of letters go straight to the tokenizer's model; the others
    take the whole way. Words are told apart by 64-bit hashes and their lengths.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.by_word = splits_words(self.tokenizer)
        self.recent, self.older = KnownWords.none(), KnownWords.none()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        words = Words(texts, lower=True, tails=True) if self.by_word else None
        if words is not None:
            hashes, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
            lengths = words.ends - words.starts
        if words is None or (lengths[first][place] != lengths).any():
            data, at = text_bytes(texts)
            own = [self._whole(data[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            return _numbers(own), np.array([len(x) // 4 for x in own], np.int64)
        known = self._known(words, hashes, first, lengths[first])
        ends = np.concatenate([[0], np.cumsum(known.sizes[place])])[words.offsets]
        return known.take(place), np.diff(ends)

    def _known(self, words: Words, hashes: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> KnownWords:
        """The distinct words of a slice, that begin at the words ``first``, by rising hash."""
        if len(self.recent.hashes) > KNOWN_WORDS:
            self.older, self.recent = self.recent, KnownWords.none()
        at, met = self.recent.find(hashes, lengths)
        before, old = self.older.find(hashes, lengths)
        old &= ~met
        new = ~(met | old)
        raw = words.data.tobytes()
        own = self._learn([raw[a:b] for a, b in zip(words.starts[first[new]].tolist(), words.ends[first[new]].tolist(), strict=True)])
        fresh = KnownWords(hashes[new], lengths[new], np.array([len(x) // 4 for x in own], np.int64), _numbers(own)).union(
            self.older.pick(before[old]))
        found = fresh.union(self.recent.pick(at[met]))
        self.recent = fresh.union(self.recent)
        return found

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that were not met lately: those of letters one by one, the others at once."""
        out, other, tokenize = [], [], self.model.tokenize
        for word in words:
            if word.isalpha():  # of bytes: ASCII letters
                text = word.lower().decode()
            elif LETTERS(letters := word.decode()):
                text = letters.lower().encode().decode("latin-1").translate(BYTE_CHARACTERS)
            else:
                other.append((len(out), letters))
                out.append(b"")
                continue
            out.append(_packed([t.id for t in tokenize(text)]))
        for at in range(0, len(other), 5000):
            some = other[at:at + 5000]
            for (place, _), found in zip(some, self.tokenizer.encode_batch_fast([w for _, w in some], add_special_tokens=False),
                                         strict=True):
                out[place] = _packed(found.ids)
        return out

    def _whole(self, text: bytes) -> bytes:
        return _packed(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _numbers(ids: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(ids), "<u4")


@lru_cache(maxsize=1)
def text_tokenizer(path: str) -> TextTokenizer:
    """One for all tasks of a Python worker, so that later tasks find the words of earlier ones: some 40 MB of words at most."""
    return TextTokenizer(path)


def _list_array(ids: list[bytes]) -> pa.Array:
    """An array of lists of 32-bit numbers from their bytes."""
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Tokens of every row of ``docs`` (``doc_id``, ``text``), ``end_id`` last, as a written table
    ``TOKENS``: the task that made a row, and the tokens that the task made before it."""
    ship_package(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, upto, coder = TaskContext.get().partitionId(), 0, text_tokenizer(tokenizer)
        for batch in batches:
            for rows in slices(batch):
                own, counts = coder.encode(rows.column("text"))
                ends = np.concatenate([[0], np.cumsum(counts + 1)])
                ids = np.full(ends[-1], end_id, np.uint32)
                ids[np.arange(len(own)) + np.repeat(np.arange(len(counts)), counts)] = own
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), part, np.int32)), pa.array(upto + ends[:-1]),
                     rows.column("doc_id"), lists], names=["part", "part_offset", "doc_id", "ids"])
                upto += int(ends[-1])

    return stage(docs.select("doc_id", "text").mapInArrow(run, TOKENS), "tokens")


def _cut(rows: pa.RecordBatch, length: int) -> pa.RecordBatch:
    ids = rows.column("ids")
    ends = ids.offsets.to_numpy().astype(np.int64)
    flat = ids.values.to_numpy()
    out: dict[str, list] = {field.split()[0]: [] for field in PIECES.split(", ")}
    for doc, place, a, b in zip(rows.column("doc_id").to_pylist(), rows.column("place").to_pylist(),
                                ends[:-1], ends[1:], strict=True):
        start, n = 0, int(b - a)
        while start < n:
            sequence, offset = divmod(place + start, length)
            size = min(length - offset, n - start)
            own = flat[a + start:a + start + size].astype("<u4").tobytes()
            values = (doc, start, size, zlib.crc32(own), n, sequence, offset, start > 0, start + size < n, own)
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
            start += size
    kinds = {"doc_id": pa.int64(), "continued": pa.bool_(), "continues": pa.bool_()}
    return pa.RecordBatch.from_arrays(
        [_list_array(v) if k == "ids" else pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()],
        names=list(out))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 4096) -> DataFrame:
    """The pieces of all documents (``doc_id``, ``text``) in sequences of ``length`` tokens.

    A piece: ``doc_id``, ``start`` (its document's ids before it), ``length``, ``ids_crc32`` (of the ids
    as little-endian unsigned 32-bit numbers), ``doc_tokens`` (with the end id), ``sequence_id``,
    ``offset`` in the sequence, ``continued`` and ``continues`` (the document has pieces before and
    after), ``ids``. Every id of every row lies in one piece; sequences have no gap, and only the
    last is shorter than ``length``.

    A text of any length is one row of one task, which tokenizes it whole. A null text counts as empty and leaves its end id; a null ``doc_id`` stays null; repeated rows are
    repeated documents; an empty table gives no pieces; other columns are ignored.
    """
    tokens = token_table(docs, tokenizer, end_id)
    totals = tokens.groupBy("part").agg(F.sum(F.size("ids").cast("bigint")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each task of the first pass; written, so that its true size picks the join
    bases = stage(totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")),
                  "token-bases")
    placed = tokens.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("part_offset")).alias("place"), "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield _cut(batch.slice(at, 500), length)

    return placed.mapInArrow(cut, PIECES)
