"""Byte-pair encoding with word ends, and its decoding, on a given vocabulary.

A text is normalised (NFC, lower case), split into words, and every word is
merged on a contiguous array of ranks: parts and the ranks of adjacent parts
stand side by side, the smallest rank is looked for by a scan, its boundary is
deleted and the two neighbouring ranks are refreshed. Long words, where repeated
scans would be quadratic, take the same merges from a heap. The strings of the
special tokens in a text stand for these tokens, as in the public library.

Defined results: a null text is an empty one; it has no ids and decodes to the
empty text. Repeated rows are encoded row by row; texts of any length are whole. Of
equal ranks in a word the leftmost is merged first. An empty table gives an empty one.
Only the id is carried over; further columns, of whatever name, are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickloom.llm.common import slices

#: Words of up to so many symbols are merged by scans.
SHORT = 96
#: Words whose ids a worker remembers.
REMEMBERED = 250_000
NONE = 1 << 30
#: White space of the public library's patterns (fixed values).
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _char_class(kind: str) -> str:
    """Ranges of all code points of a general category."""
    out, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(re.escape(chr(start)) + (f"-{re.escape(chr(c - 1))}" if c - 1 > start else ""))
            start = None
    return "".join(out)


class Encoder(dict):
    """Word -> (ids as bytes, decoded text); words are merged when first asked for."""

    def __init__(self, vocabulary: str):
        super().__init__()
        spec = json.loads(vocabulary)
        vocab, self.end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.names = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        symbols = _byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.end] for s in symbols]
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.ranks[vocab[a], vocab[b]] = rank
            self.merged.append(vocab[a + b])
        letters, numbers = _char_class("L"), _char_class("N")
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{BLANKS}{letters}{numbers}]+")
        self.ascii_words = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, word: str) -> list[int]:
        data = word.encode("utf-8", "surrogatepass")
        parts = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        return self.merge_short(parts) if len(parts) <= SHORT else self.merge_long(parts)

    def merge_short(self, parts: list[int]) -> list[int]:
        rank_of = self.ranks.get
        ranks = [rank_of(pair, NONE) for pair in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < NONE:
            i = ranks.index(least)
            parts[i] = self.merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((parts[i - 1], parts[i]), NONE)
            if i < len(ranks):
                ranks[i] = rank_of((parts[i], parts[i + 1]), NONE)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        n, rank_of = len(parts), self.ranks.get
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank_of((parts[i], parts[i + 1]), NONE)) < NONE]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = self.merged[rank], False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (r := rank_of((parts[left], parts[right]), NONE)) < NONE:
                    heapq.heappush(heap, (r, left, parts[left], parts[right]))
        return [p for p, ok in zip(parts, alive, strict=True) if ok]

    def entry(self, ids: list[int]) -> tuple[bytes, str]:
        return np.array(ids, "<u4").tobytes(), self.decode(ids)

    def __missing__(self, word: str) -> tuple[bytes, str]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self.entry(self.merge(word))
        if len(word) <= SHORT:
            self[word] = found
        return found

    def split(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words.findall(text.lower())
        # one character at a time: the end form of sigma does not exist there
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def pieces(self, text: str | None) -> list[tuple[bytes, str]]:
        out: list[tuple[bytes, str]] = []
        for k, part in enumerate(self.specials.split(text or "") if self.specials else [text or ""]):
            if k % 2:
                out.append(self.entry([self.special[part]]))
            elif part:
                out.extend(map(self.__getitem__, self.split(part)))
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(p[0] for p in self.pieces(text)), "<u4")

    def decode(self, ids) -> str:
        """The tokens' strings with a blank between them, as a vocabulary without decoder is read."""
        return " ".join([self.names[int(i)] for i in ids])


_encoders: dict[int, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    key = hash(vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids array<int>, decoded) of every whole text."""
    return _over(
        docs, path, id_col, text_col, "ids array<int>, decoded string",
        lambda p: (np.frombuffer(b"".join([x[0] for x in p]), "<i4"), " ".join([x[1] for x in p])),
        [pa.list_(pa.int32()), pa.string()],
    )


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_tokens, ids_sha256, decoded_sha256): like ``encode``, with results that stay small."""

    def digest(pieces: list[tuple[bytes, str]]) -> tuple:
        ids = b"".join([p[0] for p in pieces])
        text = " ".join([p[1] for p in pieces])
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode("utf-8")).hexdigest()

    return _over(
        docs, path, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest, [pa.int64(), pa.string(), pa.string()]
    )


def _over(docs: DataFrame, path: str, id_col: str, text_col: str, columns: str, result, types: list) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))  # one vocabulary file
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(sent.value)
        for batch in slices(batches, 64):
            found = [result(enc.pieces(t)) for t in batch.column("text").to_pylist()]
            arrays = [pa.array([f[i] for f in found], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], names=["id", *names])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, {columns}").withColumnRenamed("id", id_col)
