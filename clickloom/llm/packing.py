"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

A document is cut into whole windows and a rest, and the rest into pieces of at
most ``PIECE`` tokens. Pieces of a group are dealt to windows by differencing:
each piece starts as a partial partition of its own; the two partitions with the
largest imbalances are merged, the fullest window of one with the emptiest of the
other, until one partition is left. Its windows are nearly equal. When one of
them exceeds the capacity, the group gets one more window and starts again.

Groups are filled inside a task, in the order in which the task reads its rows,
so no token leaves the task; only a task's last group may be less than full.

Defined results: a null text is an empty one and consists of the end token.
Repeated rows are separate documents. A document of any length is cut freely. Pieces of
equal length are told apart by their place. An empty table gives an empty one. Only the
id is carried over; further columns, of whatever name, are left out.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clickloom.llm.common import slices

#: Windows of a group, and the largest piece of a document's rest.
WINDOWS, PIECE = 96, 512
#: Tokens that a group leaves free, so that nearly equal windows stay below the capacity.
FREE = 2 * WINDOWS
#: Byte-level pieces of the vocabulary's public library (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def difference(sizes: list[int], windows: int) -> np.ndarray:
    """A window for each piece, with nearly equal sums of sizes."""
    tree: list[tuple[int, int]] = []  # content of a slot: a piece (below 0) or two slots together
    heap = []
    for i, size in enumerate(sizes):
        sums, nodes = np.zeros(windows, np.int64), np.zeros(windows, np.int64)
        sums[0], nodes[0] = size, -1 - i
        heap.append((-size, i, sums, nodes))
    heapq.heapify(heap)
    tree.append((0, 0))  # node 0: nothing
    order = len(sizes)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, other, its = heapq.heappop(heap)
        sums, nodes, its = sums + other[::-1], nodes.copy(), its[::-1]
        nodes[nodes == 0] = its[nodes == 0]
        for k in np.flatnonzero((nodes != its) & (its != 0)):
            tree.append((int(nodes[k]), int(its[k])))
            nodes[k] = len(tree) - 1
        by_size = np.argsort(-sums, kind="stable")
        sums, nodes = sums[by_size], nodes[by_size]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), order, sums, nodes))
        order += 1
    place = np.zeros(len(sizes), np.int64)
    for window, node in enumerate(heap[0][3] if heap else []):
        stack = [int(node)]
        while stack:
            x = stack.pop()
            if x < 0:
                place[-1 - x] = window
            elif x:
                stack.extend(tree[x])
    return place


def pack(sizes: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """A window for each piece, none above the capacity, and the number of windows."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        place = difference(sizes, windows)
        if not sizes or np.bincount(place, sizes, windows).max() <= capacity:
            return place, windows
        windows += 1


def vocabulary_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Bytes of each token -> id, and the special tokens, of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    byte_of = {chr(b) if b in plain else chr(next(others)): b for b in range(256)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
    return {bytes(byte_of[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}, special


_encodings: dict[int, tiktoken.Encoding] = {}


def _encoding(ranks: dict, special: dict) -> tiktoken.Encoding:
    if id(ranks) not in _encodings:
        _encodings.clear()
        _encodings[id(ranks)] = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encodings[id(ranks)]


class Windows:
    """Takes documents one after the other and gives back finished rows."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.pieces: list[tuple] = []
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, key, ids: np.ndarray) -> None:
        cut = lambda a, b: (key, a, b - a, zlib.crc32(ids[a:b].tobytes()), len(ids))
        whole = len(ids) - len(ids) % self.capacity
        for a in range(0, whole, self.capacity):
            self.rows.append((*cut(a, a + self.capacity), self.next, 0))
            self.next += 1
        room, a = WINDOWS * self.capacity - FREE, whole
        while a < len(ids):
            b = min(len(ids), a + PIECE, a + room - self.held)
            self.pieces.append(cut(a, b))
            self.held += b - a
            a = b
            if self.held == room:
                self.close()

    def close(self) -> None:
        if not self.pieces:
            return
        place, windows = pack([p[2] for p in self.pieces], self.capacity)
        filled = [0] * windows
        for piece, window in zip(self.pieces, place.tolist(), strict=True):
            self.rows.append((*piece, self.next + window, filled[window]))
            filled[window] += piece[2]
        self.next += windows
        self.pieces, self.held = [], 0


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path`` is a byte-level vocabulary file; a document's ids are those of the
    public tokenizers library, special tokens' strings in the text included,
    followed by ``end``. Sequence ids are unique: part of the table, then order.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary_ranks(path))  # one vocabulary file
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(*sent.value)
        out = Windows(capacity, TaskContext.get().partitionId() << 36)
        id_type = None

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out.rows, strict=True)) or [[]] * 7
            out.rows = []
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=names)

        for batch in slices(batches, 256):
            id_type = batch.schema.field("id").type
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = enc.encode(text, allowed_special="all") if text else []
                out.add(key, np.array([*ids, end], "<u4"))
            if len(out.rows) > 10_000:
                yield ready()
        out.close()
        if id_type is not None:
            yield ready()

    fields = ", ".join(f"{n} long" for n in names[1:-1])
    return rows.mapInArrow(run, f"id {kind}, {fields}, `offset` long").withColumnRenamed("id", id_col)
