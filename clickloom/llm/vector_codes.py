"""Vectors as short codes: one codebook for each part of a vector, fitted in whole numbers.

Components become floor(256 x). Vectors are cut into 16 equal parts; each part
position has a codebook of up to 64 entries, which starts as that part of the vectors
with the smallest ids. A round assigns every part to its nearest entry (the lower
index on a tie) and moves the entries to the floored means of their parts; after the
last round the parts are assigned once more.

Adaptive bounds spare distances: with each part its b closest other entries are
written, with ordered lower bounds of their distances, and one outer bound for all
remaining entries. When entries move, the bounds shrink by the distance moved. Only
entries whose bound does not lie above the distance to the present entry are looked
at, in whole numbers; where the outer bound does not, all entries are. b follows the
depth that the parts of the batch needed. Bounds are rounded down, so they never
decide a result, only which distances are computed.

Rounds are written tables; tasks return sums by entry, so the driver holds codebooks
only (16 x 64 x part width numbers).

Defined results: rows are dropped whose vector is null or holds a null or non-finite
component. Shorter vectors count as padded with zeros to the longest one, and all to
a multiple of 16. Of rows with equal ids the smaller vector comes first, null ids come
last; repeated rows are coded one by one. With under 64 rows there are as many entries
as rows; an empty table gives no rows. Labels may be null: they sum up together.
Components beyond 65,536 in magnitude raise an error. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import slices
from clickloom.sources.staging import discard, stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Close entries written with a part at first, and the share of parts of a batch whose needed depth b covers.
NEAR, COVERED = 6, 0.99
LARGEST = 1 << 24
#: Copies of a label's sum, so that the rows of one label meet it in so many places.
SALTS = 32
_STATE = "id {id}, label {label}, x array<int>, code binary, widths binary, near binary, low binary, outer binary"


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """Rows (id, label, x) of the vectors that are kept."""
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    rows = vectors.select(F.col(id_col).alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform("v", lambda c: F.floor(c * SCALE))
    too_large = F.exists("v", lambda c: F.abs(c) * SCALE > LARGEST)
    said = F.raise_error(F.lit(f"vector components beyond {LARGEST // SCALE}: scale the vectors down"))
    return rows.where(F.col("v").isNotNull() & finite).select(
        "id", "label", F.when(too_large, said.cast("array<int>")).otherwise(scaled.cast("array<int>")).alias("x")
    )


def first_entries(rows: DataFrame, width: int) -> np.ndarray:
    """Codebooks [part, entry, component] from the vectors with the smallest ids."""
    by_id = F.col("id").asc_nulls_last()
    ids = rows.select("id").orderBy(by_id).limit(ENTRIES)
    n, known, cut = ids.agg(F.count(F.lit(1)), F.count("id"), F.max("id")).first()
    # ids first, then the rows up to the last of them: columns and row groups are pruned
    near = rows if known < n or not n else rows.where(F.col("id") <= F.lit(cut))
    first = stage(near.orderBy(by_id, "x").select("id", "x").limit(ENTRIES), "first-entries")
    found = [r["x"] for r in first.orderBy(by_id, "x").collect()]
    discard(first)
    x = np.zeros((len(found), PARTS * width), np.int64)
    for i, v in enumerate(found):
        x[i, : len(v)] = v
    return x.reshape(len(found), PARTS, width).transpose(1, 0, 2).copy()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows [part, component], padded with zeros."""
    n, full = len(column), PARTS * width
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == full).all():
        return flat.reshape(n, PARTS, width)
    x = np.zeros((n, full), np.int64)
    row = np.repeat(np.arange(n), lengths)
    x[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return x.reshape(n, PARTS, width)


def _below(distance: np.ndarray) -> np.ndarray:
    """Half-precision numbers that lie at or below the given ones."""
    capped = np.clip(distance, 0, 60_000)
    half = capped.astype(np.float16)
    return np.where(half > capped, np.nextafter(half, np.float16(0)), half).astype(np.float16)


class Part:
    """The bounds of one part position: assigned entry, near entries, ordered lower bounds, outer bound."""

    def __init__(self, code, near, low, outer):
        self.code, self.near, self.low, self.outer = code, near, low, outer
        self.verified = 0
        self.depth = np.full(len(code), near.shape[1])

    @classmethod
    def measured(cls, x: np.ndarray, book: np.ndarray, b: int) -> Part:
        """From the distances to all entries."""
        squared = ((x[:, None, :] - book) ** 2).sum(axis=2)
        b = min(b, len(book) - 1)
        # stable, so of equal distances the lower index comes first
        order = np.argsort(squared, axis=1, kind="stable")
        sorted_ = np.sqrt(np.take_along_axis(squared, order[:, : b + 2], axis=1))
        outer = sorted_[:, b + 1] if len(book) > b + 1 else np.full(len(x), 60_000.0)
        part = cls(order[:, 0], order[:, 1 : b + 1], sorted_[:, 1 : b + 1], outer)
        part.verified = squared.size
        return part

    def follow(self, x: np.ndarray, book: np.ndarray, moved: np.ndarray) -> None:
        """Assign again after the entries moved by the given distances."""
        slack = 1 - 1e-9
        self.low = (self.low - moved[self.near] - 1e-6) * slack
        order = np.argsort(self.low, axis=1, kind="stable")
        self.low, self.near = np.take_along_axis(self.low, order, axis=1), np.take_along_axis(self.near, order, axis=1)
        self.outer = (self.outer - moved.max() - 1e-6) * slack
        own = ((x - book[self.code]) ** 2).sum(axis=1)
        reach = np.sqrt(own)
        uncertain = self.low <= reach[:, None]
        self.depth = uncertain.sum(axis=1)
        self.verified = len(x)
        # near entries that may be closer: whole numbers decide
        rows, at = np.nonzero(uncertain)
        squared = ((x[rows] - book[self.near[rows, at]]) ** 2).sum(axis=1)
        self.verified += len(rows)
        self.low[rows, at] = np.sqrt(squared)
        best, choice = own.copy(), self.code.copy()
        least = np.full(self.near.shape, np.iinfo(np.int64).max)
        least[rows, at] = squared
        if self.near.shape[1]:
            column = np.lexsort((self.near, least), axis=1)[:, 0]
            every = np.arange(len(x))
            other, index = least[every, column], self.near[every, column]
            closer = (other < best) | ((other == best) & (index < choice))
            # the entry left behind takes the place of the one moved to
            self.near[every[closer], column[closer]] = choice[closer]
            self.low[every[closer], column[closer]] = reach[closer]
            self.code = np.where(closer, index, choice)
            best = np.where(closer, other, best)
        # beyond the list: all entries
        beyond = np.flatnonzero(self.outer <= np.sqrt(best))
        if len(beyond):
            again = Part.measured(x[beyond], book, self.near.shape[1])
            self.code[beyond], self.near[beyond] = again.code, again.near
            self.low[beyond], self.outer[beyond] = again.low, again.outer
            self.depth[beyond] = self.near.shape[1]
            self.verified += again.verified
        order = np.argsort(self.low, axis=1, kind="stable")
        self.low, self.near = np.take_along_axis(self.low, order, axis=1), np.take_along_axis(self.near, order, axis=1)

    def adapt(self) -> None:
        """Keep as many near entries as nearly all parts needed; the next bound becomes the outer one."""
        b = max(int(np.quantile(self.depth, COVERED, method="higher")), 1) if len(self.depth) else 1
        if b < self.near.shape[1]:
            self.outer = np.minimum(self.outer, self.low[:, b])
            self.near, self.low = self.near[:, :b], self.low[:, :b]


def _write(batch: pa.RecordBatch, parts: list[Part], schema_names: list[str]) -> pa.RecordBatch:
    n = batch.num_rows
    code = np.stack([p.code for p in parts], axis=1).astype(np.uint8)
    near = np.concatenate([p.near for p in parts], axis=1).astype(np.uint8)
    low = np.concatenate([_below(p.low) for p in parts], axis=1)
    outer = np.stack([_below(p.outer) for p in parts], axis=1)
    widths = bytes(p.near.shape[1] for p in parts)
    made = [
        pa.array([r.tobytes() for r in code], pa.binary()), pa.array([widths] * n, pa.binary()),
        pa.array([r.tobytes() for r in near], pa.binary()), pa.array([r.tobytes() for r in low], pa.binary()),
        pa.array([r.tobytes() for r in outer], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "label", "x")] + made, names=schema_names)


_NAMES = ["id", "label", "x", "code", "widths", "near", "low", "outer"]


def _rejoin(array: pa.Array, kind, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(array.to_pylist()), kind).reshape(n, -1)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[Part]]]:
    """Row numbers and bounds, for the rows with equal list widths together."""
    by_width: dict[bytes, list[int]] = {}
    for i, w in enumerate(batch.column("widths").to_pylist()):
        by_width.setdefault(w, []).append(i)
    for widths, rows in by_width.items():
        take = pa.array(rows, pa.int64())
        code, near, low, outer = (
            _rejoin(batch.column(c).take(take), k, len(rows)) for c, k in (("code", np.uint8), ("near", np.uint8), ("low", np.float16), ("outer", np.float16))
        )
        ends = np.cumsum(list(widths))
        parts = [
            Part(code[:, p].astype(np.int64), near[:, e - w : e].astype(np.int64), low[:, e - w : e].astype(np.float64), outer[:, p].astype(np.float64))
            for p, (e, w) in enumerate(zip(ends, widths, strict=True))
        ]
        yield np.array(rows), parts


def _assign_first(rows: DataFrame, books: np.ndarray, schema: str) -> DataFrame:
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = _matrix(batch.column("x"), width)
            yield _write(batch, [Part.measured(x[:, p], books[p], NEAR) for p in range(PARTS)], _NAMES)

    return rows.mapInArrow(run, schema)


def _moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return np.sqrt(((old - new) ** 2).sum(axis=2)) * (1 + 1e-9)


def _follow(state: DataFrame, old: np.ndarray, books: np.ndarray, schema: str) -> DataFrame:
    moved, width = _moved(old, books), books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = _matrix(batch.column("x"), width)
            for rows, parts in _parts(batch):
                for p, part in enumerate(parts):
                    part.follow(x[rows, p], books[p], moved[p])
                    part.adapt()
                yield _write(batch.take(pa.array(rows)), parts, _NAMES)

    return state.mapInArrow(run, schema)


def _code(state: DataFrame, old: np.ndarray, books: np.ndarray, id_type: str, label_type: str) -> DataFrame:
    moved, width = _moved(old, books), books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = _matrix(batch.column("x"), width)
            for rows, parts in _parts(batch):
                error = np.zeros(len(rows), np.int64)
                for p, part in enumerate(parts):
                    part.follow(x[rows, p], books[p], moved[p])
                    error += ((x[rows, p] - books[p][part.code]) ** 2).sum(axis=1)
                code = np.stack([p.code for p in parts], axis=1).astype(np.uint8)
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [kept.column("id"), kept.column("label"), pa.array([r.tobytes().hex() for r in code]), pa.array(error)],
                    names=["id", "label", "code", "error"],
                )

    return state.mapInArrow(run, f"id {id_type}, label {label_type}, code string, error long")


def _moved_entries(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one update: floored means of the assigned parts; unused entries stay."""
    shape = books.shape
    k, width = shape[1], shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, k, width + 1), np.int64)
        for batch in slices(batches, 4096):
            x = _matrix(batch.column("x"), width)
            code = _rejoin(batch.column("code"), np.uint8, len(x))
            for p in range(PARTS):
                np.add.at(sums[p, :, :width], code[:, p], x[:, p])
                sums[p, :, width] += np.bincount(code[:, p], minlength=k)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(sums.ravel()[cells])], names=["cell", "total"])

    cells = state.select("x", "code").mapInArrow(run, "cell long, total long")
    # at most 16 x 64 x (part width + 1) rows, whatever the number of vectors
    found = cells.groupBy("cell").agg(F.sum("total").alias("total")).collect()
    sums = np.zeros((PARTS, k, width + 1), np.int64)
    for r in found:
        sums.ravel()[r["cell"]] = r["total"]
    count = sums[:, :, width:]
    return np.where(count > 0, sums[:, :, :width] // np.maximum(count, 1), books)


def fingerprint(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def fit_and_code(rows: DataFrame, longest: int) -> tuple[np.ndarray, DataFrame]:
    """The final codebooks, and a written table (id, label, code, error)."""
    width = -(-longest // PARTS)
    books = first_entries(rows, width)
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    schema = _STATE.format(id=id_type, label=label_type)
    state = stage(_assign_first(rows, books, schema), "codes")
    for r in range(ROUNDS):
        old, books = books, _moved_entries(state, books)
        last = r == ROUNDS - 1
        after = stage(_code(state, old, books, id_type, label_type) if last else _follow(state, old, books, schema), "codes")
        discard(state)
        state = after
    return books, state


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label"
) -> DataFrame:
    """Rows (id, code, error, label_error, codebooks_sha256); ``error`` sums squared distances over the parts."""
    rows = whole_numbers(vectors, id_col, vector_col, label_col)
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        empty = "code string, error long, label_error long, codebooks_sha256 string"
        kind = rows.schema["id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"id {kind}, {empty}").withColumnRenamed("id", id_col)
    books, coded = fit_and_code(rows, longest)
    # one label may hold a third of the rows: its sum stands in several places
    places = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select("label", "label_error", places)
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    on = salted["label"].eqNullSafe(sums["label"]) & (salted["_salt"] == sums["_salt"])
    return salted.join(sums, on).select(
        salted["id"].alias(id_col), "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256")
    )
