"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has a bit set when over half of the text's shingle hashes have it.
Two fingerprints at most ``tau`` bits apart must, for thresholds t_i of the m
partitions of their bits with sum(t_i) = tau - m + 1, lie within t_i bits of each
other in some partition i (t_i = -1: the partition need not be looked at).

Correlated bits share a partition, so that the values of different partitions
say different things. Every fingerprint gets thresholds of its own: a dynamic
program over the partitions takes those with the least estimated work, which is
the number of probes plus the number of fingerprints that these will meet. It
probes all values within its thresholds in the index of partition values, and
what it meets is verified by the whole distance, inside the join.

Equal fingerprints are one row throughout. Before the search, fingerprints that
differ only within one block of ``tau`` neighbouring bits are linked to the
smallest of their kind: a dense cloud of near copies is thereby joined by as many
links as it has members. The search then gives only links between fingerprints
that these links do not connect yet, so it does not list all pairs of a cloud.

Defined results: a null, empty or blank text has fingerprint zero, which is
linked like any other. Fewer words than a shingle count as one shingle. Repeated
rows have equal fingerprints and are linked. A null id takes part, and is the
component's id only when no row of the component has an id. Of a group the row with the
smallest id, then text hash, is the one kept. Texts of any length are whole. An empty
table gives an empty one. ``keep_one`` carries further columns over, of whatever name;
``near_duplicates`` leaves them out.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import extended, mix, slices, spare
from clickloom.operators.components import connected
from clickloom.sources.staging import stage

BITS, SEED = 64, 42
#: Shingles hashed at a time.
CHUNK = 1 << 16
#: Cells of a partition's table of estimated counts: fixed, so its size is bounded.
CELLS = 1 << 14


def fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    size = min(shingle, len(words))
    first, last = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(first), CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at : at + CHUNK], last[at : at + CHUNK])], "<u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with its rows' fingerprints as a signed 64-bit column."""
    fields = [c for c in docs.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            found = np.array([fingerprint(t, shingle) for t in batch.column(text_col).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in fields], pa.array(found)], names=[*fields, name])

    kept = docs.select(*[f"`{c}`" for c in fields])
    return kept.mapInArrow(run, extended(kept.schema, (name, "long")))


# -- the index


def _bit_matrix(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often any two bits are set together, in this task's rows."""
    both = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        x = _bit_matrix(batch.column("fp").to_numpy()).astype(np.float64)
        both += (x.T @ x).astype(np.int64)
    i, j = np.meshgrid(np.arange(BITS), np.arange(BITS), indexing="ij")
    yield pa.RecordBatch.from_pydict({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "n": both.ravel()})


def partition_bits(together: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, each filled with what correlates most."""
    p = np.diag(together) / max(rows, 1)
    deviation = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((together / max(rows, 1) - np.outer(p, p)) / np.outer(deviation, deviation))
    np.fill_diagonal(corr, 0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        while len(group) < size:
            group.append(max((b for b in free if b not in group), key=lambda b: (corr[b, group].sum(), -b)))
        free = [b for b in free if b not in group]
        out.append(sorted(group))
    return out


def part_values(fps: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """One row per partition: the partition's bits of every fingerprint, side by side."""
    x = fps.view(np.uint64)
    out = np.zeros((len(groups), len(x)), np.uint64)
    for row, group in zip(out, groups, strict=True):
        for place, bit in enumerate(group):
            row |= ((x >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


def _cell(values: np.ndarray) -> np.ndarray:
    return (mix(values) & np.uint64(CELLS - 1)).astype(np.int64)


def allocate(values: np.ndarray, widths: list[int], cells: np.ndarray, tau: int) -> np.ndarray:
    """Thresholds of every fingerprint, one row per partition, by dynamic programming."""
    parts, rows = values.shape
    cost = np.zeros((parts, tau + 2, rows))  # second axis: threshold + 1
    for i, width in enumerate(widths):
        met = cells[i, _cell(values[i])].astype(float)
        near = met + sum(cells[i, _cell(values[i] ^ np.uint64(1 << b))] for b in range(width))
        for t in range(tau + 1):
            probes = sum(math.comb(width, d) for d in range(t + 1))
            estimate = met if t == 0 else near * (probes / (width + 1))
            cost[i, t + 1] = probes + estimate
    # best[s]: least cost of the partitions so far with thresholds that add up to s - parts
    total = tau - parts + 1
    best, choice = [np.zeros(rows)], []
    least = 0
    for i in range(parts):
        sums = range(least - 1, total + (parts - 1 - i) + 1)
        offers = {}
        for s in sums:
            options = [(t, best[s - t - least]) for t in range(-1, tau + 1) if 0 <= s - t - least < len(best)]
            costs = np.array([cost[i, t + 1] + b for t, b in options]) if options else np.full((1, rows), np.inf)
            pick = costs.argmin(axis=0)
            offers[s] = (costs.min(axis=0), np.array([t for t, _ in options] or [-1])[pick])
        least -= 1
        best = [offers[s][0] for s in sums]
        choice.append({s: offers[s][1] for s in sums})
    out = np.zeros((parts, rows), np.int64)
    left = np.full(rows, total)
    for i in reversed(range(parts)):
        for s in choice[i]:
            at = left == s
            out[i, at] = choice[i][s][at]
        left = left - out[i]
    return out


def _masks(width: int, distance: int) -> np.ndarray:
    """All values of ``width`` bits with at most ``distance`` of them set."""
    return np.array([sum(1 << b for b in c) for d in range(distance + 1) for c in itertools.combinations(range(width), d)], np.uint64)


def _postings(groups: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 14):
            fps = batch.column("fp").to_numpy()
            for part, row in enumerate(part_values(fps, groups)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fps), part, np.int32)), pa.array(row.view(np.int64)), batch.column("fp"), batch.column("root")],
                    names=["part", "value", "fp", "root"],
                )

    return run


def _probes(groups: list[list[int]], cells: np.ndarray, tau: int):
    widths = [len(g) for g in groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks: dict[tuple[int, int], np.ndarray] = {}
        for batch in slices(batches, 1 << 12):
            fps, roots = batch.column("fp").to_numpy(), batch.column("root").to_numpy()
            values = part_values(fps, groups)
            thresholds = allocate(values, widths, cells, tau)
            for part, t in itertools.product(range(len(groups)), range(tau + 1)):
                at = np.flatnonzero(thresholds[part] == t)
                if len(at):
                    key = (widths[part], t)
                    flips = masks[key] = masks[key] if key in masks else _masks(*key)
                    probes = (values[part][at][:, None] ^ flips[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(probes), part, np.int32)), pa.array(probes.view(np.int64)),
                            pa.array(np.repeat(fps[at], len(flips))), pa.array(np.repeat(roots[at], len(flips))),
                        ],
                        names=["part", "value", "fp", "root"],
                    )

    return run


def _count_cells(groups: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(groups), CELLS), np.int64)
        for batch in batches:
            for part, row in enumerate(part_values(batch.column("fp").to_numpy(), groups)):
                held[part] += np.bincount(_cell(row), minlength=CELLS)
        part, cell = np.nonzero(held)
        yield pa.RecordBatch.from_pydict({"part": part.astype(np.int32), "cell": cell.astype(np.int32), "n": held[part, cell]})

    return run


POSTING = "part int, value long, fp long, root long"


def parts_for(rows: int, tau: int) -> int:
    """tau partitions, fewer and wider ones when there are so many fingerprints that values would be crowded.

    Not tau + 1: their thresholds would all be 0, and the sum leaves nothing to allocate.
    """
    return max(2, min(tau, int(1.25 * BITS / max(1.0, math.log2(max(rows, 2))))))


def block_links(fps: DataFrame, tau: int) -> DataFrame:
    """(a, b): a fingerprint and the smallest that differs from it only within one block of tau bits."""
    blocks = [sum(1 << b for b in range(at, min(at + tau, BITS))) for at in range(0, BITS, tau)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in blocks]
    rest = F.array(*[F.col("fp").bitwiseAND(F.lit(~m)) for m in signed])
    rows = fps.select("fp", F.posexplode(rest).alias("block", "rest"))
    lowest = rows.groupBy("block", "rest").agg(F.min("fp").alias("b"), F.max("fp").alias("_high")).where("b < _high").drop("_high")
    return rows.join(lowest, ["block", "rest"]).where("fp <> b").select(F.col("fp").alias("a"), "b")


def links(fps: DataFrame, rows: int, tau: int) -> DataFrame:
    """(a, b) for fingerprints of (fp, root) with different roots, at most tau bits apart."""
    parts = parts_for(rows, tau)
    together = np.zeros((BITS, BITS), np.int64)
    for r in fps.select("fp").mapInArrow(_together, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        together[r["i"], r["j"]] = r["n"]  # BITS x BITS numbers
    groups = partition_bits(together, rows, parts)
    cells = np.zeros((parts, CELLS), np.int64)
    found = fps.select("fp").mapInArrow(_count_cells(groups), "part int, cell int, n long").groupBy("part", "cell").agg(F.sum("n").alias("n"))
    table = found.toPandas()  # parts x CELLS numbers
    cells[table["part"].to_numpy(int), table["cell"].to_numpy(int)] = table["n"].to_numpy(int)
    x = fps.select("fp", "root").mapInArrow(_probes(groups, cells, tau), POSTING).alias("x")
    y = fps.select("fp", "root").mapInArrow(_postings(groups), POSTING).alias("y")
    near = (
        (F.col("x.part") == F.col("y.part")) & (F.col("x.value") == F.col("y.value")) & (F.col("x.fp") < F.col("y.fp"))
        & (F.col("x.root") != F.col("y.root")) & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= tau)
    )
    return x.join(y, near).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))


def components(fps: DataFrame, tau: int = 3) -> DataFrame:
    """(fp, root) for distinct fingerprints (fp): equal roots for what links connect."""
    fps = stage(fps.select("fp"), "fingerprints")
    rows = fps.count()
    nodes = fps.select(F.col("fp").alias("id"))
    near = connected(nodes, block_links(fps, tau)).select(F.col("id").alias("fp"), "root")
    far = stage(links(near, rows, tau), "links")
    if far.isEmpty():
        return near
    root = lambda end, name: near.select(F.col("fp").alias(end), F.col("root").alias(name))
    lifted = far.join(root("a", "_a"), "a").join(root("b", "_b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    merged = connected(near.select(F.col("root").alias("id")).distinct(), lifted)
    return near.join(merged.select(F.col("id").alias("root"), F.col("root").alias("_root")), "root").select("fp", F.col("_root").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, tau: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, h, fp, component_id, root), one per document.

    component_id is the smallest linked id; root, a fingerprint, names the same
    group also where ids repeat. h is xxhash64 of the text.
    """
    rows = docs.select(id_col, text_col, F.xxhash64(text_col).alias("h"))
    staged = stage(fingerprints(rows, shingle, text_col).select(id_col, "h", "fp"), "documents")
    lowest = staged.groupBy("fp").agg(F.min(id_col).alias("_id"))
    found = stage(components(lowest.select("fp"), tau).join(lowest, "fp"), "components")
    ids = found.groupBy("root").agg(F.min("_id").alias("component_id"))
    named = found.join(ids, "root").select("fp", "component_id", "root")
    return staged.join(named, "fp").select(id_col, "h", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = 3, tau: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group: the one with the smallest id, then text hash; of repeated rows any one."""
    found = near_duplicates(docs, shingle, tau, id_col, text_col)
    copies = found.groupBy("root", F.struct(F.col(id_col).alias("id"), "h").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    # null ids last
    last = F.struct(F.col("key.id").isNull(), F.col("key.id"), F.col("key.h"))
    chosen = stage(copies.groupBy("root").agg(F.min_by(F.struct("key.*", "n"), last).alias("k")).select("k.*"), "chosen")
    h, kept_id, kept_h, n = spare(docs.columns, "h", "kept_id", "kept_h", "n")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumn(h, F.xxhash64(F.col(f"`{text_col}`")))
    chosen = chosen.select(F.col("id").alias(kept_id), F.col("h").alias(kept_h), F.col("n").alias(n))
    chosen_rows = rows.join(chosen, rows[id_col].eqNullSafe(chosen[kept_id]) & (rows[h] == chosen[kept_h]))
    once = chosen_rows.where(F.col(n) == 1).select(*columns)
    again = chosen_rows.where(F.col(n) > 1).dropDuplicates([id_col, h]).select(*columns)
    return once.unionByName(again)
