"""Near-duplicate vectors with a pivot-permutation index.

Reference points (pivots) are drawn from the vectors and thinned until no two
have a cosine above ``APART``, so that a dense group is named by one pivot, not by
as many as its share of the rows. A vector is described by its ``NEAREST`` nearest
pivots, in order. Vectors with one nearest pivot form a cell, and all pairs of a
cell are compared. A vector is inner when, by the triangle inequality for angles,
nothing it can link with is nearer to another pivot: its cell settles it. For all
others, inverted lists hold, for each label and pivot, the vectors that name it.
Two vectors of different cells are candidates when they share at least ``SHARED``
pivots; the cosine of every candidate pair, in double precision, decides. Such a
pair is counted in the list of its smallest shared pivot only, so the link counts
of all cells and lists add up without a distinct.

A list of more than ``LIST_ROWS`` vectors is divided by a second pivot: as two
shared pivots are asked for anyway, a pair meets under its two smallest shared
pivots and nothing is lost. Where that is still too long, the list is cut into
chunks, and chunks are compared two at a time, as those of a long cell are. A
comparison gives back one count per vector and the links of a spanning forest,
never its pairs. With up to ``NEAREST`` pivots left, all vectors are one cell.

Equal vectors of a label are one row with a count. The pivots are a bounded
sample (``pivots_for``), every vector is indexed; recall is measured in the tests.

Defined results: a vector that is null, zero, or holds a null or non-finite
number, or has no label, links with nothing. Vectors of different lengths never
link. Repeated rows are separate vectors. A null id takes part, and names a
component only when no row of it has an id. Equally near pivots go by their place. An
empty table gives an empty one. Columns but id, vector and label are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import extended
from clickloom.operators.components import connected
from clickloom.sources.staging import stage

NEAREST, SHARED = 12, 2
#: Stands for the second pivot where a cell is compared.
CELL = -2
LEAST_PIVOTS, MOST_PIVOTS = 64, 4096
LIST_ROWS = 512
#: Chunks of a long list or cell, in units of LIST_ROWS.
CHUNK_LISTS = 4
#: No two pivots have a cosine above this; so many vectors are drawn for each pivot that is wanted.
APART, DRAWN = 0.8, 4


def pivots_for(vectors: int) -> int:
    """The number of pivots: grows with the root of the vectors, at most ``MOST_PIVOTS``."""
    return max(LEAST_PIVOTS, min(MOST_PIVOTS, 4 * math.isqrt(vectors)))


def unit(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def apart(x: np.ndarray, wanted: int) -> np.ndarray:
    """The first ``wanted`` of the unit rows of which no two are closer than ``APART``."""
    kept: list[int] = []
    free = np.ones(len(x), bool)
    for i in range(len(x)):
        if free[i]:
            kept.append(i)
            if len(kept) == wanted:
                break
            free &= x @ x[i] <= APART
    return x[kept]


def _usable(fields: list[str]):
    """Adds each vector's bytes in double precision, null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, v in zip(batch.column("label").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
                x = np.array(v, "<f8") if v and label is not None and None not in v else None
                out.append(x.tobytes() if x is not None and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in fields], pa.array(out, pa.binary())], names=[*fields, "vector"])

    return run


def _describe(sent, least: float):
    reach = 2 * float(np.arccos(np.clip(least, -1, 1))) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, np.ndarray] = sent.value
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            near: list = [[0]] * len(vectors)
            inner = np.ones(len(vectors), bool)
            for size in {len(v) for v in vectors} & by_size.keys():
                at = [i for i, v in enumerate(vectors) if len(v) == size]
                for a in range(0, len(at), 2048):
                    some = at[a : a + 2048]
                    cosine = unit([vectors[i] for i in some]) @ by_size[size].T
                    order = np.argsort(-cosine, axis=1, kind="stable")[:, :NEAREST].astype(np.int32)
                    angle = np.arccos(np.clip(np.take_along_axis(cosine, order[:, :2], 1), -1, 1))
                    inner[some] = angle[:, 0] + reach < angle[:, 1]
                    for i, row in zip(some, order, strict=True):
                        near[i] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.list_(pa.int32())), pa.array(inner)], names=[*batch.schema.names, "near", "inner"]
            )

    return run


def _compare(least: float):
    def run(table: pa.Table) -> pa.Table:
        """Link counts (a, n) and forest links (a, b) of one cell or list, or of two chunks of it."""
        p, q, one, two = (table.column(c)[0].as_py() for c in ("p", "q", "one", "two"))
        order = np.argsort(table.column("cid").to_numpy(), kind="stable")
        cid, weight = table.column("cid").to_numpy()[order], table.column("n").to_numpy()[order]
        chunk = table.column("chunk").to_numpy()[order]
        x = unit([table.column("vector")[i].as_py() for i in order.tolist()])
        if q != CELL:
            near = np.stack([np.array(table.column("near")[i].as_py()) for i in order.tolist()])
            first = near[:, 0]
            names, place = np.unique(near, return_inverse=True)
            named = np.zeros((len(cid), len(names)), np.float32)
            named[np.arange(len(cid))[:, None], place.reshape(near.shape)] = 1
            # names are in order: the smallest shared pivots are found by looking at what lies below p, and between p and q
            below = named[:, (names < p) | ((names > p) & (names < q))]
        counts, root, forest = np.zeros(len(cid), np.int64), np.arange(len(cid)), []
        for at in range(0, len(cid), LIST_ROWS):
            rows = slice(at, at + LIST_ROWS)
            linked = x[rows] @ x[at:].T >= least
            linked &= np.arange(len(linked))[:, None] < np.arange(len(cid) - at)[None, :]
            if one != two:
                linked &= chunk[rows, None] != chunk[None, at:]
            if q != CELL:
                linked &= first[rows, None] != first[None, at:]
                linked &= (named[rows] @ named[at:].T >= SHARED) & (below[rows] @ below[at:].T == 0)
            counts[rows] += linked @ weight[at:]
            counts[at:] += weight[rows] @ linked
            # links that connect as much, fewer than there are rows
            for i in np.flatnonzero(linked.any(axis=1)):
                to = at + np.flatnonzero(linked[i])
                to = to[root[to] != root[at + i]]
                if len(to):
                    roots, some = np.unique(root[to], return_index=True)
                    forest += [(at + i, j) for j in to[some]]
                    root[np.isin(root, roots)] = root[at + i]
        some = np.flatnonzero(counts)
        return pa.table(
            {
                "a": pa.array(np.concatenate([cid[some], cid[[f[0] for f in forest]]]).astype(np.int64)),
                "b": pa.array([None] * len(some) + cid[[f[1] for f in forest]].tolist(), pa.int64()),
                "n": pa.array(counts[some].tolist() + [None] * len(forest), pa.int64()),
            }
        )

    return run


def _chunked(long: DataFrame) -> DataFrame:
    """The rows of long lists (with their ``size``), a copy for each two chunks that are compared."""
    chunks = F.ceil(F.col("size") / (CHUNK_LISTS * LIST_ROWS)).cast("int")
    cut = long.withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return met.withColumns({"one": F.least("chunk", "other"), "two": F.greatest("chunk", "other")})


def _lists(postings: DataFrame, keys: list[str], limit: int) -> tuple[DataFrame, DataFrame]:
    """Postings of lists up to the limit, and of longer ones (with their ``size``); lists of one row are left out."""
    sizes = postings.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sized = postings.join(sizes, keys)
    return sized.where(F.col("size") <= limit).drop("size"), sized.where(F.col("size") > limit)


def near_duplicates(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id") -> DataFrame:
    """Rows (id, n_links, component_id, kept), one per vector of (id, embedding, label)."""
    rows = vectors.select(F.col(id_col).alias("id"), "label", "embedding")
    plain = rows.select("id", "label")
    marked = rows.mapInArrow(_usable(["id", "label"]), extended(plain.schema, ("vector", "binary")))
    rows = stage(marked, "vectors")
    classes = rows.where("vector IS NOT NULL").groupBy("label", "vector").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    # the pivots: a bounded sample of all lengths in the order of a hash, thinned for each length apart;
    # a length that is left with few or none is one cell
    wanted = pivots_for(classes.count())
    sample = classes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(DRAWN * wanted).collect()
    by_size: dict[int, list[bytes]] = {}
    for r in sample:
        by_size.setdefault(len(r["vector"]), []).append(bytes(r["vector"]))
    pivots = {size: apart(unit(found), wanted) for size, found in by_size.items()}
    pivots = {size: found for size, found in pivots.items() if len(found) > NEAREST}
    sent = vectors.sparkSession.sparkContext.broadcast(pivots)  # at most MOST_PIVOTS vectors of a length

    kind = rows.schema["label"].dataType.simpleString()
    described = classes.select("label", "cid", "n", "vector").mapInArrow(
        _describe(sent, least), f"label {kind}, cid long, n long, vector binary, near array<int>, inner boolean"
    )
    described = stage(described.withColumn("dim", F.length("vector")), "described")
    whole = {c: F.lit(0) for c in ("one", "two", "chunk")}
    columns = ["label", "dim", "p", "q", "one", "two", "chunk", "cid", "n", "vector", "near"]
    cells = described.withColumns({"p": F.get("near", F.lit(0)), "q": F.lit(CELL)})
    short, long = _lists(cells, ["label", "dim", "p", "q"], LIST_ROWS)
    work = short.withColumns(whole).select(*columns).unionByName(_chunked(long).select(*columns))
    single = described.where("NOT inner").withColumn("p", F.explode("near"))
    short, long = _lists(single, ["label", "dim", "p"], LIST_ROWS)
    work = work.unionByName(short.withColumn("q", F.lit(-1)).withColumns(whole).select(*columns))
    double = long.drop("size").withColumn("q", F.explode(F.filter("near", lambda x: x > F.col("p"))))
    short, long = _lists(double, ["label", "dim", "p", "q"], LIST_ROWS)
    work = work.unionByName(short.withColumns(whole).select(*columns)).unionByName(_chunked(long).select(*columns))
    compared = work.groupBy("label", "dim", "p", "q", "one", "two").applyInArrow(_compare(least), "a long, b long, n long")
    found = stage(compared, "compared")

    counts = found.where("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("more"))
    roots = connected(classes.select(F.col("cid").alias("id")), found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("id", "cid")
    named = classes.join(roots, "cid").join(counts, "cid", "left")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "root").select(
        "label", "vector", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id"
    )
    return rows.join(named, ["label", "vector"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"), F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
    )
