"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text becomes a unit vector of hashed character n-grams (1 to 3 code points of
the lower-cased text), weighted by (1 + log tf) * idf. Every language has
several centroids, found by spherical k-means among its texts. A text takes the
language of the centroid with the highest cosine, and is rejected when that
cosine lies far below what the centroid's own texts reach.

Defined results: a text that is null or holds no letter gets ``und``, score 0
and is rejected. Equal cosines go to the first language in alphabetical order.
Without any labelled text every document gets ``und``. Repeated rows are
answered row by row; whole texts are read, however long. An empty table gives an empty
one. Further columns are carried over; those named like the results are replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import extended, slices

#: Hashed n-gram buckets: the length of a vector.
DIMENSIONS = 4096
#: Centroids of a language.
CLUSTERS = 4
ROUNDS = 6
#: Bound of the fit: texts of one language that k-means sees.
SAMPLE_PER_LANGUAGE = 1500
#: A centroid rejects texts below this share of its low quantile of cosines.
SLACK = 0.5
#: Letters from which on the whole floor is asked for; the cosines of shorter texts are lower by nature.
FULL_SIZE = 120
LOW_QUANTILE = 0.005
#: Code points of a text counted at a time.
CHUNK = 1 << 20
UNKNOWN = "und"


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def count_ngrams(text: str) -> tuple[np.ndarray, int]:
    """How often each n-gram bucket occurs in the whole text, and its number of letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[points]
    # a run of anything but letters is one blank: digits, signs and lay-out say nothing of a language
    points = np.where(letters, points, np.uint32(32))[letters | np.r_[True, letters[:-1]]]
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(points), CHUNK):
        c = points[at : at + CHUNK + 2]
        one, end = c * np.uint32(0x9E3779B1), min(CHUNK, len(c))
        two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0x2C1B3C6D)
        three = (two[:-1] ^ (c[2:] * np.uint32(0xC2B2AE3D))) * np.uint32(0x297A2D39)
        for grams in (one, two, three):
            counts += np.bincount(grams[:end] >> np.uint32(20), minlength=DIMENSIONS)
    return counts, int(letters.sum())


def vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows, zero for a text without letters, and the numbers of letters."""
    out, sizes = np.zeros((len(texts), DIMENSIONS), np.float32), np.zeros(len(texts), np.int64)
    for i, (row, text) in enumerate(zip(out, texts, strict=True)):
        counts, sizes[i] = count_ngrams(text or "")
        if sizes[i]:
            at = np.flatnonzero(counts)
            row[at] = (1 + np.log(counts[at])) * idf[at]
            row /= max(float(np.linalg.norm(row)), 1e-30)
    return out, sizes


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, texts = np.zeros(DIMENSIONS, np.int64), 0
    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            seen += count_ngrams(text)[0] > 0
            texts += 1
    yield pa.RecordBatch.from_pydict(
        {"bucket": np.arange(-1, DIMENSIONS, dtype=np.int32), "df": np.concatenate([[texts], seen])}
    )


def _cluster(idf: np.ndarray):
    def fit(table: pa.Table) -> pa.Table:
        """Centroids of one language; its texts are at most the sample."""
        table = table.sort_by("order")
        x, _ = vectors(table.column("text").to_pylist(), idf)
        x = x[np.linalg.norm(x, axis=1) > 0]
        k = min(CLUSTERS, len(x))
        centers = x[:k]  # in the order of a hash: texts drawn at random
        for _ in range(ROUNDS):
            near = (x @ centers.T).argmax(axis=1) if k else np.zeros(0, int)
            sums = np.stack([x[near == j].sum(axis=0) if (near == j).any() else centers[j] for j in range(k)]) if k else centers
            centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-30)
        cos = x @ centers.T
        near = cos.argmax(axis=1) if k else np.zeros(0, int)
        floors = [float(np.quantile(cos[near == j, j], LOW_QUANTILE)) if (near == j).any() else 1.0 for j in range(k)]
        return pa.table(
            {
                "lang": pa.array([table.column("lang")[0].as_py()] * k, pa.string()),
                "center": pa.array([c.astype(np.float32).tobytes() for c in centers], pa.binary()),
                "floor": pa.array([SLACK * f for f in floors], pa.float64()),
            }
        )

    return fit


def fit(labelled: DataFrame) -> dict:
    """Model from rows (text, lang); rows with a null are left out.

    Document frequencies cover all rows. The centroids come from at most about
    ``SAMPLE_PER_LANGUAGE`` different texts of each language, chosen by a hash of the text.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    df = rows.select("text").mapInArrow(_document_frequency, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df"))
    counts = {r["bucket"]: r["df"] for r in df.collect()}  # DIMENSIONS + 1 rows
    texts = counts.get(-1, 0)
    idf = np.log((1 + texts) / (1 + np.array([counts.get(i, 0) for i in range(DIMENSIONS)], float))) + 1
    per_language = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("text", F.lit("language"))
    share = F.create_map(*[F.lit(x) for lang, n in per_language.items() for x in (lang, SAMPLE_PER_LANGUAGE / n)]) if per_language else None
    model = {"idf": idf, "langs": [], "centers": np.zeros((0, DIMENSIONS), np.float32), "floors": np.zeros(0)}
    if per_language:
        # a share of the hash range: about the bound in expectation, and no sort
        part = F.pmod(order, F.lit(1 << 20)) / F.lit(1 << 20)
        # copies of a text are one: a text of a third of the rows is still one row of the sample
        sample = rows.withColumn("order", order).where(part < share[F.col("lang")]).distinct()
        found = sample.groupBy("lang").applyInArrow(_cluster(idf), "lang string, center binary, floor double").toPandas()
        found = found.sort_values(["lang", "center"])
        model["langs"] = found["lang"].tolist()
        model["centers"] = np.array([np.frombuffer(c, np.float32) for c in found["center"]], np.float32).reshape(-1, DIMENSIONS)
        model["floors"] = found["floor"].to_numpy(float)
    return model


def identify(docs: DataFrame, model: dict, out: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` with language, cosine and verdict of every row's ``text``; columns of these names are replaced."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # languages x CLUSTERS x DIMENSIONS
    kept = docs.select(*[f"`{c}`" for c in docs.columns if c not in out])
    fields = [f.name for f in kept.schema.fields]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in slices(batches, 128):
            texts = batch.column("text").to_pylist()
            x, sizes = vectors(texts, m["idf"])
            letters = (sizes > 0) & bool(len(m["langs"]))
            best, score, rejected = np.zeros(len(texts), int), np.zeros(len(texts)), np.ones(len(texts), bool)
            if letters.any():
                at = np.flatnonzero(letters)
                cos = x[at] @ m["centers"].T
                best[at] = cos.argmax(axis=1)
                score[at] = np.clip(cos.max(axis=1), 0, 1)
                rejected[at] = score[at] < m["floors"][best[at]] * np.minimum(1, np.sqrt(sizes[at] / FULL_SIZE))
            langs = [m["langs"][b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in fields], pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)], names=[*fields, *out]
            )

    schema = extended(kept.schema, (out[0], "string"), (out[1], "double"), (out[2], "boolean"))
    return kept.mapInArrow(predict, schema)
