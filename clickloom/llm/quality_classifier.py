"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every whole text is reduced to a row of statistics. Trees are grown on a bounded
sample of labelled rows: values are put into quantile bins, gradients are summed
by (node, feature, bin), and the best split of every node of a level is taken.
A tree of depth d is flattened into arrays of 2^d - 1 split features and values
and 2^d leaves, so a block of rows is scored level by level with array look-ups.

Defined results: a null text counts as empty and has all statistics 0; it is
scored like any other row. Repeated rows are scored row by row. Without any
label, or with one class only, the score is the share of class 1 (0.5 if none). Texts
of any length are whole. Of equally good splits the first statistic and cut is taken. An
empty table gives an empty one. Only the columns asked for are carried over.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import extended, sample_below, slices

#: Bound of the fit: labelled rows that the trees see.
SAMPLE_ROWS = 60_000
TREES, DEPTH, BINS, RATE = 80, 4, 64, 0.15
#: Smoothing of a leaf, and the least hessian on either side of a split.
SMOOTHING, LEAST = 1.0, 3.0

STATISTICS = [
    "chars", "words", "mean_word", "distinct_words", "top_word", "adjacent_repeats", "lines", "repeated_lines", "line_words",
    "upper", "digits", "blanks", "symbols", "punctuation", "pipes", "bangs", "non_ascii", "capital_words", "short_words", "ends",
]
_CLASSES = np.zeros((8, 256), bool)
for _k, _set in enumerate(
    [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\x0b\x0c\r", b"#*$%&<>@^~_=+\\/{}[]", b".,;:?'\"()-", b"|", b"!"]
):
    _CLASSES[_k, list(_set)] = True
_CLASSES[7, 128:] = True


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, shares but for the first three."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return [0.0] * len(STATISTICS)
    bytes_ = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    by_class = (_CLASSES @ bytes_) / len(data)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, counts = max(len(words), 1), Counter(words)
    return [
        np.log1p(len(text)), np.log1p(len(words)), len(data) / n, len(counts) / n, max(counts.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n, len(lines) / n, 1 - len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1),
        *by_class, sum(map(str.isupper, words)) / n, sum(c for w, c in counts.items() if len(w) < 3) / n,
        sum(c for w, c in counts.items() if not w[-1].isalnum()) / n,
    ]


def _measure(fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pa.array([statistics(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in fields], found], names=[*fields, "statistics"])

    return run


def measure(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` and the statistics of every row's text."""
    rows = docs.select(*[docs[c] for c in keep], docs[text_col].alias("text"))
    schema = extended(docs.select(*[docs[c] for c in keep]).schema, ("statistics", "array<double>"))
    return rows.mapInArrow(_measure(keep), schema)


def grow(x: np.ndarray, y: np.ndarray) -> dict:
    """Boosted trees for the log-odds of ``y``."""
    rows, features = x.shape
    share = (y.sum() + 0.5) / (rows + 1) if rows else 0.5
    model = {"base": float(np.log(share / (1 - share))), "feature": [], "above": [], "leaf": []}
    if not rows or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    slot = binned + np.arange(features) * BINS
    score = np.full(rows, model["base"])
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(rows, np.int64)
        feature, above = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
        for level in range(DEPTH):
            width = 2**level
            key = (slot + (node * features * BINS)[:, None]).ravel()
            g = np.bincount(key, np.repeat(grad, features), width * features * BINS).reshape(width, features, BINS).cumsum(axis=2)
            h = np.bincount(key, np.repeat(hess, features), width * features * BINS).reshape(width, features, BINS).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + SMOOTHING) + (all_g - g) ** 2 / (all_h - h + SMOOTHING) - all_g**2 / (all_h + SMOOTHING)
            gain[(h < LEAST) | (all_h - h < LEAST)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for j, b in enumerate(best):
                f, cut = divmod(int(b), BINS)
                if gain[j, f, cut] > 1e-9:
                    feature[width - 1 + j], above[width - 1 + j] = f, edges[f][cut]
            at = width - 1 + node
            node = 2 * node + (x[np.arange(rows), feature[at]] > above[at])
        leaf = -RATE * np.bincount(node, grad, 2**DEPTH) / (np.bincount(node, hess, 2**DEPTH) + SMOOTHING)
        score += leaf[node]
        for name, value in (("feature", feature), ("above", above), ("leaf", leaf)):
            model[name].append(value)
    return {k: v if k == "base" else np.array(v) for k, v in model.items()}


def probabilities(x: np.ndarray, model: dict) -> np.ndarray:
    """Walk all rows down all flattened trees, one level at a time."""
    score = np.full(len(x), model["base"])
    every = np.arange(len(x))
    for feature, above, leaf in zip(model["feature"], model["above"], model["leaf"], strict=True):
        node = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            at = 2**level - 1 + node
            node = 2 * node + (x[every, feature[at]] > above[at])
        score += leaf[node]
    return 1 / (1 + np.exp(-score))


def fit(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> dict:
    """Trees from at most ``SAMPLE_ROWS`` of the rows (id, statistics) that have a label.

    Labels of one id count once, as their rounded mean; a null label is none.
    """
    known = labels.where(F.col(label_col).isNotNull()).groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    chosen = sample_below(measured.select(id_col, "statistics").join(known, id_col), id_col, SAMPLE_ROWS)
    rows = chosen.select("statistics", "label").toPandas()
    x = np.array(rows["statistics"].tolist(), float).reshape(-1, len(STATISTICS))
    return grow(x, rows["label"].to_numpy(float))


def score(measured: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the probability of label 1."""
    sent = measured.sparkSession.sparkContext.broadcast(model)  # TREES small arrays

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("statistics").to_pylist(), float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(probabilities(x, sent.value))], names=[*keep, "score"]
            )

    return measured.mapInArrow(run, extended(measured.select(*keep).schema, ("score", "double")))
