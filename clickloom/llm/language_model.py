"""Language model scoring from a log-frequency Bloom filter.

Counts of all word unigrams and bigrams of the training texts are quantised to
levels on a logarithmic scale. An n-gram of level l is written into a Bloom
filter l times, as (n-gram, 1) to (n-gram, l). A reader probes level after level
until one is missing: the level before it is the n-gram's quantised count. The
filter never gives too low a level, and too high a one only with the filter's
small error rate. Probabilities are Dirichlet-smoothed:

    p(w | v) = (c(v w) + m * p(w)) / (c(v) + m),   p(w) = (c(w) + a) / (N + a (V + 1))

The filter is cut into blocks by the n-gram's hash. A block is written by one
task, and all probes of an n-gram fall into its block. The number of blocks
follows the number of tokens, so a task's share stays the same at every size, and
a block has ``BITS_PER_ENTRY`` bits or up to twice as many for each entry: the
filter grows with the n-grams, and every count is written from 1 on. With three
hashes an absent (n-gram, level) is found by error in 0.3 to 1.7 % of all probes.

The filter is a written table and never gathered. Texts to be scored are put in
batches; a batch sends its distinct n-grams to their blocks, gets a level back for
each, and is then scored with them.

The add-``a`` unigram base score next to it is exact: counts of the ``FREQUENT``
most frequent tokens are broadcast, and the rare tokens of each text, of which
none is more than 1/``FREQUENT`` of the corpus, are joined with their counts.

Defined results: a null text is an empty one and consists of its end alone.
Repeated rows are scored row by row and counted each. Without any training text
every known count is 0 and all tokens are equally likely. Texts of any length are whole;
no result depends on an order. An empty table gives an empty one. Columns but id,
held_out and text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import extended, mix, slices
from clickloom.sources.staging import discard, stage

#: At least so many bits of a block for each of its entries.
BITS_PER_ENTRY, HASHES = 10, 3
#: Training tokens for each block of the filter.
TOKENS_PER_BLOCK = 1 << 19
#: Bound of the broadcast table of exact counts.
FREQUENT = 1 << 16
#: Tokens that a task counts before it passes the counts on, and those of a batch that is scored.
FLUSH, BATCH = 1 << 21, 1 << 20
ADD, DIRICHLET = 0.1, 200.0
#: Counts up to 4 have levels of their own; above, a level is a factor of 1.25.
EXACT_LEVELS, STEP, MOST_LEVEL = 4, 1.25, 160
#: The hash of a text's end, which is also the word before its first one.
END = np.uint64(0x5BD1E9955BD1E995)


def tokens(text: str | None) -> np.ndarray:
    """Hashes of a text's words, A-Z lower-cased, and of its end."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8")
    out[-1] = END
    return out


def bigrams(t: np.ndarray, starts: np.ndarray | int = 0) -> np.ndarray:
    """A hash for each token with the one before it; texts begin at ``starts``."""
    before = np.empty_like(t)
    before[1:] = t[:-1]
    before[starts] = END
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + t)


def unigrams(t: np.ndarray) -> np.ndarray:
    return mix(t ^ np.uint64(0xA0761D6478BD642F))


def level_of(count: np.ndarray) -> np.ndarray:
    count = np.maximum(count, 1).astype(float)
    high = EXACT_LEVELS + np.floor(np.log(np.maximum(count / EXACT_LEVELS, 1)) / np.log(STEP) + 1e-9)
    return np.minimum(np.where(count <= EXACT_LEVELS, count, high), MOST_LEVEL).astype(np.int64)


def value_of(level: np.ndarray) -> np.ndarray:
    """The geometric middle of a level's counts, 0 for level 0."""
    high = EXACT_LEVELS * STEP ** (np.maximum(level - EXACT_LEVELS, 0) + 0.5)
    return np.where(level <= EXACT_LEVELS, level, high).astype(float)


# -- counting


def _flushed(batches, counted) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct hashes and counts of what ``counted`` gives for each text, a flush at a time."""
    held, size = [], 0
    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            found = counted(tokens(text))
            held.append(found)
            size += len(found)
            if size >= FLUSH:
                yield np.unique(np.concatenate(held), return_counts=True)
                held, size = [], 0
    if held:
        yield np.unique(np.concatenate(held), return_counts=True)


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, n) of all tokens."""
    for h, n in _flushed(batches, lambda t: t):
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])


def _count_ngrams(shift: int):
    """Rows (block, counts): the n-grams of a block, 8 bytes of hash and 4 of count each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, n in _flushed(batches, lambda t: np.concatenate([unigrams(t), bigrams(t)])):
            blocks, starts, ends = _blocks(h, shift)
            blobs = []
            for a, b in zip(starts, ends, strict=True):
                once = n[a:b] == 1
                single, more = h[a:b][once], h[a:b][~once]
                blobs.append(np.int64(len(single)).tobytes() + _narrow(single) + _narrow(more) + n[a:b][~once].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(blobs, pa.binary())], names=["block", "counts"])

    return run


def _blocks(h: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The blocks of sorted hashes, and where each begins and ends."""
    blocks = (h >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(h), np.int64)
    starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
    return blocks[starts].astype(np.int32), starts, np.r_[starts[1:], len(h)]


def _narrow(h: np.ndarray) -> bytes:
    """The lower 48 bits: with the block in the upper ones, more than enough to tell n-grams apart."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _wide(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = data.reshape(-1, 6)
    return out.view("<u8").ravel()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(blob, np.uint8)
    singles = int(data[:8].view(np.int64)[0])
    cut = 8 + 6 * singles
    more = (len(data) - cut) // 10
    h = np.concatenate([_wide(data[8:cut]), _wide(data[cut : cut + 6 * more])])
    n = np.concatenate([np.ones(singles, np.int64), data[cut + 6 * more :].copy().view("<u4").astype(np.int64)])
    return h, n


# -- the filter


def _spread(low: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The first place of (n-gram, level) and the distance to its next ones."""
    x = mix(low * np.uint64(0x9FB21C651E98DF25) + np.uint64(level))
    return x, (x >> np.uint64(32)) | np.uint64(1)


LOW48 = np.uint64((1 << 48) - 1)


def _write_block(bits: int | None = None, floor: int = 1):
    """Writes a block of ``bits`` (a power of two; by the number of its entries where none is given)."""

    def run(table: pa.Table) -> pa.Table:
        parts = [_unpack(b) for b in table.column("counts").to_pylist()]
        h, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        level = level_of(np.bincount(at, np.concatenate([p[1] for p in parts])))
        size = bits or 1 << max(6, (BITS_PER_ENTRY * int(level.sum()) - 1).bit_length())
        field = np.zeros(size, bool)
        for step in range(floor, int(level.max(initial=0)) + 1):
            place, distance = _spread(h[level >= step], step)
            for _ in range(HASHES):
                field[(place & np.uint64(size - 1)).astype(np.int64)] = True
                place = place + distance
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([np.packbits(field).tobytes()], pa.binary())})

    return run


class Filter:
    """The finished filter: quantised counts by membership probes."""

    def __init__(self, data: np.ndarray, shift: int, bits: int, floor: int):
        self.data, self.shift, self.bits, self.floor = data, shift, bits, floor

    def levels(self, h: np.ndarray) -> np.ndarray:
        base = (h >> np.uint64(self.shift)).astype(np.int64) * self.bits if self.shift < 64 else np.zeros(len(h), np.int64)
        low, out = h & LOW48, np.zeros(len(h), np.int64)
        active, level = np.arange(len(h)), self.floor
        while len(active) and level <= MOST_LEVEL:
            place, distance = _spread(low[active], level)
            for _ in range(HASHES):
                bit = base[active] + (place & np.uint64(self.bits - 1)).astype(np.int64)
                hit = (self.data[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1
                active, place, distance = active[hit], (place + distance)[hit], distance[hit]
            out[active] = level
            level += 1
        return out

    def counts(self, h: np.ndarray) -> np.ndarray:
        return value_of(self.levels(h))


def count_tokens(docs: DataFrame) -> DataFrame:
    """Staged rows (h, n) with exact counts over all texts."""
    parts = docs.select("text").mapInArrow(_count_tokens, "h long, n long")
    return stage(parts.groupBy("h").agg(F.sum("n").alias("n")), "tokens", release=True)


def build_filter(docs: DataFrame, total: int) -> tuple[DataFrame, int]:
    """Staged blocks (block, bits) of the filter over all n-grams of ``docs``, and the shift from a hash to its block."""
    shift = 64 - max(0, int(np.ceil(np.log2(max(total, 1) / TOKENS_PER_BLOCK))))
    parts = docs.select("text").mapInArrow(_count_ngrams(shift), "block int, counts binary")
    return stage(parts.groupBy("block").applyInArrow(_write_block(), "block int, bits binary"), "filter", release=True), shift


# -- scoring


def _planes(at: np.ndarray) -> bytes:
    """Places compressed byte by byte: the upper bytes hardly differ. Batches are written twice, staged and shuffled."""
    planes = np.ascontiguousarray(at.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _from_planes(blob: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd", 1).decompress(blob, 4 * count, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _batches(size: int):
    """Texts a batch at a time: ids, numbers of tokens, distinct words and the place of every token's word among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, count = [], [], 0

        def flush():
            word, at = np.unique(np.concatenate(texts), return_inverse=True)
            listed = [pa.concat_arrays([h.column(c) for h in held]) for c in ("id", "held_out")]
            columns = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in listed]
            binary = [pa.array([x.tobytes()], pa.binary()) for x in (np.array([len(t) for t in texts], "<i8"), word.astype("<u8"))]
            binary.append(pa.array([_planes(at)], pa.binary()))
            return pa.RecordBatch.from_arrays([*columns, *binary], names=["id", "held_out", "lengths", "words", "at"])

        for batch in batches:
            first = 0
            for i, text in enumerate(batch.column("text")):
                texts.append(tokens(text.as_py()))
                count += len(texts[-1])
                if count >= size:
                    held.append(batch.slice(first, i + 1 - first))
                    yield flush()
                    held, texts, count, first = [], [], 0, i + 1
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if texts:
            yield flush()

    return run


def _read_batch(row: dict) -> tuple[np.ndarray, ...]:
    """Numbers of tokens, distinct words, places of all tokens' words, starts of the texts, and hashes of all bigrams."""
    lengths, word = (np.frombuffer(row[c], kind) for c, kind in (("lengths", "<i8"), ("words", "<u8")))
    at = _from_planes(row["at"], int(lengths.sum()))
    starts = lengths.cumsum() - lengths
    return lengths, word, at, starts, bigrams(word[at], starts)


def _probe(shift: int):
    """Rows (batch, block, probes): the distinct n-grams of a batch, in the order of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            _, word, _, _, pairs = _read_batch(row)
            h = np.unique(np.concatenate([unigrams(word), pairs]))
            blocks, starts, ends = _blocks(h, shift)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(blocks), row["batch"], np.int64)), pa.array(blocks),
                    pa.array([_narrow(h[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary()),
                ],
                names=["batch", "block", "probes"],
            )

    return run


def _answer(probes: pa.Table, block: pa.Table) -> pa.Table:
    """The levels of a block's probes; 0 where nothing was written into the block."""
    sent = [_wide(np.frombuffer(p, np.uint8)) for p in probes.column("probes").to_pylist()]
    levels = [np.zeros(len(h), np.uint8) for h in sent]
    if sent and block.num_rows:
        data = np.frombuffer(block.column("bits")[0].as_py(), np.uint8)
        found = Filter(data, 64, 8 * len(data), 1).levels(np.concatenate(sent)).astype(np.uint8)
        levels = np.split(found, np.cumsum([len(h) for h in sent])[:-1])
    return pa.table({"batch": probes.column("batch"), "block": probes.column("block"), "levels": pa.array([x.tobytes() for x in levels], pa.binary())})


def _score(sent):
    def run(answers: pa.Table, batch: pa.Table) -> pa.Table:
        m = sent.value
        common, common_log, total, types = m["hashes"], m["logs"], m["total"], m["types"]
        log_floor = np.log10(total + ADD * (types + 1))
        lengths, word, at, starts, pairs = _read_batch(batch.select(["lengths", "words", "at"]).to_pylist()[0])
        ends = starts + lengths
        h, place = np.unique(np.concatenate([unigrams(word), pairs]), return_inverse=True)
        levels = np.frombuffer(b"".join(answers.sort_by("block").column("levels").to_pylist()), np.uint8)
        if len(levels) != len(h):
            raise ValueError(f"{len(levels)} levels for {len(h)} n-grams")
        counts = value_of(levels.astype(np.int64))[place]
        c, c_pair = counts[: len(word)], counts[len(word) :]
        p_word = (c + ADD) / (total + ADD * (types + 1))
        c_before = c[np.concatenate([[0], at[:-1]])]
        c_before[starts] = m["texts"]
        c_pair = np.minimum(np.minimum(c_pair, c_before), c[at])
        p = (c_pair + DIRICHLET * p_word[at]) / (c_before + DIRICHLET)
        score = np.add.reduceat(np.log10(p), starts)
        place = np.searchsorted(common, word)
        place[place == len(common)] = 0
        frequent = common[place] == word if len(common) else np.zeros(len(word), bool)
        gain = np.where(frequent, common_log[place] if len(common) else 0.0, 0.0) - log_floor
        base = np.add.reduceat(np.where(frequent, gain, 0.0)[at], starts)
        known = np.add.reduceat(frequent[at].astype(np.int64), starts)
        flat, often = word[at], frequent[at]
        rare = [np.unique(flat[a:b][~often[a:b]], return_counts=True) for a, b in zip(starts, ends, strict=True)]
        return pa.table(
            [
                *[batch.column(c).combine_chunks().flatten() for c in ("id", "held_out")], pa.array(lengths), pa.array(known), pa.array(base), pa.array(score),
                pa.array([r[0].view(np.int64) for r in rare], pa.list_(pa.int64())), pa.array([r[1] for r in rare], pa.list_(pa.int64())),
            ],
            names=["id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "times"],
        )

    return run


def fit(docs: DataFrame) -> tuple[dict, DataFrame]:
    """Model and staged exact counts from all rows of (text)."""
    words = count_tokens(docs)
    totals = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).first()
    texts = docs.count()
    total, types = totals["n"] or 0, totals["types"]
    top = words.orderBy(F.desc("n"), "h").limit(FREQUENT).select("h", "n").toPandas()
    hashes, n = top["h"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(float)
    order = np.argsort(hashes)
    blocks, shift = build_filter(docs, total)
    model = {
        "hashes": hashes[order], "logs": np.log10(n[order] + ADD), "total": total, "types": types, "texts": texts,
        "filter": blocks, "shift": shift,
    }
    return model, words


def score(docs: DataFrame, model: dict, words: DataFrame) -> DataFrame:
    """Rows (id, held_out, n_tokens, n_known, train_tokens, base_score, score) for rows (id, held_out, text)."""
    spark: SparkSession = docs.sparkSession
    sent = spark.sparkContext.broadcast({k: v for k, v in model.items() if k != "filter"})  # at most FREQUENT counts
    schema = extended(
        docs.select("id", "held_out").schema, ("n_tokens", "long"), ("n_known", "long"), ("base", "double"), ("score", "double"),
        ("rare", "array<long>"), ("times", "array<long>"),
    )
    types = {c: docs.schema[c].dataType.simpleString() for c in ("id", "held_out")}
    batches = docs.select("id", "held_out", "text").mapInArrow(
        _batches(BATCH), f"id array<{types['id']}>, held_out array<{types['held_out']}>, lengths binary, words binary, at binary"
    )
    # batch and row numbers that stay: they are written with the rows
    batches = stage(batches.withColumn("batch", F.monotonically_increasing_id()), "batches")
    probes = batches.select("batch", "lengths", "words", "at").mapInArrow(_probe(model["shift"]), "batch long, block int, probes binary")
    answers = stage(probes.groupBy("block").cogroup(model["filter"].groupBy("block")).applyInArrow(_answer, "batch long, block int, levels binary"), "answers", release=True)
    scored = answers.groupBy("batch").cogroup(batches.groupBy("batch")).applyInArrow(_score(sent), schema)
    staged = stage(scored.withColumn("row", F.monotonically_increasing_id()), "scored", release=True)
    discard(batches)
    discard(answers)
    floor = float(np.log10(model["total"] + ADD * (model["types"] + 1)))
    rare = staged.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("h"), "x.times")
    found = rare.join(words, "h").groupBy("row").agg(
        F.sum("times").alias("seen"), F.sum(F.col("times") * (F.log10(F.col("n") + ADD) - floor)).alias("more")
    )
    none = float(np.log10(ADD)) - floor
    held = F.aggregate("times", F.lit(0).cast("long"), lambda a, x: a + x)
    return staged.join(found, "row", "left").select(
        "id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(model["total"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + (held - F.coalesce("seen", F.lit(0))) * none).alias("base_score"),
        "score",
    )
