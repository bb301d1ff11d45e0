"""Removal of repeated byte strings with distributed suffix arrays.

A byte goes when it is covered by a string of ``length`` bytes that starts
somewhere else too, in the same or in another document.

Windows of ``length`` bytes that are equal have the same smallest gram (by hash,
the leftmost on a tie) at the same place. Neighbouring windows mostly share it,
so a text falls into segments: runs of windows with one smallest gram, the
anchor. Only windows of segments with equal anchors can be equal. Equal segments
are one row with a count; anchors seen once are done with. What is left is sorted
anchor by anchor, in batches of whole anchors, with a two-stage suffix array:

1. suffixes smaller than their successors are sorted directly, eight bytes at a
   time, only where they are still tied;
2. the others are induced by one scan over the buckets of first bytes;
3. adjacent common prefixes tell which windows are equal.

An anchor with more than ``MOST_SEGMENTS`` different segments, such as the edge
of a passage that countless documents share, is not sorted in one task. Its
segments are cut by the place of the anchor in the window into finer and finer
ranges, each keyed by the bytes that all its windows share, until few different
ones are left or a range is one window, of which all copies are one row.

Defined results: a null text is empty. Texts shorter than ``length`` bytes keep
all bytes. Rows with the same id and text are repeated rows: each is a text of
its own, so both lose what they share. A null id is an id like any other. No result
depends on an order, so there are no ties. An empty table gives an empty one. Further
columns, of whatever name, are carried over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import extended, mix, slices, spare
from clickloom.sources.staging import stage

LENGTH, GRAM = 400, 32
#: Windows of a text that are worked on at a time.
CHUNK = 1 << 19
#: Different segments of an anchor that one task sorts, and bytes of a batch.
MOST_SEGMENTS, BATCH_BYTES = 400, 1 << 20
#: Anchor places that share a range, round by round.
WIDTHS = (64, 16, 4, 1)


def data_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


# -- segments


def segments(data: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, first window, number of windows, anchor's place in the segment) of all segments, in parts."""
    width = length - GRAM + 1
    for at in range(0, len(data) - length + 1, CHUNK):
        piece = np.frombuffer(data, np.uint8, min(len(data) - at, CHUNK + length - 1), at)
        words = np.lib.stride_tricks.as_strided(piece[: len(piece) - 7].view(), (len(piece) - 7, 8), (1, 1))
        words = np.ascontiguousarray(words).view("<u8").ravel()
        grams = len(piece) - GRAM + 1
        h = np.zeros(grams, np.uint64)
        for k in range(0, GRAM, 8):
            h = (h ^ words[k : k + grams]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h = mix(h)
        # hash above, place below: the least one is the leftmost of the smallest grams
        place = np.uint64((1 << 20) - 1)
        keyed = (h & ~place) | np.arange(grams, dtype=np.uint64)
        windows = grams - width + 1
        padded = np.full(-(-grams // width) * width, np.uint64(2**64 - 1))
        padded[:grams] = keyed
        rows = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows])
        pick = (least & place).astype(np.int64)
        first = np.flatnonzero(np.r_[True, pick[1:] != pick[:-1]])
        count = np.diff(np.r_[first, windows])
        yield h[pick[first]].view(np.int64), first + at, count, pick[first] - first


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _anchors(length: int):
    names = ["anchor", "seg", "id", "h", "first", "windows", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches, 128):
            for i, text in enumerate(batch.column("text").to_pylist()):
                data = data_of(text)
                for anchor, first, count, place in segments(data, length):
                    seg = np.array([digest(data[a:b]) for a, b in zip(first.tolist(), (first + count + length - 1).tolist())], np.uint64)
                    same = np.zeros(len(anchor), np.int64)
                    arrays = [pa.array(anchor), pa.array(seg.view(np.int64)), *[batch.column(c).take(pa.array(same + i)) for c in ("id", "h")]]
                    arrays += [pa.array(x.astype(np.int32)) for x in (first, count, place)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


# -- the two-stage suffix array


def _words_at(text: np.ndarray):
    """Reads eight bytes at any places of ``text`` as numbers that sort like the bytes."""
    view = np.lib.stride_tricks.as_strided(text[:8].view(">u8"), (len(text) - 7,), (1,))
    return lambda at: view[at].astype(np.uint64)


def sort_directly(starts: np.ndarray, word_at, depth: int) -> np.ndarray:
    """Positions in order of their next ``depth`` bytes, eight at a time, only where they are tied."""
    order = starts.copy()
    at = np.arange(len(order))  # places in the order that are still tied
    group = np.zeros(len(order), np.int64)
    for d in range(0, depth, 8):
        if not len(at):
            break
        key = word_at(order[at] + d)
        first = np.r_[True, group[1:] != group[:-1]]
        number = first.cumsum() - 1
        mixed = np.zeros(number[-1] + 1, bool)
        mixed[number[key != key[np.flatnonzero(first)][number]]] = True
        sub = np.flatnonzero(mixed[number])
        if len(sub):
            by = sub[np.lexsort((key[sub], number[sub]))]
            order[at[sub]] = order[at[by]]
            key[sub] = key[by]
        starts_here = first | np.r_[True, key[1:] != key[:-1]]
        number = starts_here.cumsum() - 1
        tied = np.bincount(number)[number] > 1
        at, group = at[tied], number[tied]
    return order


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions in order of at least their first ``depth`` bytes.

    ``text`` has 0 only as the end of a segment and is padded by ``depth`` + 8
    zeros. What a position is induced from must be wanted too.
    """
    n = len(text) - depth - 8
    change = np.sign(text[1 : n + 1].astype(np.int16) - text[:n].astype(np.int16))
    # a run of equal bytes takes the type of its end
    end = np.where(change != 0, np.arange(n), n - 1)
    end = np.minimum.accumulate(end[::-1])[::-1]
    smaller = (change[end] > 0) | (text[:n] == 0)  # than its successor
    direct = sort_directly(np.flatnonzero(wanted[:n] & smaller), _words_at(text), depth)
    induced = wanted[:n] & ~smaller
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    cuts = np.searchsorted(text[direct], np.arange(257))
    out = []

    def pass_on(found: np.ndarray, c: int) -> np.ndarray:
        """Hand the predecessors to their buckets; those of this bucket come back."""
        before = found - 1
        before = before[(before >= 0) & induced[before]]
        byte = text[before]
        by = np.argsort(byte, kind="stable")
        before, byte = before[by], byte[by]
        at = np.searchsorted(byte, np.arange(257))
        for b in np.unique(byte):
            if b != c:
                buckets[b].append(before[at[b] : at[b + 1]])
        return before[at[c] : at[c + 1]]

    for c in range(256):
        current = np.concatenate(buckets[c]) if buckets[c] else direct[:0]
        while len(current):
            out.append(current)
            current = pass_on(current, c)
        current = direct[cuts[c] : cuts[c + 1]]
        if len(current):
            out.append(current)
            pass_on(current, c)
    return np.concatenate(out) if out else direct


def common_prefixes(order: np.ndarray, word_at, depth: int) -> np.ndarray:
    """For each position but the first, how many bytes (at most ``depth``) it shares with the one before."""
    out = np.full(max(len(order) - 1, 0), depth)
    at = np.arange(len(out))
    for d in range(0, depth, 8):
        if not len(at):
            break
        differ = word_at(order[at] + d) ^ word_at(order[at + 1] + d)
        off = differ != 0
        if off.any():
            lead = sum((differ[off] < np.uint64(1 << (56 - 8 * k))).astype(np.int64) for k in range(7))
            out[at[off]] = np.minimum(d + lead, depth)
            at = at[~off]
    return out


def repeated_windows(parts: list[bytes], counts: list[int], weights: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each segment, which of its first ``counts`` windows occur twice or more among all of them."""
    sizes = np.array([len(p) + 1 for p in parts])
    ends = sizes.cumsum()
    starts = ends - sizes
    text = np.zeros(int(ends[-1]) + length + 8, np.uint8)
    # no byte of UTF-8 is above 0xF4: moved up by one, 0 is free for the end of a segment
    text[: ends[-1]] = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8) + np.uint8(1)
    owner = np.repeat(np.arange(len(parts)), sizes)
    offset = np.arange(int(ends[-1])) - starts[owner]
    window = offset < np.array(counts)[owner]
    # up to the first position that is sorted directly, the rest of a segment is needed for inducing
    n = int(ends[-1])
    up = np.r_[text[:n].astype(np.int16)[1:] > text[:n].astype(np.int16)[:-1], False] | (text[:n] == 0)
    stop = np.where(up, np.arange(n), n)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    wanted = window.copy()
    first = starts + np.array(counts)
    for a, b in zip(first.tolist(), stop[np.minimum(first, n - 1)].tolist(), strict=True):
        wanted[a : b + 1] = True
    order = suffix_order(text, wanted, length)
    order = order[window[order]]
    prefix = common_prefixes(order, _words_at(text), length)
    run = np.r_[0, (prefix < length).cumsum()] if len(order) else order
    heavy = np.bincount(run, np.array(weights)[owner[order]]) > 1
    repeated = np.zeros(n, bool)
    repeated[order[heavy[run]]] = True
    return [repeated[s : s + c] for s, c in zip(starts.tolist(), counts, strict=True)]


def spans_of(repeated: np.ndarray, length: int) -> list[int]:
    """First and last + 1 bytes, flat, of the runs of repeated windows."""
    edge = np.flatnonzero(np.diff(np.r_[0, repeated.astype(np.int8), 0]))
    edge[1::2] += length - 1
    return edge.tolist()


def _sort_batches(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def judged():
            found = repeated_windows([r[3] for r in held], [r[2] for r in held], [r[4] for r in held], length)
            rows = [(r[0], r[1], spans_of(f, length)) for r, f in zip(held, found, strict=True) if f.any()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int32())),
                ],
                names=["anchor", "seg", "spans"],
            )

        for batch in slices(batches):
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "seg", "windows", "bytes", "n")], strict=True):
                if held and row[:2] == held[-1][:2]:
                    continue  # the text of one segment, read from repeated rows
                if size >= BATCH_BYTES and row[0] != last:
                    yield judged()
                    held, size = [], 0
                held.append(row)
                size, last = size + len(row[3]), row[0]
        if held:
            yield judged()

    return run


# -- finer ranges for anchors with very many different segments


def _cut(width: int, length: int):
    names = ["anchor", "seg", "off", "child", "part", "windows", "place", "bytes", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for anchor, seg, windows, place, data, n in zip(
                *[batch.column(c).to_pylist() for c in ("anchor", "seg", "windows", "place", "bytes", "n")], strict=True
            ):
                a = 0
                while a < windows:
                    low = (place - a) // width * width  # least anchor place of the range
                    b = min(windows, place - low + 1)
                    core = data[max(place - low, 0) : place - low - width + 1 + length]
                    child = xxhash.xxh3_64_intdigest(core, seed=(anchor ^ (low * 1024 + width)) & (2**64 - 1))
                    piece = data[a : b - 1 + length]
                    rows.append((anchor, seg, a, _signed(child), _signed(xxhash.xxh3_64_intdigest(piece)), b - a, place - a, piece, n))
                    a = b
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _only_repeated(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of segments (anchor, seg, n, ...): those that may hold repeated windows, few and many to an anchor."""
    sums = rows.groupBy("anchor").agg(F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_segments"))
    kept = rows.join(stage(sums.where("_n > 1"), "sums"), "anchor")
    return kept.where(F.col("_segments") <= MOST_SEGMENTS).drop("_n", "_segments"), kept.where(F.col("_segments") > MOST_SEGMENTS).drop("_n", "_segments")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, h, found): per text with repeats, segments' first bytes and spans of bytes to remove in them.

    ``h`` is xxhash64 of the text: id and h together name a text.
    """
    rows = keyed(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    where = f"anchor long, seg long, id {id_type}, h long, first int, windows int, place int"
    places = stage(rows.mapInArrow(_anchors(length), where), "places")
    # a written table: the join then reads plain exchanges, of which Spark can split a hot anchor's
    several = stage(places.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("anchor"), "several")
    # grouped by one column of its own, so that the grouping does not lean on the join's exchange
    distinct = places.join(several, "anchor").groupBy(F.struct("anchor", "seg").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "h", "first", "windows", "place")).alias("at")
    )
    wanted = distinct.select("key.*", "n", "at.*")
    # the bytes of one copy of each such segment
    by_text = wanted.groupBy("id", "h").agg(F.collect_list(F.struct("anchor", "seg", "n", "first", "windows", "place")).alias("segments"))
    same = lambda a, b: F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.h") == F.col(f"{b}.h"))
    with_text = rows.alias("t").join(by_text.alias("s"), same("t", "s")).select("text", "segments")
    whole = "anchor long, seg long, windows int, place int, bytes binary, n long"
    texts = stage(with_text.mapInArrow(_read_bytes(length), whole), "segments")

    few, many = _only_repeated(texts)
    pools, cuts = [few], []
    for width in WIDTHS:
        many = stage(many, "many")
        if many.isEmpty():
            break
        children = stage(
            many.mapInArrow(_cut(width, length), "anchor long, seg long, off int, child long, part long, windows int, place int, bytes binary, n long"),
            "ranges",
        )
        cuts.append(children.select("anchor", "seg", "off", "child", "part"))
        merged = children.groupBy(F.col("child").alias("anchor"), F.col("part").alias("seg")).agg(
            F.first("windows").alias("windows"), F.first("place").alias("place"), F.first("bytes").alias("bytes"), F.sum("n").alias("n")
        )
        few, many = _only_repeated(stage(merged, "merged"))
        pools.append(few)
    sortable = pools[0]
    for pool in pools[1:]:
        sortable = sortable.unionByName(pool)
    judged = sortable.select("anchor", "seg", "windows", "bytes", "n").repartition("anchor").sortWithinPartitions("anchor", "seg")
    verdicts = stage(judged.mapInArrow(_sort_batches(length), "anchor long, seg long, spans array<int>"), "verdicts")
    for children in reversed(cuts):
        back = children.join(verdicts.select(F.col("anchor").alias("child"), F.col("seg").alias("part"), "spans"), ["child", "part"])
        moved = back.groupBy("anchor", "seg").agg(F.flatten(F.collect_list(F.transform("spans", lambda x: x + F.col("off")))).alias("spans"))
        verdicts = stage(verdicts.unionByName(moved), "verdicts")
    # repeated rows have the same spans: each is gathered once, whatever the number of copies
    found = places.join(verdicts, ["anchor", "seg"]).groupBy("id", "h").agg(F.collect_set(F.struct("first", "spans")).alias("found"))
    return stage(found, "found")


def _read_bytes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("segments").to_pylist(), strict=True):
                data = data_of(text)
                for s in found:
                    piece = data[s["first"] : s["first"] + s["windows"] + length - 1]
                    rows.append((s["anchor"], s["seg"], s["windows"], s["place"], piece, s["n"]))
            kinds = {"anchor": pa.int64(), "seg": pa.int64(), "windows": pa.int32(), "place": pa.int32(), "bytes": pa.binary(), "n": pa.int64()}
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    return run


def without(data: bytes, found: list[dict] | None) -> tuple[bytes, int, int]:
    """The remaining bytes, the number of removed bytes and of their maximal runs."""
    if not found:
        return data, 0, 0
    pairs = [np.array(f["spans"], np.int64).reshape(-1, 2) + f["first"] for f in found]
    cover = np.zeros(len(data) + 1, np.int64)
    both = np.concatenate(pairs)
    np.add.at(cover, both[:, 0], 1)
    np.add.at(cover, both[:, 1], -1)
    gone = cover.cumsum()[:-1] > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def deduplicate(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with columns kept (binary), kept_text (without characters cut in two), n_bytes, n_removed, n_spans and kept_sha256; columns of these names are replaced."""
    found = repeated_spans(docs, length, id_col, text_col)
    out = ["kept", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    keep = [c for c in docs.columns if c not in out]
    id_, h, other_id, other_h, spans_col = spare(docs.columns, "id", "h", "found_id", "found_h", "found")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{id_col}`").alias(id_), F.xxhash64(F.col(f"`{text_col}`")).alias(h))
    found = found.select(F.col("id").alias(other_id), F.col("h").alias(other_h), F.col("found").alias(spans_col))
    on = rows[id_].eqNullSafe(found[other_id]) & (rows[h] == found[other_h])
    joined = rows.join(found, on, "left").select(*[f"`{c}`" for c in keep], spans_col)
    schema = extended(docs.select(*[f"`{c}`" for c in keep]).schema, ("kept", "binary"), ("kept_text", "string"), ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows = []
            for text, spans in zip(batch.column(text_col).to_pylist(), batch.column(spans_col).to_pylist(), strict=True):
                data = data_of(text)
                rest, removed, runs = without(data, spans)
                rows.append((rest, rest.decode("utf-8", "ignore"), len(data), removed, runs, hashlib.sha256(rest).hexdigest()))
            kinds = [pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], names=[*keep, *out]
            )

    return joined.mapInArrow(run, schema)
