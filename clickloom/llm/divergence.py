"""How far the sources of a language differ from one another and from the language.

Terms are runs of ASCII letters and other characters above ASCII, A-Z lower-cased. A
language keeps the terms found in enough of its documents. They are sorted, numbered,
and each run of 65,536 becomes a minimal acyclic transducer: states with the same
endings are one state, and the numbers along a path add up to the term's place in
byte order, its ordinal. Texts are then streamed through the transducers, all terms
of a batch side by side, one byte a step, and ordinals are counted by group. Ordinals
stand for terms from there on: they break ties, and are walked back to terms at last.

Transducers are a written table that grows with the vocabulary. They are broadcast in
runs of bounded size; texts are read once for each run. Neighbouring runs are joined
into one automaton, so a step costs the same for any number of them.

With c the count of a term in a group, N the sum over the V kept terms, every kept
term has p = 1 + floor(10^9 (c + 2) / (N + 2 V)), and two groups differ at it by
floor((p - q)^2 / (p + q)). All of it is whole numbers.

Defined results: null text, language and source are ''. Documents are counted row by
row, repeated rows and ids too, and need no id. A language without kept terms gives
pairs of value 0. Ties go to the smaller item in byte order. Texts of any length are
whole; terms longer than every kept term end early. An empty table gives no rows.
Columns but the three named are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.ranking import ranked
from clickloom.llm.common import slices
from clickloom.sources.staging import discard, stage

MIN_DOCUMENTS, TOP = 10, 10
#: Terms of a transducer; bytes of transducers broadcast at a time.
RUN_TERMS, BROADCAST_BYTES = 1 << 16, 1 << 27
#: Counts that a task holds before it gives them out; bytes of text walked at a time.
HELD, WALKED = 1 << 18, 1 << 22
#: Terms and sources of a block in which pairs of sources are compared.
BLOCK_TERMS, TILE = 4096, 64
UNIT, SMOOTH = 1_000_000_000, 2
_TERM = rb"[a-z\x80-\xff]+"
_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


# -- vocabulary ---------------------------------------------------------------------


def kept_terms(rows: DataFrame, min_docs: int) -> DataFrame:
    """Rows (lang, term binary): the terms in at least ``min_docs`` rows of their language."""
    find = re.compile(_TERM).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def give() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                    names=["lang", "term", "n"],
                )
            held.clear()

        for batch in slices(batches, 64):
            texts = pc.cast(batch.column("text"), pa.binary()).to_pylist()
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                held.setdefault(lang, Counter()).update(set(find(text.lower())))  # bytes.lower: A-Z only
            if sum(map(len, held.values())) >= HELD:
                yield from give()
        yield from give()

    found = rows.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


def numbered(kept: DataFrame) -> DataFrame:
    """Rows (lang, term, ordinal), ordinals from 0 in each language in byte order."""
    placed = stage(ranked(kept, ["lang", "term"], "place"), "places")
    starts = placed.groupBy("lang").agg(F.min("place").alias("start"))
    return placed.join(F.broadcast(starts), "lang").select("lang", "term", (F.col("place") - F.col("start")).alias("ordinal"))


# -- transducers --------------------------------------------------------------------


def build(terms: list[bytes]) -> dict[str, np.ndarray]:
    """A minimal acyclic transducer of sorted, distinct terms; its last state is the start.

    Arcs are sorted by (owner, label); ``skip`` is the number of terms that come
    before those of the arc among the owner's; ``below`` counts a state's terms.
    """
    owner, label, target, skip, below, final = [], [], [], [], [], []
    registered: dict[tuple, int] = {}

    def freeze(arcs: list[tuple[int, int]], ends: bool) -> int:
        key = (ends, *arcs)
        state = registered.get(key)
        if state is None:
            state = registered[key] = len(below)
            n = int(ends)
            for byte, to in arcs:
                owner.append(state)
                label.append(byte)
                target.append(to)
                skip.append(n)
                n += below[to]
            below.append(n)
            final.append(ends)
        return state

    #: the path of the last term: arcs of each state that are settled, and whether it is final
    path: list[tuple[list[tuple[int, int]], list[bool]]] = [([], [False])]
    last = b""

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            arcs, ends = path.pop()
            path[-1][0].append((last[len(path) - 1], freeze(arcs, ends[0])))

    for term in terms:
        common = 0
        while common < len(last) and common < len(term) and last[common] == term[common]:
            common += 1
        settle(common)
        path.extend(([], [False]) for _ in range(len(term) - common))
        path[-1][1][0] = True
        last = term
    settle(0)
    registered.clear()  # the start is a state of its own, and the last one
    freeze(path[0][0], path[0][1][0])
    return {
        "owner": np.array(owner, np.int32), "label": np.array(label, np.uint8), "target": np.array(target, np.int32),
        "skip": np.array(skip, np.int32), "below": np.array(below, np.int32), "final": np.array(final, np.bool_),
    }


_FIELDS = {"owner": np.int32, "label": np.uint8, "target": np.int32, "skip": np.int32, "below": np.int32, "final": np.bool_}


def transducers(vocabulary: DataFrame) -> DataFrame:
    """Rows (lang, start, n, arrays...): one transducer for each run of ordinals of a language."""

    def run(table: pa.Table) -> pa.Table:
        ordinals = table.column("ordinal").to_numpy()
        order = np.argsort(ordinals)
        made = build(table.column("term").combine_chunks().take(pa.array(order)).to_pylist())
        cells = [[table.column("lang")[0].as_py()], [int(ordinals.min())], [len(ordinals)], *[[made[f].tobytes()] for f in _FIELDS]]
        return pa.table(cells, names=["lang", "start", "n", *_FIELDS])

    by_run = vocabulary.withColumn("_run", F.floor(F.col("ordinal") / RUN_TERMS))
    return by_run.groupBy("lang", "_run").applyInArrow(
        run, "lang string, start long, n long, " + ", ".join(f"{f} binary" for f in _FIELDS)
    )


class Automaton:
    """Transducers of neighbouring runs of several languages, as one set of sorted arcs.

    A language's start joins the starts of its runs: only on the paths between two
    runs do states of both meet, and there they are joined as well.
    """

    def __init__(self, runs: list[tuple[str, int, dict[str, np.ndarray]]]):
        self.start: dict[str, int] = {}
        self.first: dict[str, int] = {}
        owner, label, target, skip, final, below = [], [], [], [], [], []
        starts: dict[str, list[int]] = {}
        at = 0
        for lang, first, made in sorted(runs, key=lambda r: (r[0], r[1])):
            owner.append(made["owner"] + np.int64(at))
            target.append(made["target"] + np.int64(at))
            label.append(made["label"])
            skip.append(made["skip"])
            final.append(made["final"])
            below.append(made["below"])
            at += len(made["below"])
            self.first.setdefault(lang, first)
            starts.setdefault(lang, []).append(at - 1)
        self.owner, self.label, self.target, self.skip = map(np.concatenate, (owner, label, target, skip))
        self.final, self.below = np.concatenate(final), np.concatenate(below)
        self._more: tuple[list, list, list, list, list] = ([], [], [], [], [])
        for lang, states in starts.items():
            self.start[lang] = self._join(states)
        more = [np.array(m, np.int64) for m in self._more]
        self.owner, self.label = np.concatenate([self.owner, more[0]]), np.concatenate([self.label, more[1]]).astype(np.int64)
        self.target, self.skip = np.concatenate([self.target, more[2]]), np.concatenate([self.skip, more[3]]).astype(np.int64)
        self.final = np.concatenate([self.final, more[4].astype(bool)])
        self.keys = self.owner << 8 | self.label
        del self._more, self.owner, self.below

    def _arcs(self, state: int) -> tuple[int, int]:
        return int(np.searchsorted(self.owner, state)), int(np.searchsorted(self.owner, state + 1))

    def _join(self, states: list[int]) -> int:
        """One state for the neighbouring states of several runs, from the first run to the last."""
        if len(states) == 1:
            return states[0]
        owner, label, target, skip, final = self._more

        def fresh() -> int:
            final.append(False)
            return len(self.final) + len(final) - 1

        start = fresh()
        waiting = deque([(start, states)])
        while waiting:
            state, members = waiting.popleft()  # in the order of their numbers, so that arcs stay sorted
            by_label: dict[int, list[int]] = {}
            for member in members:
                for k in range(*self._arcs(member)):
                    by_label.setdefault(int(self.label[k]), []).append(int(self.target[k]))
            ends = any(bool(self.final[m]) for m in members)
            final[state - len(self.final)] = ends
            n = int(ends)
            for byte, targets in sorted(by_label.items()):
                to = targets[0] if len(targets) == 1 else fresh()
                if len(targets) > 1:
                    waiting.append((to, targets))
                owner.append(state)
                label.append(byte)
                target.append(to)
                skip.append(n)
                n += sum(int(self.below[t]) for t in targets)
        return start

    def walk(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Ordinals (-1: none) of the terms data[begin : begin + length], from the given start states."""
        out = np.full(len(begin), -1, np.int64)
        left = np.arange(len(begin))
        state, place, step = start.astype(np.int64), np.zeros(len(begin), np.int64), 0
        last = len(self.keys) - 1
        while len(left):
            key = state << 8 | data[begin[left] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), last)
            going = self.keys[arc] == key
            left, arc = left[going], arc[going]
            place = place[going] + self.skip[arc]
            state = self.target[arc]
            step += 1
            done = length[left] == step
            ended = done & self.final[state]
            out[left[ended]] = place[ended]
            left, state, place = left[~done], state[~done], place[~done]
        return out

    def term(self, lang: str, ordinal: int) -> bytes | None:
        """The term with an ordinal; None if it lies in other runs."""
        if lang not in self.start:
            return None
        rest, state, out = ordinal - self.first[lang], self.start[lang], bytearray()
        while rest >= 0:
            if self.final[state] and rest == 0:
                return bytes(out)
            a, b = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            k = int(np.searchsorted(self.skip[a:b], rest, side="right")) - 1 + a
            if k < a:
                return None
            rest -= int(self.skip[k])
            out.append(int(self.label[k]))
            state = int(self.target[k])
        return None


def in_runs(table: DataFrame, bound: int) -> Iterator[Automaton]:
    """Automata of neighbouring runs, each of at most ``bound`` bytes (and one run at least)."""
    sizes = table.select("lang", "start", reduce(Column.__add__, [F.octet_length(f) for f in _FIELDS]).alias("size"))
    group: list[tuple[str, int]] = []
    held, groups = 0, []
    # one small row for each 65,536 kept terms
    for r in sizes.orderBy("lang", "start").toLocalIterator():
        if group and held + r["size"] > bound:
            groups.append(group)
            group, held = [], 0
        group.append((r["lang"], r["start"]))
        held += r["size"]
    groups += [group] if group else []
    for group in groups:
        first, last = group[0], group[-1]
        key = F.struct("lang", "start")
        low, high = (F.struct(F.lit(lang).alias("lang"), F.lit(at).cast("long").alias("start")) for lang, at in (first, last))
        rows = table.where((key >= low) & (key <= high)).collect()
        yield Automaton([(r["lang"], r["start"], {f: np.frombuffer(r[f], k) for f, k in _FIELDS.items()}) for r in rows])


# -- counting -----------------------------------------------------------------------


def _groups_of(batch: pa.RecordBatch) -> list[tuple[str, str]]:
    return list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))


def recount(rows: DataFrame, automaton: Automaton) -> DataFrame:
    """Rows (lang, source, ordinal, n) of the automaton's terms; each group may come more than once."""
    sent = rows.sparkSession.sparkContext.broadcast(automaton)  # bounded by BROADCAST_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = sent.value
        names: dict[tuple[str, str], int] = {}
        keys, counts = [], []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            if not keys:
                return np.empty(0, np.int64), np.empty(0, np.int64)
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            return distinct, np.bincount(at, np.concatenate(counts)).astype(np.int64)

        def give(distinct: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            order = list(names)
            for at in range(0, len(distinct), HELD):
                part = distinct[at : at + HELD]
                group = pa.array(part >> 40)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in order], pa.string()).take(group), pa.array([g[1] for g in order], pa.string()).take(group),
                     pa.array(part & ((1 << 40) - 1)), pa.array(n[at : at + HELD])],
                    names=["lang", "source", "ordinal", "n"],
                )

        def walk(texts: list[bytes], groups: list[tuple[str, str]]) -> None:
            data = _LOWER[np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)]
            edge = np.flatnonzero(np.diff(_LETTER[data].astype(np.int8), prepend=0))
            begin, length = edge[::2], edge[1::2] - edge[::2]
            ends = np.cumsum([len(t) + 1 for t in texts])
            doc = np.searchsorted(ends, begin, side="right")
            start = np.array([machine.start.get(g[0], -1) for g in groups], np.int64)[doc]
            there = start >= 0
            begin, length, doc, start = begin[there], length[there], doc[there], start[there]
            place = machine.walk(data, begin, length, start)
            hit = place >= 0
            ids = np.array([names.setdefault(g, len(names)) for g in groups], np.int64)
            first = np.array([machine.first.get(g[0], 0) for g in groups], np.int64)
            doc = doc[hit]
            distinct, n = np.unique(ids[doc] << 40 | (first[doc] + place[hit]), return_counts=True)
            keys.append(distinct)
            counts.append(n)

        for batch in slices(batches):
            groups, texts = _groups_of(batch), pc.cast(batch.column("text"), pa.binary()).to_pylist()
            at = held = 0
            for k, text in enumerate(texts):
                held += len(text)
                if held >= WALKED or k == len(texts) - 1:
                    walk(texts[at : k + 1], groups[at : k + 1])
                    at, held = k + 1, 0
            if sum(map(len, keys)) >= 4 * HELD:
                distinct, n = merged()
                keys[:], counts[:] = [distinct], [n]
                if len(distinct) >= 2 * HELD:
                    yield from give(distinct, n)
                    keys.clear()
                    counts.clear()
                    names.clear()
        yield from give(*merged())

    return rows.mapInArrow(run, "lang string, source string, ordinal long, n long")


def named(rows: DataFrame, automaton: Automaton) -> DataFrame:
    """The rows whose ordinal the automaton holds, with the term as ``item``."""
    sent = rows.sparkSession.sparkContext.broadcast(automaton)  # bounded by BROADCAST_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ordinals = batch.column("lang").to_pylist(), batch.column("ordinal").to_pylist()
            terms = [sent.value.term(g, o) for g, o in zip(langs, ordinals, strict=True)]
            item = pa.array([None if t is None else t.decode("utf-8", "replace") for t in terms], pa.string())
            full = pa.RecordBatch.from_arrays([*batch.columns, item], names=[*batch.schema.names, "item"])
            yield full.filter(pc.is_valid(item))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, item string")


# -- divergence ---------------------------------------------------------------------


def share(count: str, total: str) -> Column:
    """p of a count among a denominator N + 2 V."""
    return F.expr(f"1 + (CAST({count} + {SMOOTH} AS DECIMAL(20, 0)) * {UNIT}BD) DIV {total}")


def _shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same for an array, by long division with three digits a step."""
    whole, rest = np.divmod(counts + SMOOTH, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + more
    return whole + 1


def _pair_sums(table: pa.Table) -> pa.Table:
    """Sums over one block of terms, for the pairs of sources of two tiles."""
    block = {c: table.column(c)[0].as_py() for c in ("lang", "left", "right", "width")}
    number, at, n, total = (table.column(c).to_numpy() for c in ("number", "at", "n", "total"))
    inside = at >= 0
    p: dict[int, np.ndarray] = {}
    for s in np.unique(number).tolist():
        mine = number == s
        counts = np.zeros(block["width"], np.int64)
        counts[at[mine & inside]] = n[mine & inside]
        p[s] = _shares(counts, total[mine][0]) if block["width"] else counts
    rows = []
    for a in p:
        for b in p:
            if a < b and a // TILE == block["left"] and b // TILE == block["right"]:
                rows.append((a, b, int(((p[a] - p[b]) ** 2 // (p[a] + p[b])).sum()) if block["width"] else 0))
    a, b, value = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table(
        [pa.array([block["lang"]] * len(rows), pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(value, pa.int64())],
        names=["lang", "a", "b", "value"],
    )


def pair_values(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value) for every two sources of a language, both ways.

    ``groups`` holds (lang, source, number, terms, total). Pairs are summed in blocks
    of 4,096 terms and tiles of 64 sources, so a task holds two tiles of one block.
    """
    marks = groups.select(
        "lang", "number", "terms", "total",
        F.explode(F.sequence(F.lit(0), F.greatest(F.floor((F.col("terms") - 1) / BLOCK_TERMS), F.lit(0)))).alias("block"),
        F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("n"),
    )
    known = counts.join(groups, ["lang", "source"]).select(
        "lang", "number", "terms", "total", F.floor(F.col("ordinal") / BLOCK_TERMS).alias("block"),
        (F.col("ordinal") % BLOCK_TERMS).alias("at"), "n",
    )
    tiles = groups.groupBy("lang").agg(F.floor(F.max("number") / TILE).alias("tiles"))
    tile, other = F.floor(F.col("number") / TILE), F.explode(F.sequence(F.lit(0), F.col("tiles")))
    placed = marks.unionByName(known).join(tiles, "lang").withColumn("other", other).select(
        "lang", "block", F.least(tile, "other").alias("left"), F.greatest(tile, "other").alias("right"), "number", "at", "n", "total",
        F.least(F.col("terms") - F.col("block") * BLOCK_TERMS, F.lit(BLOCK_TERMS)).alias("width"),
    )
    sums = placed.groupBy("lang", "block", "left", "right").applyInArrow(_pair_sums, "lang string, a long, b long, value long")
    whole = stage(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    both = whole.unionByName(whole.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    left, right = (groups.select("lang", F.col("number").alias(n), F.col("source").alias(s)) for n, s in (("a", "source"), ("b", "item")))
    return both.join(left, ["lang", "a"]).join(right, ["lang", "b"]).select("lang", "source", "item", "value")


def top_terms(groups: DataFrame, counts: DataFrame, langs: DataFrame, top: int) -> DataFrame:
    """Rows (lang, source, ordinal, value, rank): the terms a group has more of than its language."""
    all_ = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("m"))
    both = counts.join(all_, ["lang", "ordinal"]).join(groups.select("lang", "source", "total"), ["lang", "source"]).join(langs, "lang")
    shares = both.select("lang", "source", "ordinal", share("n", "total").alias("p"), share("m", "lang_total").alias("q"))
    value = F.expr("((p - q) * (p - q)) DIV (p + q)").alias("value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    return (
        shares.where("p > q").select("lang", "source", "ordinal", value)
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    )


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCUMENTS, top: int = TOP,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank); part ``pair``: other sources, part ``term``: leading terms."""
    rows = docs.select(
        F.coalesce(docs[text_col], F.lit("")).alias("text"), F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("lang"),
        F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("source"),
    )
    kept = stage(numbered(kept_terms(rows, min_docs)), "kept-terms")
    table = stage(transducers(kept), "transducers")
    found = [stage(recount(rows, machine), "recounted") for machine in in_runs(table, broadcast_bytes)]
    empty = rows.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    counted = reduce(DataFrame.unionByName, found, empty)
    counts = stage(counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "term-counts")
    for part in found:
        discard(part)
    # sizes: V of a language, N + 2 V of a group and of a language
    terms = table.groupBy("lang").agg(F.sum("n").alias("terms"))
    seen = counts.groupBy("lang", "source").agg(F.sum("n").alias("tokens"))
    sized = (
        rows.select("lang", "source").distinct().join(seen, ["lang", "source"], "left").join(terms, "lang", "left")
        .na.fill(0, ["tokens", "terms"]).withColumn("total", F.col("tokens") + SMOOTH * F.col("terms"))
        .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    )
    groups = stage(sized.select("lang", "source", F.col("number").cast("long").alias("number"), "terms", "tokens", "total"), "groups")
    langs = groups.groupBy("lang").agg((F.sum("tokens") + SMOOTH * F.max("terms")).alias("lang_total"))

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(groups, counts).withColumn("rank", F.row_number().over(by_value))
    leading = stage(top_terms(groups, counts, langs, top), "leading-terms")
    parts = [pairs.withColumn("part", F.lit("pair"))]
    parts += [named(leading, machine).withColumn("part", F.lit("term")) for machine in in_runs(table, broadcast_bytes)]
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return reduce(DataFrame.unionByName, [p.select(columns) for p in parts])
