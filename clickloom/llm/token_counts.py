"""Exact token counts of every prefix of a text, for a byte-pair vocabulary with word ends.

Prefix dynamic programming: byte-pair merges leave the tokens of ``w[:i]`` equal to
those of ``w[:i - len(t)]`` followed by one last token ``t``, and ``t`` is the one
token ending there that stands next to the last token before it without merging.
So one step per position gives the last token and the count of every prefix of a
word, from earlier positions alone; sorted words go on from the prefix they share. One
more step closes any prefix with the token that ends a word there. A text's counts are
those of its words on top of the words before.

What is stored answers questions of length without encoding again: how many tokens
a prefix has (``prefix_counts``, ``tokens_at``), and how much of a text fits a
budget (``token_counts``, ``fitting``, ``truncate``).

Prefixes are those of the *plain* text: NFC and lower case, as the vocabulary reads
it, special tokens as they are. A prefix is not normalised again, and a special
token that is cut is ordinary text. Positions are code points.

Defined results: a null text is an empty one, with 0 tokens and no prefixes. Texts
and words of any length are whole: a step costs at most the longest token, and only
words up to ``REMEMBERED_BYTES`` are remembered. Repeated rows are counted row by
row; no result depends on an order, so there are no ties. An empty table gives an
empty one. Only the id (of any type, null or not) is carried over; other columns, of
whatever name, are left out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bpe import BLANKS, Encoder, _char_class, read_vocabulary
from clickloom.llm.common import slices

#: Entries that a worker remembers before it starts anew, and the longest words among them.
REMEMBERED, REMEMBERED_BYTES = 400_000, 64
FOREVER = 1 << 30
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_START = -1


class Neighbours(dict):
    """(token before) << 17 | token -> whether the two stay apart; judged when first asked for.

    Two tokens merge across their border at the rank of a pair (x, y) if x is the
    right edge of the first and y the left edge of the second at that time: from
    their own merge until they are merged away on their own side. Of equal ranks the
    leftmost goes first.
    """

    def __init__(self, enc: Encoder):
        super().__init__()
        self.enc = enc
        self.halves = {enc.merged[r]: (r, pair) for pair, r in enc.ranks.items()}
        self.bytes_of = {t: bytes([b]) for b, t in enumerate(enc.inner)} | {t: bytes([b]) for b, t in enumerate(enc.last)}
        closing = set(enc.last)
        for rank, pair in sorted((r, p) for p, r in enc.ranks.items()):
            token = enc.merged[rank]
            self.bytes_of[token] = self.bytes_of[pair[0]] + self.bytes_of[pair[1]]
            if pair[1] in closing:
                closing.add(token)
        self.closing = closing
        self.edges: tuple[dict, dict] = ({}, {})

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at the left (0) or right (1) edge of a token, each with the rank that merges it away."""
        known = self.edges[side].get(token)
        if known is None:
            known, until, at = [], FOREVER, token
            while True:
                known.append((at, until))
                if at not in self.halves:
                    break
                until, pair = self.halves[at]
                at = pair[side]
            self.edges[side][token] = known
        return known

    def whole(self, token: int) -> bool:
        """Whether the token's own bytes are merged into it: some are never reached."""
        data, enc = self.bytes_of[token], self.enc
        end = enc.last if token in self.closing else enc.inner
        return enc.merge_short([enc.inner[b] for b in data[:-1]] + [end[data[-1]]]) == [token]

    def apart(self, before: int, token: int) -> bool:
        rank_of = self.enc.ranks.get
        for x, until_x in self.edge(before, 1):
            for y, until_y in self.edge(token, 0):
                rank = rank_of((x, y))
                if rank is not None and rank < until_x and rank <= until_y:
                    return False
        return True

    def __missing__(self, key: int) -> bool:
        before, token = (key >> 17) - 1, key & 0x1FFFF
        if before == _START:
            found = self.whole(token)
        else:
            found = self[token] and self.apart(before, token)  # the key of (start, token) is the token
        if len(self) > 4 * REMEMBERED:
            self.clear()
        self[key] = found
        return found


class Counter(dict):
    """Word -> its number of tokens; what was not learnt is counted when asked for.

    Where places matter, a text is cut in pieces: a word and the blanks after it, or
    leading blanks.
    """

    def __init__(self, vocabulary: str):
        super().__init__()
        self.enc = enc = Encoder(vocabulary)
        self.apart = Neighbours(enc)
        names = self.apart.bytes_of
        #: tokens by their bytes from the last one back: nested tables, the token under None
        self.open, self.closed = self.backwards(closing=False), self.backwards(closing=True)
        self.ready: dict[str, np.ndarray] = {}
        letters, numbers = _char_class("L"), _char_class("N")
        self.pieces_of = re.compile(f"(?:{_CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{BLANKS}{letters}{numbers}]+)[{BLANKS}]*|[{BLANKS}]+")
        self.ascii_pieces_of = re.compile(f"(?:{_CONTRACTIONS}|[a-z]+|[0-9]|[^\t-\r a-z0-9]+)[\t-\r ]*|[\t-\r ]+")
        self.blanks = "".join(re.findall(f"[{BLANKS}]", "".join(map(chr, range(0x3001)))))
        self.between, self.control = re.compile(f"[{BLANKS}]+"), re.compile("[\x1c-\x1f]")
        #: what stands between blanks -> its number of tokens
        self.chunks: dict[str, int] = {}
        self.symbol = re.compile(f"[^{BLANKS}{letters}{numbers}]$")

    def backwards(self, closing: bool) -> dict:
        root: dict = {}
        for token, data in self.apart.bytes_of.items():
            if (token in self.apart.closing) == closing:
                at = root
                for b in reversed(data):
                    at = at.setdefault(b, {})
                at[None] = token
        return root

    def plain(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # one character at a time: the end form of sigma does not exist there
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, plain: str) -> list[str]:
        """The plain text in pieces; joined they are the text."""
        return (self.ascii_pieces_of if plain.isascii() else self.pieces_of).findall(plain)

    def steps(self, data: bytes, steps: list[tuple[int, int]] | None = None) -> list[tuple[int, int]]:
        """(last token, number of tokens) of every prefix that goes on, the empty one first.

        Steps that are known already, those of a shorter prefix, are gone on with.
        """
        steps = [(_START, 0)] if steps is None else steps
        for i in range(len(steps), len(data) + 1):
            steps.append(self.last_token(data, i, self.open, steps))
        return steps

    def learn(self, words: Iterable[str]) -> None:
        """Token numbers of words; in order, so that each goes on from the prefix it shares with the last one."""
        before, steps = b"", [(_START, 0)]
        for word in sorted(words):
            data = word.encode("utf-8", "surrogatepass")
            shared, most = 0, min(len(before), len(data)) - 1
            while shared < most and before[shared] == data[shared]:
                shared += 1
            del steps[shared + 1 :]
            self[word] = self.close(data, len(data), self.steps(data[:-1], steps))
            before = data

    def last_token(self, data: bytes, i: int, tokens: dict, before: list[tuple[int, int]]) -> tuple[int, int]:
        """Last token of data[:i] and the number of tokens, from the prefixes before."""
        at, ending, j = tokens, [], i
        while j:
            j -= 1
            at = at.get(data[j])
            if at is None:
                break
            if None in at:
                ending.append((j, at[None]))
        apart = self.apart
        for j, token in reversed(ending):
            last, n = before[j]
            if apart[last + 1 << 17 | token]:
                return token, n + 1
        raise ValueError("no token ends this prefix: the vocabulary lacks a byte")

    def close(self, data: bytes, i: int, steps: list[tuple[int, int]]) -> int:
        """Tokens of data[:i] as a whole word."""
        return self.last_token(data, i, self.closed, steps)[1] if i else 0

    def prefixes(self, piece: str) -> np.ndarray:
        """Tokens of every non-empty prefix of a piece."""
        found = self.ready.get(piece)
        if found is None:
            word = piece.rstrip(self.blanks)
            data = word.encode("utf-8", "surrogatepass")
            steps = self.steps(data)
            ends, at = [], 0
            for c in word:
                at += 1 if c < "\x80" else len(c.encode("utf-8", "surrogatepass"))
                ends.append(self.close(data, at, steps))
            if len(word) == 3 and word in _CONTRACTIONS.split("|"):
                ends[1] = ends[0] + self[word[1]]  # cut before its last letter it is a quote and a letter
            found = np.array(ends + (ends[-1:] or [0]) * (len(piece) - len(word)), np.int32)
            if len(piece) <= REMEMBERED_BYTES:
                if len(self.ready) >= REMEMBERED // 8:
                    self.ready.clear()
                self.ready[piece] = found
        return found

    def __missing__(self, piece: str) -> int:
        word = piece.rstrip(self.blanks)
        data = word.encode("utf-8", "surrogatepass")
        return self.close(data, len(data), self.steps(data[:-1])) if word else 0

    def parts(self, text: str | None) -> list[str]:
        """Ordinary texts and special tokens in turn, ordinary ones plain."""
        if not text:
            return []
        if self.enc.specials is None or "<" not in text:
            return [self.plain(text)]
        return [p if k % 2 else self.plain(p) for k, p in enumerate(self.enc.specials.split(text))]

    def totals(self, texts: list[list[str]]) -> list[int]:
        """Tokens of texts given in parts."""
        # no word goes over a blank, so what stands between blanks is counted once for all its places
        between = [[c for p in parts[::2] for c in self.chunks_of(p)] for parts in texts]
        known = self.chunks
        if len(known) >= REMEMBERED:
            known.clear()
        fresh = set(chain.from_iterable(between)).difference(known)
        find = (self.enc.ascii_words.findall, self.enc.words.findall)
        words = {c: find[not c.isascii()](c) for c in fresh}
        if len(self) >= REMEMBERED:
            self.clear()
        self.learn(set(chain.from_iterable(words.values())).difference(self))
        known.update((c, sum(map(self.__getitem__, w))) for c, w in words.items())
        found = [sum(map(known.__getitem__, c)) + len(parts) // 2 for c, parts in zip(between, texts, strict=True)]
        for chunk in [c for c in fresh if len(c) > REMEMBERED_BYTES]:
            del known[chunk]
            for word in words[chunk]:
                self.pop(word, None)
        return found

    def chunks_of(self, plain: str) -> list[str]:
        """What stands between blanks. Four control characters split here for Python, but not in the vocabulary's patterns."""
        if self.control.search(plain):
            return [c for c in self.between.split(plain) if c]
        return plain.split()

    def total(self, text: str | None) -> int:
        return self.totals([self.parts(text)])[0]

    def counts(self, text: str | None) -> np.ndarray:
        """Tokens of every non-empty prefix of the plain text."""
        return self.counts_of(self.parts(text))

    def counts_of(self, parts: list[str]) -> np.ndarray:
        out, base, tail = [], 0, ""
        for k, part in enumerate(parts):
            if k % 2:
                # a cut special token is read on from the symbols just before it
                start = base - (self[tail] if tail else 0)
                cut = [start + sum(map(self.__getitem__, self.pieces(tail + part[:j]))) for j in range(1, len(part))]
                base, tail = base + 1, ""
                out.append(np.array([*cut, base], np.int32))
                continue
            pieces = self.pieces(part)
            for piece in pieces:
                inside = self.prefixes(piece)
                out.append(inside + base)
                base += int(inside[-1])
            tail = pieces[-1] if pieces and self.symbol.search(pieces[-1]) else ""
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def fits(self, parts: list[str], limit: int) -> int:
        """Code points of the longest prefix with at most ``limit`` tokens, of a text given in parts.

        Counts only grow from word to word, so the text is read up to the first word
        that does not fit; that word's own prefixes tell where the budget ends.
        """
        base = at = 0
        for k, part in enumerate(parts):
            if k % 2:
                if base + 1 > limit:
                    # what is cut here is read on from the symbols before it
                    counts = self.counts_of(parts[: k + 1])
                    return int(np.flatnonzero(counts <= limit)[-1]) + 1 if (counts <= limit).any() else 0
                base, at = base + 1, at + len(part)
                continue
            for found in (self.ascii_pieces_of if part.isascii() else self.pieces_of).finditer(part):
                piece = found.group()
                total = self[piece.rstrip(self.blanks)]
                if base + total > limit:
                    within = np.flatnonzero(self.prefixes(piece) + base <= limit)
                    return at + int(within[-1]) + 1 if len(within) else at
                base, at = base + total, at + len(piece)
        return at


_counters: dict[int, Counter] = {}


def counter(vocabulary: str) -> Counter:
    key = hash(vocabulary)
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(vocabulary)
    return _counters[key]


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_tokens, over_limit, fit_chars) of every whole text.

    ``fit_chars`` is the length of the longest prefix of the plain text that has at
    most ``limit`` tokens.
    """

    def measure(count: Counter, texts: list[str | None]) -> list:
        parts = [count.parts(t) for t in texts]
        totals = count.totals(parts)
        fit = [count.fits(p, limit) if n > limit else sum(map(len, p)) for n, p in zip(totals, parts, strict=True)]
        return [pa.array(totals, pa.int64()), pc.greater(pa.array(totals, pa.int64()), limit), pa.array(fit, pa.int64())]

    counted = _over(docs, path, id_col, text_col, "n_tokens long, over_limit boolean, fit_chars long", measure, 1024)
    return counted.select(id_col, "n_bytes", "n_tokens", "over_limit", "fit_chars")


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, counts array<int>): the tokens of every non-empty prefix of the plain text."""

    def measure(count: Counter, texts: list[str | None]) -> list:
        return [pa.array([count.counts(t) for t in texts], pa.list_(pa.int32()))]

    return _over(docs, path, id_col, text_col, "counts array<int>", measure)


def truncate(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, fitting string): the longest prefix of the plain text with at most ``limit`` tokens."""

    def measure(count: Counter, texts: list[str | None]) -> list:
        parts = [count.parts(t) for t in texts]
        return [pa.array(["".join(p)[: count.fits(p, limit)] for p in parts], pa.string())]

    return _over(docs, path, id_col, text_col, "fitting string", measure)


def tokens_at(counts: Column, position: Column) -> Column:
    """Tokens of the first ``position`` code points, from stored prefix counts; null beyond the text."""
    return F.when(position == 0, F.lit(0)).otherwise(F.get(counts, (position - 1).cast("int")))


def fitting(counts: Column, limit: Column) -> Column:
    """Code points of the longest prefix within a budget, from stored prefix counts."""
    return F.coalesce(F.array_max(F.transform(counts, lambda n, i: F.when(n <= limit, i + 1))), F.lit(0))


def _over(docs: DataFrame, path: str, id_col: str, text_col: str, columns: str, measure, rows_at_once: int = 64) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))  # one vocabulary file
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    names = ["id", "n_bytes", *[c.split()[0] for c in columns.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(sent.value)
        for batch in slices(batches, rows_at_once):
            size = pc.cast(pc.binary_length(batch.column("text")), pa.int64())
            found = measure(count, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), size, *found], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, {columns}").withColumnRenamed("id", id_col)
