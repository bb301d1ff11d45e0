"""Token counts, source divergence and vector codes."""

import hashlib
import math

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import divergence, token_counts, vector_codes
from clickloom.llm.bpe import read_vocabulary
from clickloom.llm.common import documents
from clickloom.llm.oracles import sql

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def public():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(read_vocabulary(PATH))


def size(public, text):
    return len(public.encode(text, add_special_tokens=False).ids)


def test_token_counts_are_those_of_the_public_library(spark, small, texts, public):
    rows = texts.unionByName(documents(spark, small).select("doc_id", "text")).select("*", F.lit(1).alias("n_tokens"), F.lit("x").alias("id"))
    found = token_counts.token_counts(rows, PATH, 50)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"]
    text_of = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    own = found.collect()
    assert len(own) == rows.count()
    for r in own:
        text = text_of[r["doc_id"]]
        if sum(t == r["doc_id"] for t in text_of) == 1 and r["doc_id"] not in (4, 1, 2, 3, 5, 6, 7, 8, 9):
            assert (r["n_tokens"], r["n_bytes"]) == (size(public, text), len(text.encode()))
        assert r["over_limit"] == (r["n_tokens"] > 50)
    sums = texts.select("text").join(token_counts.token_counts(texts.select(F.col("text").alias("k"), "text"), PATH, 9, "k"), F.col("text").eqNullSafe(F.col("k")))
    for r in sums.collect():
        assert r["n_tokens"] == size(public, r["text"] or "") and r["n_bytes"] == len((r["text"] or "").encode())
    assert token_counts.token_counts(texts.limit(0), PATH, 5).count() == 0


def test_every_prefix_has_its_count(small, spark, public, counter):
    odd = [
        "Ünï çödé x" + "!" * 30, "can't we're they've I'll", "日本語 🙂 ½ \x00 1234 ''s '' 're", " \t\n lead", "x'", " ", "we 're",
        "a" * 90 + " hahahaha", "b" * 200,
    ] + [r["text"][:300] for r in documents(spark, small).where("text <> ''").limit(12).collect()]
    for text in odd:
        plain, counts = "".join(counter.parts(text)), counter.counts(text)
        assert "".join(counter.pieces(plain)) == plain and len(counts) == len(plain)
        assert counts.tolist() == [size(public, plain[:i]) for i in range(1, len(plain) + 1)]
        for limit in (0, 1, 2, 7, 30, 1000):
            within = [i for i in range(len(plain) + 1) if i == 0 or counts[i - 1] <= limit]
            assert counter.fits(counter.parts(text), limit) == within[-1]
    # a special token is one token when it is whole, and ordinary text when it is cut
    counts = counter.counts("ab!<|endoftext|>c")
    cut = ["ab!<|endoftext|>"[:i] for i in range(1, 16)]
    assert counts[:15].tolist() == [size(public, c) for c in cut] and counts[15:].tolist() == [3, 4]
    for limit in range(7):
        fit = max([i + 1 for i, n in enumerate(counts.tolist()) if n <= limit], default=0)
        # the whole special token is fewer tokens than its beginning: the prefix goes on behind it
        assert counter.fits(counter.parts("ab!<|endoftext|>c"), limit) == fit


def test_random_words_and_long_words(public, counter):
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 9, 30, 64, 65, 300, 5000):
        word = "".join(rng.choice(list("aeinrsth"), n))
        assert counter.total(word) == size(public, word)


def test_stored_prefixes_answer_questions(spark, texts, counter):
    rows = texts.where("doc_id in (4, 5, 7)").dropDuplicates(["doc_id"])
    stored = token_counts.prefix_counts(rows, PATH)
    asked = stored.select(
        "doc_id", F.size("counts").alias("n"), token_counts.fitting(F.col("counts"), F.lit(6)).alias("fit"),
        token_counts.tokens_at(F.col("counts"), F.lit(0)).alias("none"), token_counts.tokens_at(F.col("counts"), F.lit(3)).alias("three"),
        token_counts.tokens_at(F.col("counts"), F.lit(10**6)).alias("beyond"),
    )
    cut = {r["doc_id"]: r["fitting"] for r in token_counts.truncate(rows, PATH, 6).collect()}
    for r in asked.collect():
        text = rows.where(F.col("doc_id") == r["doc_id"]).first()["text"]
        counts = counter.counts(text).tolist()
        fit = max([i + 1 for i, n in enumerate(counts) if n <= 6], default=0)
        assert (r["n"], r["fit"], r["none"], r["three"], r["beyond"]) == (len(counts), fit, 0, counts[2], None)
        assert cut[r["doc_id"]] == "".join(counter.parts(text))[:fit]


def test_transducers_number_sorted_terms_and_give_them_back():
    rng = np.random.default_rng(0)
    terms = sorted({bytes(rng.choice(list(b"abc\xc3"), rng.integers(1, 8)).astype(np.uint8)) for _ in range(2000)} | {b"a" * 3000, b"a" * 3001})
    whole = divergence.build(terms)
    # minimal: as many states as different sets of endings
    prefixes = {t[:i] for t in terms if len(t) < 10 for i in range(len(t) + 1)}
    endings = {frozenset(t[len(p) :] for t in terms if t.startswith(p) and len(t) < 10) for p in prefixes}
    short = divergence.build([t for t in terms if len(t) < 10])
    assert len(short["below"]) == len(endings)
    runs = [("en", i, divergence.build(terms[i : i + 150])) for i in range(0, len(terms), 150)]
    cut = terms.index(b"a" * 3001)
    between = [("en", 0, divergence.build(terms[:cut])), ("en", cut, divergence.build(terms[cut:]))]
    for some, last in (([("en", 0, whole)], len(terms)), (runs, len(terms)), (runs[2:4], 600), (between, len(terms))):
        machine = divergence.Automaton(list(some))
        first = machine.first["en"]
        data = np.frombuffer(b"\0".join(terms) + b"\0zz\0", np.uint8)
        length = np.array([len(t) for t in terms] + [2])
        begin = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
        place = machine.walk(data, begin, length, np.full(len(length), machine.start["en"]))
        assert place.tolist() == [i - first if first <= i < last else -1 for i in range(len(terms))] + [-1]
        for i in range(0, len(terms), 13):
            assert machine.term("en", i) == (terms[i] if first <= i < last else None)


def test_divergence_equals_the_sql_in_any_number_of_runs(spark, small, monkeypatch):
    odd = spark.createDataFrame(
        [("", "tiny", None), ("ab " * 9, "tiny", "s1"), (None, None, None), ("ÄÖ xyzw " * 3, None, "only")] + [("same Words ÄÖ here", "tiny", f"s{i % 3}") for i in range(12)],
        "text string, lang string, source string",
    )
    docs = documents(spark, small).select("text", "lang", "source").unionByName(odd)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = sorted(con.execute(sql()["op12_source_divergence"]).fetchall())

    def rows(found):
        return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in found.collect())

    clashing = docs.select("*", *[F.lit(0).alias(c) for c in ("term", "n", "p", "part", "value", "rank", "ordinal", "_run", "item")])
    assert rows(divergence.audit(clashing)) == want
    monkeypatch.setattr(divergence, "RUN_TERMS", 40)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 64)
    assert rows(divergence.audit(docs, broadcast_bytes=6000)) == want
    assert divergence.audit(docs.limit(0)).count() == 0


def test_shares_stay_exact_for_large_counts():
    counts = np.array([0, 7, 9_300_000_000_000])
    total = 9_400_000_000_001
    assert divergence._shares(counts, total).tolist() == [1 + 10**9 * (int(c) + 2) // total for c in counts]


def plain_codes(rows):
    """Lloyd's rounds in whole numbers, one part at a time."""
    kept = [(i, v, y) for i, v, y in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not kept:
        return None
    width = -(-max(len(v) for _, v, _ in kept) // 16)
    kept = [(i, [math.floor(256 * c) for c in v] + [0] * (16 * width - len(v)), y) for i, v, y in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:64]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in first] for p in range(16)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(2):
        for p in range(16):
            parts = [cut(v, p) for _, v, _ in kept]
            codes = [nearest(x, books[p])[1] for x in parts]
            for j in range(len(books[p])):
                mine = [x for x, c in zip(parts, codes, strict=True) if c == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = []
    for i, v, y in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(16)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), y))
    by_label = {y: sum(r[2] for r in out if r[3] == y) for *_, y in out}
    text = ",".join(str(c) for book in books for e in book for c in e)
    return [(i, c, e, by_label[y], hashlib.sha256(text.encode()).hexdigest()) for i, c, e, y in out]


def vectors(n, width, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(c) for c in rng.normal(size=width) * 0.2], int(rng.integers(3)) or None) for i in rng.permutation(n)]
    rows += rows[:5] + [(None, rows[0][1], 1), (n, None, 1), (n + 1, [float("nan")] * width, 1), (n + 2, [None] * width, None), (n + 3, [float("inf")] * width, 2)]
    return rows


@pytest.mark.parametrize("n, width", [(400, 64), (90, 20), (30, 16), (1, 3), (200, 0)])
def test_vector_codes_equal_plain_rounds(spark, n, width):
    rows = vectors(n, width, n)
    if n == 90:
        rows += [(1000, rows[0][1][:7], None), (1001, [], 1)]  # shorter vectors
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, code int, _salt int").repartition(3)
    found = vector_codes.compress(table)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    assert sorted([tuple(r) for r in found.collect()], key=key) == sorted(plain_codes(rows), key=key)
    assert vector_codes.compress(table.limit(0)).count() == 0


def test_bounds_spare_distances_and_change_nothing():
    rng = np.random.default_rng(3)
    x = rng.integers(-200, 200, (500, 4)) + 1000 * rng.integers(0, 30, (500, 1))
    book = x[:64].copy()
    part = vector_codes.Part.measured(x, book, 6)
    assert part.verified == 500 * 64
    for step in (20, 20, 3, 400, 0):
        moved = book + rng.integers(-step, step + 1, book.shape)
        part.follow(x, moved, np.sqrt(((moved - book) ** 2).sum(axis=1)))
        squared = ((x[:, None] - moved) ** 2).sum(axis=2)
        assert part.code.tolist() == squared.argmin(axis=1).tolist()
        # every bound lies below its distance
        real = np.sqrt(np.take_along_axis(squared, part.near, axis=1))
        assert (part.low <= real + 1e-9).all()
        others = np.ones_like(squared, bool)
        np.put_along_axis(others, np.column_stack([part.near, part.code]), False, axis=1)
        assert (np.where(others, np.sqrt(squared), np.inf).min(axis=1) >= part.outer - 1e-9).all()
        assert part.verified < 500 * 64 or step == 400
        part.adapt()
        book = moved
    assert part.near.shape[1] < 6


def test_label_with_most_rows_and_large_components(spark):
    table = spark.range(300).select(F.col("id").alias("vec_id"), F.array([(F.col("id") * k % 7).cast("float") for k in range(16)]).alias("embedding"), F.lit("a").alias("label"))
    rows = vector_codes.compress(table).collect()
    assert len(rows) == 300 and {r["label_error"] for r in rows} == {sum(r["error"] for r in rows)}
    with pytest.raises(Exception, match="scale the vectors down"):
        vector_codes.compress(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>").withColumn("label", F.lit(1))).collect()
