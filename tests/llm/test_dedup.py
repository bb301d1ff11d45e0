"""Suffix-array, SimHash and embedding deduplication, and the pipeline."""

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import embedding_dedup, queries, simhash, suffix_dedup
from clickloom.llm.common import documents


def groups(n, links):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(a) for a in range(n)]


def removed_by_brute_force(data, length=400):
    seen = collections.Counter(d[j : j + length] for d in data for j in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, int)
        for j in range(len(d) - length + 1):
            if seen[d[j : j + length]] > 1:
                gone[j] += 1
                gone[j + length] -= 1
        out.append(gone.cumsum()[:-1] > 0)
    return out


@pytest.mark.parametrize("trial", range(60))
def test_suffix_arrays_find_repeated_windows(trial):
    rng = np.random.default_rng(trial)
    length = int(rng.choice([1, 3, 8, 13, 40]))
    base = bytes(rng.choice(list(b"ab\x00"), 300).tolist())
    parts = []
    for _ in range(rng.integers(1, 8)):
        k, a = int(rng.integers(1, 60)) + length - 1, int(rng.integers(0, 200))
        parts.append([base[a : a + k], bytes(rng.choice(list(b"abc"), k).tolist()), b"a" * k][rng.integers(0, 3)])
    counts, weights = [len(p) - length + 1 for p in parts], rng.choice([1, 1, 2], len(parts)).tolist()
    seen = collections.Counter()
    for p, c, w in zip(parts, counts, weights):
        for j in range(c):
            seen[p[j : j + length]] += w
    for found, p in zip(suffix_dedup.repeated_windows(parts, counts, weights, length), parts):
        assert found.tolist() == [seen[p[j : j + length]] > 1 for j in range(len(found))]


@pytest.mark.parametrize("most", [1, 1500])
def test_repeated_passages_go(spark, small, texts, monkeypatch, most):
    """With most = 1 every anchor takes the way of the crowded ones."""
    monkeypatch.setattr(suffix_dedup, "MOST_SEGMENTS", most)
    passage = "".join(map(chr, np.random.default_rng(5).integers(97, 123, 450)))
    edge = [(100 + i, f"{i} start {i * 7919}" + passage + f"end {i * 104729} {i}") for i in range(30)]
    docs = documents(spark, small).select("doc_id", "text").limit(80).unionByName(texts).unionByName(spark.createDataFrame(edge, texts.schema))
    docs = docs.withColumn("n_spans", docs.doc_id)  # a clashing name is replaced
    rows = suffix_dedup.deduplicate(docs).collect()
    data = [suffix_dedup.data_of(r["text"]) for r in rows]
    for r, d, gone in zip(rows, data, removed_by_brute_force(data)):
        rest = np.frombuffer(d, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(d), gone.sum(), runs, hashlib.sha256(rest).hexdigest())
    assert len(rows) == docs.count()
    assert suffix_dedup.deduplicate(texts.limit(0)).count() == 0


def test_thresholds_add_up():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 2**63, 200)
    bits = simhash.partition_bits(np.full((64, 64), 50) + np.diag([50] * 64), 200, 3)
    assert sorted(b for g in bits for b in g) == list(range(64))
    values = simhash.part_values(fps, bits)
    found = simhash.allocate(values, [len(g) for g in bits], rng.integers(0, 500, (3, simhash.CELLS)), 3)
    assert (found.sum(axis=0) == 1).all() and found.min() >= -1 and len(np.unique(found, axis=1).T) > 1


def test_simhash_against_brute_force(spark, small, texts):
    """A cloud of fingerprints, chains of links, far ones, and texts of all kinds."""
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 2**63, 300).astype(np.uint64)
    for k in range(200):
        flips = rng.choice(64, rng.integers(1, 6), replace=False)
        fps = np.r_[fps, fps[rng.integers(0, 20)] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))]
    fps = np.unique(fps)
    rows = simhash.components(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")).collect()
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    want = groups(len(fps), np.argwhere(np.triu(near, 1)))
    root = {np.int64(r["fp"]).astype(np.uint64): r["root"] for r in rows}
    pairs = {(w, root[x]) for w, x in zip(want, fps)}
    assert len(rows) == len(fps) and len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})

    docs = documents(spark, small).select("doc_id", "text").unionByName(texts)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    texts_of = {r["doc_id"]: r["text"] for r in documents(spark, small).collect()}
    for r in found:
        if r["doc_id"] and r["doc_id"] > 9:
            assert np.uint64(simhash.fingerprint(texts_of[r["doc_id"]], 3)) == np.int64(r["fp"]).astype(np.uint64)
    blank = {r["component_id"] for r in found if r["fp"] == 0}
    assert blank == {1}
    assert simhash.near_duplicates(texts.limit(0)).count() == 0


def test_one_of_each_group_stays(spark, texts):
    kept = simhash.keep_one(texts).collect()
    ids = [r["doc_id"] for r in kept]
    assert ids.count(1) == 1 and not {2, 3, 8} & set(ids) and ids.count(4) == 1 and ids.count(None) == 1 and 7 in ids


def test_fingerprint_of_short_texts():
    import xxhash

    assert simhash.fingerprint(None, 3) == simhash.fingerprint(" \n", 3) == 0
    assert simhash.fingerprint("One TWO", 3) == xxhash.xxh64_intdigest(b"one two", 42)


@pytest.mark.parametrize("rows", [8, 512])
def test_vectors_against_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(embedding_dedup, "LIST_ROWS", rows)
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(12, 16))
    x = [c + rng.normal(size=16) * s for c in centers for s in (0.02, 0.05, 0.1, 0.1, 0.6, 1.0)]
    data = [(i, [float(v) for v in row], i % 2) for i, row in enumerate(x)] + [(500 + i, [float(v) for v in x[0]], 0) for i in range(40)]
    data += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, [1.0, None], 1), (204, data[0][1], None), (205, [1.0, 2.0], 1), (None, data[0][1], 0)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(frame).collect()}
    usable = [(i, np.array(v), lab) for i, v, lab in data if i not in (200, 201, 202, 203, 204, 205)]
    m = np.array([v / np.linalg.norm(v) for _, v, _ in usable])
    label = np.array([lab for *_, lab in usable])
    near = (m @ m.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    links = sum(found[i]["n_links"] for i, *_ in usable)
    assert len(found) == len(data) and 0.9 * near.sum() <= links <= near.sum()
    assert all(found[i]["n_links"] <= k for (i, *_), k in zip(usable, near.sum(axis=1)))
    for i in (200, 201, 202, 203, 204, 205):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def recall(spark, x, least=0.93):
    rows = spark.createDataFrame([(i, row.tolist(), 0) for i, row in enumerate(x)], "vec_id long, embedding array<double>, label int")
    found = embedding_dedup.near_duplicates(rows, least).agg({"n_links": "sum"}).first()[0]
    m = x / np.linalg.norm(x, axis=1, keepdims=True)
    total = sum(int((m[a : a + 2000] @ m.T >= least).sum()) for a in range(0, len(m), 2000)) - len(m)
    assert total and found <= total
    return found / total


@pytest.mark.parametrize("rows", [2000, 12000])
def test_recall_on_a_hot_jittered_group(spark, rows):
    """A third of the rows are near copies of one vector, with a cosine of about 0.95 to each other."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(rows, 64))
    x[: rows // 3] = x[0] + rng.normal(size=(rows // 3, 64)) * 0.23
    assert recall(spark, x) >= 0.9


def test_vectors_of_one_group_only(spark):
    rng = np.random.default_rng(8)
    assert recall(spark, rng.normal(size=64) + rng.normal(size=(1500, 64)) * 0.23) == 1


def test_links_of_a_rare_vector_length(spark):
    """Six near copies of a length that hardly any pivot is drawn from."""
    rng = np.random.default_rng(9)
    x = [*rng.normal(size=(2000, 16)), *(rng.normal(size=8) + rng.normal(size=(6, 8)) * 0.01)]
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    found = embedding_dedup.near_duplicates(rows).where("vec_id >= 2000").collect()
    assert [(r["n_links"], r["component_id"]) for r in found] == [(5, 2000)] * 6


def test_recall_on_the_given_vectors(spark):
    """The given vectors hold no links: near copies of some are planted."""
    rng = np.random.default_rng(11)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").where("label IS NOT NULL").orderBy("vec_id").toPandas()
    planted = [
        (10**9 + i, (np.array(v, float) + rng.normal(size=len(v)) * 0.01 * np.linalg.norm(v) / len(v) ** 0.5).tolist(), int(y))
        for i, (v, y) in enumerate(zip(rows["embedding"][:400], rows["label"][:400]))
    ]
    every = [(int(i), list(map(float, v)), int(y)) for i, v, y in zip(rows["vec_id"], rows["embedding"], rows["label"])] + planted
    total = 0
    for label in {y for *_, y in every}:
        m = np.array([v for _, v, y in every if y == label])
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        total += int((m @ m.T >= 0.93).sum()) - len(m)
    vectors = spark.createDataFrame(every, "vec_id long, embedding array<double>, label int")
    found = embedding_dedup.near_duplicates(vectors).agg({"n_links": "sum"}).first()[0]
    assert total >= 800 and 0.9 * total <= found <= total


@pytest.mark.parametrize("copies", [200, 400])
def test_copies_of_a_row_are_gathered_once(spark, copies):
    """The spans of a repeated row do not grow with its copies."""
    rng = np.random.default_rng(6)
    text = "".join(map(chr, rng.integers(97, 123, 1500)))
    others = [(1000 + i, "".join(map(chr, rng.integers(97, 123, 700)))) for i in range(copies)]
    docs = spark.createDataFrame([(1, text)] * copies + others, "doc_id long, text string")
    found = suffix_dedup.repeated_spans(docs).collect()
    # some segments of one text, whatever the copies: their anchors lie a window's width apart on average
    assert len(found) == 1 and len(found[0]["found"]) < 40
    rows = suffix_dedup.deduplicate(docs).collect()
    assert [(r["n_removed"], r["n_spans"]) for r in rows if r["doc_id"] == 1] == [(1500, 1)] * copies
    assert not any(r["n_removed"] for r in rows if r["doc_id"] != 1)


def test_op2_returns_what_is_left(spark, folder):
    """A passage goes from 400 bytes on, the contract's length; the text left, without halves of characters, matches the digests."""
    rng = np.random.default_rng(8)
    words = lambda n: " ".join("".join(map(chr, rng.integers(97, 123, 5))) for _ in range(n))
    long, short = words(67)[:400], words(67)[:399]
    # the passage of the last two ends amid a character: both share its first byte only
    split = words(67)[:399]
    rows = [(1, "A" + long + "B"), (2, "C" + long + "D"), (3, "E" + short + "F"), (4, "G" + short + "H"), (5, words(200)), (6, None), (7, "I" + split + "é"), (8, "J" + split + "ü")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.registered()["op2_suffix_array_dedup"](spark, folder).collect()}
    want = dict(rows) | {1: "AB", 2: "CD", 6: "", 7: "I", 8: "J"}
    assert {k: r["text"] for k, r in found.items()} == want
    assert {k: r["n_removed"] for k, r in found.items()} == {1: 400, 2: 400, 3: 0, 4: 0, 5: 0, 6: 0, 7: 400, 8: 400}
    assert all(r["kept_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest() for k, r in found.items() if k < 7)


def test_names_of_the_caller_stay(spark, texts):
    """Columns named like inner ones come out as they went in."""
    inner = ["_h", "_id", "_found", "h", "id", "found", "_found_id", "__h", "n", "_n", "_kept_id", "k", "_f", "fp", "root"]
    docs = texts.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(0))).alias(c) for c in inner])
    want = sorted((str(r["doc_id"]), *[r[c] for c in inner]) for r in docs.collect())
    cut = suffix_dedup.deduplicate(docs)
    assert cut.columns[: len(docs.columns)] == docs.columns
    assert sorted((str(r["doc_id"]), *[r[c] for c in inner]) for r in cut.collect()) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {(str(r["doc_id"]), *[r[c] for c in inner]) for r in kept.collect()} <= set(want)


def test_pipeline_against_brute_force(spark, small):
    docs = documents(spark, small)
    columns = docs.columns
    steps = {"documents": docs}
    for name, apply in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(apply(spark, docs, small), name)
        steps[name] = docs
        if name != "packing":
            assert docs.columns == columns
    rows = {k: v.collect() for k, v in steps.items()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").collect()}
    assert {r["doc_id"] for r in rows["language_id"]} == {r["doc_id"] for r in rows["documents"]}
    long = {r["doc_id"] for r in rows["documents"] if len(r["text"].split()) >= 50}
    assert good & long <= {r["doc_id"] for r in rows["quality_rules"]}
    before = sorted(rows["quality_rules"], key=lambda r: r["doc_id"])
    fps = np.array([simhash.fingerprint(r["text"], 3) for r in before], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    first = set(groups(len(fps), np.argwhere(np.triu(near, 1))))
    assert sorted(r["doc_id"] for r in rows["simhash_near_dedup"]) == [before[i]["doc_id"] for i in sorted(first)]
    kept = rows["simhash_near_dedup"]
    data = [r["text"].encode() for r in kept]
    cut = {r["doc_id"]: np.frombuffer(d, np.uint8)[~g].tobytes().decode("utf-8", "ignore") for r, d, g in zip(kept, data, removed_by_brute_force(data, corpus_pipeline.PASSAGE_BYTES))}
    assert {r["doc_id"]: r["text"] for r in rows["suffix_array_dedup"]} == cut
    assert all(r["n_chars"] == len(r["text"]) for r in rows["suffix_array_dedup"])
    held = collections.Counter()
    for r in rows["packing"]:
        held[r["doc_id"]] += r["length"]
    assert set(held) == set(cut) and all(held[r["doc_id"]] == r["doc_tokens"] for r in rows["packing"])
    assert corpus_pipeline.run(spark, small).count() == len(rows["packing"])
