"""Language ID, quality classifier, language model and BPE."""

import collections
import math
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import bpe, language_id, language_model, quality_classifier
from clickloom.llm.common import documents
from clickloom.llm.queries import registered


def test_languages_are_told_apart(spark, small):
    truth = {r["doc_id"]: r["lang"] for r in documents(spark, small).collect()}
    rows = registered()["op1_language_id"](spark, small).where("held_out").collect()
    assert rows and np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in rows]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows) and not any(r["rejected"] for r in rows)


def test_language_of_odd_texts(spark, small, texts):
    model = language_id.fit(documents(spark, small))
    odd = texts.withColumn("score", F.lit("mine"))  # a clashing name is replaced
    found = {r["text"]: r for r in language_id.identify(odd, model).collect()}
    for blank in (None, "", " \t\n"):
        assert (found[blank]["lang_pred"], found[blank]["score"], found[blank]["rejected"]) == ("und", 0.0, True)
    foreign = spark.createDataFrame([("Это предложение на другом языке. " * 10,)], "text string")
    assert language_id.identify(foreign, model).first()["rejected"]
    assert language_id.identify(texts.limit(0), model).count() == 0
    nothing = language_id.fit(documents(spark, small).limit(0))
    assert {r["lang_pred"] for r in language_id.identify(texts, nothing).collect()} == {"und"}


@pytest.fixture(scope="module")
def public():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_equals_the_public_library(spark, small, texts, public):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = texts.unionByName(documents(spark, small).select("doc_id", "text"))
    for r in bpe.encode(rows, path).join(rows.select("doc_id", F.col("text").alias("_t")), "doc_id").where("doc_id > 9").collect():
        assert r["ids"] == public.encode(r["_t"], add_special_tokens=False).ids
        assert r["decoded"] == public.decode(r["ids"], skip_special_tokens=False)
    enc = bpe.encoder(bpe.read_vocabulary(path))
    for text in [r["text"] or "" for r in texts.collect()] + ["ab" * 700 + "!?" * 400]:
        ids = public.encode(text, add_special_tokens=False).ids
        assert enc.encode(text).tolist() == ids
        assert " ".join(p[1] for p in enc.pieces(text)) == public.decode(ids, skip_special_tokens=False)
    assert bpe.digests(texts, path).count() == texts.count() and bpe.digests(texts.limit(0), path).count() == 0


def test_long_words_merge_like_short_ones():
    enc = bpe.encoder(bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))
    rng = np.random.default_rng(0)
    for n in (2, 10, 95, 400):
        data = rng.choice(list(b"aeinrst"), n)
        parts = [enc.inner[b] for b in data[:-1]] + [enc.last[data[-1]]]
        assert enc.merge_short(list(parts)) == enc.merge_long(list(parts))


def test_flat_trees_give_what_the_nested_ones_give():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, len(quality_classifier.STATISTICS)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality_classifier.grow(x, y)

    def walk(row, tree):
        node = 0
        for _ in range(quality_classifier.DEPTH):
            node = 2 * node + 1 + int(row[model["feature"][tree][node]] > model["above"][tree][node])
        return model["leaf"][tree][node - 2**quality_classifier.DEPTH + 1]

    p = quality_classifier.probabilities(x, model)
    slow = [1 / (1 + math.exp(-model["base"] - sum(walk(row, t) for t in range(len(model["leaf"]))))) for row in x[:50]]
    assert np.allclose(p[:50], slow) and ((p > 0.5) == (y > 0)).mean() > 0.95


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in registered()["op5_quality_classifier"](spark, sf).where("held_out").collect() if r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) > 0.9


def test_quality_without_labels(spark, texts):
    measured = quality_classifier.measure(texts, ["doc_id"])
    model = quality_classifier.fit(measured, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality_classifier.score(measured, model, ["doc_id"]).collect()} == {0.5}
    assert quality_classifier.measure(texts.limit(0), ["doc_id"]).count() == 0


def test_filter_never_reads_too_little():
    rng = np.random.default_rng(2)
    h, n = rng.integers(0, 2**63, 4000).astype(np.uint64), rng.zipf(1.5, 4000).clip(1, 100_000)
    bits, floor = 1 << 16, 1
    import pyarrow as pa

    blob = np.int64(0).tobytes() + language_model._narrow(h) + n.astype("<u4").tobytes()
    out = language_model._write_block(bits, floor)(pa.table({"block": pa.array([0], pa.int32()), "counts": pa.array([blob], pa.binary())}))
    seen = language_model.Filter(np.frombuffer(out.column("bits")[0].as_py(), np.uint8), 64, bits, floor)
    level = language_model.level_of(n)
    assert (seen.levels(h) >= level).all() and (seen.levels(h) == level).mean() > 0.7
    ratio = language_model.value_of(level) / n
    assert 0.75 < ratio.min() and ratio.max() < 1.3


def test_scores_of_the_language_model(spark, small):
    rows = registered()["op7_lm_scoring"](spark, small).collect()
    texts = {r["doc_id"]: r["text"] for r in documents(spark, small).collect()}
    words = {i: (t or "").encode().lower().split() + ["end"] for i, t in texts.items()}
    counts = collections.Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, types = sum(counts.values()), len(counts)
    for r in rows:
        ws = words[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in ws)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(counts[w] > 0 for w in ws), total)
        assert abs(r["base_score"] - base) < 1e-6 and r["score"] < 0
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_counts_of_one_reach_the_scores(spark, small, monkeypatch):
    """Any bound on the filter's size, where one exists, is set far below what all n-grams need."""
    defaults = language_model.build_filter.__defaults__
    monkeypatch.setattr(language_model.build_filter, "__defaults__", defaults and (1 << 13,) * len(defaults))
    for name, value in (("TOKENS_PER_BLOCK", 5000), ("BATCH", 3000)):
        monkeypatch.setattr(language_model, name, value, raising=False)
    rows = documents(spark, small).select(F.col("doc_id").alias("id"), (F.col("doc_id") % 7 == 0).alias("held_out"), "text")
    model, known = language_model.fit(rows.where("NOT held_out"))
    found = {r["id"]: r["score"] for r in language_model.score(rows, model, known).collect()}
    words = {r["id"]: ["."] + (r["text"] or "").encode().lower().split() + ["."] for r in rows.collect()}
    train = {r["id"] for r in rows.where("NOT held_out").collect()}
    one = collections.Counter(w for i in train for w in words[i][1:])
    two = collections.Counter(p for i in train for p in zip(words[i], words[i][1:]))
    level = lambda n: float(language_model.value_of(language_model.level_of(np.array([n])))[0]) if n else 0.0
    total, types = sum(one.values()), len(one)
    ratios = []
    for i, ws in words.items():
        want = 0.0
        for k, (v, w) in enumerate(zip(ws, ws[1:])):
            before = len(train) if k == 0 else level(one[v])
            pair = min(level(two[v, w]), before, level(one[w]))
            want += math.log10((pair + 200 * (level(one[w]) + 0.1) / (total + 0.1 * (types + 1))) / (before + 200))
        ratios.append(found[i] / want)
    assert len(found) == len(words) and abs(np.mean(ratios) - 1) < 0.01 and np.std(ratios) < 0.02


def test_language_model_on_odd_texts(spark, texts):
    rows = texts.select(F.col("doc_id").alias("id"), F.lit(False).alias("held_out"), "text")
    model, words = language_model.fit(rows)
    found = language_model.score(rows, model, words).collect()
    assert len(found) == texts.count() and all(math.isfinite(r["score"]) for r in found)
    model, words = language_model.fit(rows.limit(0))
    found = language_model.score(rows, model, words).collect()
    assert len(found) == texts.count() and {r["n_known"] for r in found} == {0}


def test_batches_of_texts_are_small_and_come_back_whole():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(i)}" for i in rng.zipf(1.3, 400) % 50_000) for _ in range(60)] + [None, ""]
    rows = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "held_out": [False] * len(texts), "text": texts})
    want = [language_model.tokens(t) for t in texts]
    seen, stored = 0, 0
    for batch in language_model._batches(10_000)(iter([rows])):
        row = batch.to_pylist()[0]
        lengths, word, at, _, _ = language_model._read_batch(row)
        stored += len(row["at"])
        assert np.array_equal(word[at], np.concatenate(want[seen : seen + len(lengths)]))
        seen += len(lengths)
    assert seen == len(texts)
    # 4 bytes a token before
    assert stored < 2.5 * sum(map(len, want))


def test_scoring_leaves_no_shuffle_files_of_its_steps(spark, monkeypatch):
    """They would lie beside the next step's until a garbage collection at some later time."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [d.getAbsolutePath() for d in disk.localDirs()]
    shuffled = lambda: {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    left, write = [], language_model.stage

    def stage(df, name, **options):
        before = shuffled()
        table = write(df, name, **options)
        left.append((name, shuffled() - before))
        return table

    monkeypatch.setattr(language_model, "stage", stage)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = spark.createDataFrame([(i, i % 10 == 0, f"word {i} and {i % 7}") for i in range(300)], "id long, held_out boolean, text string")
    model, words = language_model.fit(rows.where("NOT held_out"))
    assert language_model.score(rows, model, words).count() == 300
    assert left == [(name, set()) for name in ("tokens", "filter", "batches", "answers", "scored")]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
