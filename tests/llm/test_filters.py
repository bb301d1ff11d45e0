"""Quality rules, URL filters and packing."""

import collections
import datetime
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import oracles, packing, quality_rules, url_filters
from clickloom.llm.common import documents
from clickloom.llm.queries import registered
from tools.check_queries import canonical


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def hashes(words):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    pack = lambda x, seed: xxhash.xxh64_intdigest(int(x).to_bytes(8, "little"), seed)
    return h + [pack(b, pack(a, 42)) for a, b in zip(h, h[1:])]


def test_quality_rules_against_plain_python(spark, texts, small):
    docs = documents(spark, small).select("doc_id", "text").unionByName(texts.where("doc_id IS NOT NULL").withColumn("doc_id", F.col("doc_id") + 10**6))
    trusted = spark.read.parquet(f"{small}/labels.parquet").where("quality = 1").select("doc_id")
    rows = quality_rules.judge(docs, quality_rules.log_ratios(docs, trusted)).collect()
    names, plain = {r["doc_id"] for r in trusted.collect()}, [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in plain}
    mask = quality_rules.BUCKETS - 1
    raw, target = collections.Counter(), collections.Counter()
    for i, _ in plain:
        buckets = [h & mask for h in hashes(words[i])]
        raw.update(buckets)
        if i in names:
            target.update(buckets)
    scale = sum(target.values()) / sum(raw.values())
    ratio = {b: np.log((target[b] + quality_rules.ADD) / (raw[b] * scale + quality_rules.ADD)) for b in raw}
    by_id = dict(plain)
    for r in rows:
        found = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert found == base_counts(by_id[r["doc_id"]])
        grams = hashes(words[r["doc_id"]])
        score = np.mean([ratio[h & mask] for h in grams]) if grams else 0.0
        assert abs(score - r["ratio_score"]) < 1e-9
        assert r["kept"] == (not r["base_failed"] and r["ratio_score"] >= quality_rules.THRESHOLD)


def test_quality_rules_without_trusted_or_documents(spark, texts):
    none = spark.createDataFrame([], "doc_id long")
    odd = texts.withColumn("kept", F.lit("clash"))
    rows = quality_rules.judge(odd, quality_rules.log_ratios(odd, none))
    assert {r["ratio_score"] for r in rows.collect()} == {0.0} and rows.count() == texts.count()
    assert quality_rules.judge(texts.limit(0), quality_rules.log_ratios(texts.limit(0), none)).count() == 0


def test_quality_rules_keep_the_names_of_the_caller(spark, texts):
    inner = ["_text", "_words", "_hashes", "_row", "_kept", "_ratios", "_one", "_raw", "_trusted", "_salt", "_id", "h", "bucket"]
    docs = texts.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(0))).alias(c) for c in inner])
    ratios = quality_rules.log_ratios(docs, spark.createDataFrame([(7, "x"), (None, "y"), (7, "z")], "doc_id long, _salt string"))
    rows = quality_rules.judge(docs, ratios).collect()
    assert sorted((str(r["doc_id"]), *[r[c] for c in inner]) for r in rows) == sorted((str(r["doc_id"]), *[r[c] for c in inner]) for r in docs.collect())
    # doc 7 and its equal, doc 8, hold the trusted n-grams
    score = {r["doc_id"]: r["ratio_score"] for r in rows}
    assert score[7] == score[8] > score[5]


def test_all_trusted_ids_count(spark):
    """Every row of the trusted ids is in the target, however many there are."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("alpha beta w"), F.col("id") % 7).alias("text"))
    trusted = docs.where("doc_id % 3 = 0").select("doc_id")
    ratios = quality_rules.log_ratios(docs, trusted).first()["ratios"]
    h = spark.sql("SELECT CAST(xxhash64('alpha') & 65535 AS INT)").first()[0]
    assert ratios[h] == pytest.approx(0.0, abs=1e-9)


def test_labels_separate(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in registered()["op10_quality_rules"](spark, sf).collect() if r["doc_id"] in labels and not r["base_failed"]]
    assert all(r["kept"] == (labels[r["doc_id"]] == 1) for r in rows)


def test_url_filters_against_sql(spark, small):
    con = duckdb.connect()
    for path in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    ours, theirs = registered()["op3_url_filters"](spark, small).toPandas(), con.execute(oracles.sql()["op3_url_filters"]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and canonical(ours) == canonical(theirs)
    assert ours["blocked"].nunique() == 2


def test_url_intervals(spark):
    day = lambda n: datetime.date(2024, 1, n)
    entries = spark.createDataFrame(
        [
            ("l", "domain:x.org", day(3), True), ("l", "domain:x.org", day(5), True), ("l", "domain:x.org", day(8), False),
            ("l", "domain:x.org", day(8), False), ("l", "domain:x.org", day(9), False), ("l", "domain:x.org", day(12), True),
            ("l", "section:y.org/a", day(2), True), ("l", "domain:z.org", day(4), False), ("l", "domain:z.org", day(4), True),
            (None, "domain:y.org", day(1), True), ("l", None, day(1), True), ("l", "domain:y.org", None, True),
        ],
        "list string, pattern string, day date, added boolean",
    )
    captures = spark.createDataFrame(
        [
            (1, "http://x.org/", day(2)), (2, "http://a.x.org:80/q", day(3)), (3, "https://u:p@X.ORG", day(7)), (4, "http://x.org", day(8)),
            (5, "http://x.org", day(31)), (6, "http://y.org/a/b", day(2)), (7, "http://y.org/ab", day(2)), (8, "http://z.org", day(4)),
            (9, None, day(4)), (10, "not a url", day(4)), (11, "http://x.org", None), (12, "http://xx.org", day(4)),
            (2, "http://a.x.org:80/q", day(3)), (13, "http://" + "a." * 200 + "x.org", day(4)),
        ],
        "page_id long, url string, fetched date",
    )
    rows = url_filters.judge(captures, entries).collect()
    assert len(rows) == 14 and sorted(r["page_id"] for r in rows if r["blocked"]) == [2, 2, 3, 5, 6, 8]
    assert {r["listed_since"] for r in rows if r["page_id"] in (2, 3)} == {day(3)}
    assert url_filters.judge(captures, entries.limit(0)).where("blocked").count() == 0
    assert url_filters.judge(captures.limit(0), entries).count() == 0


@pytest.mark.parametrize("count", [0, 1, 2, 7, 300])
def test_windows_are_nearly_equal(count):
    sizes = np.random.default_rng(count).integers(1, 512, count).tolist()
    place, windows = packing.pack(sizes, 2048)
    sums = np.bincount(place, sizes, windows)
    assert sums.max(initial=0) <= 2048 and sums.sum() == sum(sizes) and windows >= -(-sum(sizes) // 2048)
    if count == 300:
        assert sums.max() - sums.min() < 100


def test_window_count_rises_when_capacity_is_exceeded():
    place, windows = packing.pack([6, 6, 6], 9)
    assert windows == 3 and sorted(place.tolist()) == [0, 1, 2]


def test_packing(spark, texts, small):
    path = public_tokenizers.path("byte_bpe_50k.json")
    public = Tokenizer.from_file(path)
    docs = texts.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(documents(spark, small).select(F.col("doc_id") + 100, "text").toDF("doc_id", "text"))
    rows = packing.pack_documents(docs, path).collect()
    pieces, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    for r in docs.collect():
        ids, at = [*public.encode(r["text"] or "", add_special_tokens=False).ids, 1], 0
        for p in sorted(pieces[r["doc_id"]], key=lambda p: p["start"]):
            part = np.array(ids[at : at + p["length"]], "<u4")
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += p["length"]
        assert at == len(ids)
    for held in windows.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    assert sum(r["length"] for r in rows) > 0.9 * 2048 * len(windows)
    assert packing.pack_documents(texts, path).where("doc_id = 4").count() == 2
    assert packing.pack_documents(texts.limit(0), path).count() == 0
