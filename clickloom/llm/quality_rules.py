"""Quality rules: n-gram log-likelihood ratio between trusted texts and the corpus.

Words and pairs of adjacent words are hashed into buckets. Two multinomials over
the buckets are estimated with additive smoothing: one from trusted texts, one
from all texts. A document's score is the mean, over its n-grams, of the log
ratio of the two. Every document whose score reaches a fixed threshold is kept;
nothing is drawn at random. Plain counts of words, symbols, repeated lines and
repeated three-word windows make a base rule next to it.

All of it is DataFrame expressions: no Python runs on the executors.

Defined results: a null text has no words and fails the base rule, like an empty
one. Repeated rows are judged row by row, and no result depends on an order, so there
are no ties. Without trusted texts, or without any n-gram, the score is 0. Null ids are
never trusted; repeated ones are trusted together. Texts are read whole; windows are
compared by their 64-bit hash. An empty table gives an empty one. Further columns, of
whatever name but those of the results, are carried over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.sources.staging import stage

BUCKETS = 1 << 16
#: Places over which rows without an id are spread in the join with the trusted ids.
SALTS = 64
#: Added to every bucket's count.
ADD = 4.0
THRESHOLD = -0.07
#: Base rule (fixed values).
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3
BLANKS, SYMBOLS = " \t\n\x0b\x0c\r", "[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{BLANKS}]+"), "")


def windows_of(hashes: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` adjacent words."""
    runs = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, size)]))
    return F.slice(runs, 1, F.greatest(F.size(hashes) - (size - 1), F.lit(0)))


def bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _with_hashes(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds the text without null, its words, and the words' hashes."""
    docs = docs.withColumn("_text", F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).withColumn("_words", words_of(F.col("_text")))
    return docs.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row with ``ratios``, an array of the buckets' log ratios.

    ``trusted`` holds ids: all rows with one of them stand for the target. The
    corpus counts cover all of ``docs``.
    """
    chosen = trusted.select(F.col(f"`{id_col}`").alias("_id")).where("_id IS NOT NULL").distinct()
    # the ids grow with the documents, so both sides are dealt out by id at every size; the ids are the small side
    chosen = chosen.select("_id", F.lit(0).alias("_salt"), F.lit(1).alias("_trusted")).hint("shuffle_hash")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_raw"))
    salt = F.when(F.col("_id").isNull(), F.pmod(F.xxhash64("_raw"), F.lit(SALTS)).cast("int")).otherwise(0)
    rows = _with_hashes(rows.withColumn("_salt", salt).join(chosen, ["_id", "_salt"], "left").select("_trusted", "_raw"), "_raw")
    hashes = F.col("_hashes")
    grams = rows.select("_trusted", F.explode(F.concat(hashes, windows_of(hashes, 2))).alias("h")).select("_trusted", bucket(F.col("h")).alias("bucket"))
    counts = stage(grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("target")), "buckets")
    sums = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    raw, target = sums["raw"] or 0, sums["target"] or 0
    # the corpus counts at the target's size, so that both are smoothed alike and rare buckets say little
    expected = F.coalesce("raw", F.lit(0)) * F.lit(target / max(raw, 1))
    ratio = F.log((F.coalesce("target", F.lit(0)) + ADD) / (expected + ADD))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    table = every.join(counts, "bucket", "left").select("bucket", ratio.alias("ratio"))
    return table.agg(F.sort_array(F.collect_list(F.struct("bucket", "ratio"))).alias("x")).select(F.col("x.ratio").alias("ratios"))


def judge(docs: DataFrame, ratios: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the base counts, the score and the verdict; columns of these names are replaced."""
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio_score", "kept"]
    keep = [c for c in docs.columns if c not in out]
    # the caller's columns travel in one, so that no name of theirs meets a name of ours
    rows = _with_hashes(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(0)).alias("_kept"), F.col(f"`{text_col}`").alias("_raw")), "_raw")
    hashes, text = F.col("_hashes"), F.col("_text")
    rows = rows.select(
        "_kept", "_text", "_words", "_hashes",
        F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "").alias("_lines"),
        windows_of(hashes, WINDOW).alias("_windows"),
    )
    windows = F.col("_windows")
    # windows in order of their hash, only where one occurs twice
    rows = rows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    s = F.col("_sorted")
    same = lambda k, h: F.coalesce(F.get(s, k)["h"] == h, F.lit(False))
    rows = rows.withColumn(
        "_again", F.sort_array(F.transform(F.filter(s, lambda x, k: same(k - 1, x["h"]) | same(k + 1, x["h"])), lambda x: x["i"]))
    )
    again = F.col("_again")
    covered = F.transform(again, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(again, k + 1) - p, F.lit(WINDOW))))
    count = lambda x: x.cast("long")
    rows = rows.select(
        "_kept", count(F.size("_words")).alias("n_words"),
        count(F.length(F.array_join("_words", ""))).alias("word_chars"),
        count(F.regexp_count(text, F.lit(SYMBOLS))).alias("n_symbols"),
        count(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        count(F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))).alias("n_repeat_words"),
        F.concat(hashes, windows_of(hashes, 2)).alias("_grams"), F.monotonically_increasing_id().alias("_row"),
    )
    # the one row of ratios reaches every document
    rows = rows.withColumn("_one", F.lit(1)).join(F.broadcast(ratios.select(F.lit(1).alias("_one"), F.col("ratios").alias("_ratios"))), "_one")
    total = F.aggregate("_grams", F.lit(0.0), lambda a, h: a + F.get("_ratios", bucket(h)))
    rows = rows.withColumn("ratio_score", F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(F.lit(0.0))).drop("_grams", "_ratios", "_one")
    # a filter on the verdict must not be moved below this: it would take the arrays' definitions into the look-ups
    rows = rows.where("_row >= 0").drop("_row")
    rows = rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("ratio_score") >= threshold))
    return rows.select(*[F.col(f"_kept.`{c}`") for c in keep], *out)
