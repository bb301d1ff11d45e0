"""Registered queries of this subpackage: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    bpe, divergence, embedding_dedup, language_id, language_model, packing, quality_classifier, quality_rules, simhash, suffix_dedup,
    token_counts, url_filters, vector_codes,
)
from clickloom.llm.common import documents, remainder
from clickloom.sources.staging import stage

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Query] = {}

QUALITY_CUT = 0.3
TOKEN_LIMIT = 2048


def query(fn: Query) -> Query:
    _registered[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_registered)


@query
def op1_language_id(spark, sf):
    """Language of every document, learnt from the documents that are not held out."""
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(remainder("doc_id", 5) != 0))
    rows = docs.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "text")
    return language_id.identify(rows, model).drop("text")


@query
def op4_bpe_codec(spark, sf):
    return bpe.digests(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_quality_classifier(spark, sf):
    docs = documents(spark, sf).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "text")
    measured = stage(quality_classifier.measure(docs, ["doc_id", "held_out"]), "statistics")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    model = quality_classifier.fit(measured.where(~F.col("held_out")), labels)
    scored = quality_classifier.score(measured, model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


@query
def op7_lm_scoring(spark, sf):
    docs = documents(spark, sf).select(F.col("doc_id").alias("id"), (remainder("doc_id", 10) == 0).alias("held_out"), "text")
    model, words = language_model.fit(docs.where(~F.col("held_out")))
    return language_model.score(docs, model, words).withColumnRenamed("id", "doc_id")


@query
def op8_packing(spark, sf):
    return packing.pack_documents(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json"))


FIRST_DAY = "2024-01-01"


def captures(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a capture, with a fetch day that follows from its id."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("page_id") * 13 % 365).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))


def list_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Dated entries of two lists, derived from the pages: hosts of every fifth page, sections of every seventh."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").where("page_id IS NOT NULL")
    url, id_ = F.col("url"), F.col("page_id")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (id_ * 29 % 365).cast("int"))
    domains = pages.where(id_ % 5 == 0).select(
        F.lit("blocked").alias("list"), F.concat(F.lit("domain:"), url_filters.host_of(url)).alias("pattern"),
        day.alias("day"), (F.floor(id_ / 5) % 3 != 0).alias("added"),
    )
    section = F.element_at(url_filters.patterns_of(url), -1)
    sections = pages.where(id_ % 7 == 0).select(
        F.lit("spam").alias("list"), F.when(section.startswith("section:"), section).alias("pattern"),
        day.alias("day"), (F.floor(id_ / 7) % 2 == 0).alias("added"),
    )
    return domains.unionByName(sections)


@query
def op3_url_filters(spark, sf):
    judged = url_filters.judge(captures(spark, sf), list_entries(spark, sf))
    return judged.withColumns({c: F.col(c).cast("string") for c in ("fetched", "listed_since")})


@query
def op6_simhash_near_dedup(spark, sf):
    found = simhash.near_duplicates(documents(spark, sf))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def trusted_ids(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").select("doc_id")


@query
def op10_quality_rules(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    ratios = quality_rules.log_ratios(docs, trusted_ids(spark, sf))
    return quality_rules.judge(docs, ratios).drop("text")


@query
def op2_suffix_array_dedup(spark, sf):
    """What is left of every text, in digests and as text without characters cut in two."""
    docs = documents(spark, sf).select("doc_id", "text")
    cut = suffix_dedup.deduplicate(docs)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept_text").alias("text"))


@query
def op9_embedding_near_dedup(spark, sf):
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query
def op11_token_counts(spark, sf):
    return token_counts.token_counts(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"), TOKEN_LIMIT)


@query
def op12_source_divergence(spark, sf):
    return divergence.audit(documents(spark, sf))


@query
def op13_vector_codes(spark, sf):
    return vector_codes.compress(spark.read.parquet(f"{sf}/embeddings.parquet"))
