"""The corpus pipeline: documents in, packed token sequences out.

Every stage gets what its predecessor kept, as a table read back from Parquet,
and all but the last return rows with the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import language_id, packing, quality_rules, simhash, suffix_dedup
from clickloom.llm.common import documents, remainder
from clickloom.sources.shipping import ship
from clickloom.sources.staging import stage

#: Passages of so many bytes that stand elsewhere too are cut: 50 words of five bytes with their blanks.
PASSAGE_BYTES = 250

#: SQL has no counterpart to these stages; tests hold run() against plain Python.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the centroids know; learnt from those that are not held out."""
    ship(spark)
    model = language_id.fit(docs.where(remainder("doc_id", 5) != 0))
    names = ("_lang", "_score", "_rejected")
    return language_id.identify(docs, model, names).where("NOT _rejected").select(docs.columns)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and resemble the texts labelled as good."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    ratios = quality_rules.log_ratios(docs, trusted)
    return quality_rules.judge(docs, ratios).where("kept").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship(spark)
    return simhash.keep_one(docs).select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeat elsewhere; an emptied text stays as an empty one."""
    ship(spark)
    cut = suffix_dedup.deduplicate(docs, PASSAGE_BYTES)
    text = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.withColumns(text).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences."""
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
