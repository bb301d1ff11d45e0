"""Helpers shared by the operators on texts and vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a kernel takes out of an Arrow batch at a time.
SLICE_ROWS = 512


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id's text modulo ``divisor``; 0 (held out) where the id is null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor, F.lit(0))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces small enough to be held as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sample_below(ids: DataFrame, id_col: str, bound: int) -> DataFrame:
    """At most ``bound`` rows, chosen by a hash of the id: the same rows on every run."""
    return ids.orderBy(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), id_col).limit(bound)


def spare(columns: list[str], *stems: str) -> list[str]:
    """Names made of the stems that the given columns do not use."""
    taken = {c.lower() for c in columns}
    mark = "_"
    while any(f"{mark}{s}".lower() in taken for s in stems):
        mark += "_"
    return [f"{mark}{s}" for s in stems]


def extended(schema: T.StructType, *more: tuple[str, str]) -> T.StructType:
    """A schema with further (name, type) columns; the given one stays as it is."""
    return T.StructType([*schema.fields, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in more]])
