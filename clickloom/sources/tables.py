"""Reading and writing the tables of a run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schema import KEY


class MissingInput(FileNotFoundError):
    """A table or fitted artifact is not where it was looked for."""


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL, so that counts and means skip it."""
    return df.select(
        *[
            F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


#: Decimal numbers as they are written in files; what a cast takes beside them (1d, 0x1p3) is text.
_NUMBER = r"^\s*([-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?|[-+]?(nan|inf|infinity))\s*$"


def inferred_schema(spark: SparkSession, path: str) -> T.StructType:
    """Types of the columns of CSV files with a header line, from all values of all files.

    One pass counts, per column, the values that each candidate type can hold; the
    narrowest type that holds all of them is taken: int, bigint, double, string. A
    column without values is a string. Files whose headers differ raise an error.
    """
    # the header of one file; every other one is held against it
    names = _loaded(spark.read.option("header", True), path, "csv").schema
    table = _loaded(spark.read.schema(names).option("header", True).option("enforceSchema", False), path, "csv")
    checks = {"int": lambda c: c.try_cast("int"), "bigint": lambda c: c.try_cast("bigint")}
    cells = []
    for c in table.columns:
        text = F.col(f"`{c}`")
        whole = text.rlike(r"^\s*[-+]?\d+\s*$")
        held = [F.count(F.when(whole, check(text))).alias(kind) for kind, check in checks.items()]
        number = F.count(F.when(F.lower(text).rlike(_NUMBER), F.lit(1))).alias("double")
        cells.append(F.struct(F.count(text).alias("n"), *held, number))
    counts = table.agg(*[cell.alias(f"c{i}") for i, cell in enumerate(cells)]).first()
    fields = []
    for i, c in enumerate(table.columns):
        seen = counts[f"c{i}"]
        kind = next((k for k in (*checks, "double") if seen["n"] and seen[k] == seen["n"]), "string")
        fields.append(T.StructField(c, T._parse_datatype_string(kind)))
    return T.StructType(fields)


def _loaded(reader, path: str, fmt: str) -> DataFrame:
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            raise MissingInput(path) from err
        raise


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    nan_as_null: bool | None = None,
    nested: bool = False,
) -> DataFrame:
    """Scan parquet, or CSV with a header line; a CSV without a schema takes one more pass to infer it.

    NaN becomes NULL in CSV scans, and in others on request: the check hides a
    column from filter pushdown, and tables written by this library hold none.
    ``nested`` reads the files of all folders below the path.
    """
    if fmt == "csv" and schema is None:
        schema = inferred_schema(spark, path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if nested:
        reader = reader.option("recursiveFileLookup", True)
    table = _loaded(reader, path, fmt)
    return nan_to_null(table) if (fmt == "csv" if nan_as_null is None else nan_as_null) else table


def write_table(df: DataFrame, path: str, fmt: str = "parquet", index: str | None = None) -> str:
    """Write a directory of parts; ``index`` names the column put first."""
    if index is not None:
        df = df.select(index, *[c for c in df.columns if c != index])
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def write_report(lines: DataFrame, path: str) -> str:
    """Write the short text report (part, pos, line) as one file, in order."""
    ordered = lines.orderBy(F.asc_nulls_first("part"), "pos").select("line")
    ordered.coalesce(1).write.mode("overwrite").text(path)
    return path


def export_rows(df: DataFrame, path: str, **equals: object) -> str:
    """Write the rows of a filtered result as CSV (session, profile or report)."""
    for name, value in equals.items():
        df = df.where(F.col(name) == F.lit(value))
    return write_table(df, path, fmt="csv", index=KEY if KEY in df.columns else None)
