"""File sources: CSV, JSON Lines, text.

Production reads should pass an explicit schema: inference costs an extra
pass over the data (CSV) or a sampling pass (JSON), and a few polluted
values silently turn a numeric column into strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _with_mode(reader, schema: StructType | str | None, mode: str, corrupt_column: str | None):
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.option("mode", mode)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader


def read_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    infer_schema: bool = False,
    schema: StructType | str | None = None,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV with a header.

    ``schema`` imposes types (S3); without it, ``infer_schema=True`` asks
    Spark to infer them (S1, one extra pass) and the default keeps every
    column a string (S2).  With ``corrupt_column`` (a string field of the
    schema) malformed lines are kept and flagged instead of failing.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
    if schema is None and infer_schema:
        reader = reader.option("inferSchema", True)
    return _with_mode(reader, schema, mode, corrupt_column).csv(path)


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
) -> DataFrame:
    """JSON Lines (one object per line); pass ``schema`` to skip inference."""
    return _with_mode(spark.read, schema, mode, corrupt_column).json(path)


def read_text(spark: SparkSession, path: str, whole_text: bool = False) -> DataFrame:
    """One row per line in column ``value`` (or per file with ``whole_text``)."""
    return spark.read.text(path, wholetext=whole_text)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar scan with filter pushdown and column pruning."""
    return spark.read.parquet(path)
