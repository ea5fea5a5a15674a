"""Session catalog helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType


def register_views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    """V1: one temporary view per DataFrame."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def create_view_as(spark: SparkSession, name: str, select_sql: str) -> DataFrame:
    """V2: ``CREATE OR REPLACE TEMP VIEW name AS <select>``; analysed
    eagerly, executed only when read.  Returns the view as a DataFrame."""
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {select_sql}")
    return spark.table(name)


def list_tables(spark: SparkSession) -> DataFrame:
    """V3: catalog tables and views with their temporary flag."""
    schema = StructType([StructField("name", StringType()), StructField("isTemporary", BooleanType())])
    rows = [(t.name, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, schema)
