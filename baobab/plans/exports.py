"""File copies of stand-in inputs, for the queries that exercise the CSV,
JSON and text sources.

A copy is written on every call, into a folder of its own under the one the
cluster names in ``spark.checkpoint.dir`` (shared storage; a scratch folder
only on a local master), then read back through :mod:`baobab.sources.files`:
two sessions never touch each other's copies, and a copy is never older than
the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from baobab.session import ensure_checkpoint_dir

#: CSV writer options that keep values byte-for-byte (Spark trims on write
#: by default).
CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def export(spark: SparkSession, name: str, df: DataFrame, fmt: str, options: dict | None = None) -> str:
    """Write ``df`` as ``fmt`` files into a new folder and return its path."""
    path = f"{new_folder(spark)}/{name}.{fmt}"
    df.write.options(**(options or {})).format(fmt).save(path)
    return path


def new_folder(spark: SparkSession) -> str:
    """Path of a folder of its own on the shared storage."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/baobab-exports/{uuid.uuid4().hex}"
