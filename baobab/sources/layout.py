"""Stored layouts for joins and filters that repeat (J1-J4, C35; F5, C17, C21).

``bucketed`` writes a frame once in buckets of its join key, so that every
later join of two such frames runs bucket by bucket and moves neither side
again.  ``by_month`` writes one partition per calendar month, so that a filter
on months reads those months alone, whether they are named in the query or
found by it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the rows that one key may hold in a bucketed table, in buckets: a bucket is one
#: task's work in every later join and can not be split.
HOT_SHARE = 1.0


def hottest_key(df: DataFrame, key: str) -> int:
    """Rows of the most frequent key (partial counts, one row to the driver)."""
    return df.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def bucketed(df: DataFrame, name: str, key: str, buckets: int, folder: str) -> DataFrame:
    """``df`` as a table under ``folder``, bucketed and sorted by ``key``.

    A key with more rows than an average bucket makes its bucket a straggler in
    every join, so such a frame is returned as it is: its joins then shuffle, and
    AQE splits the hot key.  The table's name is unique in the session catalog."""
    if hottest_key(df, key) * buckets > HOT_SHARE * max(df.count(), buckets):
        return df
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", f"{folder.rstrip('/')}/{table}").saveAsTable(table)
    return df.sparkSession.table(table)


def by_month(df: DataFrame, date_col: str, folder: str, month: str = "mois") -> DataFrame:
    """``df`` under ``folder`` with a partition per month (``yyyy-MM``) of ``date_col``.

    The rows are rebalanced by month first: few files a month, and a month that
    holds most of the rows is written by many tasks.  A NULL date has the NULL
    partition."""
    dated = df.withColumn(month, F.date_format(date_col, "yyyy-MM"))
    dated.hint("rebalance", month).write.partitionBy(month).parquet(folder)
    return df.sparkSession.read.schema(dated.schema).parquet(folder)
