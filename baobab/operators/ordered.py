"""Running maxima over ordered groups of any size.

A window over a group needs all its rows in one task.  Here the rows are
range-sorted as a whole, so a group that holds a third of them lies over many
tasks; a running maximum is taken within each task's run of the group, and the
maxima of the runs before are carried in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from baobab.session import materialise


def in_runs(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` sorted by ``group`` and ``order`` and written to shared storage, with
    the columns ``_run`` (a task's part of a group) and ``_at`` (the place in it)."""
    placed = df.orderBy(group, *order).withColumn("_place", F.monotonically_increasing_id())
    placed = placed.withColumn("_run", F.shiftright("_place", 33)).withColumnRenamed("_place", "_at")
    return materialise(placed)


def running_max(runs: DataFrame, group: str, value: Column, out: str) -> DataFrame:
    """Adds ``out``: the maximum of ``value`` over the rows of the group before each row.

    ``runs`` comes from :func:`in_runs`; rows of a NULL group have none."""
    valued = runs.withColumn("_value", value)
    tops = valued.groupBy(group, "_run").agg(F.max("_value").alias("_top"))
    earlier = W.partitionBy(group).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)  # a row for each task at most
    carried = tops.select(group, "_run", F.max("_top").over(earlier).alias("_carried"))
    inside = W.partitionBy(group, "_run").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    scanned = valued.withColumn("_inside", F.max("_value").over(inside)).join(carried, [group, "_run"], "left")
    return scanned.withColumn(out, F.greatest("_inside", "_carried")).drop("_value", "_inside", "_carried")
