"""Window reports: top-N per group and period-over-period change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def top_n_per_group(df: DataFrame, group: Sequence[str], order_col: str, n: int = 3, tie_cols: Sequence[str] = (), rank_col: str = "rang") -> DataFrame:
    """``row_number() over (partition by group order by order_col desc,
    ties...) <= n``.

    Spark plans the filter on ``row_number`` as a partial
    ``WindowGroupLimit`` before the shuffle and a final one after it, so no
    partition ever ships more than ``n`` rows per group per task.
    """
    w = Window.partitionBy(*group).orderBy(F.col(order_col).desc(), *[F.col(c) for c in tie_cols])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def fill_month_gaps(df: DataFrame, month_col: str, fill: dict) -> DataFrame:
    """Add a row for every calendar month missing between the first and
    last month of ``df`` (``month_col`` holds month-start dates), with the
    ``fill`` values.  Runs on aggregated rows: one row per month."""
    bounds = df.agg(F.min(month_col).alias("_lo"), F.max(month_col).alias("_hi"))
    months = bounds.select(
        F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 MONTH"))).alias(month_col)
    )
    return months.join(df, month_col, "left").fillna(fill)


def period_delta(df: DataFrame, period_col: str, value_col: str, delta_col: str = "delta", fill_gaps: bool = False) -> DataFrame:
    """``value - lag(value) over (order by period)``.

    The window has no partition key, so it runs in one task: call it only
    on aggregated rows (one per period).  By default the previous *present*
    period is used, as the reference does; ``fill_gaps=True`` (month-start
    date periods) first inserts missing calendar months with value 0 (X21).
    """
    if fill_gaps:
        df = fill_month_gaps(df, period_col, {value_col: 0})
    w = Window.orderBy(period_col)
    return df.withColumn(delta_col, F.col(value_col) - F.lag(value_col, 1).over(w))


def period_delta_by(
    df: DataFrame, group: Sequence[str], month_col: str, value_col: str, delta_col: str = "delta"
) -> DataFrame:
    """W3 and X21 per group: change against the calendar month before, with a row
    of value 0 for every month without one between a group's first and last.

    ``df`` has one row per group and month (a month-start date).  A row reaches
    up to the group's next one, and the months in between are made from it, so no
    table of all months meets all groups and one window sees a month of a group
    once.  A group's first month has no change; a row without a month stays as it
    is and has none either.  A null group is a group, a null value counts as 0."""
    w = Window.partitionBy(*group).orderBy(month_col)
    value = F.coalesce(F.col(value_col), F.lit(0))
    before, past = F.lag(month_col).over(w), F.lag(value).over(w)
    reach = F.coalesce(F.add_months(F.lead(month_col).over(w), -1), F.col(month_col))
    placed = df.select(
        *group,
        F.col(month_col),
        value.alias("_value"),
        # months that were filled in stand before this one, with value 0
        F.when(before == F.add_months(month_col, -1), past).when(before.isNotNull(), F.lit(0)).alias("_past"),
        F.sequence(F.col(month_col), reach, F.expr("INTERVAL 1 MONTH")).alias("_months"),
    )
    each = placed.select(*group, F.col(month_col).alias("_own"), "_value", "_past", F.posexplode_outer("_months").alias("_at", "_month"))
    own = F.coalesce(F.col("_at"), F.lit(0)) == 0
    change = F.when(own, F.col("_value") - F.col("_past")).when(F.col("_at") == 1, -F.col("_value")).otherwise(F.lit(0))
    return each.select(
        *group,
        F.coalesce("_month", "_own").alias(month_col),
        F.when(own, F.col("_value")).otherwise(F.lit(0)).alias(value_col),
        change.alias(delta_col),
    )
