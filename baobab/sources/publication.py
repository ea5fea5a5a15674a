"""Published reports with history, on files.

Overwriting a table keeps its last state only.  A published report here has one
partition per day: publishing a day replaces that day's partition alone and
leaves every other day as it was, so a day can be published again and any
earlier state read back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partition column of a published report.
DAY = "jour"


def row_digest(columns: Sequence[str]) -> Column:
    """Sum of the rows' hashes: the same for the same rows in any order, and a partial aggregate."""
    hashed = F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns))
    return F.coalesce(F.sum(hashed.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).cast("string")


def publish(report: DataFrame, path: str, day: str, files: int = 1) -> None:
    """Publish ``report`` as the state of ``day`` (yyyy-MM-dd).

    The day's partition is replaced as a whole when the job commits (dynamic
    partition overwrite); a task that runs again, or a job that fails, leaves the
    published days untouched.  ``files``: of the partition.  An empty report
    publishes nothing and leaves the day as it was."""
    if DAY in report.columns:
        raise ValueError(f"a published report has its own column {DAY}")
    dated = report.repartition(files).withColumn(DAY, F.lit(day).cast("date"))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def published(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """All published days, or the state as of ``day``: the last one published up to then.

    The days are partitions, so only the chosen one is read."""
    history = spark.read.parquet(path)
    if day is None:
        return history
    last = history.filter(F.col(DAY) <= F.lit(day).cast("date")).agg(F.max(DAY)).first()[0]
    return history.filter(F.col(DAY) == F.lit(last).cast("date")) if last is not None else history.limit(0)


def read_back(spark: SparkSession, path: str, written: dict[str, DataFrame]) -> DataFrame:
    """K2: what is on file for each day against what was published last: a row a day
    with jour, n_publiees, n_lues and identiques (equal counts and digests)."""
    columns = sorted(c for c in published(spark, path).columns if c != DAY)
    facts = [F.count("*").alias("n"), row_digest(columns).alias("digest")]
    sides = None
    for day, report in written.items():
        one = report.agg(*facts).select(F.lit(day).cast("date").alias(DAY), F.col("n").alias("n_publiees"), F.col("digest").alias("d"))
        sides = one if sides is None else sides.unionByName(one)
    there = published(spark, path).groupBy(DAY).agg(*facts)
    return sides.join(there, DAY, "full").select(
        F.date_format(DAY, "yyyy-MM-dd").alias(DAY),
        F.coalesce("n_publiees", F.lit(0)).alias("n_publiees"),
        F.coalesce("n", F.lit(0)).alias("n_lues"),
        (F.col("n_publiees").eqNullSafe(F.col("n")) & F.col("d").eqNullSafe(F.col("digest"))).alias("identiques"),
    )


def evolution(spark: SparkSession, path: str, day: str, keys: Sequence[str], measure: str) -> DataFrame:
    """Between the state as of ``day`` and the one published before it: keys, avant, apres, ecart (NULL side: 0)."""
    history = published(spark, path)
    days = [r[0] for r in history.filter(F.col(DAY) <= F.lit(day).cast("date")).select(DAY).distinct().orderBy(F.desc(DAY)).limit(2).collect()]
    side = lambda k, name: (
        history.filter(F.col(DAY) == F.lit(days[k]).cast("date")) if k < len(days) else history.limit(0)
    ).select(*keys, F.col(measure).alias(name))
    both = side(1, "avant").join(side(0, "apres"), list(keys), "full")
    before, after = F.coalesce("avant", F.lit(0)).alias("avant"), F.coalesce("apres", F.lit(0)).alias("apres")
    return both.select(*keys, before, after).withColumn("ecart", F.col("apres") - F.col("avant"))
