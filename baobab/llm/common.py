"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from baobab.session import ensure_checkpoint_dir

#: Fixed value: what separates words, `\x20` and `\x09`-`\x0D`, as a trim list
#: and as a Java character class.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read again.

    A lost executor then costs a re-read and not a recomputation, and later
    plans know the true size: ``DataFrame.checkpoint()`` would keep the estimate
    of the plan that it cuts, which every join multiplies, so that loops plan
    with ever larger numbers.  Columns of type void come back as nulls."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    void = [f.name for f in df.schema if isinstance(f.dataType, NullType)]
    written = df.drop(*void) if void else df
    written.write.parquet(path)
    back = spark.read.schema(written.schema).parquet(path)
    return back.withColumns({c: F.lit(None) for c in void}).select(*df.columns) if void else back


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words `[^\\x20\\x09-\\x0D]+` of a text; null text: none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def text_key(text: Column) -> Column:
    """128-bit identity of a text as a struct of two 64-bit hashes (null for a
    null text): the second hashes the text under another seed."""
    return F.when(
        text.isNotNull(), F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7919), text).alias("b"))
    )


def thinned(rows: DataFrame, most: int, about: int, at: Column) -> DataFrame:
    """The rows whose hash ``at`` can be among the ``most`` smallest of ``about``
    rows: half as many again as that, however many there are."""
    share = 1.5 * (most + 20) / max(about, 1)
    return rows.where(at < F.lit(int(share * 2**64) - 2**63)) if share < 1 else rows


def bounded_sample(rows: DataFrame, most: int, about: int, *key: str) -> DataFrame:
    """At most ``most`` rows of about ``about``, the same ones on every run: those
    of the smallest hashes of ``key``.  All others go before anything is gathered."""
    at = F.xxhash64(*key)
    return thinned(rows, most, about, at).orderBy(at).limit(most)


def positions(rows: DataFrame, group: list[str], order: list[Column], out: str = "pos") -> DataFrame:
    """``rows``, written, with the gapless number ``out`` from 0 of each row in its group.

    The rows are range-sorted as a whole, equal ones apart from each other too,
    so a group of any size lies over many tasks; a row's number is its place in
    its task's run of the group and the lengths of the runs before.  The columns
    of ``group`` have no nulls."""
    from pyspark.sql import Window as W

    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    sorted_rows = tied.orderBy(*group, *order, "__tie").drop("__tie")
    at = cut(sorted_rows.withColumn("__at", F.monotonically_increasing_id()))
    at = at.withColumn("__run", F.shiftright("__at", 33))
    runs = at.groupBy(*group, "__run").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    w = W.partitionBy(*group).orderBy("__run").rowsBetween(W.unboundedPreceding, -1)  # a row for each task at most
    runs = cut(runs.withColumn("__before", F.coalesce(F.sum("__n").over(w), F.lit(0))))
    number = (F.col("__at") - F.col("__first") + F.col("__before")).cast("long")
    return at.join(runs.drop("__n"), [*group, "__run"]).withColumn(out, number).drop("__at", "__run", "__first", "__before")


def cell_offsets(counts: DataFrame, group: list[str], cells: list[str], n: str = "n") -> DataFrame:
    """Exclusive running sum ``before`` of ``n`` over the cells of each group.

    ``counts`` has one row per (group, cell); the number of cells is a
    parameter of the caller, so no window partition grows with the data."""
    from pyspark.sql import Window as W

    w = W.partitionBy(*group).orderBy(*cells).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum(n).over(w), F.lit(0)).cast("long"))
