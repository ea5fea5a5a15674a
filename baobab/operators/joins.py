"""Join audits: row-count discipline, sentinel sums, orphans, the
semi/anti partition test, duplicate keys and null-aware NOT IN.

Each audit returns a small DataFrame.  Both sides are reduced to one row
per key (row count, amount, multiplicity) before they meet, so one
key-to-key join yields left, semi, anti, inner and fan-out counts together
and a hot key cannot skew it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_multiplicity(right: DataFrame, key: str) -> DataFrame:
    """(key, _mult): how many right rows carry each non-NULL key."""
    return right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_mult"))


def _keyed(left: DataFrame, right: DataFrame, key: str, amount: str | None = None) -> DataFrame:
    """Both sides reduced to one row per key, then joined.

    Left: (key, _n rows, _amount sum); right: (key, _mult).  Each side is a
    partial aggregate, so a key that holds a large share of the rows is
    summed inside every map task and the join sees one row per key: no
    skewed join partition whatever the key distribution.  A NULL left key
    forms its own group and never matches.
    """
    aggs = [F.count("*").alias("_n")]
    if amount is not None:
        aggs.append(F.sum(F.col(amount)).alias("_amount"))
    per_key = left.groupBy(key).agg(*aggs)
    return per_key.join(key_multiplicity(right, key), key, "left")


def partition_test(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``n_semi + n_anti = n_left`` holds for any real semi join;
    ``n_inner - n_semi`` is the fan-out an inner join adds when the right side
    repeats keys, and ``inner_ok`` is the check that can fail: whether matched
    and unmatched rows of the inner join add up to the left side.  One row:
    (n_left, n_semi, n_anti, n_inner, fan_out, partition_ok, inner_ok).
    """
    j = _keyed(left, right, key)
    n, matched_ = F.col("_n"), F.col("_mult").isNotNull()
    one = j.agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n_left"),
        F.coalesce(F.sum(F.when(matched_, n).otherwise(0)), F.lit(0)).cast("bigint").alias("n_semi"),
        F.coalesce(F.sum(F.when(~matched_, n).otherwise(0)), F.lit(0)).cast("bigint").alias("n_anti"),
        F.coalesce(F.sum(n * F.col("_mult")), F.lit(0)).cast("bigint").alias("n_inner"),
    )
    return one.select(
        "n_left", "n_semi", "n_anti", "n_inner",
        (F.col("n_inner") - F.col("n_semi")).alias("fan_out"),
        ((F.col("n_semi") + F.col("n_anti")) == F.col("n_left")).alias("partition_ok"),
        ((F.col("n_inner") + F.col("n_anti")) == F.col("n_left")).alias("inner_ok"),
    )


def row_discipline(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows before and after an inner join on ``key`` and the change."""
    j = _keyed(left, right, key)
    one = j.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_avant"),
        F.coalesce(F.sum(F.col("_n") * F.col("_mult")), F.lit(0)).cast("bigint").alias("n_apres"),
    )
    return one.withColumn("ecart", F.col("n_apres") - F.col("n_avant"))


def sentinel(left: DataFrame, right: DataFrame, key: str, amount: str) -> DataFrame:
    """The same sum before and after an inner join on ``key``.

    ``ca_apres`` weights each left key's sum by its number of right matches, which
    is exactly what the joined rows would sum to; a gap means lost rows
    (orphans) or duplicated rows (fan-out), and the two are reported apart.
    """
    j = _keyed(left, right, key, amount)
    a = F.col("_amount")
    one = j.agg(
        F.sum(a).alias("ca_avant"),
        F.sum(a * F.col("_mult")).alias("ca_apres"),
        F.sum(F.when(F.col("_mult").isNull(), a)).alias("ca_perdu"),
        F.sum(a * (F.col("_mult") - 1)).alias("ca_duplique"),
    )
    return one.select(
        "ca_avant", "ca_apres", (F.col("ca_apres") - F.col("ca_avant")).alias("ecart"),
        F.coalesce("ca_perdu", F.lit(0)).alias("ca_perdu"),
        F.coalesce("ca_duplique", F.lit(0)).alias("ca_duplique"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys present more than once, with their count (HAVING n > 1)."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose key has no match on the right (anti join;
    a LEFT JOIN + IS NULL would keep an outer join and a filter).

    The right side is its plain key column: with an aggregate between shuffle and
    join Spark could not split a key that holds a large share of the left rows."""
    return left.join(right.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-NULL distinct keys of ``df``.

    ``distinct`` is a partial aggregate, so a key repeated on a large share
    of the rows is collapsed inside each map task; the build side of a
    semi/anti join (which AQE cannot split) then holds one row per key.
    """
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def matched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows with at least one match, each once (semi join)."""
    return left.join(right.select(key).where(F.col(key).isNotNull()), key, "left_semi")


def orphan_summary(left: DataFrame, right: DataFrame, key: str, amount: str) -> DataFrame:
    """Orphan count, share of the left side (%) and amount at stake."""
    j = _keyed(left, right, key, amount)
    is_orphan = F.col("_mult").isNull()
    one = j.agg(
        F.sum("_n").alias("n_total"),
        F.coalesce(F.sum(F.when(is_orphan, F.col("_n"))), F.lit(0)).cast("bigint").alias("nb_orphelines"),
        F.sum(F.when(is_orphan, F.col("_amount"))).alias("ca_orphelines"),
    )
    return one.select(
        "nb_orphelines",
        F.round(F.try_divide(F.col("nb_orphelines") * F.lit(100.0), F.col("n_total")), 3).alias("part_pct"),
        F.coalesce("ca_orphelines", F.lit(0)).alias("ca_orphelines"),
    )


def orphans_by_month(left: DataFrame, right: DataFrame, key: str, date_col: str) -> DataFrame:
    """Orphan count per ``yyyy-MM``; the left side is counted per key and
    month before the join, so a key of any size is a few rows there."""
    per = left.groupBy(key, F.date_format(F.col(date_col), "yyyy-MM").alias("mois")).agg(F.count("*").alias("n"))
    return per.join(key_multiplicity(right, key), key, "left_anti").groupBy("mois").agg(F.sum("n").alias("n"))


def not_in_count(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows kept by ``key NOT IN (SELECT key FROM right)``, next to
    the anti-join count.

    SQL three-valued logic: one NULL key on the right makes NOT IN unknown
    for every row (0 rows); a NULL key on the left is kept only when the
    right side is empty.  Rows per key, NULL keys and matches of the left side
    come from one key-to-key join (one scan), the NULL statistics of the right
    side from one row, so there is no nested loop as Spark plans it for a
    null-aware anti join whose right side is too large to broadcast.
    """
    n, zero = F.col("_n"), F.lit(0).cast("bigint")
    kept = _keyed(left, right, key).agg(
        F.coalesce(F.sum(F.when(F.col(key).isNotNull() & F.col("_mult").isNull(), n)), zero).alias("a"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), n)), zero).alias("l_null"),
    )
    stats = right.agg(F.count_if(F.col(key).isNull()).alias("r_null"), F.count("*").alias("r_rows"))
    s = (
        kept.select("a", "l_null", zero.alias("r_null"), zero.alias("r_rows"))
        .unionByName(stats.select(zero.alias("a"), zero.alias("l_null"), "r_null", "r_rows"))
        .agg(*(F.sum(c).alias(c) for c in ("a", "l_null", "r_null", "r_rows")))
    )
    n_not_in = (
        F.when(F.col("r_rows") == 0, F.col("a") + F.col("l_null"))
        .when(F.col("r_null") > 0, F.lit(0))
        .otherwise(F.col("a"))
    )
    n_anti = F.col("a") + F.col("l_null")
    return s.select(n_not_in.cast("bigint").alias("n_not_in"), n_anti.cast("bigint").alias("n_anti"))


def unused_keys(dim: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Dimension rows never referenced by the facts (anti join)."""
    return dim.join(distinct_keys(facts, key), key, "left_anti")


def unknown_references(events: DataFrame, facts: DataFrame, key: str, event_filter=None) -> DataFrame:
    """Among (filtered) events, how many point to an unknown fact key."""
    ev = events if event_filter is None else events.filter(event_filter)
    n, zero = F.col("_n"), F.lit(0)
    return _keyed(ev.select(key), facts, key).agg(
        F.coalesce(F.sum(n), zero).cast("bigint").alias("n_events"),
        F.coalesce(F.sum(F.when(F.col("_mult").isNull(), n)), zero).cast("bigint").alias("n_unknown"),
    )


def join_audit(left: DataFrame, right: DataFrame, key: str, amount: str) -> DataFrame:
    """C24-C27 in one pass: every count and sum of the partition test, the
    row discipline, the sentinel and the orphan summary from a single
    key-to-key join, so a full audit of a join costs one scan of each side.
    """
    j = _keyed(left, right, key, amount)
    n, m, a = F.col("_n"), F.col("_mult"), F.col("_amount")
    hit = m.isNotNull()
    one = j.agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n_left"),
        F.coalesce(F.sum(F.when(hit, n).otherwise(0)), F.lit(0)).cast("bigint").alias("n_semi"),
        F.coalesce(F.sum(F.when(~hit, n).otherwise(0)), F.lit(0)).cast("bigint").alias("n_anti"),
        F.coalesce(F.sum(n * m), F.lit(0)).cast("bigint").alias("n_inner"),
        F.sum(a).alias("ca_avant"),
        F.sum(a * m).alias("ca_apres"),
        F.coalesce(F.sum(F.when(~hit, a)), F.lit(0)).alias("ca_perdu"),
        F.coalesce(F.sum(a * (m - 1)), F.lit(0)).alias("ca_duplique"),
    )
    return one.select(
        "*",
        (F.col("n_inner") - F.col("n_semi")).alias("fan_out"),
        F.round(F.try_divide(F.col("n_anti") * F.lit(100.0), F.col("n_left")), 3).alias("part_orphelines_pct"),
        ((F.col("n_semi") + F.col("n_anti")) == F.col("n_left")).alias("partition_ok"),
        ((F.col("n_inner") + F.col("n_anti")) == F.col("n_left")).alias("inner_ok"),
    )
