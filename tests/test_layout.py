"""Stored layouts: joins without an exchange, pruned months, and the way out for a hot key."""

import os
import re

from pyspark.sql import functions as F

from baobab.operators import kpi
from baobab.sources import layout


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark, hot=False):
    order = F.when(F.lit(hot) & (F.col("id") % 3 == 0), 1).otherwise(F.col("id") % 500)
    return spark.range(6000).select(
        order.alias("order_id"), (F.col("id") % 40).alias("product_id"), F.lit(2).cast("long").alias("quantite"), F.col("id").alias("prix_unitaire_fcfa")
    )


def _orders(spark):
    status = F.when(F.col("id") % 3 == 0, "annulee").otherwise("livree")
    return spark.range(450).select(F.col("id").alias("order_id"), status.alias("statut_norm"))


def test_bucketed_join_moves_neither_side(spark, tmp_dir):
    lines, orders = _lines(spark), _orders(spark)
    want = sorted(map(tuple, kpi.delivered_line_revenue(lines, orders).collect()))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        a, b = (layout.bucketed(x, n, "order_id", 6, tmp_dir) for x, n in ((lines, "l"), (orders, "o")))
        got = kpi.delivered_line_revenue(a, b)
        shuffled, stored = plan(kpi.delivered_line_revenue(lines, orders)), plan(got)
        assert "hashpartitioning(order_id" in shuffled and "hashpartitioning(order_id" not in stored
        assert "SortMergeJoin" in stored and "Bucketed: true" in stored
        assert sorted(map(tuple, got.collect())) == want
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_key_is_not_bucketed(spark, tmp_dir):
    hot = _lines(spark, hot=True)
    assert layout.hottest_key(hot, "order_id") >= 2000
    assert layout.bucketed(hot, "l", "order_id", 6, tmp_dir) is hot
    assert layout.bucketed(hot.limit(0), "l", "order_id", 6, tmp_dir).count() == 0


def test_months_are_pruned(spark, tmp_dir):
    rows = [(k, f"2025-{k % 6 + 1:02d}-11 10:00:00" if k % 50 else None, "livree" if k % 2 else "annulee", "mobile_app", k) for k in range(600)]
    orders = spark.createDataFrame(rows, "order_id long, d string, statut_norm string, canal string, montant_fcfa long")
    orders = orders.withColumn("date_commande", F.to_timestamp("d")).drop("d")
    stored = layout.by_month(orders, "date_commande", os.path.join(tmp_dir, "orders"))
    count = kpi.delivered_in_stored_month(stored, "2025-02")
    p = plan(count)
    assert re.search(r"PartitionFilters: \[[^\]]*mois#\d+ = 2025-02", p) and "EqualTo(statut_norm,livree)" in p
    want = [k for k, d, s, *_ in rows if d and d.startswith("2025-02") and s == "livree"]
    assert count.first()[0] == len(want) > 0
    months = stored.select("mois")
    recent = kpi.last_months_revenue(stored, months, 2)
    assert re.search(r"PartitionFilters: \[[^\]]*mois#\d+ >= [Ss]ubquery", plan(recent))
    revenue = lambda m: sum(k for k, d, status, *_ in rows if d and d.startswith(m) and status == "livree")
    assert {r.mois: r.ca_fcfa for r in recent.collect()} == {"2025-06": revenue("2025-06")}  # May has nothing delivered
    assert stored.count() == 600 and stored.filter("mois IS NULL").count() == 12
