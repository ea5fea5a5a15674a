"""A key holding a third of all rows: results stay exact (checked by brute
force) and the hot key is reduced before any shuffle or join."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from baobab.operators import cleaning, funnel, joins, kpi

N = 3000


def _orders(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(N):
        cust = 1 if i % 3 == 0 else rnd.randint(2, 200)  # customer 1 owns a third of the orders
        status = "livree" if i % 2 == 0 else "annulee"
        rows.append((i, cust, status, str(1000 + i)))
    return rows, kpi.prepare_orders(
        spark.createDataFrame(rows, "order_id long, customer_id long, statut string, montant_total_fcfa string").repartition(6)
    )


def test_hot_customer_revenue_and_audit(spark):
    rows, orders = _orders(spark)
    cust = spark.createDataFrame([(c, f"R{c % 3}") for c in range(1, 150)] + [(1, "R1")], "customer_id long, region string")
    got = {r.region: (r.ca_fcfa, r.nb_commandes) for r in kpi.revenue_by_region(orders, cust).collect()}
    exp = defaultdict(lambda: [0, 0])
    regions = defaultdict(list)
    for c in range(1, 150):
        regions[c].append(f"R{c % 3}")
    regions[1].append("R1")
    for _, c, s, a in rows:
        if s == "livree":
            for reg in regions.get(c, []):
                exp[reg][0] += int(a)
                exp[reg][1] += 1
    assert got == {k: tuple(v) for k, v in exp.items()}
    p = joins.partition_test(orders, cust, "customer_id").first()
    known = Counter(c for c in [x[1] for x in rows] if c < 150)
    assert p.n_semi == sum(known.values()) and p.n_left == N
    assert p.fan_out == known[1]  # customer 1 is listed twice
    plan = joins.partition_test(orders, cust, "customer_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 2  # both sides pre-aggregated


def test_hot_session_funnel_and_dedup(spark):
    ev = [("hot", "view_product")] * 1000 + [("hot", "purchase")] * 10 + [(f"s{i}", "view_product") for i in range(2000)]
    df = spark.createDataFrame(ev, "session_id string, event_type string").repartition(6)
    f = funnel.funnel_counts(df).first()
    assert (f.sessions, f.vues, f.achats) == (2001, 2001, 1)
    cust = spark.createDataFrame(
        [("1", f"e{i % 7}") for i in range(1500)] + [(str(i), "x") for i in range(2, 1502)], "customer_id string, email string"
    ).repartition(6)
    d = {r.customer_id: r.email for r in cleaning.dedup_by_key(cust).collect()}
    assert len(d) == 1501 and d["1"] == "e0"


def test_line_join_skew_split_by_aqe(spark):
    """Order lines where one order holds a third of all lines: the line ->
    order join cannot be pre-aggregated, so AQE splits the hot partition
    (forced here with tiny thresholds); the result stays exact."""
    n_lines = 6000
    items = spark.createDataFrame(
        [(0 if i % 3 == 0 else i % 500, i % 40, 1 + i % 3, 100 + i % 7) for i in range(n_lines)],
        "order_id long, product_id long, quantite long, prix_unitaire_fcfa long",
    ).repartition(8)
    orders = kpi.prepare_orders(
        spark.createDataFrame(
            [(o, o % 9, "livree" if o % 2 == 0 else "annulee", "1000") for o in range(500)],
            "order_id long, customer_id long, statut string, montant_total_fcfa string",
        )
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = kpi.delivered_line_revenue(items, orders)
        got = {r.product_id: r.ca for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    exp = defaultdict(int)
    for i in range(n_lines):
        o = 0 if i % 3 == 0 else i % 500
        if o % 2 == 0:
            exp[i % 40] += (1 + i % 3) * (100 + i % 7)
    assert got == dict(exp)
    assert "skew=true" in plan


@pytest.fixture()
def tiny_partitions(spark):
    """Broadcast off, and thresholds at which AQE splits whatever it can."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orphans_of_a_hot_key_are_split(spark, tiny_partitions):
    left = spark.createDataFrame([(1 if i % 3 == 0 else i, i) for i in range(N)], "k long, v long").repartition(8)
    right = spark.createDataFrame([(k,) for k in range(2, N, 2)] + [(None,)], "k long").repartition(3)
    df = joins.orphans(left, right, "k")
    assert df.count() == sum(1 for i in range(N) if i % 3 == 0 or i % 2)
    got = {r.v for r in df.collect()}
    assert got == {i for i in range(N) if i % 3 == 0 or i % 2}
    assert "skew=true" in _plan(df)


def test_counted_anti_joins_meet_one_row_a_key(spark, tiny_partitions):
    """Orphans by month, NOT IN and unknown references sum the hot key before the join."""
    rows = [(1 if i % 3 == 0 else None if i % 3 == 1 else i, f"2025-0{1 + i % 4}-03") for i in range(N)]
    left = spark.createDataFrame(rows, "k long, d string").withColumn("d", F.to_timestamp_ntz("d")).repartition(8)
    right = spark.createDataFrame([(k,) for k in range(2, N, 5)] * 2, "k long")
    known = set(range(2, N, 5))
    want = Counter(d[:7] for k, d in rows if k not in known)
    by_month = joins.orphans_by_month(left, right, "k", "d")
    assert {r.mois: r.n for r in by_month.collect()} == want
    not_in = joins.not_in_count(left, right, "k")
    assert tuple(not_in.first()) == (sum(k is not None and k not in known for k, _ in rows), sum(want.values()))
    refs = joins.unknown_references(left, right, "k")
    assert tuple(refs.first()) == (N, sum(want.values()))
    for df in (by_month, not_in, refs):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        join = plan[plan.index("Join") :]
        assert join.count("Aggregate [k") >= 2, plan  # both sides are one row a key below the join
    assert not_in._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 3  # left read once


def test_category_share_of_a_hot_order(spark, tiny_partitions):
    n = 3000
    lines = [(0 if i % 3 == 0 else i % 500, i % 40, 1 + i % 3, 100 + i % 7) for i in range(n)]
    items = spark.createDataFrame(lines, "order_id long, product_id long, quantite long, prix_unitaire_fcfa long").repartition(8)
    status = [(o, 1, "livree" if o % 2 == 0 else "annulee", "1") for o in range(500)]
    orders = kpi.prepare_orders(
        spark.createDataFrame(status, "order_id long, customer_id long, statut string, montant_total_fcfa string")
    )
    pay = [(o, "Wave" if o % 4 == 0 else "carte") for o in range(500)] + [(0, "carte")]
    payments = spark.createDataFrame(pay, "order_id long, methode string")
    products = spark.createDataFrame([(p, f"c{p % 3}") for p in range(40)], "product_id long, categorie string")
    df = kpi.share_by_category(items, orders, payments, products)
    total, mobile = Counter(), Counter()
    for o, p, q, price in lines:
        if o % 2 == 0:
            total[f"c{p % 3}"] += q * price
            mobile[f"c{p % 3}"] += q * price * (o % 4 == 0)
    assert {r.categorie: (r.ca_total_fcfa, r.ca_mobile_money_fcfa) for r in df.collect()} == {
        c: (total[c], mobile[c]) for c in total
    }
    assert "Aggregate [order_id" in df._jdf.queryExecution().optimizedPlan().toString()
