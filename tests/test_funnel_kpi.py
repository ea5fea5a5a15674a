"""Funnel flags against COUNT(DISTINCT), windows, KPI helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from baobab.operators import cleaning, funnel, kpi, quality, ranking

EV = ["session_id", "event_type", "device"]


def _events(spark):
    return spark.createDataFrame(
        [
            ("s1", "view_product", "mobile"), ("s1", "add_to_cart", "mobile"), ("s1", "purchase", "mobile"),
            ("s2", "view_product", "desktop"), ("s2", "view_product", "mobile"),
            ("s3", "purchase", "tablet"),
            (None, "purchase", "mobile"),
            ("s4", "signup", "desktop"),
        ],
        EV,
    )


def test_funnel_matches_count_distinct(spark):
    ev = _events(spark)
    f = funnel.funnel_counts(ev).first()
    ev.createOrReplaceTempView("ev_f")
    ref = spark.sql(
        """SELECT COUNT(DISTINCT session_id) s,
                  COUNT(DISTINCT CASE WHEN event_type='view_product' THEN session_id END) v,
                  COUNT(DISTINCT CASE WHEN event_type='add_to_cart' THEN session_id END) c,
                  COUNT(DISTINCT CASE WHEN event_type='purchase' THEN session_id END) p FROM ev_f"""
    ).first()
    assert (f.sessions, f.vues, f.paniers, f.achats) == tuple(ref) == (4, 2, 1, 2)
    strict = funnel.funnel_counts(ev, strict=True).first()
    assert (strict.vues, strict.paniers, strict.achats) == (2, 1, 1)
    rates = funnel.funnel_rates(funnel.funnel_counts(ev)).first()
    assert (rates.t_vues, rates.t_paniers, rates.t_achats, rates.t_global) == (50.0, 50.0, 200.0, 50.0)
    by_dev = {r.device: (r.sessions, r.achats) for r in funnel.funnel_by(ev, "device").collect()}
    assert by_dev == {"mobile": (2, 1), "desktop": (2, 0), "tablet": (1, 1)}  # s2 counted twice (X16)
    a = funnel.anonymous_share(ev).first()
    assert (a.n_events, a.n_sans_session) == (8, 1)


def test_top_n_and_delta(spark):
    df = spark.createDataFrame(
        [("A", "p1", 5), ("A", "p2", 9), ("A", "p3", 9), ("A", "p4", 1), ("B", "p1", 3)], ["region", "nom", "ca"]
    )
    top = [(r.region, r.nom, r.rang) for r in ranking.top_n_per_group(df, ["region"], "ca", 2, ["nom"]).orderBy("region", "rang").collect()]
    assert top == [("A", "p2", 1), ("A", "p3", 2), ("B", "p1", 1)]
    m = spark.createDataFrame([("2025-10", 10), ("2025-12", 25), ("2025-11", 15)], ["mois", "ca"])
    d = [(r.mois, r.delta) for r in ranking.period_delta(m, "mois", "ca").orderBy("mois").collect()]
    assert d == [("2025-10", None), ("2025-11", 5), ("2025-12", 10)]


def test_amount_cleaning_and_gap(spark):
    raw = spark.createDataFrame(
        [(1, "1000"), (2, "2500 FCFA"), (3, None), (4, "N/A"), (5, " 300 ")], ["order_id", "montant_total_fcfa"]
    )
    clean = {r.order_id: r.montant_fcfa for r in quality.clean_amounts(raw).collect()}
    assert clean == {1: 1000, 2: 2500, 3: None, 4: None, 5: 300}
    p = quality.amount_polluted(raw).first()
    assert (p.n_polluted, p.n_null, p.n_distinct_polluted) == (3, 1, 3)
    v = quality.amount_validation(quality.clean_amounts(raw)).first()
    assert (v.nb_lignes, v.nb_valides, v.nb_null, v.montant_min, v.montant_max, v.ca_total) == (5, 3, 2, 300, 2500, 3800)
    g = quality.amount_gap(raw).first()
    # a tolerant cast trims spaces: " 300 " counts in the naive sum
    assert (g.ca_naif, g.ca_nettoye, g.ecart_fcfa) == (1300, 3800, 2500)


def test_profiles(spark):
    df = spark.createDataFrame(
        [("1", "a@b.com", "Dakar"), ("1", "a@b.com", "Dakar"), ("2", " n/a ", None), ("3", None, "Thies")],
        ["customer_id", "email", "ville"],
    )
    prof = {r.metric: r.value for r in quality.quality_profile(df).collect()}
    assert prof["n_rows"] == 4 and prof["n_exact_duplicates"] == 1 and prof["n_distinct_cities"] == 2
    assert prof["n_email_pseudo_missing"] == 2 and prof["n_null_ville"] == 1
    nulls = {r.column_name: r.n_null for r in quality.null_counts(df).collect()}
    assert nulls == {"customer_id": 0, "email": 1, "ville": 1}
    pm = quality.pseudo_missing(df).first()
    assert (pm.n_pseudo_missing, pm.n_missing_literal) == (2, 1)
    vc = {(r.column_name, r.value): r.n for r in quality.value_counts(df, ["ville"]).collect()}
    assert vc == {("ville", "Dakar"): 2, ("ville", None): 1, ("ville", "Thies"): 1}
    tp = {r.column_name: (r.position, r.data_type, r.n_null) for r in quality.table_profile(df).collect()}
    assert tp["email"] == (2, "string", 1)
    assert quality.exact_duplicate_count(df).first().n_exact_duplicates == 1
    one = df.agg(F.count("*").alias("n"), F.max(F.lit(None).cast("int")).alias("m"))
    none = df.limit(0).select("customer_id")
    reg = quality.measure_registry([(one, {"a": "n", "b": "m"}), (none, {"c": "customer_id"})])
    assert {r.metric: r.missing for r in reg.collect()} == {"a": False, "b": True, "c": True}


def test_registry_on_empty_orders(spark):
    schema = "order_id long, customer_id long, statut string, canal string, montant_total_fcfa string, date_commande timestamp_ntz"
    orders = kpi.prepare_orders(spark.createDataFrame([], schema))
    frames = [
        (quality.amount_validation(orders), {"nb": "nb_lignes", "ca": "ca_total"}),
        (kpi.record_month(orders), {"record": "ca_fcfa"}),
    ]
    got = {r.metric: (r.value, r.missing) for r in quality.measure_registry(frames).collect()}
    assert got == {"nb": (0.0, False), "ca": (None, True), "record": (None, True)}


def test_strict_cast_suspects_and_full_row_dedup(spark):
    raw = ["-1500", "12.75", "1 200,50", "900", "800 FCFA", "N/A", None]
    df = spark.createDataFrame([(x,) for x in raw], "montant_total_fcfa string")
    flags = {r.montant_total_fcfa: r.montant_suspect for r in quality.suspect_amounts(df).collect()}
    assert flags == {"-1500": True, "12.75": True, "1 200,50": True, "900": False, "800 FCFA": False, "N/A": False, None: False}
    good = quality.clean_amounts(df.where("montant_total_fcfa in ('900', '-1500')"), strict=True)
    assert sorted(r.montant_fcfa for r in good.collect()) == [900, 1500]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        quality.clean_amounts(df.where("montant_total_fcfa = 'N/A'"), strict=True).collect()
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None)], "k int, v string")
    assert sorted((r.k, r.v or "") for r in cleaning.drop_exact_duplicates(twice).collect()) == [(1, ""), (1, "a")]
    assert [r.k for r in quality.head_sample(spark.range(9).toDF("k"), ["k"], 3).collect()] == [0, 1, 2]


def test_category_revenue_of_unknown_and_repeated_customers(spark):
    orders = kpi.prepare_orders(
        spark.createDataFrame(
            [(1, 10, "livree", "1"), (2, 99, "livree", "1"), (3, 10, "annulee", "1")],
            "order_id long, customer_id long, statut string, montant_total_fcfa string",
        )
    )
    items = spark.createDataFrame(
        [(1, 5, 1, 100), (2, 5, 1, 50), (3, 5, 1, 7)],
        "order_id long, product_id long, quantite long, prix_unitaire_fcfa long",
    )
    products = spark.createDataFrame([(5, "cafe", "boisson")], "product_id long, nom_produit string, categorie string")
    customers = spark.createDataFrame([(10, "Dakar"), (10, "Dakar")], "customer_id long, ville string")
    [r] = kpi.revenue_by(items, orders, customers, products, (), ("categorie",)).collect()
    assert (r.categorie, r.ca_fcfa, r.nb_ventes) == ("boisson", 150, 2)  # the unknown customer's order counts
    [r] = kpi.revenue_by(items, orders, customers, products, ("ville",), ()).collect()
    assert (r.ville, r.ca_fcfa, r.nb_ventes) == ("Dakar", 200, 2)  # an inner join: twice for the repeated customer
    [r] = kpi.top_products(items, orders, customers, products).collect()
    assert (r.nom_produit, r.ca) == ("cafe", 200)


def test_split_payment_counts_lines_once(spark):
    orders = kpi.prepare_orders(
        spark.createDataFrame(
            [(1, 10, "livree", "1"), (2, 10, "livree", "1")],
            "order_id long, customer_id long, statut string, montant_total_fcfa string",
        )
    )
    items = spark.createDataFrame(
        [(1, 5, 1, 100), (2, 5, 1, 50)], "order_id long, product_id long, quantite long, prix_unitaire_fcfa long"
    )
    pay = spark.createDataFrame([(1, "Wave"), (1, "carte"), (1, "Wave")], "order_id long, methode string")
    products = spark.createDataFrame([(5, "boisson")], "product_id long, categorie string")
    [r] = kpi.share_by_category(items, orders, pay, products).collect()
    assert (r.ca_total_fcfa, r.ca_mobile_money_fcfa, r.part_mobile_money_pct) == (150, 100, 66.7)
    assert {(r.methode, r.nb) for r in kpi.basket_by_payment(orders, pay).collect()} == {("Wave", 1), ("carte", 1), (None, 1)}


def test_kpi_small(spark):
    o = spark.createDataFrame(
        [
            (1, 10, "livrée", "web", "1000", dt.datetime(2025, 12, 31, 23, 0)),
            (2, 10, "livree", "mobile_app", "3000 FCFA", dt.datetime(2025, 12, 1)),
            (3, 20, "annulee", "mobile_app", "500", dt.datetime(2025, 11, 5)),
        ],
        ["order_id", "customer_id", "statut", "canal", "montant_total_fcfa", "date_commande"],
    )
    orders = kpi.prepare_orders(o)
    st = {r.statut: r.ca_fcfa for r in kpi.revenue_by_status(orders).collect()}
    assert st == {"livree": 4000, "annulee": 500}  # both spellings folded
    sh = kpi.delivered_share(orders).first()
    assert (sh.ca_livre, sh.ca_total, sh.part_livre_pct) == (4000, 4500, 88.89)
    # the half-open month keeps 31 Dec 23:00
    assert kpi.delivered_in_month(orders, "2025-12", "web").first().nb_commandes == 1
    rec = kpi.record_month(orders).first()
    assert (rec.mois, rec.ca_fcfa) == ("2025-12", 4000)
    piv = kpi.basket_pivot(orders).first()
    assert (piv.panier_mobile, piv.panier_web, piv.panier_global) == (1750.0, 1000.0, 1500.0)
    pay = spark.createDataFrame([(1, "Wave"), (2, "carte"), (3, "Wave")], ["order_id", "methode"])
    share = {r.methode: r.part_pct for r in kpi.payment_share(pay).collect()}
    assert share == {"Wave": 66.7, "carte": 33.3}
    assert kpi.grouped_payment_share(pay).first().part_mobile_money_pct == 66.7


def test_period_delta_gap_fill(spark):
    m = spark.createDataFrame(
        [(dt.date(2025, 10, 1), 10), (dt.date(2025, 12, 1), 25)], "mois date, ca long"
    )
    plain = [(r.mois.month, r.delta) for r in ranking.period_delta(m, "mois", "ca").orderBy("mois").collect()]
    assert plain == [(10, None), (12, 15)]  # previous present month
    filled = [(r.mois.month, r.ca, r.delta) for r in ranking.period_delta(m, "mois", "ca", fill_gaps=True).orderBy("mois").collect()]
    assert filled == [(10, 10, None), (11, 0, -10), (12, 25, 25)]


def test_period_delta_by_group_fills_the_calendar(spark):
    d = dt.date
    m = spark.createDataFrame(
        [("a", d(2025, 10, 1), 10), ("a", d(2026, 1, 1), 25), ("a", d(2026, 2, 1), None), ("b", d(2025, 12, 1), 7),
         (None, d(2025, 11, 1), 3), (None, d(2025, 12, 1), 4), ("a", None, 5)],
        "g string, mois date, ca long",
    )
    out = ranking.period_delta_by(m, ["g"], "mois", "ca")
    assert out.columns == ["g", "mois", "ca", "delta"]
    got = {(r.g, r.mois): (r.ca, r.delta) for r in out.collect()}
    assert got == {
        ("a", None): (5, None),
        ("a", d(2025, 10, 1)): (10, None), ("a", d(2025, 11, 1)): (0, -10), ("a", d(2025, 12, 1)): (0, 0),
        ("a", d(2026, 1, 1)): (25, 25), ("a", d(2026, 2, 1)): (0, -25),
        ("b", d(2025, 12, 1)): (7, None),
        (None, d(2025, 11, 1)): (3, None), (None, d(2025, 12, 1)): (4, 1),
    }
    assert out.count() == 9 and ranking.period_delta_by(m.limit(0), ["g"], "mois", "ca").count() == 0


def test_period_delta_by_equals_a_plain_calendar(spark):
    import random

    rnd, data = random.Random(4), {}
    for g in range(30):
        for k in rnd.sample(range(60), rnd.randint(1, 12)):
            data[g, k] = rnd.randint(0, 99)
    month = lambda k: dt.date(2020 + k // 12, k % 12 + 1, 1)
    m = spark.createDataFrame([(g, month(k), v) for (g, k), v in data.items()], "g int, mois date, ca long")
    want = set()
    for g in range(30):
        own = [k for h, k in data if h == g]
        for k in range(min(own), max(own) + 1):
            v = data.get((g, k), 0)
            want.add((g, month(k), v, None if k == min(own) else v - data.get((g, k - 1), 0)))
    got = [tuple(r) for r in ranking.period_delta_by(m, ["g"], "mois", "ca").collect()]
    assert len(got) == len(want) and set(got) == want
