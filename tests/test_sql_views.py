"""SQL over the registered views gives the operators' results (the SQL
entry point and the DataFrame entry point agree)."""

import pytest
from pyspark.testing import assertDataFrameEqual

from baobab.operators import funnel, joins, kpi, ranking
from baobab.plans.views import register_commerce_views
from baobab.sources.catalog import create_view_as
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def views(spark):
    register_commerce_views(spark, SF_SMALL, as_of="2026-01-01")
    return spark


def test_region_totals(views):
    per_client = views.sql(
        "SELECT customer_id, sum(montant_fcfa) AS somme, count(1) AS lignes FROM commandes_clean WHERE statut_norm LIKE 'livree' GROUP BY ALL"
    )
    per_client.createOrReplaceTempView("totaux_clients")
    sql = views.sql(
        "SELECT region, sum(somme) AS ca_fcfa, sum(lignes) AS nb_commandes FROM totaux_clients NATURAL JOIN (SELECT customer_id, region FROM clients) GROUP BY region"
    )
    op = kpi.revenue_by_region(views.table("commandes_clean"), views.table("clients"))
    assertDataFrameEqual(sql, op.select("region", "ca_fcfa", "nb_commandes"))


def test_funnel_from_session_flags(views):
    sql = views.sql(
        """WITH flags AS (
             SELECT session_id, any(event_type = 'view_product') AS a, any(event_type = 'add_to_cart') AS b,
                    any(event_type = 'purchase') AS c
             FROM events WHERE session_id IS NOT NULL GROUP BY session_id)
           SELECT count(*) AS sessions, count_if(a) AS vues, count_if(b) AS paniers, count_if(c) AS achats FROM flags"""
    )
    assertDataFrameEqual(sql, funnel.funnel_counts(views.table("events")))


def test_month_before(views):
    create_view_as(
        views,
        "livraisons_mois",
        "SELECT substr(CAST(date_commande AS STRING), 1, 7) AS mois, sum(montant_fcfa) AS ca_fcfa FROM commandes_clean WHERE statut_norm = 'livree' GROUP BY ALL",
    )
    sql = views.sql(
        "SELECT mois, ca_fcfa, ca_fcfa - first(ca_fcfa) OVER (ORDER BY mois ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS delta FROM livraisons_mois"
    )
    op = ranking.period_delta(kpi.monthly_label_revenue(views.table("commandes_clean")), "mois", "ca_fcfa")
    assertDataFrameEqual(sql, op)


def test_not_in_against_set_difference(views):
    keys = views.sql("SELECT customer_id FROM commandes_clean EXCEPT SELECT customer_id FROM clients_partiels")
    keys.createOrReplaceTempView("cles_inconnues")
    n = views.sql("SELECT count(*) FROM commandes_clean LEFT SEMI JOIN cles_inconnues USING (customer_id)").first()[0]
    r = joins.not_in_count(views.table("commandes_clean"), views.table("clients_partiels"), "customer_id").first()
    assert r.n_not_in == r.n_anti == n > 0


def test_metamorphic_shares_and_funnel(views):
    spark = views
    shares = kpi.payment_share(spark.table("paiements")).agg({"part_pct": "sum"}).first()[0]
    assert abs(shares - 100.0) < 0.5
    f = funnel.funnel_counts(spark.table("events")).first()
    assert max(f.vues, f.paniers, f.achats) <= f.sessions
    s = funnel.funnel_counts(spark.table("events"), strict=True).first()
    assert s.achats <= s.paniers <= s.vues <= f.vues
    clean = spark.table("clients_propres")
    assert clean.count() == clean.select("customer_id").distinct().count()


def test_wide_view_and_repeated_keys(views):
    wide = create_view_as(
        views,
        "commandes_clients",
        "SELECT cmd.*, cli.* EXCEPT (customer_id) FROM clients_partiels cli, commandes_clean cmd WHERE cli.customer_id = cmd.customer_id",
    )
    r = joins.row_discipline(views.table("commandes_clean"), views.table("clients_partiels"), "customer_id").first()
    assert wide.count() == r.n_apres
    sql = views.sql(
        "SELECT customer_id, n FROM (SELECT customer_id, count(*) AS n FROM clients_partiels GROUP BY 1) WHERE n >= 2"
    )
    assertDataFrameEqual(sql, joins.duplicate_keys(views.table("clients_partiels"), "customer_id"))
