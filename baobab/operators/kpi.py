"""Revenue, basket and ranking indicators over orders, payments, order
lines, products and customers.

Conventions: ``orders`` is the output of :func:`prepare_orders` (cleaned
BIGINT ``montant_fcfa`` and an accent-folded ``statut_norm``).  Joins that
multiply rows (order lines) aggregate *before* joining dimensions, so the
dimension join sees one row per key; a key holding a large share of the
rows is collapsed by the map-side partial aggregate first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from baobab.functions import rules, text
from baobab.operators import quality

AMOUNT = "montant_fcfa"


def prepare_orders(orders_raw: DataFrame, raw_col: str = "montant_total_fcfa") -> DataFrame:
    """C13 + status key: raw amount kept, clean amount and folded status added."""
    out = quality.clean_amounts(orders_raw, raw_col=raw_col)
    return out.withColumn("statut_norm", text.fold_key(F.col("statut")))


def delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("statut_norm") == rules.DELIVERED)


def _money(col: str = AMOUNT) -> Column:
    return F.sum(F.col(col))


# --- single-table indicators -------------------------------------------------


def revenue_by_status(orders: DataFrame) -> DataFrame:
    """Orders and revenue per (folded) status."""
    return orders.groupBy(F.col("statut_norm").alias("statut")).agg(
        F.count("*").alias("nb_commandes"), _money().alias("ca_fcfa")
    )


def orders_per_status(orders: DataFrame) -> DataFrame:
    """Orders and total per status exactly as spelled."""
    return orders.groupBy("statut").agg(F.count("*").alias("nb_commandes"), _money().alias("total_fcfa"))


def delivered_share(orders: DataFrame) -> DataFrame:
    """Delivered revenue, total revenue and the delivered share (%)."""
    is_dlv = F.col("statut_norm") == rules.DELIVERED
    one = orders.agg(
        F.sum(F.when(is_dlv, F.col(AMOUNT)).otherwise(0)).alias("ca_livre"),
        _money().alias("ca_total"),
    )
    return one.withColumn("part_livre_pct", rules.pct(F.col("ca_livre"), F.col("ca_total"), 2))


def monthly_revenue(orders: DataFrame, date_col: str = "date_commande") -> DataFrame:
    """C17: delivered orders and revenue per calendar month (month start date)."""
    return (
        delivered(orders)
        .groupBy(F.trunc(F.col(date_col).cast("date"), "month").alias("mois"))
        .agg(F.count("*").alias("nb_commandes"), _money().alias("ca_fcfa"))
    )


def monthly_label_revenue(orders: DataFrame, date_col: str = "date_commande") -> DataFrame:
    """Delivered revenue per ``yyyy-MM`` label."""
    return (
        delivered(orders)
        .groupBy(F.date_format(F.col(date_col), "yyyy-MM").alias("mois"))
        .agg(_money().alias("ca_fcfa"))
    )


def record_month(orders: DataFrame, date_col: str = "date_commande") -> DataFrame:
    """C17: the month with the highest delivered revenue (earliest on ties)."""
    return monthly_label_revenue(orders, date_col).orderBy(F.col("ca_fcfa").desc(), F.col("mois")).limit(1)


def basket_by_channel(orders: DataFrame, channel: str = "canal") -> DataFrame:
    """Orders, revenue and rounded average basket per channel."""
    return orders.groupBy(channel).agg(
        F.count("*").alias("nb_commandes"),
        _money().alias("ca_fcfa"),
        F.round(F.avg(F.col(AMOUNT)), 0).alias("panier_moyen_fcfa"),
    )


def basket_pivot(orders: DataFrame, channels: Sequence[str] = ("mobile_app", "web"), channel: str = "canal") -> DataFrame:
    """One row, one conditional average per channel plus the global one.

    ``AVG(CASE WHEN ... THEN x END)`` ignores the other channels' rows.
    """
    cols = [
        F.round(F.avg(F.when(F.col(channel) == c, F.col(AMOUNT))), 0).alias(f"panier_{c.split('_')[0]}")
        for c in channels
    ]
    return orders.agg(*cols, F.round(F.avg(F.col(AMOUNT)), 0).alias("panier_global"))


def customer_revenue(orders: DataFrame, key: str = "customer_id") -> DataFrame:
    return orders.groupBy(key).agg(F.count("*").alias("nb_commandes"), _money().alias("ca_fcfa"))


def top_customers(orders: DataFrame, threshold: int = 1_000_000, k: int = 10, key: str = "customer_id") -> DataFrame:
    """Customers whose revenue exceeds ``threshold`` (HAVING), top ``k``
    by revenue; ties broken by key so the cut is stable."""
    agg = customer_revenue(orders, key).filter(F.col("ca_fcfa") > threshold)
    return agg.orderBy(F.col("ca_fcfa").desc(), F.col(key)).limit(k)


def top_customer(orders: DataFrame, key: str = "customer_id") -> DataFrame:
    """The arg-max customer as a one-row frame."""
    return customer_revenue(orders, key).orderBy(F.col("ca_fcfa").desc(), F.col(key)).limit(1)


def top_orders(orders: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` largest orders, ties broken by order id."""
    return (
        orders.filter(F.col(AMOUNT).isNotNull())
        .select("order_id", "customer_id", "statut", AMOUNT)
        .orderBy(F.col(AMOUNT).desc(), F.col("order_id"))
        .limit(k)
    )


def delivered_in_month(orders: DataFrame, month: str, channel_value: str = "mobile_app", channel: str = "canal", date_col: str = "date_commande") -> DataFrame:
    """Delivered orders of a channel in one calendar month.

    Half-open range ``[month, month + 1)`` so the last day counts whole
    (``BETWEEN`` on a timestamp would drop its hours).
    """
    start = F.lit(f"{month}-01").cast("date")
    ts = F.col(date_col)
    cond = (
        (F.col(channel) == channel_value)
        & (F.col("statut_norm") == rules.DELIVERED)
        & (ts >= start.cast("timestamp_ntz"))
        & (ts < F.add_months(start, 1).cast("timestamp_ntz"))
    )
    return orders.filter(cond).agg(F.count("*").alias("nb_commandes"))


def delivered_in_stored_month(stored: DataFrame, month: str, channel_value: str = "mobile_app", channel: str = "canal") -> DataFrame:
    """C21 over orders stored by month with their folded status: the month is a
    partition and the status a plain column, so both filters are the scan's."""
    cond = (F.col("mois") == month) & (F.col(channel) == channel_value) & (F.col("statut_norm") == rules.DELIVERED)
    return stored.filter(cond).agg(F.count("*").alias("nb_commandes"))


def last_months_revenue(stored: DataFrame, months: DataFrame, k: int = 3) -> DataFrame:
    """C17: delivered revenue of the ``k`` latest of ``months`` (one column mois).

    Which month begins them is found by the query, as a scalar subquery in the
    scan's partition filter, so only their partitions are read."""
    latest = months.filter(F.col("mois").isNotNull()).distinct().orderBy(F.desc("mois")).limit(k)
    recent = stored.filter(F.col("mois") >= latest.agg(F.min("mois")).scalar())
    return delivered(recent).groupBy("mois").agg(_money().alias("ca_fcfa"), F.count("*").alias("nb_commandes"))


# --- payments ----------------------------------------------------------------


def payment_share(payments: DataFrame, method: str = "methode") -> DataFrame:
    """Payments per method and share of all payments (%).

    The share uses ``sum(count) over ()``: the global window runs on the
    aggregated rows (one per method), never on raw payments.
    """
    per = payments.groupBy(method).agg(F.count("*").alias("nb"))
    total = F.sum("nb").over(Window.partitionBy())
    return per.withColumn("part_pct", rules.pct(F.col("nb"), total, 1))


def grouped_payment_share(payments: DataFrame, methods: Sequence[str] = rules.MOBILE_MONEY, method: str = "methode") -> DataFrame:
    """C20: share (%) of payments made with any of ``methods``."""
    hit = F.sum(F.when(F.col(method).isin(list(methods)), 1).otherwise(0))
    return payments.agg(rules.pct(hit, F.count("*"), 1).alias("part_mobile_money_pct"))


def with_payment(orders: DataFrame, payments: DataFrame, method: str = "methode") -> DataFrame:
    """Orders with each of their payment methods: an order paid with several
    methods is a row for each, one paid twice with the same method is one row."""
    return orders.join(payments.select("order_id", method).distinct(), "order_id", "left")


def basket_by_payment(orders: DataFrame, payments: DataFrame, method: str = "methode") -> DataFrame:
    """Orders and rounded average basket per payment method."""
    return with_payment(orders, payments, method).groupBy(method).agg(
        F.count("*").alias("nb"), F.round(F.avg(F.col(AMOUNT)), 0).alias("panier_moyen_fcfa")
    )


def cancel_rate(orders: DataFrame, payments: DataFrame, method: str = "methode") -> DataFrame:
    """Cancelled orders and cancellation rate (%) per payment method.

    The status is reduced to a 0/1 flag before the payment join, so the
    shuffle carries an int per order rather than the status text."""
    flagged = orders.select(
        "order_id", F.when(F.col("statut_norm") == rules.CANCELLED, 1).otherwise(0).alias("_c")
    )
    cancelled = F.sum("_c")
    return (
        with_payment(flagged, payments, method)
        .groupBy(method)
        .agg(F.count("*").alias("nb_total"), cancelled.alias("nb_annulees"))
        .withColumn("taux_annulation_pct", rules.pct(F.col("nb_annulees"), F.col("nb_total"), 1))
    )


# --- customers and products ----------------------------------------------------


def clients_per_city(customers: DataFrame, city: str = "ville") -> DataFrame:
    """Customers per city."""
    return customers.groupBy(city).agg(F.count("*").alias("nb_clients"))


def distinct_cities(customers: DataFrame, city: str = "ville") -> DataFrame:
    """Number of distinct cities."""
    return customers.agg(F.count_distinct(F.col(city)).alias("nb_villes"))


def city_listing(customers: DataFrame, city_key: str, key_col: str = "ville_norm", columns: Sequence[str] = ("customer_id", "prenom", "nom", "ville")) -> DataFrame:
    """Customers of one city (matched on the folded key)."""
    return customers.filter(F.col(key_col) == city_key).select(*columns)


def top_products_price(products: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` dearest products, ties by product id."""
    return (
        products.select("product_id", "nom_produit", "categorie", "prix_unitaire_fcfa")
        .orderBy(F.col("prix_unitaire_fcfa").desc(), F.col("product_id"))
        .limit(k)
    )


# --- multi-table indicators --------------------------------------------------


def revenue_by_region(orders: DataFrame, customers: DataFrame, group: str | Sequence[str] = "region") -> DataFrame:
    """Delivered revenue and orders per customer attribute.

    Orders are first reduced to one row per customer (partial + final
    aggregate); the customer join then runs on already hash-partitioned
    customer-sized inputs, and a customer owning a large share of orders
    is collapsed map-side instead of skewing the join.
    """
    per_customer = delivered(orders).groupBy("customer_id").agg(
        F.count("*").alias("_n"), _money().alias("_ca")
    )
    groups = [group] if isinstance(group, str) else list(group)
    attrs = [g for g in groups if g != "customer_id"]
    joined = per_customer.join(customers.select("customer_id", *attrs), "customer_id")
    return joined.groupBy(*groups).agg(
        F.sum("_ca").alias("ca_fcfa"), F.sum("_n").cast("bigint").alias("nb_commandes")
    )


def delivered_line_revenue(items: DataFrame, orders: DataFrame, by: Sequence[str] = ("product_id",), order_attrs: DataFrame | None = None) -> DataFrame:
    """Revenue ``sum(quantite * prix_unitaire_fcfa)`` of delivered order lines,
    and number of lines, aggregated by ``by`` (columns of the lines or of ``order_attrs``).

    ``order_attrs`` (one row per order id) adds order-level attributes such
    as the region; it replaces the delivered orders when given and must be
    already restricted to delivered orders.
    """
    keys = order_attrs if order_attrs is not None else delivered(orders).select("order_id")
    # line revenue is computed before the join: the order-line shuffle, the
    # largest of these plans, carries one amount instead of quantity and price
    item_cols = [c for c in by if c in items.columns and c != "order_id"]
    amounts = items.select(
        "order_id", *item_cols, (F.col("quantite") * F.col("prix_unitaire_fcfa")).alias("_ca")
    )
    lines = amounts.join(keys, "order_id")
    return lines.groupBy(*by).agg(F.sum("_ca").alias("ca"), F.count("*").alias("nb"))


def top_products(items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` products (category, name) by delivered line revenue,
    over lines -> orders -> customers -> products.

    An inner join on the customer, as in :func:`revenue_by` and
    :func:`revenue_by_region`: orders without a known customer are dropped, and
    an order counts once for every row of its customer.  Revenue is aggregated
    per product id before the product join.
    """
    known = orders_with(orders, customers, ())
    per_product = delivered_line_revenue(items, orders, ("product_id",), known)
    named = per_product.join(products.select("product_id", "categorie", "nom_produit"), "product_id")
    agg = named.groupBy("categorie", "nom_produit").agg(F.sum("ca").alias("ca"))
    return agg.orderBy(F.col("ca").desc(), "categorie", "nom_produit").limit(k)


def orders_with(orders: DataFrame, customers: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Delivered order ids with customer attributes (inner join on the customer)."""
    return delivered(orders).select("order_id", "customer_id").join(
        customers.select("customer_id", *attrs), "customer_id"
    ).select("order_id", *attrs)


def revenue_by(items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, customer_attrs: Sequence[str] = (), product_attrs: Sequence[str] = ()) -> DataFrame:
    """Delivered line revenue (``ca_fcfa``) and number of sold lines
    (``nb_ventes``) by any customer and product attributes.

    Lines join delivered orders, are reduced per (attributes, product id), and
    only then meet the product table.  The customer table is joined for its
    attributes alone: without any, orders of unknown customers count too.
    """
    attrs = orders_with(orders, customers, customer_attrs) if customer_attrs else None
    per = delivered_line_revenue(items, orders, (*customer_attrs, "product_id"), attrs)
    if product_attrs:
        per = per.join(products.select("product_id", *product_attrs), "product_id")
    return per.groupBy(*customer_attrs, *product_attrs).agg(
        F.sum("ca").alias("ca_fcfa"), F.sum("nb").alias("nb_ventes")
    )


def monthly_line_revenue(
    items: DataFrame, orders: DataFrame, by: Sequence[str] = ("product_id",), date_col: str = "date_commande"
) -> DataFrame:
    """Delivered line revenue per calendar month and ``by`` (columns of the lines)."""
    month = F.trunc(F.col(date_col).cast("date"), "month").alias("mois")
    per = delivered_line_revenue(items, orders, (*by, "mois"), delivered(orders).select("order_id", month))
    return per.select(*by, "mois", F.col("ca").alias("ca_fcfa"))


def share_by_category(items: DataFrame, orders: DataFrame, payments: DataFrame, products: DataFrame, methods: Sequence[str] = rules.MOBILE_MONEY, method: str = "methode") -> DataFrame:
    """Delivered line revenue per category and the share (%) paid with
    ``methods``.

    An order is paid with ``methods`` if any of its payments is, so that a split
    payment counts its lines once.  Lines are summed per (order, product) and
    payments per order before they meet: an order that holds a large share of
    the lines is a few rows then, and the join has nothing to split.
    """
    hit = F.max(F.coalesce(F.col(method).isin(list(methods)), F.lit(False)))
    flags = payments.groupBy("order_id").agg(hit.alias("_mm"))
    amount = F.sum(F.col("quantite") * F.col("prix_unitaire_fcfa"))
    lines = items.groupBy("order_id", "product_id").agg(amount.alias("_ca"))
    paid = lines.join(delivered(orders).select("order_id"), "order_id").join(flags, "order_id", "left")
    per = paid.groupBy("product_id", F.coalesce("_mm", F.lit(False)).alias("_mm")).agg(F.sum("_ca").alias("ca"))
    per = per.join(products.select("product_id", "categorie"), "product_id")
    agg = per.groupBy("categorie").agg(
        F.sum("ca").alias("ca_total_fcfa"),
        F.sum(F.when(F.col("_mm"), F.col("ca")).otherwise(0)).alias("ca_mobile_money_fcfa"),
    )
    return agg.withColumn("part_mobile_money_pct", rules.pct(F.col("ca_mobile_money_fcfa"), F.col("ca_total_fcfa"), 1))
