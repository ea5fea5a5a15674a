"""SQL entry point: the commerce tables as session temp views.

``register_commerce_views`` puts the inputs and the library's cleaned
frames in the session catalog under the names SQL users query
(``commandes``, ``commandes_clean``, ``clients``, ``produits`` ...), so a
query written in SQL runs on the same plans as the DataFrame operators:
views are inlined by the analyzer and optimised with the rest of the query.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from baobab.operators import cleaning, kpi
from baobab.plans import inputs
from baobab.sources.catalog import register_views


def register_commerce_views(spark: SparkSession, sf_dir: str, as_of: str | None = None) -> list[str]:
    """Register the views and return their names."""
    customers_raw = inputs.customers_raw(spark, sf_dir)
    orders_raw = inputs.orders_raw(spark, sf_dir)
    frames = {
        "clients_bruts": customers_raw,
        "clients_propres": cleaning.clean_customers(customers_raw, as_of=as_of),
        "clients": inputs.customers_dim(spark, sf_dir),
        "clients_partiels": inputs.clients_partial(spark, sf_dir),
        "commandes": orders_raw,
        "commandes_clean": kpi.prepare_orders(orders_raw),
        "paiements": inputs.payments(spark, sf_dir),
        "lignes_commande": inputs.items(spark, sf_dir),
        "produits": inputs.products(spark, sf_dir),
        "events": inputs.web_events(spark, sf_dir),
    }
    register_views(spark, frames)
    return list(frames)
