"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's whole tables (through the stand-in input
builders of :mod:`baobab.plans.inputs`) and runs the library's operators on
them.  Column names match the DuckDB oracle in :mod:`baobab.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baobab.functions import rules
from baobab.operators import cleaning, funnel, joins, kpi, quality, ranking, text
from baobab.plans import exports, inputs, views
from baobab.session import materialise
from baobab.sources import files, layout, publication, rejects
from baobab.sources.catalog import create_view_as
from baobab.streaming import clean_drops

# --- Fixed query parameters ----------------------------------------------------
AS_OF = "2026-01-01"          # upper bound for birth dates (fixed, not "today")
REVENUE_THRESHOLD = 1_000_000  # HAVING threshold for top customers
FILTER_MONTH = "2000-12"      # month of the delivered-mobile count
RECENT_SINCE = "2001-07-01"   # customers without an order since this day
LISTED_CITY = "thies"         # folded key of the listed city
PUBLISHED_DAYS = ("1999-01-01", "2000-01-01")  # reports over the orders before each
PUBLISHED_AS_OF = "1999-06-30"  # a day between the two
FUNNEL_WINDOW = "6 hours"     # from the first step of an ordered funnel to its last
# -------------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Lazily built stand-in inputs for one (session, sf_dir)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def customers_raw(self) -> DataFrame:
        return inputs.customers_raw(self.spark, self.sf_dir)

    def customers_clean(self) -> DataFrame:
        return cleaning.clean_customers(self.customers_raw(), as_of=AS_OF)

    def orders_raw(self) -> DataFrame:
        return inputs.orders_raw(self.spark, self.sf_dir)

    def orders(self) -> DataFrame:
        return kpi.prepare_orders(self.orders_raw())

    def payments(self) -> DataFrame:
        return inputs.payments(self.spark, self.sf_dir)

    def items(self) -> DataFrame:
        return inputs.items(self.spark, self.sf_dir)

    def products(self) -> DataFrame:
        return inputs.products(self.spark, self.sf_dir)

    def customers(self) -> DataFrame:
        return inputs.customers_dim(self.spark, self.sf_dir)

    def clients_partial(self) -> DataFrame:
        return inputs.clients_partial(self.spark, self.sf_dir)

    def events(self) -> DataFrame:
        return inputs.web_events(self.spark, self.sf_dir)

    def documents(self) -> DataFrame:
        return inputs.table(self.spark, self.sf_dir, "documents")

    # file copies of the stand-in inputs
    def orders_csv_path(self) -> str:
        return exports.export(self.spark, "orders", self.orders_raw(), "csv", exports.CSV_WRITE)

    def customers_csv_path(self) -> str:
        return exports.export(self.spark, "customers", self.customers_raw(), "csv", exports.CSV_WRITE)

    def events_json_path(self) -> str:
        return exports.export(self.spark, "events", self.events(), "json")

    def checked_order_lines(self) -> DataFrame:
        path = exports.export(self.spark, "order_lines", inputs.order_lines(self.spark, self.sf_dir), "text")
        return rejects.check_csv(self.spark, path, inputs.LINE_SCHEMA, required=("order_id",))

    def documents_text_path(self) -> str:
        texts = self.documents().select("text").filter(F.col("text").isNotNull())
        return exports.export(self.spark, "documents", texts, "text")


_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Inputs], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run

    return deco


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- cleaning (C1 - C7) ------------------------------------------------------------


@query("clean_email")
def _clean_email(i: Inputs) -> DataFrame:
    """C1 + C2: missing e-mails unified, then lower/trim and validity flag."""
    df = i.customers_raw().transform(cleaning.unify_missing).transform(cleaning.normalize_email)
    return df.select("customer_id", "email", "email_valide")


@query("clean_city")
def _clean_city(i: Inputs) -> DataFrame:
    """Display city and accent-free key."""
    return cleaning.normalize_city(i.customers_raw()).select("customer_id", "ville", "ville_norm")


@query("clean_phone")
def _clean_phone(i: Inputs) -> DataFrame:
    """C4: digits-only phone without country code and mobile validity."""
    return cleaning.normalize_phone(i.customers_raw()).select("customer_id", "telephone", "telephone_valide")


@query("clean_birth")
def _clean_birth(i: Inputs) -> DataFrame:
    """Valid birth date or NULL."""
    return cleaning.validate_birth_date(i.customers_raw(), as_of=AS_OF).select("customer_id", "date_naissance")


@query("dedup_customers")
def _dedup(i: Inputs) -> DataFrame:
    """One raw row per customer id (deterministic survivor)."""
    return cleaning.dedup_customers(i.customers_raw())


@query("clean_customers")
def _clean_customers(i: Inputs) -> DataFrame:
    """The whole cleaning chain."""
    return i.customers_clean()


@query("before_after")
def _before_after(i: Inputs) -> DataFrame:
    """Rows, distinct cities, missing e-mails before and after cleaning."""
    return quality.before_after(i.customers_raw(), i.customers_clean())


# --- quality (C8, C10, C42, D2, A3) ---------------------------------------------------


@query("quality_profile")
def _quality_profile(i: Inputs) -> DataFrame:
    """One-pass profile of raw customers."""
    return quality.quality_profile(i.customers_raw())


@query("null_counts")
def _null_counts(i: Inputs) -> DataFrame:
    """A3: NULLs of every raw customer column."""
    return quality.null_counts(i.customers_raw())


@query("pseudo_missing")
def _pseudo_missing(i: Inputs) -> DataFrame:
    """Pseudo-missing e-mails, rule form and literal SQL form."""
    return quality.pseudo_missing(i.customers_raw())


@query("exact_duplicates")
def _exact_duplicates(i: Inputs) -> DataFrame:
    """Exact duplicate raw customer rows."""
    return quality.exact_duplicate_count(i.customers_raw())


@query("table_profile")
def _table_profile(i: Inputs) -> DataFrame:
    """Per-column shape of raw orders."""
    return quality.table_profile(i.orders_raw())


@query("orders_head")
def _orders_head(i: Inputs) -> DataFrame:
    """The first five raw orders (the sample is the feature)."""
    return quality.head_sample(i.orders_raw(), ["order_id"], 5)


@query("drop_duplicates")
def _drop_duplicates(i: Inputs) -> DataFrame:
    """D3: raw customers without exact copies."""
    return cleaning.drop_exact_duplicates(i.customers_raw())


@query("value_counts")
def _value_counts(i: Inputs) -> DataFrame:
    """Value counts of status and channel in one shuffle."""
    return quality.value_counts(i.orders_raw(), ["statut", "canal"])


# --- polluted amounts (C12 - C15) -----------------------------------------------------------


@query("amount_polluted")
def _amount_polluted(i: Inputs) -> DataFrame:
    """Non-numeric raw amounts."""
    return quality.amount_polluted(i.orders_raw())


@query("amount_polluted_samples")
def _amount_samples(i: Inputs) -> DataFrame:
    """Ten distinct polluted values (the sample is the feature)."""
    return quality.amount_polluted_samples(i.orders_raw())


@query("amount_clean")
def _amount_clean(i: Inputs) -> DataFrame:
    """Raw and cleaned amount of every order."""
    return i.orders().select("order_id", "montant_raw", "montant_fcfa")


@query("amount_strict")
def _amount_strict(i: Inputs) -> DataFrame:
    """Strict cast of the amounts that are digits only (it raises on any other)."""
    digits = i.orders_raw().where(~rules.amount_is_polluted(F.col("montant_total_fcfa")))
    return quality.clean_amounts(digits, strict=True).select("order_id", "montant_fcfa")


@query("amount_suspects")
def _amount_suspects(i: Inputs) -> DataFrame:
    """Raw amounts that lose a sign or a decimal mark in cleaning, counted."""
    flagged = quality.suspect_amounts(i.orders_raw())
    return flagged.groupBy("montant_suspect").agg(F.count("*").alias("n"))


@query("amount_validation")
def _amount_validation(i: Inputs) -> DataFrame:
    """C14: cleaning validation."""
    return quality.amount_validation(i.orders())


@query("amount_gap")
def _amount_gap(i: Inputs) -> DataFrame:
    """Naive against clean revenue."""
    return quality.amount_gap(i.orders_raw())


@query("amount_report")
def _amount_report(i: Inputs) -> DataFrame:
    """C12 + C14 + C15: polluted count, validation and gap in one scan."""
    return quality.amount_report(i.orders_raw())


# --- single-table indicators (C16 - C21, C36, C37, C40, C41) ------------------------


@query("revenue_by_status")
def _revenue_by_status(i: Inputs) -> DataFrame:
    """Revenue per folded status."""
    return kpi.revenue_by_status(i.orders())


@query("orders_per_status")
def _orders_per_status(i: Inputs) -> DataFrame:
    """Orders and total per status as spelled."""
    return kpi.orders_per_status(i.orders())


@query("delivered_share")
def _delivered_share(i: Inputs) -> DataFrame:
    """Delivered share of revenue."""
    return kpi.delivered_share(i.orders())


@query("monthly_revenue")
def _monthly_revenue(i: Inputs) -> DataFrame:
    """C17: delivered revenue per month."""
    return kpi.monthly_revenue(i.orders())


@query("record_month")
def _record_month(i: Inputs) -> DataFrame:
    """C17: the record month."""
    return kpi.record_month(i.orders())


@query("basket_by_channel")
def _basket_by_channel(i: Inputs) -> DataFrame:
    """Average basket per channel."""
    return kpi.basket_by_channel(i.orders())


@query("basket_pivot")
def _basket_pivot(i: Inputs) -> DataFrame:
    """One-row pivot of baskets."""
    return kpi.basket_pivot(i.orders())


@query("top_customers_having")
def _top_customers(i: Inputs) -> DataFrame:
    """Top 10 customers above the revenue threshold."""
    return kpi.top_customers(i.orders(), REVENUE_THRESHOLD, 10)


@query("top_customer")
def _top_customer(i: Inputs) -> DataFrame:
    """The arg-max customer."""
    return kpi.top_customer(i.orders())


@query("top_orders")
def _top_orders(i: Inputs) -> DataFrame:
    """Five largest orders."""
    return kpi.top_orders(i.orders(), 5)


@query("filtered_count")
def _filtered_count(i: Inputs) -> DataFrame:
    """Delivered mobile orders in one month."""
    return kpi.delivered_in_month(i.orders(), FILTER_MONTH)


@query("payment_share")
def _payment_share(i: Inputs) -> DataFrame:
    """C20: payments per method and share."""
    return kpi.payment_share(i.payments())


@query("grouped_payment_share")
def _grouped_payment_share(i: Inputs) -> DataFrame:
    """C20: mobile-money share of payments."""
    return kpi.grouped_payment_share(i.payments())


@query("basket_by_payment")
def _basket_by_payment(i: Inputs) -> DataFrame:
    """Average basket per payment method."""
    return kpi.basket_by_payment(i.orders(), i.payments())


@query("cancel_rate")
def _cancel_rate(i: Inputs) -> DataFrame:
    """Cancellation rate per payment method."""
    return kpi.cancel_rate(i.orders(), i.payments())


@query("clients_per_city")
def _clients_per_city(i: Inputs) -> DataFrame:
    """Cleaned customers per city."""
    return kpi.clients_per_city(i.customers_clean(), "ville_norm")


@query("distinct_cities")
def _distinct_cities(i: Inputs) -> DataFrame:
    """Distinct cleaned cities."""
    return kpi.distinct_cities(i.customers_clean(), "ville_norm")


@query("city_listing")
def _city_listing(i: Inputs) -> DataFrame:
    """Cleaned customers of one city."""
    return kpi.city_listing(i.customers_clean(), LISTED_CITY)


@query("top_products_price")
def _top_products_price(i: Inputs) -> DataFrame:
    """Ten dearest products."""
    return kpi.top_products_price(i.products(), 10)


# --- multi-table indicators (C22, C23, C33 - C35, C38) ---------------------------------


@query("revenue_by_region")
def _revenue_by_region(i: Inputs) -> DataFrame:
    """Delivered revenue per region (flagship)."""
    return kpi.revenue_by_region(i.orders(), i.customers(), "region")


@query("revenue_by_city")
def _revenue_by_city(i: Inputs) -> DataFrame:
    """Delivered revenue per city."""
    return kpi.revenue_by_region(i.orders(), i.customers(), "ville")


@query("region_report")
def _region_report(i: Inputs) -> DataFrame:
    """C22 + O1: delivered revenue per region, dearest first, fully ordered."""
    return kpi.revenue_by_region(i.orders(), i.customers(), "region").orderBy(F.desc("ca_fcfa"), "region")


@query("revenue_city_total")
def _revenue_city_total(i: Inputs) -> DataFrame:
    """Aggregate of an aggregate (total of the per-city revenue)."""
    per_city = kpi.revenue_by_region(i.orders(), i.customers(), "ville")
    return per_city.agg(F.sum("ca_fcfa").alias("ca_total_fcfa"), F.count("*").alias("nb_villes"))


@query("top_products")
def _top_products(i: Inputs) -> DataFrame:
    """Top 10 products over four tables."""
    return kpi.top_products(i.items(), i.orders(), i.customers(), i.products(), 10)


@query("top_products_partial")
def _top_products_partial(i: Inputs) -> DataFrame:
    """C23 over the broken customer extract: unknown customers drop their
    orders, repeated ones multiply them, as an inner join does."""
    return kpi.top_products(i.items(), i.orders(), i.clients_partial(), i.products(), 10)


@query("top3_per_region")
def _top3_per_region(i: Inputs) -> DataFrame:
    """Top 3 products per region by delivered line revenue."""
    per = kpi.revenue_by(i.items(), i.orders(), i.customers(), i.products(), ("region",), ("nom_produit",)).drop("nb_ventes")
    return ranking.top_n_per_group(per, ["region"], "ca_fcfa", 3, ["nom_produit"])


@query("monthly_delta")
def _monthly_delta(i: Inputs) -> DataFrame:
    """Month-over-month change of delivered revenue."""
    return ranking.period_delta(kpi.monthly_label_revenue(i.orders()), "mois", "ca_fcfa")


@query("monthly_delta_by_product")
def _monthly_delta_by_product(i: Inputs) -> DataFrame:
    """C34 per product against the calendar month before; months without a sale
    between a product's first and last count as 0."""
    sold = kpi.monthly_line_revenue(i.items(), i.orders())
    return ranking.period_delta_by(sold, ["product_id"], "mois", "ca_fcfa")


@query("revenue_city_category")
def _revenue_city_category(i: Inputs) -> DataFrame:
    """Delivered line revenue per city and category."""
    return kpi.revenue_by(i.items(), i.orders(), i.customers(), i.products(), ("ville",), ("categorie",))


@query("revenue_by_category")
def _revenue_by_category(i: Inputs) -> DataFrame:
    """Delivered line revenue and sales per category; the (broken) customer extract plays no part."""
    return kpi.revenue_by(i.items(), i.orders(), i.clients_partial(), i.products(), (), ("categorie",))


@query("revenue_by_product")
def _revenue_by_product(i: Inputs) -> DataFrame:
    """Delivered line revenue and sales per product with its category."""
    attrs = ("product_id", "nom_produit", "categorie")
    return kpi.revenue_by(i.items(), i.orders(), i.clients_partial(), i.products(), (), attrs)


@query("revenue_by_customer")
def _revenue_by_customer(i: Inputs) -> DataFrame:
    """Delivered orders and revenue per customer."""
    return kpi.revenue_by_region(i.orders(), i.customers(), ("customer_id", "nom", "ville"))


@query("share_by_category")
def _share_by_category(i: Inputs) -> DataFrame:
    """Mobile-money share of delivered revenue per category."""
    return kpi.share_by_category(i.items(), i.orders(), i.payments(), i.products())


# --- join audits (C24 - C28, C32, J8) -----------------------------------------------------


def _delivered_amounts(i: Inputs) -> DataFrame:
    return kpi.delivered(i.orders()).select("order_id", "customer_id", "date_commande", "montant_fcfa")


@query("sentinel")
def _sentinel(i: Inputs) -> DataFrame:
    """Delivered revenue before and after the customer join."""
    return joins.sentinel(_delivered_amounts(i), i.clients_partial(), "customer_id", "montant_fcfa")


@query("row_discipline")
def _row_discipline(i: Inputs) -> DataFrame:
    """Order rows before and after the customer join."""
    return joins.row_discipline(i.orders(), i.clients_partial(), "customer_id")


@query("orphans")
def _orphans(i: Inputs) -> DataFrame:
    """Orders whose customer is unknown."""
    cols = ["order_id", "customer_id", "date_commande", "statut", "montant_fcfa"]
    return joins.orphans(i.orders().select(*cols), i.clients_partial(), "customer_id")


@query("orphans_by_month")
def _orphans_by_month(i: Inputs) -> DataFrame:
    """Orphan orders per month."""
    return joins.orphans_by_month(i.orders(), i.clients_partial(), "customer_id", "date_commande")


@query("orphan_amount")
def _orphan_amount(i: Inputs) -> DataFrame:
    """Orphan count, share and amount at stake."""
    return joins.orphan_summary(i.orders(), i.clients_partial(), "customer_id", "montant_fcfa")


@query("partition_test")
def _partition_test(i: Inputs) -> DataFrame:
    """Semi + anti = left, with inner count and fan-out."""
    return joins.partition_test(i.orders(), i.clients_partial(), "customer_id")


@query("join_audit")
def _join_audit(i: Inputs) -> DataFrame:
    """The whole audit of the order -> customer join in one pass."""
    return joins.join_audit(i.orders(), i.clients_partial(), "customer_id", "montant_fcfa")


@query("duplicate_keys")
def _duplicate_keys(i: Inputs) -> DataFrame:
    """Customer keys present more than once."""
    return joins.duplicate_keys(i.clients_partial(), "customer_id")


@query("not_in_anti")
def _not_in_anti(i: Inputs) -> DataFrame:
    """NOT IN count next to the anti-join count."""
    return joins.not_in_count(i.orders(), i.clients_partial(), "customer_id")


@query("not_in_null_key")
def _not_in_null_key(i: Inputs) -> DataFrame:
    """NOT IN against raw customer ids, some of which are NULL: no row qualifies."""
    ids = i.customers_raw().select(F.col("customer_id").cast("bigint").alias("customer_id"))
    return joins.not_in_count(i.orders(), ids, "customer_id")


@query("unused_customers")
def _unused_customers(i: Inputs) -> DataFrame:
    """Customers without an order since a day."""
    recent = i.orders().filter(F.col("date_commande") >= F.lit(RECENT_SINCE).cast("timestamp_ntz"))
    return joins.unused_keys(i.customers(), recent, "customer_id")


@query("join_growth")
def _join_growth(i: Inputs) -> DataFrame:
    """Rows of orders before and after the order-line join."""
    return joins.row_discipline(i.orders(), i.items(), "order_id")


@query("orders_without_items")
def _orders_without_items(i: Inputs) -> DataFrame:
    """Orders that have no order line (anti join, counted)."""
    return joins.unused_keys(i.orders().select("order_id"), i.items(), "order_id").agg(
        F.count("*").alias("nb_commandes_sans_ligne")
    )


@query("event_order_integrity")
def _event_order_integrity(i: Inputs) -> DataFrame:
    """Purchase events pointing to an unknown order."""
    return joins.unknown_references(i.events(), i.orders(), "order_id", F.col("event_type") == "purchase")


# --- funnel (C29 - C31) -------------------------------------------------------------------


@query("funnel")
def _funnel(i: Inputs) -> DataFrame:
    """Distinct sessions per step."""
    return funnel.funnel_counts(i.events())


@query("funnel_strict")
def _funnel_strict(i: Inputs) -> DataFrame:
    """Nested funnel (a session counts at a step only if it also reached every earlier step)."""
    return funnel.funnel_counts(i.events(), strict=True)


@query("funnel_rates")
def _funnel_rates(i: Inputs) -> DataFrame:
    """Step and global rates."""
    return funnel.funnel_rates(funnel.funnel_counts(i.events()))


@query("funnel_by_device")
def _funnel_by_device(i: Inputs) -> DataFrame:
    """Funnel per device."""
    return funnel.funnel_by(i.events(), "device")


@query("funnel_by_city")
def _funnel_by_city(i: Inputs) -> DataFrame:
    """Ten cities with most sessions."""
    return funnel.top_segments(i.events(), "ville", 10)


@query("funnel_ordered")
def _funnel_ordered(i: Inputs) -> DataFrame:
    """Sessions that reach each step one after the other, whenever."""
    return funnel.ordered_funnel(i.events())


@query("funnel_ordered_window")
def _funnel_ordered_window(i: Inputs) -> DataFrame:
    """The same within a time window from the first step on."""
    return funnel.ordered_funnel(i.events(), within=FUNNEL_WINDOW)


@query("funnel_ordered_rates")
def _funnel_ordered_rates(i: Inputs) -> DataFrame:
    """Step and global rates of the ordered funnel; none can exceed 100 %."""
    return funnel.funnel_rates(funnel.ordered_funnel(i.events(), within=FUNNEL_WINDOW))


@query("funnel_first_device")
def _funnel_first_device(i: Inputs) -> DataFrame:
    """Each session in the segment of its first event."""
    return funnel.first_touch(i.events(), "device")


@query("funnel_first_city")
def _funnel_first_city(i: Inputs) -> DataFrame:
    """The same per city, all of them."""
    return funnel.first_touch(i.events(), "ville")


@query("funnel_first_total")
def _funnel_first_total(i: Inputs) -> DataFrame:
    """First-touch segments added up are the funnel itself."""
    names = ("sessions", *funnel.STEP_NAMES)
    return funnel.first_touch(i.events(), "device").agg(*(F.sum(n).cast("bigint").alias(n) for n in names))


@query("anonymous_sessions")
def _anonymous_sessions(i: Inputs) -> DataFrame:
    """Events without a session."""
    return funnel.anonymous_share(i.events())


# --- text (C11) ---------------------------------------------------------------------------


@query("word_count")
def _word_count(i: Inputs) -> DataFrame:
    """C11: word count over every document's whole text."""
    return text.word_count(i.documents(), "text")


@query("top_words")
def _top_words(i: Inputs) -> DataFrame:
    """C11: the 20 most frequent words (the ranking is the feature)."""
    return text.top_words(i.documents(), 20, "text")


# --- file sources (S1, S2, S4, S5) ------------------------------------------------------

EVENTS_SCHEMA = (
    "event_id long, event_time timestamp_ntz, session_id string, event_type string, "
    "device string, ville string, order_id long"
)


@query("csv_amount_report")
def _csv_amount_report(i: Inputs) -> DataFrame:
    """S1 + C12-C15: orders read from CSV with inferred types (the polluted
    amounts keep that column a string), then the one-scan amount report."""
    return quality.amount_report(files.read_csv(i.spark, i.orders_csv_path(), infer_schema=True))


CUSTOMERS_SCHEMA = (
    "customer_id string, prenom string, nom string, email string, telephone string, "
    "ville string, region string, date_naissance string, date_inscription string"
)


@query("csv_clean_customers")
def _csv_clean_customers(i: Inputs) -> DataFrame:
    """S3 + C7: raw customers read from CSV with an imposed schema (empty
    fields load as NULL), then the whole cleaning chain."""
    raw = files.read_csv(i.spark, i.customers_csv_path(), schema=CUSTOMERS_SCHEMA)
    return cleaning.clean_customers(raw, as_of=AS_OF)


@query("csv_value_counts")
def _csv_value_counts(i: Inputs) -> DataFrame:
    """S2 + C42: orders read from CSV as strings, value counts of status and channel."""
    return quality.value_counts(files.read_csv(i.spark, i.orders_csv_path()), ["statut", "canal"])


@query("json_funnel")
def _json_funnel(i: Inputs) -> DataFrame:
    """S4 + C29: web events read from JSON Lines with a schema, then the funnel."""
    return funnel.funnel_counts(files.read_json(i.spark, i.events_json_path(), schema=EVENTS_SCHEMA))


@query("json_funnel_inferred")
def _json_funnel_inferred(i: Inputs) -> DataFrame:
    """S4 + C29: web events read from JSON Lines with inferred types, then the funnel."""
    return funnel.funnel_counts(files.read_json(i.spark, i.events_json_path()))


@query("text_word_count")
def _text_word_count(i: Inputs) -> DataFrame:
    """S5 + C11: every document's text read back as text lines, word count."""
    return text.word_count(files.read_text(i.spark, i.documents_text_path()))


# --- measure registry (C43) -------------------------------------------------------------


@query("measure_registry")
def _measure_registry(i: Inputs) -> DataFrame:
    """Named measures with a missing-entry flag."""
    orders = i.orders()
    part = joins.partition_test(orders, i.clients_partial(), "customer_id")
    return quality.measure_registry(
        [
            (quality.amount_validation(orders), {"nb_commandes": "nb_lignes", "ca_nettoye": "ca_total"}),
            (part, {"nb_orphelines": "n_anti", "fan_out": "fan_out"}),
            (funnel.funnel_counts(i.events()), {"sessions": "sessions", "achats": "achats"}),
            (kpi.record_month(orders), {"record_month_ca": "ca_fcfa"}),
        ]
    )


# --- SQL entry point (V1, V2, S9, P4, P6, A15) -----------------------------------------


def _sql(i: Inputs, statement: str) -> DataFrame:
    """Run SQL over the session's commerce views."""
    views.register_commerce_views(i.spark, i.sf_dir, as_of=AS_OF)
    return i.spark.sql(statement)


@query("sql_status_report")
def _sql_status_report(i: Inputs) -> DataFrame:
    """V1 + A15: orders per status and channel, grouped by ordinals."""
    return _sql(
        i,
        """SELECT statut_norm, canal, count(*) AS commandes, sum(frais_livraison_fcfa) AS frais
           FROM commandes_clean GROUP BY 1, 2""",
    )


@query("sql_delivery_fees")
def _sql_delivery_fees(i: Inputs) -> DataFrame:
    """V2 + P4 + S9: a view of all order columns with the customer's city, read as a table."""
    views.register_commerce_views(i.spark, i.sf_dir, as_of=AS_OF)
    joined = create_view_as(
        i.spark,
        "commandes_localisees",
        "SELECT cmd.*, cli.ville FROM clients cli JOIN commandes_clean cmd USING (customer_id)",
    )
    return joined.groupBy("ville").agg(F.sum("frais_livraison_fcfa").alias("frais"), F.max("date_commande").alias("derniere"))


@query("sql_monthly_orders")
def _sql_monthly_orders(i: Inputs) -> DataFrame:
    """V2 + W3: orders per month as a view, and the change against the month before."""
    views.register_commerce_views(i.spark, i.sf_dir, as_of=AS_OF)
    create_view_as(
        i.spark,
        "volumes_mois",
        "SELECT date_format(date_commande, 'yyyy-MM') AS periode, count(*) AS volume FROM commandes GROUP BY periode",
    )
    return i.spark.sql(
        "SELECT periode, volume, volume - lag(volume) OVER (ORDER BY periode) AS ecart FROM volumes_mois"
    )


@query("sql_dearest_products")
def _sql_dearest_products(i: Inputs) -> DataFrame:
    """P6 + W2: the two dearest products of every category, from a derived table."""
    return _sql(
        i,
        """SELECT d.categorie, d.nom_produit, d.place FROM (
             SELECT categorie, nom_produit,
                    row_number() OVER (PARTITION BY categorie ORDER BY prix_unitaire_fcfa DESC, product_id) AS place
             FROM produits) d
           WHERE d.place < 3""",
    )


@query("sql_repeated_clients")
def _sql_repeated_clients(i: Inputs) -> DataFrame:
    """Cities of the broken extract with repeated customers (HAVING)."""
    return _sql(
        i,
        """SELECT ville, count(customer_id) - count(DISTINCT customer_id) AS en_trop FROM clients_partiels
           GROUP BY ville HAVING count(customer_id) > count(DISTINCT customer_id)""",
    )


@query("sql_orphan_fees")
def _sql_orphan_fees(i: Inputs) -> DataFrame:
    """Orders of unknown customers per channel, as an outer join and IS NULL."""
    return _sql(
        i,
        """SELECT cmd.canal, count(*) AS commandes, sum(cmd.frais_livraison_fcfa) AS frais
           FROM commandes cmd LEFT OUTER JOIN clients_partiels cli USING (customer_id)
           WHERE cli.nom IS NULL GROUP BY cmd.canal""",
    )


# --- reject channel (S3, S4) -----------------------------------------------------------------


@query("csv_reject_counts")
def _csv_reject_counts(i: Inputs) -> DataFrame:
    """S3: lines of a CSV export by what speaks against them."""
    return rejects.reject_report(i.checked_order_lines())


@query("csv_rejected_lines")
def _csv_rejected_lines(i: Inputs) -> DataFrame:
    """S3: the quarantined raw lines and the reasons."""
    return rejects.rejected(i.checked_order_lines())


@query("csv_accepted_report")
def _csv_accepted_report(i: Inputs) -> DataFrame:
    """S3: a report over the accepted lines, typed."""
    good = rejects.accepted(i.checked_order_lines(), inputs.LINE_SCHEMA)
    return good.groupBy("statut").agg(
        F.count("*").alias("n"), F.sum("frais_livraison_fcfa").alias("frais"), F.max("date_commande").alias("derniere")
    )


# --- published reports with history (K1, K2, C39) --------------------------------------------


def _published_reports(i: Inputs) -> tuple[str, dict[str, DataFrame]]:
    """Two days of the status report, the first one published twice; what each day holds last."""

    def report(until: str) -> DataFrame:
        orders = i.orders().filter(F.col("date_commande") < F.lit(until).cast("date"))
        return orders.groupBy("statut_norm", "canal").agg(
            F.count("*").alias("commandes"), F.sum("frais_livraison_fcfa").alias("frais")
        )

    path = f"{exports.new_folder(i.spark)}/status_report"
    first, second = PUBLISHED_DAYS
    publication.publish(report(first).filter(F.col("canal") == "web"), path, first)  # incomplete
    publication.publish(report(second), path, second)
    publication.publish(report(first), path, first)  # published again: replaces its own day alone
    return path, {first: report(first), second: report(second)}


@query("published_read_back")
def _published_read_back(i: Inputs) -> DataFrame:
    """K1/K2: two published days, one of them twice, read back and compared."""
    path, written = _published_reports(i)
    return publication.read_back(i.spark, path, written)


@query("published_evolution")
def _published_evolution(i: Inputs) -> DataFrame:
    """Orders by status and channel between the last two published days."""
    path, _ = _published_reports(i)
    return publication.evolution(i.spark, path, PUBLISHED_DAYS[1], ("statut_norm", "canal"), "commandes")


@query("published_as_of")
def _published_as_of(i: Inputs) -> DataFrame:
    """The state as of a day between the two, which is the first."""
    path, _ = _published_reports(i)
    return publication.published(i.spark, path, PUBLISHED_AS_OF).drop(publication.DAY)


# --- streaming (C6) --------------------------------------------------------------------------


@query("stream_clean_customers")
def _stream_clean_customers(i: Inputs) -> DataFrame:
    """C1-C6 on a stream: three deliveries, the job started anew for each; rows of the sink.

    Copies of a customer are dealt over the deliveries; cleaned, they are equal, so
    it does not matter which of them comes first.  Records without an id are left out."""
    named = i.customers_raw().filter(F.col("customer_id").isNotNull())
    rows = named.withColumn("drop", F.pmod(F.monotonically_increasing_id(), F.lit(3)).cast("int"))
    rows = rows.withColumn("arrivee", F.expr("timestamp'2025-01-01 00:00:00' + make_dt_interval(drop)"))
    rows = materialise(rows)  # one dealing for all deliveries
    drops = [rows.filter(F.col("drop") == k).drop("drop") for k in range(3)]
    return clean_drops(i.spark, drops, exports.new_folder(i.spark), "arrivee", "30 days", as_of=AS_OF).drop("arrivee")


# --- field-level survivor and cell-level difference (C6, C9) ------------------------------------


@query("best_customer_fields")
def _best_customer_fields(i: Inputs) -> DataFrame:
    """Per customer the best value of every field over all of its records."""
    cleaned = cleaning.cleaned_columns(inputs.customer_extracts(i.spark, i.sf_dir), as_of=AS_OF)
    valid = {"email": "email_valide", "telephone": "telephone_valide"}
    named = cleaned.filter(F.col("customer_id").isNotNull())
    return cleaning.best_fields(named, valid=valid, latest="date_inscription").select(
        "customer_id", "email", "email_valide", "telephone", "telephone_valide", "ville", "date_inscription"
    )


@query("cell_changes")
def _cell_changes(i: Inputs) -> DataFrame:
    """Cells that cleaning changes, by column and kind of change."""
    raw = i.customers_raw()
    columns = ("email", "telephone", "ville", "date_naissance", "nom")
    return quality.cell_changes(cleaning.dedup_by_key(raw), i.customers_clean(), "customer_id", columns)


# --- stored layouts (J1-J4, C35; F5, C17, C21) ---------------------------------------------------


@query("revenue_by_category_bucketed")
def _revenue_by_category_bucketed(i: Inputs) -> DataFrame:
    """C35 over order lines and orders stored in buckets of the order id: the join moves neither."""
    folder, buckets = exports.new_folder(i.spark), int(i.spark.conf.get("spark.sql.shuffle.partitions"))
    items = layout.bucketed(i.items(), "lignes", "order_id", buckets, folder)
    orders = layout.bucketed(i.orders(), "commandes", "order_id", buckets, folder)
    return kpi.revenue_by(items, orders, i.clients_partial(), i.products(), (), ("categorie",))


def _stored_orders(i: Inputs) -> DataFrame:
    return layout.by_month(i.orders(), "date_commande", f"{exports.new_folder(i.spark)}/commandes")


@query("filtered_count_stored")
def _filtered_count_stored(i: Inputs) -> DataFrame:
    """C21 over orders stored by month with their folded status."""
    return kpi.delivered_in_stored_month(_stored_orders(i), FILTER_MONTH)


@query("last_months_revenue")
def _last_months_revenue(i: Inputs) -> DataFrame:
    """C17: delivered revenue of the three latest months, by pruned partitions."""
    months = i.orders_raw().select(F.date_format("date_commande", "yyyy-MM").alias("mois"))
    return kpi.last_months_revenue(_stored_orders(i), materialise(months.distinct()))
