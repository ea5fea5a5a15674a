"""Stand-in inputs built from the driver's tables.

The driver supplies TPC-H-like tables with no defects.  The operators of
this library expect the reference's commerce data (raw customers with
dirty strings, orders with text amounts, payments, order lines, products,
web events).  The functions below only *reshape* driver rows into those
schemas: each reads whole tables, selects a raw variant per row from the
row's own key, and does none of the operators' work.  The operators never
look at how these rows were made; they must be right on any data of the
same schema.

``oracle.py`` writes the same derivations in DuckDB SQL so that both
engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values for the stand-in data --------------------------------------
# City names of our own choice (accented and plain spellings).
CITIES = [
    "Dakar", "Thiès", "Saint-Louis", "Kaolack", "Ziguinchor", "Touba", "Mbour", "Rufisque",
    "Louga", "Tambacounda", "Kédougou", "Diourbel", "Sédhiou", "Kolda", "Fatick", "Thies",
]
# Payment method per order priority.
PAYMENT_BY_PRIORITY = {
    "1-URGENT": "Orange Money",
    "2-HIGH": "Wave",
    "3-MEDIUM": "Free Money",
    "4-NOT SPECIFIED": "carte",
    "5-LOW": "especes",
}
# Order status per TPC-H status letter; 1 in 10 delivered orders carries
# the accented spelling.
STATUS_BY_LETTER = {"F": "livree", "O": "en_cours", "P": "annulee"}
DELIVERED_ACCENTED = "livrée"
# Web event names per driver event type; others keep their name.
EVENT_NAMES = {"view": "view_product", "click": "add_to_cart", "purchase": "purchase"}
DEVICES = ["mobile", "desktop", "tablet"]
# -----------------------------------------------------------------------------

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table, listed anew on every call: files added
    to the folder are read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _array(values: list[str]) -> str:
    """SQL array literal."""
    return "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


def _city_of(key: str) -> str:
    return f"{_array(CITIES)}[CAST(pmod({key}, {len(CITIES)}) AS INT)]"


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> region name: 25 rows whatever the scale."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("region")
    )


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer records, nine strings, with the defects the cleaning
    operators handle: padded / upper / lower cities, blank and ``N/A``
    e-mails, phone numbers in several layouts, impossible birth dates,
    exact copies, near copies and NULL ids."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    c = c.join(_geo(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"))
    # one extra copy for 1 in 50 (exact), 1 in 50 (near) and 1 in 500 (NULL id)
    base = c.selectExpr(
        "c_custkey AS k", "CAST(c_custkey AS STRING) AS ks", "c_name", "region", f"{_city_of('c_custkey')} AS city",
        "lpad(CAST(c_custkey % 10000000 AS STRING), 7, '0') AS d7",
        "explode(CASE WHEN c_custkey % 50 IN (3, 4) OR c_custkey % 500 = 11 THEN array(0, 1) ELSE array(0) END) AS copy",
    )
    raw = base.selectExpr(
        "*",
        f"""CASE CAST(floor(k / {len(CITIES)}) % 4 AS INT) WHEN 0 THEN city WHEN 1 THEN upper(city)
            WHEN 2 THEN concat('  ', lower(city), ' ') ELSE concat(' ', city) END AS ville0""",
        """CASE CAST(k % 8 AS INT) WHEN 0 THEN concat('customer', ks, '@mail.com') WHEN 1 THEN concat('  Customer', ks, '@Mail.COM  ')
           WHEN 2 THEN '' WHEN 3 THEN 'N/A' WHEN 4 THEN '   ' WHEN 5 THEN concat('customer', ks, '@mail')
           WHEN 6 THEN NULL ELSE 'n/a' END AS email0""",
    )
    return raw.selectExpr(
        "CASE WHEN copy = 1 AND k % 500 = 11 THEN NULL ELSE ks END AS customer_id",
        "concat('Prenom', ks) AS prenom",
        "c_name AS nom",
        "CASE WHEN copy = 1 AND k % 50 = 4 THEN upper(email0) ELSE email0 END AS email",
        """CASE CAST(k % 9 AS INT) WHEN 0 THEN concat('77', d7) WHEN 1 THEN concat('+221 76 ', d7)
           WHEN 2 THEN concat('78-', substring(d7, 1, 3), '-', substring(d7, 4, 2), '-', substring(d7, 6, 2))
           WHEN 3 THEN concat('70 ', substring(d7, 1, 6)) WHEN 4 THEN concat('69', d7) WHEN 5 THEN NULL WHEN 6 THEN ''
           WHEN 7 THEN concat('00221 77', d7) ELSE concat('221221 75', d7) END AS telephone""",
        "CASE WHEN copy = 1 AND k % 50 = 4 THEN concat('  ', ville0) ELSE ville0 END AS ville",
        "region",
        """CASE CAST(k % 7 AS INT)
           WHEN 0 THEN concat(CAST(1940 + k % 60 AS STRING), '-', lpad(CAST(1 + k % 12 AS STRING), 2, '0'), '-',
                              lpad(CAST(1 + k % 28 AS STRING), 2, '0'))
           WHEN 1 THEN '1919-12-31' WHEN 2 THEN '2099-01-01' WHEN 3 THEN '15/01/1990' WHEN 4 THEN '2000-02-30'
           WHEN 5 THEN NULL ELSE '1920-01-01' END AS date_naissance""",
        "CAST(date_add(DATE'2020-01-01', CAST(k % 1000 AS INT)) AS STRING) AS date_inscription",
    )


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a text amount (about 1 % carry `` FCFA``, 1 % ``N/A``,
    1 % missing), two spellings of the delivered status, and a channel."""
    amount = "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "o_orderdate AS date_commande",
        f"""CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 10 = 0 THEN '{DELIVERED_ACCENTED}' ELSE '{STATUS_BY_LETTER['F']}' END
            WHEN 'O' THEN '{STATUS_BY_LETTER['O']}' ELSE '{STATUS_BY_LETTER['P']}' END AS statut""",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'mobile_app' ELSE 'web' END AS canal",
        f"""CASE CAST(o_orderkey % 100 AS INT) WHEN 0 THEN concat({amount}, ' FCFA') WHEN 50 THEN NULL WHEN 25 THEN 'N/A'
            ELSE {amount} END AS montant_total_fcfa""",
        "CAST(1000 + (o_orderkey % 5) * 500 AS BIGINT) AS frais_livraison_fcfa",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order: method from the order priority."""
    methods = " ".join(f"WHEN '{prio}' THEN '{name}'" for prio, name in PAYMENT_BY_PRIORITY.items())
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        f"CASE o_orderpriority {methods} END AS methode",
        "CAST(floor(o_totalprice) AS BIGINT) AS montant_fcfa",
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines: quantity and an integral unit price."""
    li = table(spark, sf_dir, "lineitem")
    unit = F.when(
        F.col("l_quantity") > 0, F.floor(F.col("l_extendedprice") / F.col("l_quantity"))
    ).cast("bigint")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantite"),
        unit.alias("prix_unitaire_fcfa"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("nom_produit"),
        F.col("p_type").alias("categorie"),
        F.floor(F.col("p_retailprice")).cast("bigint").alias("prix_unitaire_fcfa"),
    )


def customers_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean customer dimension: one row per key, city and region."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    c = c.join(_geo(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"))
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("nom"),
        F.expr(_city_of("c_custkey")).alias("ville"),
        F.col("region"),
    )


def clients_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A broken customer extract: 1 in 500 keys missing (orphans on the
    order side) and 1 in 50 keys present twice (fan-out)."""
    dim = customers_dim(spark, sf_dir)
    k = F.col("customer_id")
    dim = dim.filter(k % 500 != 7)
    dim = dim.withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.when(k % 50 == 3, 1).otherwise(0)))
    )
    return dim.drop("_copy")


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web events: a session per user and day (1 in 29 events anonymous),
    funnel event names, a device, a city, and an order id on purchases."""
    names = " ".join(f"WHEN '{src}' THEN '{dst}'" for src, dst in EVENT_NAMES.items())
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts AS event_time",
        "CASE WHEN event_id % 29 = 0 THEN NULL ELSE concat(CAST(user_id AS STRING), '-', date_format(ts, 'yyyyMMdd')) END AS session_id",
        f"CASE event_type {names} ELSE event_type END AS event_type",
        f"{_array(DEVICES)}[CAST(coalesce(pmod(try_cast(get_json_object(props, '$.k') AS BIGINT), 3), 2) AS INT)] AS device",
        f"{_city_of('user_id')} AS ville",
        "CASE WHEN event_type = 'purchase' THEN event_id * 2 END AS order_id",
    )


# --- Fixed values: the planted defects of the order lines in text form, by order_id modulo 40,
# and the columns of an order line.
LINE_DEFECTS = {"short": 3, "long": 7, "bad_customer": 11, "bad_date": 13, "no_id": 17, "two": 19}
LINE_SCHEMA = "order_id bigint, customer_id bigint, date_commande date, statut string, frais_livraison_fcfa bigint"
# -------------------------------------------------------------------------------------------


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV lines (one string column), some of them malformed: a field
    missing or too many, a customer or a day that is none, no order id, and two
    faults at once."""
    o = orders_raw(spark, sf_dir)
    defect = F.pmod(F.col("order_id"), F.lit(40))
    d = {name: defect == k for name, k in LINE_DEFECTS.items()}
    fields = [
        F.when(d["no_id"] | d["two"], F.lit("")).otherwise(F.col("order_id").cast("string")),
        F.when(d["bad_customer"] | d["two"], F.concat(F.lit("x"), F.col("customer_id").cast("string"))).otherwise(
            F.col("customer_id").cast("string")
        ),
        F.when(d["bad_date"], F.lit("2024-13-45")).otherwise(F.date_format("date_commande", "yyyy-MM-dd")),
        F.col("statut"),
    ]
    line = F.concat_ws(",", *fields)
    fees = F.concat(F.lit(","), F.col("frais_livraison_fcfa").cast("string"))
    return o.select(F.when(d["short"], line).when(d["long"], F.concat(line, fees, fees)).otherwise(F.concat(line, fees)).alias("value"))


def customer_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer records with a second, later one for every third customer: a new
    e-mail for some, a new phone number (valid or not) for others, no city."""
    raw = customers_raw(spark, sf_dir)
    k = F.col("customer_id").try_cast("bigint")
    later = raw.filter(k % 3 == 0).withColumns(
        {
            "email": F.when(k % 2 == 0, F.concat(F.lit("new"), F.col("customer_id"), F.lit("@mail.com"))),
            "telephone": F.when(k % 4 == 0, F.concat(F.lit("77"), F.lpad((k % 10000000).cast("string"), 7, "0"))).otherwise(F.lit("12")),
            "ville": F.lit(None).cast("string"),
            "date_inscription": F.lit("2024-01-01"),
        }
    )
    return raw.unionByName(later)
