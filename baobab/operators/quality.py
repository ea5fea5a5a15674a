"""Quality measurement: profiles, null counts, pseudo-missing values,
polluted amounts and before/after reports.

Every report is a DataFrame (metrics in rows), computed in as few passes
as possible; nothing is pulled to the driver to be combined in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.functions import rules


def _long(df_one_row: DataFrame, names: Sequence[str], key: str = "metric", value: str = "value") -> DataFrame:
    """Unpivot a one-row frame of measures into (key, value) rows."""
    return df_one_row.unpivot([], list(names), key, value)


def is_pseudo_missing(col: Column) -> Column:
    """NULL, empty, blank or ``N/A`` in any case (the cleaning rule)."""
    t = F.trim(col)
    return col.isNull() | (t == "") | (F.upper(t) == "N/A")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A3: NULL count of every column, one pass; rows (column_name, n_null)."""
    cols = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _long(one, cols, "column_name", "n_null")


def pseudo_missing(df: DataFrame, col: str = "email") -> DataFrame:
    """The two faces of a missing value, one pass.

    ``n_pseudo_missing`` uses the cleaning rule (trim, any case);
    ``n_missing_literal`` is the literal SQL form (``= ''``, ``= 'N/A'``,
    ``IS NULL``) which misses blanks and lower-case tokens.
    """
    c = F.col(col)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(c.isNull()).alias("n_null"),
        F.count_if(c.isNotNull() & (F.trim(c) == "")).alias("n_blank"),
        F.count_if(F.upper(F.trim(c)) == "N/A").alias("n_na"),
        F.count_if(is_pseudo_missing(c)).alias("n_pseudo_missing"),
        F.count_if((c == "") | (c == "N/A") | c.isNull()).alias("n_missing_literal"),
    )


def quality_profile(df: DataFrame, email_col: str = "email", city_col: str = "ville") -> DataFrame:
    """Row count, NULLs per column, pseudo-missing e-mails, distinct
    cities and exact duplicate rows, as (metric, value) rows.

    One aggregation over full-row groups gives every count (partial
    aggregation collapses repeated rows map-side), and one more distinct
    aggregation over that already-reduced frame gives the city count.
    """
    cols = df.columns
    grouped = df.groupBy(*cols).agg(F.count("*").alias("_n"))
    n = F.col("_n")
    measures = [
        F.sum(n).alias("n_rows"),
        *[F.sum(F.when(F.col(c).isNull(), n).otherwise(0)).alias(f"n_null_{c}") for c in cols],
        F.sum(F.when(is_pseudo_missing(F.col(email_col)), n).otherwise(0)).alias("n_email_pseudo_missing"),
        F.count_distinct(F.col(city_col)).alias("n_distinct_cities"),
        F.sum(n - 1).alias("n_exact_duplicates"),
    ]
    one = grouped.agg(*measures)
    names = [f.name for f in one.schema.fields]
    one = one.select(*[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in names])
    return _long(one, names)


def exact_duplicate_count(df: DataFrame) -> DataFrame:
    """``count - distinct count`` in one pass: sum(n - 1) over full-row groups."""
    g = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("n_exact_duplicates"))


def table_profile(df: DataFrame) -> DataFrame:
    """Per column its position, type, row count, non-NULL and NULL counts."""
    cols = df.columns
    one = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in cols])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pos = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i + 1))])
    typ = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    long = one.unpivot(["_rows"], cols, "column_name", "n_non_null")
    return long.select(
        "column_name",
        pos[F.col("column_name")].alias("position"),
        typ[F.col("column_name")].alias("data_type"),
        F.col("_rows").alias("n_rows"),
        F.col("n_non_null"),
        (F.col("_rows") - F.col("n_non_null")).alias("n_null"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of each value of several columns in one shuffle.

    Rows are tagged with their column name and exploded, so one
    aggregation (with map-side combine) serves every column.
    """
    tagged = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
        )
    )
    return (
        df.select(tagged.alias("t"))
        .select("t.column_name", "t.value")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )


# --- polluted amounts (C12 - C15) --------------------------------------------


def amount_polluted(df: DataFrame, raw_col: str = "montant_total_fcfa") -> DataFrame:
    """How many raw amounts are not purely digits.

    ``NOT RLIKE`` is unknown on NULL, so NULLs are counted on their own.
    """
    raw = F.col(raw_col)
    bad = rules.amount_is_polluted(raw)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(bad).alias("n_polluted"),
        F.count_if(raw.isNull()).alias("n_null"),
        F.count_distinct(F.when(bad, raw)).alias("n_distinct_polluted"),
    )


def amount_polluted_samples(df: DataFrame, raw_col: str = "montant_total_fcfa", n: int = 10) -> DataFrame:
    """The first ``n`` distinct polluted values (sampling is the feature)."""
    raw = F.col(raw_col)
    return (
        df.filter(rules.amount_is_polluted(raw))
        .select(raw.alias("valeur_fautive"))
        .distinct()
        .orderBy("valeur_fautive")
        .limit(n)
    )


def clean_amounts(
    df: DataFrame,
    raw_col: str = "montant_total_fcfa",
    raw_out: str = "montant_raw",
    clean_out: str = "montant_fcfa",
    strict: bool = False,
) -> DataFrame:
    """Keep the raw text and add the cleaned BIGINT amount.

    ``strict=True`` uses a plain ``CAST`` (P7), which under ANSI mode fails
    the job on a value without digits instead of returning NULL (P8).
    """
    clean = rules.amount_clean(F.col(raw_col), strict=strict)
    return df.withColumn(clean_out, clean).withColumnRenamed(raw_col, raw_out)


def amount_validation(df: DataFrame, amount_col: str = "montant_fcfa") -> DataFrame:
    """C14: rows, cast values, NULLs, min, max, total in one pass."""
    a = F.col(amount_col)
    return df.agg(
        F.count("*").alias("nb_lignes"),
        F.count(a).alias("nb_valides"),
        (F.count("*") - F.count(a)).alias("nb_null"),
        F.min(a).alias("montant_min"),
        F.max(a).alias("montant_max"),
        F.sum(a).alias("ca_total"),
    )


def amount_gap(df: DataFrame, raw_col: str = "montant_total_fcfa") -> DataFrame:
    """Naive total (tolerant cast of the raw text) against the clean
    total, absolute and in percent of the naive total, one pass."""
    raw = F.col(raw_col)
    one = df.agg(
        F.sum(rules.amount_naive(raw)).alias("ca_naif"),
        F.sum(rules.amount_clean(raw)).alias("ca_nettoye"),
    )
    gap = F.col("ca_nettoye") - F.col("ca_naif")
    return one.select("ca_naif", "ca_nettoye", gap.alias("ecart_fcfa"), rules.pct(gap, F.col("ca_naif"), 2).alias("ecart_pct"))


def amount_report(df: DataFrame, raw_col: str = "montant_total_fcfa") -> DataFrame:
    """C12 + C14 + C15 in one scan: polluted values, cleaning validation and
    the naive-versus-clean gap from a single aggregation."""
    raw = F.col(raw_col)
    clean = rules.amount_clean(raw)
    bad = rules.amount_is_polluted(raw)
    one = df.agg(
        F.count("*").alias("nb_lignes"),
        F.count_if(bad).alias("n_polluted"),
        F.count_if(raw.isNull()).alias("n_raw_null"),
        F.count(clean).alias("nb_valides"),
        (F.count("*") - F.count(clean)).alias("nb_null"),
        F.min(clean).alias("montant_min"),
        F.max(clean).alias("montant_max"),
        F.sum(clean).alias("ca_nettoye"),
        F.sum(rules.amount_naive(raw)).alias("ca_naif"),
    )
    gap = F.col("ca_nettoye") - F.col("ca_naif")
    return one.select("*", gap.alias("ecart_fcfa"), rules.pct(gap, F.col("ca_naif"), 2).alias("ecart_pct"))


# --- before / after ------------------------------------------------------------


def _city_email_metrics(df: DataFrame, city: Column, email: Column) -> DataFrame:
    one = df.agg(
        F.count("*").cast("bigint").alias("n_rows"),
        F.count_distinct(city).cast("bigint").alias("n_distinct_cities"),
        F.count_if(is_pseudo_missing(email)).cast("bigint").alias("n_missing_email"),
    )
    return _long(one, ["n_rows", "n_distinct_cities", "n_missing_email"])


def before_after(raw: DataFrame, clean: DataFrame, city_raw: str = "ville", city_clean: str = "ville_norm", email: str = "email") -> DataFrame:
    """Rows, distinct cities and missing e-mails before and after
    cleaning, with the change and the change in percent."""
    b = _city_email_metrics(raw, F.col(city_raw), F.col(email)).withColumnRenamed("value", "before")
    a = _city_email_metrics(clean, F.col(city_clean), F.col(email)).withColumnRenamed("value", "after")
    j = b.join(a, "metric")
    delta = F.col("after") - F.col("before")
    return j.select("metric", "before", "after", delta.alias("delta"), rules.pct(delta, F.col("before"), 2).alias("delta_pct"))


def measure_registry(frames: Sequence[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Named measures as rows (metric, value, missing).

    Each entry is a frame of at most one row and the measures to take from it
    (metric name -> column).  A measure that is NULL or whose frame has no row is
    flagged, so the report lists what is still unset; every frame is evaluated
    once, however many measures it gives.
    """
    out = None
    for frame, measures in frames:
        one = frame.agg(*(F.max(F.col(c)).cast("double").alias(name) for name, c in measures.items()))
        part = _long(one, list(measures))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("missing", F.col("value").isNull())


def head_sample(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order`` (the sample is the feature)."""
    return df.orderBy(*order).limit(n)


def suspect_amounts(df: DataFrame, raw_col: str = "montant_total_fcfa") -> DataFrame:
    """Flag raw amounts that lose a sign or a decimal mark in cleaning
    (``-1500`` becomes 1500, ``12.75`` becomes 1275).  NULL stays unflagged."""
    return df.withColumn("montant_suspect", F.coalesce(rules.amount_is_suspect(F.col(raw_col)), F.lit(False)))


def cell_changes(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """C9 cell by cell: how many values of each column were changed, and how.

    ``before`` and ``after`` have one row per ``key`` each (NULL is a key like any
    other).  Columns: colonne, nature (`identique`, `modifiee`, `videe`: a value
    became NULL, `remplie`: NULL became a value, `ligne_absente` / `ligne_ajoutee`:
    the key is on one side only), n.  One full join by key, compared null-safely,
    then a partial aggregate of the kinds."""
    left = before.select(F.col(key).alias("_k"), F.struct(*(F.col(c).cast("string").alias(c) for c in columns)).alias("_a"))
    right = after.select(F.col(key).alias("_k2"), F.struct(*(F.col(c).cast("string").alias(c) for c in columns)).alias("_b"))
    both = left.join(right, F.col("_k").eqNullSafe(F.col("_k2")), "full")

    def kind(c: str) -> Column:
        a, b = F.col(f"_a.{c}"), F.col(f"_b.{c}")
        return (
            F.when(F.col("_b").isNull(), "ligne_absente")
            .when(F.col("_a").isNull(), "ligne_ajoutee")
            .when(a.eqNullSafe(b), "identique")
            .when(b.isNull(), "videe")
            .when(a.isNull(), "remplie")
            .otherwise("modifiee")
        )

    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("colonne"), kind(c).alias("nature")) for c in columns)))
    return both.select(cells.alias("_c")).groupBy("_c.colonne", "_c.nature").agg(F.count("*").alias("n"))
