"""Customer cleaning: each step is ``DataFrame -> DataFrame``.

All steps are row-wise column expressions (one ``Project`` each, fused by
Catalyst into one codegen stage), except de-duplication, which is one
aggregation on the key with map-side partial aggregation.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.functions import rules, text


# The rules as column expressions; the steps below and the whole chain select them.


def email_columns(raw: Column, col: str = "email", flag: str = "email_valide") -> list[Column]:
    address = F.lower(F.trim(raw))
    return [address.alias(col), rules.email_valid(address).alias(flag)]


def city_columns(raw: Column, col: str = "ville", key: str = "ville_norm") -> list[Column]:
    shown = F.initcap(F.trim(raw))
    return [shown.alias(col), text.fold_key(shown).alias(key)]


def phone_columns(raw: Column, col: str = "telephone", flag: str = "telephone_valide") -> list[Column]:
    digits = rules.phone_digits(raw)
    return [digits.alias(col), rules.phone_valid(digits).alias(flag)]


def _replaced(df: DataFrame, columns: list[Column], names: Sequence[str]) -> DataFrame:
    """``df`` with the named columns replaced in place, new ones at the end."""
    return df.withColumns(dict(zip(names, columns, strict=True)))


def unify_missing(df: DataFrame, col: str = "email") -> DataFrame:
    """Trim; empty, blank and any-case ``N/A`` become NULL."""
    return _replaced(df, [text.blank_to_null(F.col(col))], [col])


def normalize_email(df: DataFrame, col: str = "email", flag: str = "email_valide") -> DataFrame:
    """Lower + trim, and a tri-state validity flag (NULL when NULL)."""
    return _replaced(df, email_columns(F.col(col), col, flag), [col, flag])


def normalize_city(df: DataFrame, col: str = "ville", key: str = "ville_norm") -> DataFrame:
    """``initcap(trim)`` display form, and an accent-free lower key of that form."""
    return _replaced(df, city_columns(F.col(col), col, key), [col, key])


def normalize_phone(df: DataFrame, col: str = "telephone", flag: str = "telephone_valide") -> DataFrame:
    """C4: digits only, one leading 221 removed, and the mobile rule."""
    return _replaced(df, phone_columns(F.col(col), col, flag), [col, flag])


def validate_birth_date(
    df: DataFrame, col: str = "date_naissance", as_of: str | _dt.date | None = None
) -> DataFrame:
    """A real ``yyyy-MM-dd`` day in [1920-01-01, as_of] (DATE), else NULL."""
    return _replaced(df, [rules.valid_birth_date(F.col(col), as_of)], [col])


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """D3: full-row de-duplication."""
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """One row per key, chosen deterministically.

    The survivor is the smallest row under the remaining columns in their
    column order, NULLs first, so re-runs and engines agree.  Exact copies
    therefore collapse first (the reference's full-row pass is subsumed).
    NULL keys form one group, as with ``dropDuplicates``.

    ``min(struct(...))`` is a partial aggregate: each map task reduces its
    rows to one per key before the shuffle, so a key that holds a large
    share of the rows never reaches one reducer as raw rows.
    """
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    best = df.groupBy(key).agg(F.min(F.struct(*[F.col(c) for c in others])).alias("_best"))
    return best.select(F.col(key), *[F.col(f"_best.{c}").alias(c) for c in others]).select(*df.columns)


def dedup_customers(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Full-row then keyed de-duplication, in one aggregation."""
    return dedup_by_key(df, key)


def cleaned_columns(df: DataFrame, as_of: str | _dt.date | None = None) -> DataFrame:
    """C1 - C5 in one projection, for a batch or a stream."""
    cleaned = [
        *email_columns(text.blank_to_null(F.col("email"))),
        *city_columns(F.col("ville")),
        *phone_columns(F.col("telephone")),
        rules.valid_birth_date(F.col("date_naissance"), as_of).alias("date_naissance"),
    ]
    names = ["email", "email_valide", "ville", "ville_norm", "telephone", "telephone_valide", "date_naissance"]
    return _replaced(df, cleaned, names)


def clean_customers(df: DataFrame, as_of: str | _dt.date | None = None) -> DataFrame:
    """All rules in one projection, then one row per customer."""
    return dedup_customers(cleaned_columns(df, as_of))


def best_fields(
    df: DataFrame, key: str = "customer_id", valid: dict[str, str] | None = None, latest: str | None = None
) -> DataFrame:
    """C6 field by field: one row per key with the best value of every column.

    A value comes before NULL; one that is valid (by the flag column that
    ``valid`` names for its column) before one that is not; then the value of the
    greatest ``latest`` (NULL last); then the greatest value.  The flag goes with
    its value.  So a later record's valid e-mail is not lost with its record.
    Rows with a NULL key are nobody's copies and stay as they are.  Every column
    is a partial aggregate, so a key with very many rows is one row a map task."""
    valid = valid or {}
    at = F.col(latest) if latest else F.lit(None).cast("string")
    best, out = [], {}
    for c in (c for c in df.columns if c != key and c not in valid.values()):
        flag = F.col(valid[c]) if c in valid else F.lit(None).cast("boolean")
        order = (F.col(c).isNotNull(), F.coalesce(flag, F.lit(False)), at)
        best.append(F.max(F.struct(*(o.alias(f"o{k}") for k, o in enumerate(order)), F.col(c).alias("v"), flag.alias("f"))).alias(f"_{c}"))
        out[c] = F.col(f"_{c}.v")
        if c in valid:
            out[valid[c]] = F.col(f"_{c}.f")
    merged = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*best)
    merged = merged.select(key, *(value.alias(c) for c, value in out.items())).select(*df.columns)
    return merged.unionByName(df.filter(F.col(key).isNull()))
