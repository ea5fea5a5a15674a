"""Column-expression helpers (all JVM built-ins)."""

from baobab.functions.rules import (
    CANCELLED,
    DELIVERED,
    MOBILE_MONEY,
    amount_clean,
    amount_is_polluted,
    amount_naive,
    as_of_column,
    email_valid,
    pct,
    phone_digits,
    phone_valid,
    valid_birth_date,
)
from baobab.functions.text import accent_table, blank_to_null, fold_accents, fold_key

__all__ = [
    "CANCELLED",
    "DELIVERED",
    "MOBILE_MONEY",
    "accent_table",
    "amount_clean",
    "amount_is_polluted",
    "amount_naive",
    "as_of_column",
    "blank_to_null",
    "email_valid",
    "fold_accents",
    "fold_key",
    "pct",
    "phone_digits",
    "phone_valid",
    "valid_birth_date",
]
