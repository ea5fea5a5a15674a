"""Business rules as column expressions (no Python UDF anywhere).

Fixed values below must equal the reference's rules for results to match.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (rules of the reference data set) -------------------------
# E-mail format.
EMAIL_PATTERN = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"
# Mobile number: operator prefix 70, 75, 76, 77 or 78 then seven digits,
# after removing every non-digit and one leading country code 221.
PHONE_PATTERN = r"^(70|75|76|77|78)\d{7}$"
PHONE_COUNTRY_CODE = "221"
# Birth dates: ISO day, not before 1920-01-01 and not after "today".
BIRTH_FORMAT = "yyyy-MM-dd"
BIRTH_MIN = "1920-01-01"
# Amounts: a clean amount is digits only.
AMOUNT_CLEAN_PATTERN = r"^[0-9]+$"
# Mobile-money payment methods.
MOBILE_MONEY = ("Orange Money", "Wave", "Free Money")
# Delivered status, compared after accent folding ("livree" / "livrée").
DELIVERED = "livree"
CANCELLED = "annulee"
# -----------------------------------------------------------------------------


def email_valid(email: Column) -> Column:
    """Tri-state flag: NULL when the e-mail is NULL, else the regex result."""
    return F.when(email.isNull(), F.lit(None).cast("boolean")).otherwise(
        email.rlike(EMAIL_PATTERN)
    )


def phone_digits(phone: Column) -> Column:
    """Digits only, with one leading country code removed."""
    digits = F.regexp_replace(phone, r"[^0-9]", "")
    return F.regexp_replace(digits, "^" + PHONE_COUNTRY_CODE, "")


def phone_valid(normalized_phone: Column) -> Column:
    return normalized_phone.rlike(PHONE_PATTERN)


def as_of_column(as_of: str | _dt.date | None) -> Column:
    """Upper date bound: a fixed date when given, else ``current_date()``."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def valid_birth_date(raw: Column, as_of: str | _dt.date | None = None) -> Column:
    """Parsed ``yyyy-MM-dd`` date inside [1920-01-01, as_of], else NULL.

    ``try_to_date`` returns NULL for text that is not a real day in that
    pattern (``15/01/1990``, ``2000-02-30``) instead of raising under ANSI.
    """
    d = F.try_to_date(raw, BIRTH_FORMAT)
    ok = d.isNotNull() & (d >= F.lit(BIRTH_MIN).cast("date")) & (d <= as_of_column(as_of))
    return F.when(ok, d)


def amount_clean(raw: Column, strict: bool = False) -> Column:
    """Digits of the trimmed raw text as BIGINT; NULL when none remain
    (``strict``: a plain cast, which raises under ANSI mode instead)."""
    digits = F.regexp_replace(F.trim(raw), r"[^0-9]", "")
    return digits.cast("bigint") if strict else digits.try_cast("bigint")


def amount_naive(raw: Column) -> Column:
    """The naive reading: a tolerant cast of the raw text."""
    return raw.try_cast("bigint")


def amount_is_polluted(raw: Column) -> Column:
    """True when a non-NULL raw amount is not purely digits (NULL stays NULL)."""
    return ~raw.rlike(AMOUNT_CLEAN_PATTERN)


def amount_is_suspect(raw: Column) -> Column:
    """True when the digits of a raw amount are not its value: a minus sign
    before them, or a point or comma between them."""
    return raw.rlike(r"-\s*[0-9]|[0-9][.,][0-9]")


def pct(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    """Rounded percentage as double; NULL when the denominator is 0 or NULL."""
    ratio = F.try_divide(numerator.cast("double") * F.lit(100.0), denominator.cast("double"))
    return F.round(ratio, digits)
