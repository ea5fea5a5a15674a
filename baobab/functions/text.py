"""String column expressions: accent folding and case rules.

Accent folding uses ``translate`` (JVM-side, whole-stage codegen) with a
one-to-one table.  The table is built from a rule rather than written out:
every letter of Latin-1 Supplement and Latin Extended-A (U+00C0..U+017F)
whose compatibility decomposition, minus combining marks, is one ASCII
letter maps to that letter.  Letters that decompose to two characters
(``Ĳ``, ``Ŀ``, ``ŉ``) or not at all (``Æ``, ``Ø``, ``ß``, ``Đ``, ``Ł``,
``Œ`` ...) are left unchanged.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_FOLD_RANGE = (0x00C0, 0x017F)


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """(source, target) strings for ``translate``; equal length."""
    src, dst = [], []
    for cp in range(_FOLD_RANGE[0], _FOLD_RANGE[1] + 1):
        ch = chr(cp)
        base = "".join(
            c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)
        )
        if len(base) == 1 and base.isascii() and base.isalpha() and base != ch:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def fold_accents(col: Column) -> Column:
    """Replace accented Latin letters with their base letter."""
    src, dst = accent_table()
    return F.translate(col, src, dst)


def fold_key(col: Column) -> Column:
    """Comparison key: trimmed, lower-cased, accent-folded."""
    return fold_accents(F.lower(F.trim(col)))


def blank_to_null(col: Column, null_tokens: tuple[str, ...] = ("N/A",)) -> Column:
    """Trimmed value, or NULL when empty, blank, or a null token (any case)."""
    t = F.trim(col)
    tokens = [tok.upper() for tok in null_tokens]
    return F.when((t == "") | F.upper(t).isin(tokens), F.lit(None).cast("string")).otherwise(t)
