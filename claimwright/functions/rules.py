"""Column expressions for the cleaning rules.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); none needs a UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
CODE_SEPARATOR = ";"
# e-mail mask: keep the first three characters before the last '@'
EMAIL_MASK_PATTERN = "(.{3}).*@"
EMAIL_MASK_REPLACEMENT = "$1***@"
# strict variant (off by default): also mask local parts shorter than three
EMAIL_MASK_STRICT_PATTERN = "^(.{0,3}).*@"
DAYS_PER_YEAR = 365.25
# --- end of fixed values ------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_codes(c: Column | str) -> Column:
    """';'-separated code list -> array; NULL -> empty array.

    ``split`` keeps empty items, so ``"A;B;"`` has three elements.
    """
    c = _c(c)
    return F.when(c.isNotNull(), F.split(c, CODE_SEPARATOR)).otherwise(
        F.array().cast("array<string>"))


def mask_email(c: Column | str, strict: bool = False) -> Column:
    """Mask the local part of an address; NULL stays NULL.

    The default keeps three characters and replaces the rest up to the last
    ``@`` with ``***``; an address with fewer than three characters before
    the ``@`` is left as it is.  ``strict=True`` masks those too.
    """
    c = _c(c)
    pattern = EMAIL_MASK_STRICT_PATTERN if strict else EMAIL_MASK_PATTERN
    return F.when(c.isNotNull(), F.regexp_replace(c, pattern, EMAIL_MASK_REPLACEMENT))


def age_years(dob: Column | str, as_of: Column) -> Column:
    """Whole years between ``dob`` and ``as_of`` (365.25-day years)."""
    dob = _c(dob)
    return F.when(dob.isNotNull(), F.floor(F.datediff(as_of, dob) / F.lit(DAYS_PER_YEAR)))


def flag_from_number(c: Column | str) -> Column:
    """1.0 -> true, 0.0 -> false, anything else -> NULL."""
    c = _c(c)
    return F.when(c == 1.0, F.lit(True)).when(c == 0.0, F.lit(False))


def all_present(cols: Sequence[str]) -> Column:
    """True when every column is non-NULL, else false (never NULL)."""
    cond = F.lit(True)
    for name in cols:
        cond = cond & F.col(name).isNotNull()
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def trimmed(c: Column | str) -> Column:
    c = _c(c)
    return F.when(c.isNotNull(), F.trim(c))


def trimmed_upper(c: Column | str) -> Column:
    c = _c(c)
    return F.when(c.isNotNull(), F.upper(F.trim(c)))


def band(value: Column, bands: Sequence[tuple[str, float, object]], otherwise: object) -> Column:
    """Ordered threshold ladder: the first matching ``(op, bound, result)`` wins.

    ``op`` is one of ``>``, ``>=``, ``<``, ``<=``.  A NULL ``value`` matches
    no band and falls through to ``otherwise`` (three-valued logic of CASE).
    """
    ops = {
        ">": lambda v, b: v > b,
        ">=": lambda v, b: v >= b,
        "<": lambda v, b: v < b,
        "<=": lambda v, b: v <= b,
    }
    expr = None
    for op, bound, result in bands:
        cond = ops[op](value, F.lit(bound))
        expr = F.when(cond, F.lit(result)) if expr is None else expr.when(cond, F.lit(result))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)


def count_when(cond: Column) -> Column:
    """Conditional count as ``sum(CASE WHEN cond THEN 1 ELSE 0 END)``.

    Unlike ``count_if`` this is NULL over zero rows, which the published
    summaries keep.
    """
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))
