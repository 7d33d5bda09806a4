"""Scalar column builders shared by the operators.

All of them are plain Catalyst expressions, so they stay inside whole-stage
codegen.  Division goes through ``try_divide``: a zero or NULL divisor gives
NULL regardless of the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(col(num), col(den))


def pct_change(new: str | Column, base: str | Column) -> Column:
    """(new - base) / base * 100, NULL on a zero base."""
    return safe_div(col(new) - col(base), col(base)) * F.lit(100)


def sign_vs(a: str | Column, b: str | Column) -> Column:
    """1 when a > b, -1 when a < b, else 0 (NULL on either side gives 0)."""
    a, b = col(a), col(b)
    return F.when(a > b, F.lit(1)).when(a < b, F.lit(-1)).otherwise(F.lit(0))


def bucket_above(value: str | Column, thresholds: list[tuple[float, str]], default: str) -> Column:
    """First label whose threshold is strictly exceeded, in the given order, else default.

    A NULL value matches nothing and gets the default.
    """
    value = col(value)
    expr = None
    for threshold, label in thresholds:
        cond = value > F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def flag_if_abs_above(value: str | Column, limit: float, label: str, default: str = "Normal") -> Column:
    return F.when(F.abs(col(value)) > F.lit(limit), F.lit(label)).otherwise(F.lit(default))


def bool_to_int(cond: Column) -> Column:
    """Cast a predicate to 0/1, keeping NULL when the predicate is NULL."""
    return cond.cast("int")
