"""Report projections used by the registered queries.

Results are compared with an independent SQL engine, so doubles are snapped on
both sides to a binary grid: ``floor(x * 2^k + 0.5) / 2^k`` (k = 14, a step of
about 6e-5; k = 30 for columns of small fractions).  Scaling by a power of two is exact, so equal inputs give
bit-equal outputs in both engines, and the tiny summation-order differences of
aggregates vanish.  A binary grid rather than 4 decimals, because bar prices
are exact decimals: an average like 3802.01885 sits exactly on a decimal
half-way point, where two summation orders round apart; decimal data never
sits on a binary half-way point.  NaN and huge magnitudes pass through
unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRID_BITS = 14
# Columns whose values are small fractions get a grid of about 1e-9.
FINE_BITS = 30
FINE_COLUMNS = {"drawdown", "price_deviation_sma7", "price_deviation_sma20", "next_day_return", "price_position"}
_PASS_LIMIT = 1e15


def round_col(c: Column, bits: int = GRID_BITS) -> Column:
    scale = float(2 ** bits)
    rounded = F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.isnan(c) | (F.abs(c) > F.lit(_PASS_LIMIT)), c).otherwise(rounded)


def bits_of(name: str) -> int:
    return FINE_BITS if name in FINE_COLUMNS else GRID_BITS


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every top-level double column, keeping names and order."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            out.append(round_col(F.col(f.name), bits_of(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def sql_round(expr: str, bits: int = GRID_BITS) -> str:
    scale = f"{float(2 ** bits)!r}"
    e = f"({expr})"
    return (f"CASE WHEN isnan({e}) OR abs({e}) > {_PASS_LIMIT!r} THEN {e} "
            f"ELSE floor({e} * {scale} + 0.5) / {scale} END")
