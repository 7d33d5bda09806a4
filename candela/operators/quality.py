"""Data-quality flags and the clean / failed split.

The four rules read raw bar columns only, so they can run before or after the
feature windows.  The first rule that fires names the flag; a bar with no flag
passes.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

PASSED = "Passed"
FAILED = "Failed"

# Flag names, in priority order.
MISSING_SYMBOL = "missing_symbol"
MISSING_PRICE = "missing_price_data"
MISSING_VOLUME = "missing_volume"
INVALID_HIGH_LOW = "invalid_high_low"
# Optional rules (off by default, not part of the reference rule set).
NAN_PRICE = "nan_price"
LATE_BAR = "late_bar"
MISSING_DATE = "missing_date"


def quality_rules(nan_rule: bool = False) -> list[tuple[Column, str]]:
    prices = ["open", "high", "low", "close"]
    rules = [
        (F.col("symbol").isNull(), MISSING_SYMBOL),
        (reduce(or_, [F.col(p).isNull() for p in prices]), MISSING_PRICE),
        (F.col("volume").isNull(), MISSING_VOLUME),
        # NaN compares greater than every number: NaN low -> invalid, NaN high -> not.
        (F.col("high") < F.col("low"), INVALID_HIGH_LOW),
    ]
    if nan_rule:
        rules.append((reduce(or_, [F.isnan(p) for p in prices + ["volume"]]), NAN_PRICE))
    return rules


def quality_flag(nan_rule: bool = False) -> Column:
    expr = None
    for cond, label in quality_rules(nan_rule):
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def quality_flags(df: DataFrame, nan_rule: bool = False) -> DataFrame:
    """Append ``data_quality_flag`` (first rule hit, else NULL) and ``data_quality_status``."""
    return (df.withColumn("data_quality_flag", quality_flag(nan_rule))
              .withColumn("data_quality_status",
                          F.when(F.col("data_quality_flag").isNull(), F.lit(PASSED))
                           .otherwise(F.lit(FAILED))))


def clean_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("data_quality_status") == F.lit(PASSED))


def failed_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("data_quality_status") == F.lit(FAILED))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, failed) views of a flagged frame; persist the input before writing both."""
    return clean_rows(df), failed_rows(df)


def quality_counts(df: DataFrame) -> DataFrame:
    """One row: total, clean and failed counts of a flagged frame, in one pass."""
    passed = F.col("data_quality_status") == F.lit(PASSED)
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.count_if(passed).alias("clean_records"),
                  F.count_if(~passed).alias("failed_records"))


def count_observation(df: DataFrame, name: str = "quality_counts") -> tuple[DataFrame, Observation]:
    """Attach the three counts to the next action over ``df`` (no extra job)."""
    obs = Observation(name)
    passed = F.col("data_quality_status") == F.lit(PASSED)
    observed = df.observe(obs,
                          F.count(F.lit(1)).alias("total_records"),
                          F.count_if(passed).alias("clean_records"),
                          F.count_if(~passed).alias("failed_records"))
    return observed, obs
