"""Weekly and monthly re-aggregation of daily bars.

One ``groupBy(symbol, period)`` each.  Open and close are taken by bar time with
``min_by`` / ``max_by`` (deterministic, unlike first/last), and every aggregate
here has a partial form with fixed-width buffers (a hash aggregate), so the shuffle carries one partial row per
(symbol, period) and map task: a symbol holding a third of all bars is split
over its periods and pre-aggregated before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.columns import pct_change
from candela.schema import MONTHLY_COLUMNS, WEEKLY_COLUMNS


def bar_time(date_col: str = "date") -> Column:
    """The bar's date key as a timestamp, in any form that casts to one; NULL if none.

    A fixed-width ordering key: ``min_by`` / ``max_by`` ordered by it keep their
    buffers in a hash aggregate (a string key would force a sort-based one).
    """
    return F.col(date_col).cast("string").try_cast("timestamp")


def period_start(unit: str, date_col: str = "date") -> Column:
    """Start of the calendar week (Monday) or month as a DATE; NULL on unparseable dates."""
    return F.to_date(F.date_trunc(unit, bar_time(date_col)))


def weekly_rollup(df: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    out = (df.withColumn("_t", bar_time()).withColumn("week", F.to_date(F.date_trunc("week", "_t")))
             .groupBy(*keys, "week")
             .agg(F.min_by("open", "_t").alias("week_open"),
                  F.max("high").alias("week_high"),
                  F.min("low").alias("week_low"),
                  F.max_by("close", "_t").alias("week_close"),
                  F.sum("volume").alias("week_volume"),
                  F.count(F.lit(1)).alias("trading_days"))
             .withColumn("weekly_change_pct", pct_change("week_close", "week_open")))
    return out.select(*keys, *WEEKLY_COLUMNS[1:])


def monthly_rollup(df: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    out = (df.withColumn("_t", bar_time()).withColumn("month", F.to_date(F.date_trunc("month", "_t")))
             .groupBy(*keys, "month")
             .agg(F.min_by("open", "_t").alias("month_open"),
                  F.max("high").alias("month_high"),
                  F.min("low").alias("month_low"),
                  F.max_by("close", "_t").alias("month_close"),
                  F.sum("volume").alias("month_volume"),
                  F.avg("close").alias("month_avg_price"),
                  F.stddev_samp("close").alias("month_volatility")))
    return out.select(*keys, *MONTHLY_COLUMNS[1:])
