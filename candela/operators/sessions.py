"""Market sessions as intervals of instants.

``open_intervals`` turns sessions (local opening and closing times of several markets, in
their zones), holidays and half days into a table of open intervals, one per market and
trading day: changes of the clock, sessions over midnight and days that close early are
settled there, once per day instead of once per row.  ``open_markets`` then finds for every
timestamp the markets that are open: intervals are dealt to the UTC days they touch, one row
per day with all its intervals, and rows meet them by an equality join on their day.  No row
is multiplied, and the day table has a row per calendar day, however many timestamps there
are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.operators.market import MAX_BROADCAST_ROWS
from candela.plans.sizing import broadcast_if_small

HALF_DAY_SCHEMA = T.StructType([
    T.StructField("market", T.StringType(), False),
    T.StructField("day", T.DateType(), False),
    T.StructField("close_time", T.StringType(), False),
])


def half_days_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, HALF_DAY_SCHEMA)


def _instant(day: Column, hhmm: Column, zone: Column) -> Column:
    """A local day and time as UTC wall time."""
    local = F.concat_ws(" ", day.cast("string"), F.when(F.length(hhmm) == 5, F.concat(hhmm, F.lit(":00"))).otherwise(hhmm))
    return F.convert_timezone(zone, F.lit("UTC"), local.cast("timestamp_ntz"))


def open_intervals(sessions: DataFrame, first: dt.date, last: dt.date, holidays: DataFrame | None = None,
                   half_days: DataFrame | None = None) -> DataFrame:
    """(market, day, opens, closes) of every trading day from ``first`` to ``last``; UTC wall times, both ends open.

    Trading days are weekdays that are no holiday of the market.  A half day closes at its own
    time; a session that closes at or before its opening time ends on the next day.
    """
    days = sessions.select("market", "timezone", "open_time", "close_time",
                           F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day")).filter(F.weekday("day") < 5)
    if holidays is not None:
        days = days.join(holidays.select("market", F.col("holiday").alias("day")).distinct(), ["market", "day"], "left_anti")
    if half_days is not None:
        early = half_days.groupBy("market", "day").agg(F.min("close_time").alias("early"))
        days = days.join(early, ["market", "day"], "left").withColumn("close_time", F.coalesce("early", "close_time"))
    closing = F.when(F.col("close_time") <= F.col("open_time"), F.date_add("day", 1)).otherwise(F.col("day"))
    return days.select("market", "day", _instant(F.col("day"), F.col("open_time"), F.col("timezone")).alias("opens"),
                       _instant(closing, F.col("close_time"), F.col("timezone")).alias("closes"))


def open_markets(df: DataFrame, ts_col: str, intervals: DataFrame) -> DataFrame:
    """``df`` with ``open_markets``: the markets open at each timestamp, sorted; empty for a NULL timestamp.

    ``TIMESTAMP_NTZ`` input is taken as UTC wall time, ``TIMESTAMP`` as an instant.
    """
    touched = F.sequence(F.to_date("opens"), F.to_date("closes"))
    by_day = intervals.select("market", "opens", "closes", F.explode(touched).alias("_day")).groupBy("_day").agg(
        F.collect_list(F.struct("market", "opens", "closes")).alias("_open"))  # a market's one or two sessions of a day
    ts = F.col(ts_col)
    if not isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        ts = F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))
    met = df.withColumn("_ts", ts).withColumn("_day", F.to_date("_ts")).join(
        broadcast_if_small(by_day, MAX_BROADCAST_ROWS), "_day", "left")
    at = lambda x: (F.col("_ts") >= x["opens"]) & (F.col("_ts") <= x["closes"])
    found = F.array_sort(F.array_distinct(F.transform(F.filter("_open", at), lambda x: x["market"])))
    return met.withColumn("open_markets", F.coalesce(found, F.array().cast("array<string>"))).drop("_ts", "_day", "_open")


def span_of_days(df: DataFrame, ts_col: str) -> tuple[dt.date, dt.date]:
    """The days that intervals must cover for ``df``'s timestamps, whatever the markets' zones."""
    r = df.agg(F.to_date(F.min(ts_col)).alias("first"), F.to_date(F.max(ts_col)).alias("last")).first()
    if r["first"] is None:
        return dt.date(1970, 1, 1), dt.date(1970, 1, 1)
    return r["first"] - dt.timedelta(days=3), r["last"] + dt.timedelta(days=2)
