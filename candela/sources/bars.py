"""Daily bars built from the driver's ``lineitem`` table.

No driver table holds bars, so the fixtures derive them: each line item is a
trade at ``p = l_extendedprice / l_quantity`` on ``l_shipdate``; a bar is one
(symbol, day).  Open and close are the first and last trade by
``(l_orderkey, l_linenumber, p)`` -- ``p`` ends the key because the first two
are not unique in the data.

Scale: one ``groupBy(symbol, date)`` with map-side partial aggregation
(min/max/sum all merge partial buffers), so a hot symbol is
spread over its days before the shuffle and every reducer holds at most one
partial row per (symbol, day) and map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.schema import BAR_COLUMNS


def supplier_symbol() -> Column:
    return F.col("l_suppkey").cast("string")


def flag_symbol() -> Column:
    return F.concat(F.col("l_returnflag"), F.col("l_linestatus"))


def bars_from_trades(trades: DataFrame, symbol: Column, ts: Column, price: Column,
                     qty: Column, tiebreak: list[Column], date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Aggregate trades into bars of the 7 bar columns, one row per (symbol, period).

    ``tiebreak`` orders trades inside a period; the price is appended to it so
    the first/last trade is always well defined.
    """
    t = trades.select(
        symbol.alias("symbol"),
        F.date_format(ts, date_format).alias("date"),
        price.alias("p"),
        qty.alias("q"),
        *[c.alias(f"_k{i}") for i, c in enumerate(tiebreak)],
    )
    order_key = F.struct(*[F.col(f"_k{i}") for i in range(len(tiebreak))], F.col("p"))
    # The price ends the key, so the key alone is shuffled: min_by would carry the price beside it.
    return (t.groupBy("symbol", "date")
             .agg(F.min(order_key)["p"].alias("open"),
                  F.max("p").alias("high"),
                  F.min("p").alias("low"),
                  F.max(order_key)["p"].alias("close"),
                  F.sum("q").alias("volume"))
             .select(*BAR_COLUMNS))


def bars_from_lineitem(lineitem: DataFrame, symbol: Column | None = None) -> DataFrame:
    return bars_from_trades(
        lineitem,
        symbol=symbol if symbol is not None else supplier_symbol(),
        ts=F.col("l_shipdate"),
        price=F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
        qty=F.col("l_quantity"),
        tiebreak=[F.col("l_orderkey"), F.col("l_linenumber")],
    )


def bars_by_supplier(lineitem: DataFrame) -> DataFrame:
    """Fixture B1: symbol = supplier key (many symbols, mostly flat bars)."""
    return bars_from_lineitem(lineitem, supplier_symbol())


def bars_by_flag(lineitem: DataFrame) -> DataFrame:
    """Fixture B2: symbol = return flag || line status (few symbols, long real-range series)."""
    return bars_from_lineitem(lineitem, flag_symbol())


def bars_by_event_hour(events: DataFrame) -> DataFrame:
    """Fixture B3: hourly bars per event type, ``value`` as the price, one unit per event."""
    return bars_from_trades(
        events,
        symbol=F.col("event_type"),
        ts=F.col("ts"),
        price=F.col("value"),
        qty=F.lit(1.0),
        tiebreak=[F.col("ts"), F.col("event_id")],
        date_format="yyyy-MM-dd HH:00",
    )


# The dirty-bar fixture.  Every n-th bar of a series (1-based, by
# date) is damaged; rules apply top to bottom.
DIRTY_EVERY = {
    "symbol_null": 97,
    "close_null": 89,
    "volume_null": 83,
    "swap_high_low": 79,
    "high_nan": 73,
}


def dirty_bars(bars: DataFrame) -> DataFrame:
    """Deterministically damage bars to exercise every quality rule.

    The ordinal comes from a per-symbol window; bars are unique per
    (symbol, date), so it is stable run to run.
    """
    n = F.row_number().over(Window.partitionBy("symbol").orderBy("date"))
    hit = lambda rule: (F.col("_n") % F.lit(DIRTY_EVERY[rule])) == 0
    swapped = hit("swap_high_low")
    return (bars.withColumn("_n", n)
            .withColumns({
                "symbol": F.when(hit("symbol_null"), F.lit(None).cast("string")).otherwise(F.col("symbol")),
                "close": F.when(hit("close_null"), F.lit(None).cast("double")).otherwise(F.col("close")),
                "volume": F.when(hit("volume_null"), F.lit(None).cast("double")).otherwise(F.col("volume")),
                "high": F.when(hit("high_nan"), F.lit(float("nan")))
                         .when(swapped, F.col("low"))
                         .otherwise(F.col("high")),
                "low": F.when(swapped, F.col("high") + F.lit(1.0)).otherwise(F.col("low")),
            })
            .select(*BAR_COLUMNS))


# When and how often bars of the arrival fixture come.
ARRIVE_LATE, ARRIVE_AGAIN, ARRIVE_CHANGED, LOSE_DATE = 61, 7, 59, 101


def dirty_arrivals(bars: DataFrame) -> DataFrame:
    """Damaged bars with ``arrival``, the batch in which each comes (a year; "" without a date).

    Beyond the quality damage of ``dirty_bars`` (but for NaN): dates are lost, some bars come
    a year late, some come again a year later as exact copies, some again with another close.
    """
    n = F.row_number().over(Window.partitionBy("symbol").orderBy("date"))
    every = lambda k: (F.col("_n") % F.lit(k)) == 0
    swapped = every(DIRTY_EVERY["swap_high_low"])
    damaged = (bars.withColumn("_n", n).withColumn("_year", F.substring("date", 1, 4).cast("int"))
               .withColumns({
                   "symbol": F.when(~every(DIRTY_EVERY["symbol_null"]), F.col("symbol")),
                   "date": F.when(~every(LOSE_DATE), F.col("date")),
                   "close": F.when(~every(DIRTY_EVERY["close_null"]), F.col("close")),
                   "volume": F.when(~every(DIRTY_EVERY["volume_null"]), F.col("volume")),
                   "high": F.when(swapped, F.col("low")).otherwise(F.col("high")),
                   "low": F.when(swapped, F.col("high") + F.lit(1.0)).otherwise(F.col("low")),
               }))
    year = lambda c: F.when(F.col("date").isNull(), F.lit("")).otherwise(c.cast("string"))
    first = damaged.withColumn("arrival", year(F.col("_year") + every(ARRIVE_LATE).cast("int")))
    whole = damaged.filter("symbol is not null and date is not null").filter(~every(ARRIVE_LATE)) \
        .withColumn("arrival", year(F.col("_year") + 1))
    again = whole.filter(every(ARRIVE_AGAIN))
    changed = (whole.filter(every(ARRIVE_CHANGED) & ~every(ARRIVE_AGAIN)).filter("close is not null")
               .withColumn("close", F.col("close") + 1))
    columns = [*BAR_COLUMNS, "arrival"]
    return first.select(columns).unionByName(again.select(columns)).unionByName(changed.select(columns))
