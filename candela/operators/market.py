"""Market-session logic as DataFrame operators.

``is_market_open`` flags each timestamp: open when, in the market's local time,
it is a weekday, the time of day lies in [open, close] (both inclusive, to the
microsecond) and the local date is not a holiday of that market.  Sessions and
holidays are small dimension tables joined on the market; they are broadcast
only after their row count is checked against a bound (see ``broadcast_if_small``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.plans.sizing import broadcast_if_small

SESSION_SCHEMA = T.StructType([
    T.StructField("market", T.StringType(), False),
    T.StructField("timezone", T.StringType(), False),
    T.StructField("open_time", T.StringType(), False),
    T.StructField("close_time", T.StringType(), False),
    T.StructField("holidays_calendar", T.StringType(), True),
])
HOLIDAY_SCHEMA = T.StructType([
    T.StructField("market", T.StringType(), False),
    T.StructField("holiday", T.DateType(), False),
])

# The configured market and the asset classes of the extraction plan.
NYSE_SESSION = ("NYSE", "America/New_York", "09:30", "16:00", "NYSE")
CRYPTO = "crypto"
STOCK = "stock"
EXTRACT_TASKS = {CRYPTO: "extract_crypto_data", STOCK: "extract_stocks_data"}

# Dimension tables above this many rows are joined with a shuffle, not broadcast.
MAX_BROADCAST_ROWS = 100_000


def sessions_frame(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(rows or [NYSE_SESSION], SESSION_SCHEMA)


def holidays_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, HOLIDAY_SCHEMA)


def _time_key(hhmm: F.Column) -> F.Column:
    """'HH:mm' or 'HH:mm:ss' -> 'HH:mm:ss.SSSSSS', comparable as a string."""
    padded = F.when(F.length(hhmm) == 5, F.concat(hhmm, F.lit(":00"))).otherwise(hhmm)
    return F.concat(padded, F.lit(".000000"))


def local_time(ts: F.Column, tz: F.Column, ts_type: T.DataType) -> F.Column:
    """Wall-clock time in ``tz`` of a timestamp.

    ``TIMESTAMP_NTZ`` input is taken as UTC wall time.  ``TIMESTAMP`` is an instant:
    its wall time in the session's zone is converted from that zone.
    """
    if isinstance(ts_type, T.TimestampNTZType):
        return F.convert_timezone(F.lit("UTC"), tz, ts)
    return F.convert_timezone(F.current_timezone(), tz, ts.cast("timestamp_ntz"))


def is_market_open(df: DataFrame, ts_col: str, sessions: DataFrame, holidays: DataFrame | None = None,
                   market: str | None = "NYSE") -> DataFrame:
    """Append ``market``, ``local_time`` (string) and ``is_open`` to every row of ``df``.

    With ``market`` set, each row is checked against that market; with
    ``market=None`` ``df`` must carry a ``market`` column.
    """
    ts_type = df.schema[ts_col].dataType
    base = df.withColumn("market", F.lit(market)) if market is not None else df
    sess = broadcast_if_small(sessions.select("market", "timezone", "open_time", "close_time"),
                              MAX_BROADCAST_ROWS)
    joined = base.join(sess, on="market", how="left")
    local = local_time(F.col(ts_col), F.col("timezone"), ts_type)
    joined = (joined
              .withColumn("_local", local)
              .withColumn("_local_date", F.to_date("_local"))
              .withColumn("_tod", F.date_format("_local", "HH:mm:ss.SSSSSS")))
    if holidays is not None:
        hol = broadcast_if_small(
            holidays.select("market", F.col("holiday").alias("_local_date"),
                            F.lit(True).alias("_is_holiday")).dropDuplicates(["market", "_local_date"]),
            MAX_BROADCAST_ROWS)
        joined = joined.join(hol, on=["market", "_local_date"], how="left")
    else:
        joined = joined.withColumn("_is_holiday", F.lit(None).cast("boolean"))
    open_now = (
        (F.weekday("_local") < 5)
        & (F.col("_tod") >= _time_key(F.col("open_time")))
        & (F.col("_tod") <= _time_key(F.col("close_time")))
        & F.col("_is_holiday").isNull()
    )
    # Anything unknown (no session for the market, NULL timestamp) counts as closed.
    return (joined
            .withColumn("local_time", F.date_format("_local", "yyyy-MM-dd HH:mm:ss"))
            .withColumn("is_open", F.coalesce(open_now, F.lit(False)))
            .drop("timezone", "open_time", "close_time", "_local", "_local_date", "_tod", "_is_holiday"))


def gate_by_session(df: DataFrame, asset_col: str = "asset_class", open_col: str = "is_open") -> DataFrame:
    """Keep crypto rows always and stock rows only while their market is open."""
    return df.filter((F.col(asset_col) == F.lit(CRYPTO)) | F.coalesce(F.col(open_col), F.lit(False)))


def extraction_plan(ticks: DataFrame, open_col: str = "is_open") -> DataFrame:
    """Scheduler ticks with a market-open flag -> one row per extraction task to run.

    Crypto extraction runs on every tick, stock extraction only when the market
    is open.  Each tick fans out to at most two rows (no join).
    """
    classes = F.array(F.lit(CRYPTO), F.lit(STOCK))
    per_class = ticks.withColumn("asset_class", F.explode(classes))
    task = F.when(F.col("asset_class") == F.lit(CRYPTO), F.lit(EXTRACT_TASKS[CRYPTO])) \
            .otherwise(F.lit(EXTRACT_TASKS[STOCK]))
    return gate_by_session(per_class, "asset_class", open_col).withColumn("task", task)
