"""Bars that publishers send again, told from new late ones without reading the history.

For every symbol and month the state holds a digest of the bars that are stored: how many,
and the exclusive or of two 64-bit hashes of each.  The late bars of a batch (not newer than
their symbol's series) are digested alike.  Where symbol and month agree, the batch holds
exactly the stored bars again, and they go.  Only the months that differ are read, from a
table of known bars (symbol and hashes) in folders by month; the bars found there go too.
A publisher that sends all it ever sent with every batch thus costs one comparison of
digests a batch, however long its history is.

Two sets of bars with equal digests are equal up to a collision of 128 bits.  Hashes are
taken over text forms, so a NULL is a value of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.schema import BAR_COLUMNS
from candela.session import scratch_path
from candela.sinks import folders

DIGESTS = "symbol string, month string, n long, x1 long, x2 long"
KNOWN = "symbol string, h1 long, h2 long, run_id string, batch_id long, month string"
#: The one folder of dates that name no month.
OTHER = "other"


def month_of(date: str = "date") -> Column:
    return F.when(F.col(date).rlike(r"^\d{4}-\d{2}-"), F.substring(date, 1, 7)).otherwise(F.lit(OTHER))


def hashed(bars: DataFrame) -> DataFrame:
    """Bars that have a symbol and a date, with ``month`` and the hashes ``h1`` and ``h2``."""
    forms = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in BAR_COLUMNS[1:]]
    return (bars.filter("symbol is not null and date is not null")
            .withColumns({"month": month_of(), "h1": F.xxhash64(*forms), "h2": F.xxhash64(F.lit("second"), *forms)}))


def digests(bars: DataFrame) -> DataFrame:
    """One row per symbol and month of ``hashed`` bars; copies count once."""
    return (bars.select("symbol", "month", "h1", "h2").distinct().groupBy("symbol", "month")
            .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2")))


def merged_digests(stored: DataFrame, added: DataFrame) -> DataFrame:
    """Digests of the stored bars and the added ones, which are not among them."""
    return (stored.unionByName(added).groupBy("symbol", "month")
            .agg(F.sum("n").alias("n"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")))


def late_months(late: DataFrame, stored: DataFrame) -> DataFrame:
    """(symbol, month, same) of the late bars of a batch: whether they are just the stored ones again."""
    known = stored.select("symbol", "month", *[F.col(c).alias(f"_{c}") for c in ("n", "x1", "x2")])
    same = (F.col("n") == F.col("_n")) & (F.col("x1") == F.col("_x1")) & (F.col("x2") == F.col("_x2"))
    return (digests(hashed(late)).join(known, ["symbol", "month"], "left")
            .select("symbol", "month", F.coalesce(same, F.lit(False)).alias("same")))


def known_bars(spark: SparkSession, path: str, months: list[str], visible: Column) -> DataFrame:
    """(symbol, h1, h2) of the recorded bars of some months; only their folders are read."""
    there = [m for m in months if folders.exists(spark, f"{path}/month={m}")]
    if not there:
        return spark.createDataFrame([], KNOWN).select("symbol", "h1", "h2")
    return (spark.read.schema(KNOWN).option("basePath", path).parquet(*[f"{path}/month={m}" for m in there])
            .filter(visible).select("symbol", "h1", "h2").distinct())


def without_copies(bars: DataFrame, late: DataFrame, compared: DataFrame, path: str, visible: Column) -> DataFrame:
    """``bars`` but for those late ones that are stored already; written once, as the batch's own bars."""
    spark = bars.sparkSession
    months = sorted(r["month"] for r in compared.filter("not same").select("month").distinct().collect())  # a calendar's months
    same = compared.filter("same").select("symbol", "month")
    doubtful = hashed(late).join(same, ["symbol", "month"], "left_anti")
    fresh = doubtful.join(known_bars(spark, path, months, visible), ["symbol", "h1", "h2"], "left_anti")
    rest = bars.join(late.select("symbol", "date").distinct(), ["symbol", "date"], "left_anti")
    out = scratch_path(spark, "fresh-bars")
    rest.unionByName(fresh.select(bars.columns)).write.parquet(out)
    return spark.read.schema(bars.schema).parquet(out)


def write_known(bars: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    """Add a batch's bars to the table of known ones, in folders by month.

    A replayed attempt adds its rows again: copies, which readers take once.
    """
    (hashed(bars).select("symbol", "h1", "h2", F.lit(run_id).alias("run_id"), F.lit(int(batch_id)).cast("long").alias("batch_id"), "month")
     .distinct().hint("rebalance", "month").write.mode("append").partitionBy("month").parquet(path))
