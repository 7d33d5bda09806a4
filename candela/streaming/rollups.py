"""Weekly and monthly rollups kept up to date by the streaming job.

A period's row can be built from parts: the first open and last close with their times,
extremes, sums, counts, and mean and squared deviations that merge pairwise.  A batch rolls
its own bars up, reads the stored rows of the periods it touches, late bars' periods
included, merges both and appends new versions.  Versions lie in folders by the month in
which the period begins; only the folders of touched months are read, so a batch costs as
much as the bars it brings, not as the history.  The newest recorded version of a period is
its row.

Equal to the batch rollups over all bars that the job stored, but for one addition: of bars
with the same time the least open and the greatest close count, so that the order of
arrival does not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.functions.columns import pct_change
from candela.operators.rollup import bar_time
from candela.schema import MONTHLY_COLUMNS, WEEKLY_COLUMNS
from candela.sinks import folders
from candela.streaming.commits import committed

KINDS = ("week", "month")
KEYS = ["kind", "symbol", "period"]
_ENDS = "struct<t: timestamp, v: double>"
PARTS = (f"kind string, symbol string, period date, opened {_ENDS}, closed {_ENDS}, high double, low double, "
         "volume double, bars long, n long, mean double, m2 double")
VERSIONS = PARTS + ", seq long, run_id string, batch_id long, begins string"
NO_MONTH = "none"


def parts(bars: DataFrame) -> DataFrame:
    """One mergeable row per symbol and week, and per symbol and month."""
    timed = bars.withColumn("_t", bar_time())
    timed_at = F.col("_t").isNotNull()
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.to_date(F.date_trunc(k, "_t")).alias("period")) for k in KINDS]))
    return (timed.withColumn("_p", both).groupBy(F.col("_p.kind").alias("kind"), "symbol", F.col("_p.period").alias("period")).agg(
        F.min(F.when(timed_at, F.struct(F.col("_t").alias("t"), F.col("open").alias("v")))).alias("opened"),
        F.max(F.when(timed_at, F.struct(F.col("_t").alias("t"), F.col("close").alias("v")))).alias("closed"),
        F.max("high").alias("high"), F.min("low").alias("low"), F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("bars"), F.count("close").alias("n"), F.avg("close").alias("mean"),
        (F.var_pop("close") * F.count("close")).alias("m2")))


def merged(some: DataFrame) -> DataFrame:
    """Parts of the same period made one.  Mean and squared deviations are added pair by pair."""
    one = F.struct("n", "mean", "m2")
    moments = F.expr("""
        aggregate(filter(_m, x -> x.n > 0), named_struct('n', 0L, 'mean', CAST(NULL AS DOUBLE), 'm2', CAST(NULL AS DOUBLE)),
          (a, b) -> CASE WHEN a.n = 0 THEN b ELSE named_struct(
            'n', a.n + b.n, 'mean', a.mean + (b.mean - a.mean) * b.n / (a.n + b.n),
            'm2', a.m2 + b.m2 + (b.mean - a.mean) * (b.mean - a.mean) * a.n * b.n / (a.n + b.n)) END)""")
    return (some.groupBy(*KEYS).agg(
        F.min("opened").alias("opened"), F.max("closed").alias("closed"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("volume").alias("volume"), F.sum("bars").alias("bars"), F.collect_list(one).alias("_m"))  # two parts at most
        .withColumn("_m", moments)
        .select(*KEYS, "opened", "closed", "high", "low", "volume", "bars", "_m.n", "_m.mean", "_m.m2"))


def begins():
    return F.coalesce(F.date_format("period", "yyyy-MM"), F.lit(NO_MONTH))


def newest_versions(versions: DataFrame) -> DataFrame:
    names = [c.split()[0] for c in PARTS.replace("struct<t: timestamp, v: double>", "s").split(", ")][3:]
    best = F.max_by(F.struct(*names), "seq").alias("_v")
    return versions.groupBy(*KEYS).agg(best).select(*KEYS, *[F.col("_v").getField(n).alias(n) for n in names])


def stored_versions(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """The recorded versions, of some months or of all."""
    output = path.rpartition("/")[0]
    there = [f"{path}/begins={m}" for m in months if folders.exists(spark, f"{path}/begins={m}")] if months is not None \
        else [path] if folders.exists(spark, path) else []
    if not there:
        return spark.createDataFrame([], VERSIONS)
    return committed(spark.read.schema(VERSIONS).option("basePath", path).parquet(*there), output)


def update_rollups(bars: DataFrame, path: str, run_id: str, batch_id: int, seq: int) -> None:
    """Append new versions of the periods that a batch's bars touch."""
    spark = bars.sparkSession
    own = parts(bars).withColumn("begins", begins()).persist()
    try:
        months = sorted(r["begins"] for r in own.select("begins").distinct().collect())  # a calendar's months
        touched = own.select(*[F.col(k).alias(f"_{k}") for k in KEYS])
        same = F.lit(True)
        for k in KEYS:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        known = newest_versions(stored_versions(spark, path, months)).join(touched, same, "left_semi")
        (merged(known.unionByName(own.drop("begins")))
         .withColumns({"seq": F.lit(seq).cast("long"), "run_id": F.lit(run_id), "batch_id": F.lit(int(batch_id)).cast("long"), "begins": begins()})
         .hint("rebalance", "begins").write.mode("append").partitionBy("begins").parquet(path))
    finally:
        own.unpersist()


def read_weekly(spark: SparkSession, path: str) -> DataFrame:
    rows = newest_versions(stored_versions(spark, path).filter("kind = 'week'"))
    return rows.select("symbol", F.col("period").alias("week"), F.col("opened.v").alias("week_open"), F.col("high").alias("week_high"),
                       F.col("low").alias("week_low"), F.col("closed.v").alias("week_close"), F.col("volume").alias("week_volume"),
                       F.col("bars").alias("trading_days")).withColumn("weekly_change_pct", pct_change("week_close", "week_open")) \
        .select(*WEEKLY_COLUMNS)


def read_monthly(spark: SparkSession, path: str) -> DataFrame:
    rows = newest_versions(stored_versions(spark, path).filter("kind = 'month'"))
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return rows.select("symbol", F.col("period").alias("month"), F.col("opened.v").alias("month_open"), F.col("high").alias("month_high"),
                       F.col("low").alias("month_low"), F.col("closed.v").alias("month_close"), F.col("volume").alias("month_volume"),
                       F.col("mean").alias("month_avg_price"), deviation.alias("month_volatility")).select(*MONTHLY_COLUMNS)
