"""Cross-batch look-back for the feature windows.

Row-frame windows restart in every micro-batch unless earlier bars are put back
in front of the new ones.  Per symbol the state keeps

* ``tail``: the last ``LOOKBACK_ROWS`` (118) bars -- the longest finite
  dependency of the composite, the 100-row mean of a 20-row stddev;
* ``carry_sum`` / ``carry_sum_exact``: the running sum of ``daily_change_pct``
  just before the tail, as a double and as the exact decimal sum;
* ``carry_peak``: the highest close before the tail;
* ``last_date``: the newest stored date.

so every feature of a new bar equals the value a full recompute over the whole
history gives.  The one exception is the label ``next_day_return`` of the last
bar of each batch, NULL when written, because its next bar has not arrived; the batch
that brings it writes the label to a table of its own (``completed_labels``).

The state is a snapshot of all symbols per batch, in a folder of its own, beside digests of
the stored bars (``candela.streaming.redelivery``).  The record of committed batches
(``candela.streaming.commits``) names the newest one; a batch reads that and nothing older,
so its cost does not grow with the number of batches.  Snapshots are dropped when two newer
ones are recorded.  A run with a fresh checkpoint goes on from the same record.

Batch and state rows meet in one shuffle on the symbol: state rows travel as one
row each, spread their last date and peak over the symbol's rows by a window, and
unfold their tails only where the batch has rows of the symbol.

Bars without a symbol or a date belong to no series: each is a series of its own, so
however many there are, they meet in no task, and they never enter the state.  Bars dated at or before ``last_date`` are
late: they are kept out of the windows and flagged ``late_bar``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.operators import features as feat
from candela.operators.segmented import segmented_features
from candela.schema import BAR_COLUMNS, LOOKBACK_ROWS
from candela.sinks import folders
from candela.streaming.commits import Commit, newest
from candela.streaming.redelivery import DIGESTS

TAIL_FIELDS = ["date", "open", "high", "low", "close", "volume"]
_TAIL = "array<struct<date:string,open:double,high:double,low:double,close:double,volume:double>>"
STATE_SCHEMA = ("symbol string, last_date string, carry_sum double, carry_sum_exact decimal(38,18), "
                f"carry_peak double, tail {_TAIL}")
SEEDS = ["carry_sum", "carry_sum_exact", "carry_peak"]


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


STATE_FOLDER = "_history_state"


def read_state(spark: SparkSession, output: str, last: Commit | None = None) -> tuple[DataFrame, DataFrame]:
    """(look-back state, digests of the stored bars) that the newest record names.

    Empty when there is none; a snapshot that cannot be read raises.
    """
    last = last or newest(spark, output)
    if last.state is None:
        return empty_state(spark), spark.createDataFrame([], DIGESTS)
    path = f"{output}/{STATE_FOLDER}/{last.state}"
    return spark.read.schema(STATE_SCHEMA).parquet(f"{path}/tails"), spark.read.schema(DIGESTS).parquet(f"{path}/digests")


def write_state(state: DataFrame, stored: DataFrame, output: str, seq: int) -> str:
    """Write a snapshot under a name of its own; it counts when a record names it."""
    name = f"{seq:012d}-{uuid.uuid4().hex[:8]}"
    state.write.parquet(f"{output}/{STATE_FOLDER}/{name}/tails")
    stored.write.parquet(f"{output}/{STATE_FOLDER}/{name}/digests")
    return name


def drop_older(spark: SparkSession, output: str, newest_state: str) -> None:
    """Drop the snapshots before the last one but one, and those of attempts that were not recorded."""
    older = [s for s in folders.subfolders(spark, f"{output}/{STATE_FOLDER}") if s < newest_state]
    for s in older[:-1]:
        folders.delete(spark, f"{output}/{STATE_FOLDER}/{s}")


def no_series() -> Column:
    """Bars that belong to no series."""
    return F.col("symbol").isNull() | F.col("date").isNull()


def late_rows(bars: DataFrame, state: DataFrame) -> DataFrame:
    """Bars dated at or before the last stored date of their symbol."""
    last = state.select("symbol", "last_date")
    return bars.join(last, "symbol").filter("date <= last_date").select(bars.columns)


def features_with_history(bars: DataFrame, state: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Features of a batch continued from ``state``, history rows included.

    With ``chunk_rows`` every series, its history in front, is cut into chunks that run in
    parallel; the state's carries enter the first of them.

    The result has the bar and feature columns plus ``_late``, ``_hist`` and the seed
    columns; ``batch_rows`` keeps the batch's own rows and ``next_state`` derives the
    new state, so a caller can persist this frame once and feed both.
    """
    bar = F.struct(*[F.col(c) for c in TAIL_FIELDS])
    aside = no_series() | (F.col("_aside") if "_aside" in bars.columns else F.lit(False))
    own = bars.select("symbol", aside.alias("_aside"), F.array(bar).cast(_TAIL).alias("tail"),
                      F.lit(None).cast("string").alias("last_date"),
                      F.lit(None).cast("double").alias("carry_sum"),
                      F.lit(None).cast("decimal(38,18)").alias("carry_sum_exact"),
                      F.lit(None).cast("double").alias("carry_peak"), F.lit(False).alias("_hist"))
    kept = state.select("symbol", F.lit(False).alias("_aside"), "tail", "last_date", *SEEDS,
                        F.lit(True).alias("_hist"))
    met = own.unionByName(kept).withColumn(
        "_alone", F.when(F.col("symbol").isNull() | F.get("tail", F.lit(0))["date"].isNull(),
                         F.monotonically_increasing_id()))
    series = Window.partitionBy("symbol", "_alone")
    met = (met
           .withColumn("_touched", F.max((~F.col("_hist")).cast("int")).over(series))
           .withColumn("_stored", F.max("last_date").over(series))
           .withColumn("_peak_seed", F.max("carry_peak").over(series))
           .filter("_touched = 1"))
    rows = (met.select("symbol", "_alone", "_aside", "_hist", "_stored", "_peak_seed", "carry_sum",
                       "carry_sum_exact", F.posexplode("tail").alias("_pos", "_bar"))
            .select("symbol", *[F.col("_bar").getField(c).alias(c) for c in TAIL_FIELDS],
                    (F.col("_aside") | (~F.col("_hist") & F.coalesce(
                        F.col("_bar.date") <= F.col("_stored"), F.lit(False)))).alias("_late"),
                    "_alone", "_hist", "_stored", "_peak_seed",
                    # The sum carry rides on the first history row.
                    F.when(F.col("_hist") & (F.col("_pos") == 0), F.col("carry_sum")).alias("_sum_seed"),
                    F.when(F.col("_hist") & (F.col("_pos") == 0), F.col("carry_sum_exact"))
                    .alias("_sum_seed_exact")))
    rows = rows.withColumn("_peak_seed", F.when(~F.col("_late"), F.col("_peak_seed")))
    keys = ("symbol", "_alone", "_late")
    if chunk_rows:
        return segmented_features(rows, keys, chunk_rows, sum_seed="_sum_seed", sum_seed_exact="_sum_seed_exact",
                                  peak_seed="_peak_seed", keep_exact=True)
    return feat.ohlcv_features(rows, partition_cols=keys,
                               sum_seed="_sum_seed", sum_seed_exact="_sum_seed_exact",
                               peak_seed="_peak_seed", keep_exact=True)


def batch_rows(with_history: DataFrame) -> DataFrame:
    """The batch's own rows of ``features_with_history`` (keeps ``_late``)."""
    return with_history.filter(~F.col("_hist")).drop("_alone", "_hist", "_stored", "_sum_seed", "_sum_seed_exact",
                                                     "_peak_seed", "_cumulative_exact")


def completed_labels(with_history: DataFrame) -> DataFrame:
    """(symbol, date, next_day_return) of stored last bars whose next bar this batch has brought."""
    return (with_history.filter(F.col("_hist") & (F.col("date") == F.col("_stored")))
            .filter("next_day_return is not null").select("symbol", "date", "next_day_return"))


def next_state(with_history: DataFrame, lookback: int = LOOKBACK_ROWS) -> DataFrame:
    """New state of every touched symbol, from its on-time rows (history + batch)."""
    newest_first = Window.partitionBy("symbol").orderBy(*[F.col(c).desc() for c in feat.ORDER_COLS])
    ranked = (with_history.filter(~F.col("_late") & ~no_series())
              .withColumn("_rank", F.row_number().over(newest_first)))
    in_tail = F.col("_rank") <= F.lit(lookback)
    bar = F.struct(*[F.col(c) for c in TAIL_FIELDS])
    # Running sum just before the new tail: that of the row ranked lookback + 1;
    # on a short series the old carry (the seed of the first row).
    has_prev = F.max("_rank") > F.lit(lookback)
    before_tail = lambda c: F.max(F.when(F.col("_rank") == lookback + 1, F.col(c)))
    return ranked.groupBy("symbol").agg(
        F.max("date").alias("last_date"),
        F.when(has_prev, before_tail("cumulative_return")).otherwise(F.max("_sum_seed")).alias("carry_sum"),
        F.when(has_prev, before_tail("_cumulative_exact"))
         .otherwise(F.max("_sum_seed_exact")).cast("decimal(38,18)").alias("carry_sum_exact"),
        F.greatest(F.max(F.when(~in_tail, F.col("close"))), F.max("_peak_seed")).alias("carry_peak"),
        # At most ``lookback`` bars per symbol: collect_list skips the NULLs.
        F.sort_array(F.collect_list(F.when(in_tail, bar))).alias("tail"),
    )


def merged_state(touched: DataFrame, state: DataFrame) -> DataFrame:
    """The whole new snapshot: the touched symbols' new rows, the others' old ones."""
    return touched.unionByName(state.join(touched.select("symbol"), "symbol", "left_anti"))
