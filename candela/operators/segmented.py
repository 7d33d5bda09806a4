"""Feature windows for series too long for one task.

``ohlcv_features`` partitions windows by symbol, so one series is one task.
For unique daily bars that is bounded by the calendar, but an intraday feed,
one symbol holding a large share of all rows, or all bars without a symbol or a
date, would put an unbounded group into a single task.  ``segmented_features``
computes the same columns with every series cut into chunks of ``chunk_rows``
bars, each a window group of its own, and long series into blocks of whole chunks
(``BLOCK_ROWS`` bars, or one chunk if that is more) that run in parallel:

1. the bars are written once to the shared scratch folder.  Series of up to a block
   stay whole.  Longer ones are range-partitioned and sorted by (series, window order)
   and written with their running number.  Ranges are even however rows share keys, but
   for identical rows, which stay in one; a row's ordinal in its series follows from its
   number and the row counts per (series, range), a small table;
2. ``block = ordinal div block rows``; the last ``LOOKBACK_ROWS`` (118) bars of each
   block are copied into the next block and its first bar into the previous one, as
   read-only halo rows.  All rows then move once, to their (series, block), and stay
   there;
3. the two unbounded columns run over the block.  A later block gets its prefix from
   totals per block: the sum of ``daily_change_pct`` and the highest close of all earlier
   ones, summed up over the block table.  Bars that tie on a date share one running
   return; where a block boundary cuts them apart, the part beyond it is added from the
   block table too;
4. ``chunk = ordinal div chunk_rows``; chunks of a block get halo rows from each other
   as blocks do, inside the task, so every bounded frame (the longest is the 100-bar mean
   of a 20-bar stddev) and the one-bar look-ahead see exactly the rows they would see
   over the whole series.

Of all rows only one copy is shuffled or stored at a time beside the stored bars (of long
series the sorted ones too): shuffle files go when the table they served is written.

Results equal the plain plan, for ties, NULL keys and NULL dates as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.operators import features as feat
from candela.schema import FEATURE_COLUMNS, LOOKAHEAD_ROWS, LOOKBACK_ROWS
from candela.session import scratch_path, shuffles_dropped

DEFAULT_CHUNK_ROWS = 100_000
#: A longer series is cut into blocks of at least so many rows.
BLOCK_ROWS = 100_000
#: Rows that a task gets on average at most.
TASK_ROWS = 100_000
#: Bits of ``monotonically_increasing_id`` below the partition's number.
ROW_BITS = 33


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as written under the shared scratch folder, the shuffle files behind it dropped."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def series_ordinals(df: DataFrame, keys: Sequence[str] = feat.DEFAULT_KEYS,
                    order_cols: Sequence[str] = feat.ORDER_COLS, ranges: int | None = None) -> DataFrame:
    """Append ``_key`` (the series, never NULL) and ``_ord``: each row's 0-based place in it.

    The rows are materialised once under the shared scratch folder.
    """
    # (is NULL, value) pairs: equal for equal keys, so they can be joined on.
    key = F.array(*[F.concat(F.when(F.col(k).isNull(), F.lit("n")).otherwise(F.lit("v")),
                             F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys]) \
        if keys else F.array(F.lit("v"))
    sort = ["_key", *order_cols]
    keyed = df.withColumn("_key", key)
    spread = keyed.repartitionByRange(ranges, *sort) if ranges else keyed.repartitionByRange(*sort)
    rows = stored(spread.sortWithinPartitions(*sort).withColumn("_seq", F.monotonically_increasing_id()),
                  "ordered-bars").withColumn("_range", F.shiftright("_seq", ROW_BITS))
    spans = rows.groupBy("_key", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_seq0"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select("_key", "_range", "_seq0",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    if ranges:  # long series alone: no more spans than ranges and series
        offsets = F.broadcast(stored(offsets, "offsets"))
    return (rows.join(offsets, ["_key", "_range"])
                .withColumn("_ord", F.col("_offset") + F.col("_seq") - F.col("_seq0"))
                .drop("_range", "_offset", "_seq0", "_seq"))


def _with_halo(rows: DataFrame, place: str, size: int, within: Column | None = None) -> DataFrame:
    """Each row in its own ``place`` (``_ord`` div ``size``), plus copies for its neighbours, not ``_own``.

    A place's last rows are copied to the next one, its first to the one before; with
    ``within`` only to places for which it holds.
    """
    pos = F.col("_ord") - F.col(place) * F.lit(size)
    copy = lambda at, own: F.struct(at.alias("at"), F.lit(own).alias("own"))
    copies = F.array(
        copy(F.col(place), True),
        F.when(pos >= F.lit(size - LOOKBACK_ROWS), copy(F.col(place) + 1, False)),
        F.when((pos < F.lit(LOOKAHEAD_ROWS)) & (F.col(place) > 0), copy(F.col(place) - 1, False)),
    )
    spread = (rows.withColumn("_copy", F.explode(F.filter(copies, lambda c: c.isNotNull())))
                  .withColumn("_own", F.col("_copy.own"))
                  .withColumn(place, F.col("_copy.at"))
                  .drop("_copy"))
    return spread if within is None else spread.filter(within)


def _block_carries(rows: DataFrame, sum_seed: str | None, sum_seed_exact: str | None,
                   peak_seed: str | None) -> DataFrame:
    """What came before each (``_key``, ``_block``), and what goes on beyond it on its last date."""
    date = feat.ORDER_COLS[0]
    # Per-block totals (one row per block), whole and of the block's first date alone.
    ret = F.col("daily_change_pct")
    if sum_seed is not None:  # set on a series' first row alone
        seed = F.col(sum_seed)
        ret = F.when(seed.isNull(), ret).when(ret.isNull(), seed).otherwise(seed + ret)
    ret_x = F.col("daily_change_pct").try_cast(feat.EXACT_RETURN)
    if sum_seed_exact is not None:
        seed_x = F.col(sum_seed_exact).try_cast(feat.EXACT_RETURN)
        ret_x = F.when(seed_x.isNull(), ret_x).when(ret_x.isNull(), seed_x).otherwise(seed_x + ret_x)
    top = F.greatest("close", F.col(peak_seed)) if peak_seed is not None else F.col("close")
    bad = F.coalesce(F.isnan(ret) | (F.abs(ret) == F.lit(float("inf")))
                     | (ret.isNotNull() & ret_x.isNull()), F.lit(False)).cast("int")
    by_date = rows.groupBy("_key", "_block", date).agg(
        F.sum(ret).alias("total"), F.try_sum(ret_x).alias("exact"), F.max(bad).alias("bad"),
        F.max(top).alias("peak"), F.min("_ord").alias("ord"))
    first = F.struct("ord", date, "total", "exact", "bad")
    totals = by_date.groupBy("_key", "_block").agg(
        F.sum("total").alias("total"), F.try_sum("exact").alias("exact"), F.max("bad").alias("bad"),
        F.max("peak").alias("peak"), F.min(first).alias("head"),
        F.max(F.struct("ord", date)).alias("last"))
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy("_key").orderBy("_block")
    # Blocks that begin with one date follow each other; summed from the last of them backwards.
    onward = Window.partitionBy("_key", f"head.{date}").orderBy(F.desc("_block"))
    tails = totals.withColumn("_beyond", F.struct(
        F.try_sum("head.exact").over(onward).alias("exact"), F.sum("head.total").over(onward).alias("total"),
        (F.max("head.bad").over(onward) > 0).alias("bad")))
    follows = F.lead(f"head.{date}").over(along).eqNullSafe(F.col(f"last.{date}")) \
        & F.lead("_block").over(along).isNotNull()
    return tails.select(
        "_key", "_block", F.sum("total").over(earlier).alias("_carry_sum"),
        F.when(F.max("bad").over(earlier) > 0, F.lit(None))
         .otherwise(F.try_sum("exact").over(earlier)).alias("_carry_sum_exact"),
        F.max("peak").over(earlier).alias("_carry_peak"),
        F.col(f"last.{date}").alias("_last_date"),
        F.when(follows, F.lead("_beyond").over(along)).alias("_beyond"))


#: What rows of long series bring along to their block.
_PLACED = {"_block": "bigint", "_ord": "bigint", "_halo": "boolean", "_sum_seed_b": "double",
           "_sum_exact_b": "decimal(38,18)", "_peak_b": "double",
           "_sum_extra": "struct<exact:decimal(38,18),total:double,bad:boolean>"}


def _in_blocks(rows: DataFrame, columns: Sequence[str], block_rows: int, sum_seed: str | None,
               sum_seed_exact: str | None, peak_seed: str | None) -> DataFrame:
    """Rows of long series, with ``_key`` and ``_ord``, in their blocks: ``columns`` and ``_PLACED``."""
    date = feat.ORDER_COLS[0]
    rows = rows.withColumn("_block", F.expr(f"_ord div {block_rows}"))
    # One row for so many bars, or for a long series.
    carries = F.broadcast(stored(_block_carries(feat.basic_features(rows), sum_seed, sum_seed_exact, peak_seed),
                                 "block-carries"))
    starts = F.col("_own") & (F.col("_ord") == F.col("_block") * F.lit(block_rows))
    # The first block has no carry: its first row keeps the seed that it came with.
    seeded_by = lambda carry, own: F.when(starts, F.coalesce(F.col(carry), F.col(own)) if own else F.col(carry))
    return (_with_halo(rows, "_block", block_rows).join(carries, ["_key", "_block"], "left")
            .withColumns({
                "_halo": ~F.col("_own"),
                "_sum_seed_b": seeded_by("_carry_sum", sum_seed),
                "_sum_exact_b": seeded_by("_carry_sum_exact", sum_seed_exact),
                "_peak_b": F.greatest("_carry_peak", peak_seed) if peak_seed is not None else F.col("_carry_peak"),
                "_sum_extra": F.when(F.col("_own") & F.col(date).eqNullSafe(F.col("_last_date")), F.col("_beyond"))})
            .select(*columns, *[F.col(c).cast(kind).alias(c) for c, kind in _PLACED.items()]))


def _whole(rows: DataFrame, columns: Sequence[str], sum_seed: str | None, sum_seed_exact: str | None,
           peak_seed: str | None) -> DataFrame:
    """Rows of series that are one block, as ``_in_blocks`` gives them; ``_ord`` is still to be counted."""
    own = {"_block": F.lit(0), "_halo": F.lit(False), "_sum_seed_b": sum_seed and F.col(sum_seed),
           "_sum_exact_b": sum_seed_exact and F.col(sum_seed_exact), "_peak_b": peak_seed and F.col(peak_seed)}
    value = lambda c: F.lit(None) if own.get(c) is None else own[c]
    return rows.select(*columns, *[value(c).cast(kind).alias(c) for c, kind in _PLACED.items()])


def segmented_features(df: DataFrame, keys: Sequence[str] = feat.DEFAULT_KEYS,
                       chunk_rows: int = DEFAULT_CHUNK_ROWS, sum_seed: str | None = None,
                       sum_seed_exact: str | None = None, peak_seed: str | None = None,
                       keep_exact: bool = False) -> DataFrame:
    """``ohlcv_features(df, keys)`` computed over bounded chunks of each series.

    The seeds carry what came before a series, as in ``performance_features``: they count
    into the first block's totals, and from there into every later block's carry.
    """
    if chunk_rows <= LOOKBACK_ROWS:
        raise ValueError(f"chunk_rows must exceed the look-back of {LOOKBACK_ROWS} rows")
    columns, keys, seeds = df.columns, list(keys), (sum_seed, sum_seed_exact, peak_seed)
    chunks = -(-BLOCK_ROWS // chunk_rows)  # in a block
    block_rows = chunks * chunk_rows

    bars = stored(df, "bars")
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-bars.count() // TASK_ROWS))
    # Series whose keys share a hash count together: at worst short ones are taken for long.
    hashed = bars.withColumn("_series", F.xxhash64(*keys) if keys else F.lit(0).cast("bigint"))
    long = stored(hashed.groupBy("_series").count().filter(F.col("count") > block_rows).select("_series"),
                  "long-series")
    if long.isEmpty():
        placed = _whole(bars.repartition(tasks, *keys) if keys else bars.repartition(1), columns, *seeds)
    else:  # fewer than one for so many bars
        cut = series_ordinals(hashed.join(F.broadcast(long), "_series", "left_semi").drop("_series"), keys, ranges=tasks)
        kept = hashed.join(F.broadcast(long), "_series", "left_anti")
        placed = _in_blocks(cut, columns, block_rows, *seeds).unionByName(_whole(kept, columns, *seeds)) \
            .repartition(tasks, *keys, "_block")

    block = (*keys, "_block")
    running = feat.performance_features(
        feat.basic_features(placed), block, sum_seed="_sum_seed_b", sum_seed_exact="_sum_exact_b",
        peak_seed="_peak_b", sum_mask="_halo", sum_extra="_sum_extra", keep_exact=True)
    rows = running.select(
        *columns, "_block",
        F.coalesce("_ord", F.row_number().over(feat.series_window(block)) - 1).cast("bigint").alias("_ord"),
        F.col("cumulative_return").alias("_running_return"), F.col("drawdown").alias("_running_drawdown"),
        F.col("_cumulative_exact").alias("_running_exact"))
    chunked = _with_halo(rows.withColumn("_chunk", F.expr(f"_ord div {chunk_rows}")), "_chunk", chunk_rows,
                         F.expr(f"_chunk div {chunks}") == F.col("_block"))
    out = feat.ohlcv_features(chunked, partition_cols=(*block, "_chunk")).filter(F.col("_own"))
    over_block = {"cumulative_return": "_running_return", "drawdown": "_running_drawdown"}
    names = columns + [c for c in FEATURE_COLUMNS if c not in columns]
    return out.select(*[F.col(over_block.get(c, c)).alias(c) for c in names],
                      *[F.col("_running_exact").alias("_cumulative_exact")] * keep_exact)
