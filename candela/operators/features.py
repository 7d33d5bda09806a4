"""Technical-indicator and ML feature stages over daily bars.

Each stage is ``DataFrame -> DataFrame`` and appends its columns after the
existing ones, so stages chain with ``df.transform`` and run unchanged in batch
jobs and inside streaming micro-batches.

Windows are partitioned by ``partition_cols`` (default ``("symbol",)``) and
ordered by ``date``, then by the bar values as a tie-break: on unique
(symbol, date) the tie-break never fires, and where dates do tie (bars with a
NULL symbol, duplicate deliveries) it makes every row frame deterministic --
identical rows are interchangeable, so the result is the same multiset in any
engine and on any partitioning.  Every stage uses the same partitioning and ordering, so
Catalyst plans the whole composite as one hash exchange on the symbol plus one
sort, with the window layers stacked on top (the 100-row average of a 20-row
standard deviation needs a second Window node over the same sorted input).
Pass ``partition_cols=()`` to treat the whole input as one series, which is what
a single-symbol feed needs; it funnels every row through one task, so keep it
for small inputs.

For series too long for one task, see ``candela.operators.segmented``, which
computes the same columns over fixed-size chunks with an exact halo.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.schema import FEATURE_COLUMNS
from candela.functions.columns import (
    bool_to_int,
    bucket_above,
    flag_if_abs_above,
    pct_change,
    safe_div,
    sign_vs,
)

DEFAULT_KEYS: tuple[str, ...] = ("symbol",)
ORDER_COLS: tuple[str, ...] = ("date", "open", "high", "low", "close", "volume")

# Thresholds and labels of the categorical features.
VOLUME_CATEGORIES = [(2.0, "High Volume"), (1.5, "Above Average")]
VOLUME_CATEGORY_DEFAULT = "Normal"
MOVEMENT_CATEGORIES = [(5.0, "Strong_Up"), (2.0, "Up"), (-2.0, "Neutral"), (-5.0, "Down")]
MOVEMENT_CATEGORY_DEFAULT = "Strong_Down"
ZSCORE_LIMIT = 2.0


def series_window(partition_cols: Sequence[str] = DEFAULT_KEYS,
                  order_cols: Sequence[str] = ORDER_COLS) -> WindowSpec:
    """The per-series window, ordered by date (then the tie-break), no frame."""
    return Window.partitionBy(*partition_cols).orderBy(*order_cols)


def trailing(partition_cols: Sequence[str], n: int,
             order_cols: Sequence[str] = ORDER_COLS) -> WindowSpec:
    """The last ``n`` rows up to and including the current one."""
    return series_window(partition_cols, order_cols).rowsBetween(-(n - 1), Window.currentRow)


def basic_features(df: DataFrame) -> DataFrame:
    """Row-local price transformations (no window)."""
    o, h, l, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    return df.withColumns({
        "daily_change": c - o,
        "daily_change_pct": pct_change(c, o),
        "daily_range": h - l,
        "daily_range_pct": safe_div(h - l, o) * F.lit(100),
        "typical_price": (h + l + c) / F.lit(3),
        "ohlc4": (o + h + l + c) / F.lit(4),
        # close x volume: a traded notional, not a VWAP.
        "volume_weighted_price": c * v,
    })


def technical_features(df: DataFrame, partition_cols: Sequence[str] = DEFAULT_KEYS,
                       order_cols: Sequence[str] = ORDER_COLS) -> DataFrame:
    """Moving averages, momentum, RSI components, 20-bar dispersion and extremes."""
    w = series_window(partition_cols, order_cols)
    w7, w20, w50 = (trailing(partition_cols, n, order_cols) for n in (7, 20, 50))
    close = F.col("close")
    prev_close = F.lag("close", 1).over(w)
    return df.withColumns({
        "sma_7": F.avg(close).over(w7),
        "sma_20": F.avg(close).over(w20),
        "sma_50": F.avg(close).over(w50),
        "avg_volume_20": F.avg("volume").over(w20),
        "price_momentum_1d": close - prev_close,
        "price_momentum_7d": close - F.lag("close", 7).over(w),
        # greatest() skips NULL, so the first bar of a series has gain = loss = 0.
        "gain": F.greatest(close - prev_close, F.lit(0)),
        "loss": F.greatest(prev_close - close, F.lit(0)),
        "price_stddev_20": F.stddev_samp(close).over(w20),
        "volume_ratio": safe_div(F.col("volume"), F.avg("volume").over(w20)),
        "highest_20d": F.max("high").over(w20),
        "lowest_20d": F.min("low").over(w20),
    })


def advanced_features(df: DataFrame) -> DataFrame:
    """Bollinger bands, stochastic %K, volume category and trend signs (needs technical)."""
    span = F.col("highest_20d") - F.col("lowest_20d")
    position = safe_div(F.col("close") - F.col("lowest_20d"), span)
    return df.withColumns({
        "bollinger_upper": F.col("sma_20") + F.lit(2) * F.col("price_stddev_20"),
        "bollinger_lower": F.col("sma_20") - F.lit(2) * F.col("price_stddev_20"),
        "stochastic_k": position * F.lit(100),
        "price_position": position,
        "volume_category": bucket_above("volume_ratio", VOLUME_CATEGORIES, VOLUME_CATEGORY_DEFAULT),
        "short_trend": sign_vs("close", "sma_7"),
        "medium_trend": sign_vs("sma_7", "sma_20"),
    })


# Bars in the frame of the 30-bar moments and quartiles.
MOMENT_BARS = 30


def _frame_values(value: str, n: int, partition_cols: Sequence[str],
                  order_cols: Sequence[str], prefix: str) -> dict[str, Column]:
    """The ``n``-row trailing frame of ``value`` as columns ``<prefix>_l0`` (the
    current row) .. ``<prefix>_l{n-1}`` (the oldest), all ``lag``s of the one
    series window, so they share its sort and cost O(1) per row each.  A NULL
    stands for a row before the series start or a NULL value; either way it is
    not part of the frame's values, as in ``collect_list``.
    """
    w = series_window(partition_cols, order_cols)
    return {f"{prefix}_l{k}": (F.col(value) if k == 0 else F.lag(value, k).over(w))
            for k in range(n)}


def _frame_stats(df: DataFrame, n: int, prefix: str) -> tuple[DataFrame, dict[str, Column]]:
    """Population skewness, excess kurtosis and the 0.25 / 0.75 quantiles of the
    frame held in ``<prefix>_l*`` columns (see ``_frame_values``).

    Same definitions and NULLs as Spark's ``skewness`` / ``kurtosis`` (NULL on
    an empty or constant frame) and as ``percentile_approx`` on at most 10,000
    values, where it is exact and returns the element of 1-based rank
    ceil(q * count) in sorted order.  The central moments take two passes: the
    mean, then the sums of powers of the deviations, oldest value first.  All of
    it is plain arithmetic on fixed columns plus one ``sort_array``, so it stays
    in generated code; the deviations are a projection of their own so each
    generated method stays small.  The expressions have ~100 terms each, so they
    are written as SQL text (one parse in the JVM per column instead of a remote
    call per operator).  Returns the frame with helper columns (all
    ``<prefix>_*``) and the four result columns.
    """
    vals = [f"`{prefix}_l{k}`" for k in range(n)]
    devs = [f"`{prefix}_d{k}`" for k in range(n)]
    count, mean = f"`{prefix}_n`", f"`{prefix}_mean`"

    def fold(terms: list[str]) -> str:  # left to right from 0.0, oldest value first
        return " + ".join(["0.0D", *terms[::-1]])

    out = df.withColumn(f"{prefix}_n", F.expr(
        "CAST(" + " + ".join(["0", *[f"CAST({v} IS NOT NULL AS INT)" for v in vals[::-1]]])
        + " AS DOUBLE)"))
    out = out.withColumn(f"{prefix}_mean", F.expr(
        f"try_divide({fold([f'coalesce({v}, 0.0D)' for v in vals])}, {count})"))
    out = out.withColumns({f"{prefix}_d{k}": F.expr(f"coalesce({vals[k]} - {mean}, 0.0D)")
                           for k in range(n)})
    m2 = fold([f"{d} * {d}" for d in devs])
    m3 = fold([f"{d} * {d} * {d}" for d in devs])
    m4 = fold([f"({d} * {d}) * ({d} * {d})" for d in devs])
    listed = ", ".join(vals)
    # A frame of one value has no variance; one of NaNs or infinities alone has an undefined one.
    flat = (f"{count} = 0 OR (least({listed}) = greatest({listed}) AND NOT "
            f"(isnan(least({listed})) OR abs(least({listed})) = double('infinity')))")
    skew = F.expr(f"CASE WHEN {flat} THEN NULL "
                  f"ELSE try_divide(sqrt({count}) * ({m3}), sqrt(({m2}) * ({m2}) * ({m2}))) END")
    kurt = F.expr(f"CASE WHEN {flat} THEN NULL "
                  f"ELSE try_divide({count} * ({m4}), ({m2}) * ({m2})) - 3.0D END")

    def quantile(q: float) -> Column:
        # sort_array puts the NULLs first, then the values ascending.
        rank = f"CAST(greatest(ceil({q!r}D * {count}), 1) AS INT)"
        return F.expr(f"CASE WHEN {count} > 0 THEN element_at(sort_array(array({listed})), "
                      f"{n} - CAST({count} AS INT) + {rank}) END")

    return out, {"skewness": skew, "kurtosis": kurt, "q1": quantile(0.25), "q3": quantile(0.75)}


def _frame_columns(prefix: str, n: int) -> list[str]:
    return ([f"{prefix}_l{k}" for k in range(n)] + [f"{prefix}_d{k}" for k in range(n)]
            + [f"{prefix}_n", f"{prefix}_mean"])


def statistics_features(df: DataFrame, partition_cols: Sequence[str] = DEFAULT_KEYS,
                        order_cols: Sequence[str] = ORDER_COLS) -> DataFrame:
    """30-bar moments and quartiles of close; price and volume z-scores (needs technical).

    Skewness and kurtosis are the population moments (kurtosis in excess form),
    NULL on an empty or zero-variance frame.  The quartiles are those of
    ``percentile_approx``, which on at most 30 values is exact and returns one of
    the values.  All four come from the same 30 lag columns.
    """
    w20 = trailing(partition_cols, 20, order_cols)
    close = F.col("close")
    framed = df.withColumns(_frame_values("close", MOMENT_BARS, partition_cols, order_cols, "_c30"))
    with_stats, st = _frame_stats(framed, MOMENT_BARS, "_c30")
    return (with_stats.withColumns({
        "price_skewness_30d": st["skewness"],
        "price_kurtosis_30d": st["kurtosis"],
        "price_q1_30d": st["q1"],
        "price_q3_30d": st["q3"],
        "price_zscore": safe_div(close - F.col("sma_20"), F.col("price_stddev_20")),
        "volume_zscore": safe_div(F.col("volume") - F.col("avg_volume_20"),
                                  F.stddev_samp("volume").over(w20)),
    }).drop(*_frame_columns("_c30", MOMENT_BARS)))


def ml_features(df: DataFrame, partition_cols: Sequence[str] = DEFAULT_KEYS,
                order_cols: Sequence[str] = ORDER_COLS) -> DataFrame:
    """Lags, deviations from the moving averages, categories, binary flags, next-bar label."""
    w = series_window(partition_cols, order_cols)
    close = F.col("close")
    return df.withColumns({
        "close_lag_1": F.lag("close", 1).over(w),
        "close_lag_2": F.lag("close", 2).over(w),
        "close_lag_3": F.lag("close", 3).over(w),
        "price_deviation_sma7": safe_div(close, F.col("sma_7")) - F.lit(1),
        "price_deviation_sma20": safe_div(close, F.col("sma_20")) - F.lit(1),
        "price_movement_category": bucket_above("daily_change_pct", MOVEMENT_CATEGORIES,
                                                MOVEMENT_CATEGORY_DEFAULT),
        "is_green_candle": bool_to_int(close > F.col("open")),
        "is_high_volume": bool_to_int(F.col("volume") > F.col("avg_volume_20")),
        # Label: NULL on the last bar of each series.
        "next_day_return": safe_div(F.lead("close", 1).over(w) - close, close),
    })


def anomaly_features(df: DataFrame) -> DataFrame:
    """Flags and a combined score from the price and volume z-scores (needs statistics)."""
    return df.withColumns({
        "price_anomaly_flag": flag_if_abs_above("price_zscore", ZSCORE_LIMIT, "Price_Anomaly"),
        "volume_anomaly_flag": flag_if_abs_above("volume_zscore", ZSCORE_LIMIT, "Volume_Anomaly"),
        "combined_anomaly_score": F.abs("price_zscore") + F.abs("volume_zscore"),
    })


def regime_features(df: DataFrame, partition_cols: Sequence[str] = DEFAULT_KEYS,
                    order_cols: Sequence[str] = ORDER_COLS) -> DataFrame:
    """Volatility regime (20-bar stddev against its own 100-bar mean) and trend regime."""
    w100 = trailing(partition_cols, 100, order_cols)
    sd = F.col("price_stddev_20")
    both = lambda v: (F.col("short_trend") == v) & (F.col("medium_trend") == v)
    return df.withColumns({
        "volatility_regime": F.when(sd > F.avg(sd).over(w100), F.lit("High_Volatility"))
                              .otherwise(F.lit("Low_Volatility")),
        "trend_regime": F.when(both(1), F.lit("Uptrend"))
                         .when(both(-1), F.lit("Downtrend"))
                         .otherwise(F.lit("Sideways")),
    })


# Exact summand type of the running return: 18 integer and 18 fractional digits,
# so a seed plus a return still fits DECIMAL(38, 18) without losing scale.
EXACT_RETURN = T.DecimalType(36, 18)


def _nonfinite(c: Column) -> Column:
    return F.coalesce(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(False))


def _running_return(partition_cols: Sequence[str], order_cols: Sequence[str],
                    sum_seed: str | None, sum_mask: str | None,
                    sum_seed_exact: str | None, sum_extra: str | None = None) -> tuple[Column, Column]:
    """(cumulative_return, exact running sum or NULL) -- see ``performance_features``."""
    w_by_date = Window.partitionBy(*partition_cols).orderBy(order_cols[0])
    ret = F.col("daily_change_pct")
    ret_x = ret.try_cast(EXACT_RETURN)
    summed, summed_x = ret, ret_x
    bad = _nonfinite(ret) | (ret.isNotNull() & ret_x.isNull())
    if sum_seed is not None:
        seed = F.col(sum_seed)
        seed_x = (F.col(sum_seed_exact) if sum_seed_exact else seed).try_cast(EXACT_RETURN)
        summed = F.when(seed.isNull(), ret).when(ret.isNull(), seed).otherwise(seed + ret)
        summed_x = F.when(seed_x.isNull(), ret_x).when(ret_x.isNull(), seed_x).otherwise(seed_x + ret_x)
        bad = bad | _nonfinite(seed) | (seed.isNotNull() & seed_x.isNull())
    if sum_mask is not None:
        mask = F.col(sum_mask)
        summed = F.when(mask, F.lit(None).cast("double")).otherwise(summed)
        summed_x = F.when(mask, F.lit(None).cast(EXACT_RETURN)).otherwise(summed_x)
        bad = ~mask & bad
    any_bad = F.max(bad.cast("int")).over(w_by_date) > F.lit(0)
    # A sum beyond the decimal's range is NULL; the double sum then stands in, as for other bad frames.
    exact = F.try_sum(summed_x).over(w_by_date)
    double = F.sum(summed).over(w_by_date)
    if sum_extra is not None:
        more = F.col(sum_extra)
        any_bad = any_bad | F.coalesce(more["bad"], F.lit(False))
        exact = F.when(more["exact"].isNull(), exact).when(exact.isNull() & double.isNull(), more["exact"]) \
            .otherwise(F.try_add(exact, more["exact"])).cast(T.DecimalType(38, 18))
        double = F.when(more["total"].isNull(), double).otherwise(F.coalesce(double, F.lit(0.0)) + more["total"])
    lost = any_bad | (exact.isNull() & double.isNotNull())
    return (F.when(lost, double).otherwise(exact.cast("double")),
            F.when(lost, F.lit(None)).otherwise(exact))


def _running_peak(partition_cols: Sequence[str], order_cols: Sequence[str],
                  peak_seed: str | None) -> Column:
    w_all = series_window(partition_cols, order_cols).rowsBetween(Window.unboundedPreceding,
                                                                  Window.currentRow)
    peak = F.max("close").over(w_all)
    return F.greatest(peak, F.col(peak_seed)) if peak_seed is not None else peak


def performance_features(df: DataFrame, partition_cols: Sequence[str] = DEFAULT_KEYS,
                         order_cols: Sequence[str] = ORDER_COLS,
                         sum_seed: str | None = None, peak_seed: str | None = None,
                         sum_mask: str | None = None, sum_seed_exact: str | None = None,
                         keep_exact: bool = False, sum_extra: str | None = None) -> DataFrame:
    """Running additive return, drawdown from the running peak, 30-bar return mean/stddev.

    ``cumulative_return`` orders by date alone with the default frame (RANGE up
    to the current row), so bars tied on date share one value; on unique
    (symbol, date) it is the plain running sum.  The sum is exact: returns are
    added as DECIMAL(36, 18) and the total converted to double once, so it does
    not depend on the order of the additions -- chunked plans, stream batches
    and other engines get the same value.  A frame holding a NaN, an infinity or
    a return beyond 1e18, or a sum beyond 1e20, falls back to the IEEE double sum
    (NaN propagates).

    ``sum_seed`` / ``sum_seed_exact`` / ``peak_seed`` name columns carrying what
    came before the first row of a series (stream look-back, chunked plans):
    the sum seeds, set on the first row only, are added to that row's return;
    the peak seed raises the running maximum.  Rows where ``sum_mask`` is true
    (look-back copies) add nothing to the sum; ``sum_extra`` names a struct (exact, total,
    bad) of returns on the row's own date that stand in a later chunk.  ``keep_exact`` keeps the exact
    running sum as ``_cumulative_exact`` (NULL where the double fallback applies).
    """
    w30 = trailing(partition_cols, 30, order_cols)
    ret = F.col("daily_change_pct")
    cumulative, exact = _running_return(partition_cols, order_cols, sum_seed, sum_mask, sum_seed_exact, sum_extra)
    cols = {
        "cumulative_return": cumulative,
        "drawdown": safe_div(F.col("close"), _running_peak(partition_cols, order_cols, peak_seed)) - F.lit(1),
        "avg_return_30d": F.avg(ret).over(w30),
        "return_volatility_30d": F.stddev_samp(ret).over(w30),
    }
    if keep_exact:
        cols["_cumulative_exact"] = exact
    return df.withColumns(cols)


def ohlcv_features(df: DataFrame, partition_cols: Sequence[str] = DEFAULT_KEYS,
                   order_cols: Sequence[str] = ORDER_COLS,
                   sum_seed: str | None = None, peak_seed: str | None = None,
                   sum_mask: str | None = None, sum_seed_exact: str | None = None,
                   keep_exact: bool = False, sum_extra: str | None = None) -> DataFrame:
    """All 50 feature columns appended to the bar columns (57 with the 7 bar fields).

    Same columns and values as chaining the eight stage functions, planned for
    speed: every window aggregate that reads only input columns is computed in
    one projection, so Catalyst evaluates them in a single Window operator over
    one sort (plus the date-ordered running return, which reuses that sort);
    the derived columns are plain projections; only the 100-bar mean of the
    20-bar stddev needs a second window layer.  Chaining the stages instead
    gives six stacked Window operators and runs about 4x slower.
    """
    keys, order = tuple(partition_cols), tuple(order_cols)
    w = series_window(keys, order)
    w7, w20, w30, w50, w100 = (trailing(keys, n, order) for n in (7, 20, 30, 50, 100))
    close, volume, ret = F.col("close"), F.col("volume"), F.col("daily_change_pct")
    cumulative, exact = _running_return(keys, order, sum_seed, sum_mask, sum_seed_exact, sum_extra)

    base = basic_features(df)
    layer1 = base.withColumns({
        "sma_7": F.avg(close).over(w7),
        "sma_20": F.avg(close).over(w20),
        "sma_50": F.avg(close).over(w50),
        "avg_volume_20": F.avg(volume).over(w20),
        "price_stddev_20": F.stddev_samp(close).over(w20),
        "highest_20d": F.max("high").over(w20),
        "lowest_20d": F.min("low").over(w20),
        "_f_sdvol20": F.stddev_samp(volume).over(w20),
        "_f_lag1": F.lag("close", 1).over(w),
        "_f_lag2": F.lag("close", 2).over(w),
        "_f_lag3": F.lag("close", 3).over(w),
        "_f_lag7": F.lag("close", 7).over(w),
        "_f_lead1": F.lead("close", 1).over(w),
        **_frame_values("close", MOMENT_BARS, keys, order, "_c30"),
        "avg_return_30d": F.avg(ret).over(w30),
        "return_volatility_30d": F.stddev_samp(ret).over(w30),
        "_f_peak": _running_peak(keys, order, peak_seed),
        "cumulative_return": cumulative,
        "_cumulative_exact": exact,
    })
    prev = F.col("_f_lag1")
    span = F.col("highest_20d") - F.col("lowest_20d")
    position = safe_div(close - F.col("lowest_20d"), span)
    derived = layer1.withColumns({
        "price_momentum_1d": close - prev,
        "price_momentum_7d": close - F.col("_f_lag7"),
        "gain": F.greatest(close - prev, F.lit(0)),
        "loss": F.greatest(prev - close, F.lit(0)),
        "volume_ratio": safe_div(volume, F.col("avg_volume_20")),
        "bollinger_upper": F.col("sma_20") + F.lit(2) * F.col("price_stddev_20"),
        "bollinger_lower": F.col("sma_20") - F.lit(2) * F.col("price_stddev_20"),
        "stochastic_k": position * F.lit(100),
        "price_position": position,
        "short_trend": sign_vs("close", "sma_7"),
        "medium_trend": sign_vs("sma_7", "sma_20"),
        "price_zscore": safe_div(close - F.col("sma_20"), F.col("price_stddev_20")),
        "volume_zscore": safe_div(volume - F.col("avg_volume_20"), F.col("_f_sdvol20")),
        "close_lag_1": prev,
        "close_lag_2": F.col("_f_lag2"),
        "close_lag_3": F.col("_f_lag3"),
        "price_deviation_sma7": safe_div(close, F.col("sma_7")) - F.lit(1),
        "price_deviation_sma20": safe_div(close, F.col("sma_20")) - F.lit(1),
        "price_movement_category": bucket_above("daily_change_pct", MOVEMENT_CATEGORIES,
                                                MOVEMENT_CATEGORY_DEFAULT),
        "is_green_candle": bool_to_int(close > F.col("open")),
        "is_high_volume": bool_to_int(volume > F.col("avg_volume_20")),
        "next_day_return": safe_div(F.col("_f_lead1") - close, close),
        "drawdown": safe_div(close, F.col("_f_peak")) - F.lit(1),
    })
    derived = derived.withColumn(
        "volume_category", bucket_above("volume_ratio", VOLUME_CATEGORIES, VOLUME_CATEGORY_DEFAULT))
    moments, st = _frame_stats(derived, MOMENT_BARS, "_c30")
    sd = F.col("price_stddev_20")
    both = lambda v: (F.col("short_trend") == v) & (F.col("medium_trend") == v)
    out = moments.withColumns({
        "price_skewness_30d": st["skewness"],
        "price_kurtosis_30d": st["kurtosis"],
        "price_q1_30d": st["q1"],
        "price_q3_30d": st["q3"],
        "price_anomaly_flag": flag_if_abs_above("price_zscore", ZSCORE_LIMIT, "Price_Anomaly"),
        "volume_anomaly_flag": flag_if_abs_above("volume_zscore", ZSCORE_LIMIT, "Volume_Anomaly"),
        "combined_anomaly_score": F.abs("price_zscore") + F.abs("volume_zscore"),
        # The one window over a window result: a second layer on the same sort.
        "volatility_regime": F.when(sd > F.avg(sd).over(w100), F.lit("High_Volatility"))
                              .otherwise(F.lit("Low_Volatility")),
        "trend_regime": F.when(both(1), F.lit("Uptrend"))
                         .when(both(-1), F.lit("Downtrend"))
                         .otherwise(F.lit("Sideways")),
    })
    columns = df.columns + [c for c in FEATURE_COLUMNS if c not in df.columns]
    if keep_exact:
        columns.append("_cumulative_exact")
    return out.select(*columns)


def job_columns(df: DataFrame, volume_threshold: float = 1_000_000.0,
                with_timestamps: bool = True) -> DataFrame:
    """Columns the streaming job adds after the features.

    ``processed_timestamp`` / ``processing_date`` are wall-clock values; pass
    ``with_timestamps=False`` for reproducible output.
    """
    cols: dict[str, Column] = {}
    if with_timestamps:
        cols["processed_timestamp"] = F.current_timestamp()
        cols["processing_date"] = F.current_date()
    cols["price_range"] = F.col("high") - F.col("low")
    cols["is_volume_high"] = F.when(F.col("volume") > F.lit(volume_threshold), F.lit(True)) \
                              .otherwise(F.lit(False))
    return df.withColumns(cols)


STAGES = {
    "basic": basic_features,
    "technical": technical_features,
    "advanced": advanced_features,
    "statistics": statistics_features,
    "ml": ml_features,
    "anomaly": anomaly_features,
    "regime": regime_features,
    "performance": performance_features,
}
