"""Named queries over the driver's tables, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the given parquet tables (or data Spark derives from them)
whole; outputs go through ``round_doubles`` so they can be compared with the
DuckDB oracle in ``candela.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.operators import features as feat
from candela.operators.quality import clean_rows, failed_rows, quality_counts, quality_flags
from candela.operators.rollup import monthly_rollup, weekly_rollup
from candela.operators.segmented import segmented_features
from candela.plans import oracle as O
from candela.plans.report import round_doubles
from candela.schema import BAR_COLUMNS, FEATURE_COLUMNS, QUALITY_COLUMNS
from candela.operators.market import (
    NYSE_SESSION,
    extraction_plan,
    holidays_frame,
    is_market_open,
    sessions_frame,
)
from candela.operators.sessions import half_days_frame, open_intervals, open_markets, span_of_days
from candela.operators.payload import bars_to_payloads, validate_payloads
from candela.session import scratch_path
from candela.sinks.writers import publish_bars, write_landing_csv, write_landing_files, write_table
from candela.streaming.incremental import replay_in_periods, replay_landing, replay_topic, year_of
from candela.streaming.metrics import BatchMetrics
from candela.streaming.pipeline import read_output
from candela.streaming.rollups import read_monthly, read_weekly
from candela.sources.bars import (
    bars_by_event_hour,
    bars_by_flag,
    bars_by_supplier,
    dirty_arrivals,
    dirty_bars,
)
from candela.sources.files import (
    CRYPTO_SERIES_KEY,
    STOCK_SERIES_KEY,
    flatten_payload,
    pair_symbol,
    read_bar_messages,
    read_landing_csv,
)

Query = Callable[[SparkSession, str], DataFrame]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_by_supplier(read_table(spark, sf_dir, "lineitem"))


def flag_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_by_flag(read_table(spark, sf_dir, "lineitem"))


# Feature-stage queries: (columns, bars fixture).  Each chains the stage functions up to
# the one that adds its columns; Catalyst prunes the expressions the subset does not use.
STAGE_QUERIES: dict[str, list[str]] = {
    "basic_price": ["daily_change", "daily_change_pct", "daily_range", "daily_range_pct",
                    "typical_price", "ohlc4", "volume_weighted_price"],
    "sma": ["sma_7", "sma_20", "sma_50"],
    "avg_volume": ["avg_volume_20"],
    "momentum": ["price_momentum_1d", "price_momentum_7d"],
    "gain_loss": ["gain", "loss"],
    "price_stddev": ["price_stddev_20"],
    "volume_ratio": ["volume_ratio"],
    "high_low_20d": ["highest_20d", "lowest_20d"],
    "bollinger": ["bollinger_upper", "bollinger_lower"],
    "stochastic": ["stochastic_k", "price_position"],
    "volume_category": ["volume_category"],
    "trends": ["short_trend", "medium_trend"],
    "skew_kurt_30d": ["price_skewness_30d", "price_kurtosis_30d"],
    "quartiles_30d": ["price_q1_30d", "price_q3_30d"],
    "zscores": ["price_zscore", "volume_zscore"],
    "close_lags": ["close_lag_1", "close_lag_2", "close_lag_3"],
    "sma_deviation": ["price_deviation_sma7", "price_deviation_sma20"],
    "movement_category": ["price_movement_category"],
    "binary_flags": ["is_green_candle", "is_high_volume"],
    "next_day_return": ["next_day_return"],
    "anomaly_flags": ["price_anomaly_flag", "volume_anomaly_flag", "combined_anomaly_score"],
    "volatility_regime": ["volatility_regime"],
    "trend_regime": ["trend_regime"],
    "cumulative_return": ["cumulative_return"],
    "drawdown": ["drawdown"],
    "return_stats_30d": ["avg_return_30d", "return_volatility_30d"],
}


def _stage_query(columns: list[str]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = flag_bars(spark, sf_dir)
        for stage in feat.STAGES.values():
            if not set(columns) <= set(out.columns):
                out = stage(out)
        return round_doubles(out.select("symbol", "date", *columns))
    return run


def q_bars_by_supplier(spark, sf_dir):
    return round_doubles(supplier_bars(spark, sf_dir))


def q_bars_by_flag(spark, sf_dir):
    return round_doubles(flag_bars(spark, sf_dir))


def q_ohlcv_features(spark, sf_dir):
    """Flagship: all 57 columns over the supplier-day bars (many symbols)."""
    return round_doubles(feat.ohlcv_features(supplier_bars(spark, sf_dir)))


def q_ohlcv_features_flag(spark, sf_dir):
    """All 57 columns over the flag bars (few, long series with real ranges)."""
    return round_doubles(feat.ohlcv_features(flag_bars(spark, sf_dir)))


def q_ohlcv_features_segmented(spark, sf_dir):
    """The flagship columns through the chunked long-series plan (128-bar chunks,
    so every supplier series spans several chunks); equal to ``ohlcv_features``."""
    return round_doubles(segmented_features(supplier_bars(spark, sf_dir), chunk_rows=128))


def event_hour_bars(spark, sf_dir):
    return bars_by_event_hour(read_table(spark, sf_dir, "events"))


def q_bars_by_event_hour(spark, sf_dir):
    """Fixture B3: hourly bars per event type (intraday date keys)."""
    return round_doubles(event_hour_bars(spark, sf_dir))


def q_ohlcv_features_event_hour(spark, sf_dir):
    """All 57 columns over the hourly event bars."""
    return round_doubles(feat.ohlcv_features(event_hour_bars(spark, sf_dir)))


def q_job_columns(spark, sf_dir):
    out = feat.job_columns(feat.ohlcv_features(flag_bars(spark, sf_dir)), with_timestamps=False)
    return round_doubles(out.select("symbol", "date", "price_range", "is_volume_high"))


def q_weekly_rollup(spark, sf_dir):
    return round_doubles(weekly_rollup(supplier_bars(spark, sf_dir)))


def q_monthly_rollup(spark, sf_dir):
    return round_doubles(monthly_rollup(supplier_bars(spark, sf_dir)))


def dirty_flag_bars(spark, sf_dir):
    return dirty_bars(flag_bars(spark, sf_dir))


def pipeline(bars: DataFrame) -> DataFrame:
    """The batch form of the streaming job: features -> job columns -> quality flags."""
    return quality_flags(feat.job_columns(feat.ohlcv_features(bars), with_timestamps=False))


def q_quality_flags(spark, sf_dir):
    return round_doubles(quality_flags(dirty_flag_bars(spark, sf_dir))
                         .select(*BAR_COLUMNS, *QUALITY_COLUMNS))


def q_clean_bars(spark, sf_dir):
    return round_doubles(clean_rows(pipeline(dirty_flag_bars(spark, sf_dir))))


def q_failed_bars(spark, sf_dir):
    return round_doubles(failed_rows(pipeline(dirty_flag_bars(spark, sf_dir))))


def quarantined(spark, sf_dir) -> DataFrame:
    """The batch job with quality checks before the windows (failed bars set aside)."""
    from candela.streaming.pipeline import PipelineConfig, transform_batch
    cfg = PipelineConfig(output_path="", checkpoint_path="", dedupe=False,
                         with_timestamps=False, quarantine="before")
    flagged, _ = transform_batch(dirty_flag_bars(spark, sf_dir), cfg)
    return flagged.select(*O.PIPELINE_COLUMNS)


def q_clean_bars_quarantined(spark, sf_dir):
    return round_doubles(clean_rows(quarantined(spark, sf_dir)))


def q_failed_bars_quarantined(spark, sf_dir):
    return round_doubles(failed_rows(quarantined(spark, sf_dir)))


def q_quality_counts(spark, sf_dir):
    return quality_counts(quality_flags(dirty_flag_bars(spark, sf_dir)))


def q_json_roundtrip(spark, sf_dir):
    """Bars -> JSON messages in text files -> parsed bars (equal to the bars)."""
    path = scratch_path(spark, "messages")
    publish_bars(supplier_bars(spark, sf_dir), fmt="text", path=path)
    return round_doubles(read_bar_messages(spark, path))


def q_payload_flatten(spark, sf_dir):
    """Bars -> provider payloads (one per symbol-month) -> flattened bars (equal to the bars)."""
    payloads = bars_to_payloads(supplier_bars(spark, sf_dir), STOCK_SERIES_KEY)
    return round_doubles(flatten_payload(payloads, "body", STOCK_SERIES_KEY))


def q_csv_landing(spark, sf_dir):
    """Bars -> landing CSV per symbol -> positional CSV scan (equal to the bars)."""
    path = scratch_path(spark, "landing")
    write_landing_csv(supplier_bars(spark, sf_dir), path)
    return round_doubles(read_landing_csv(spark, path, symbol_from="partition"))


# NYSE holidays inside the events range.
NYSE_HOLIDAYS = [("NYSE", "2024-01-01"), ("NYSE", "2024-01-15")]


def market_flags(spark, sf_dir):
    holidays = holidays_frame(spark, [(m, dt.date.fromisoformat(d)) for m, d in NYSE_HOLIDAYS])
    events = read_table(spark, sf_dir, "events")
    return is_market_open(events, "ts", sessions_frame(spark), holidays)


def q_market_open_events(spark, sf_dir):
    return market_flags(spark, sf_dir).select("event_id", "ts", "market", "local_time", "is_open")


def q_gated_events(spark, sf_dir):
    return extraction_plan(market_flags(spark, sf_dir)).select("event_id", "asset_class", "task")


def payload_responses(spark, sf_dir) -> DataFrame:
    """Responses to validate: stock payloads built from the bars, and ticker
    responses built from ``events`` (error events answered 500, signup events
    answered with a body lacking the price)."""
    stock = bars_to_payloads(supplier_bars(spark, sf_dir)).select(
        F.lit("alpha_vantage").alias("source"),
        F.concat_ws("/", "symbol", "period").alias("request_id"),
        F.lit(200).alias("status"),
        "body")
    ev = read_table(spark, sf_dir, "events")
    ticker = ev.select(
        F.lit("binance").alias("source"),
        F.col("event_id").cast("string").alias("request_id"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.when(F.col("event_type") == "signup", F.col("props"))
         .otherwise(F.to_json(F.struct(F.upper("event_type").alias("symbol"),
                                       F.col("value").cast("string").alias("price")))).alias("body"))
    return stock.unionByName(ticker)


def q_payload_validation(spark, sf_dir):
    return validate_payloads(payload_responses(spark, sf_dir)).select(
        "source", "request_id", "status", "is_valid", "error")


def q_delta_or_parquet_sink(spark, sf_dir):
    """Bars appended to a symbol-partitioned table (Delta, else the Parquet
    fallback next to it), read back (equal to the bars)."""
    path = scratch_path(spark, "table")
    bars = supplier_bars(spark, sf_dir)
    written = write_table(bars, path, fmt="delta")
    return round_doubles(read_output(spark, written, schema=bars.schema).select(*BAR_COLUMNS))


def q_stream_microbatch(spark, sf_dir):
    """The streaming job over the flag bars arriving one year per micro-batch,
    windows restarting in every batch; clean + failed tables read back."""
    out = replay_in_periods(spark, flag_bars(spark, sf_dir), year_of("date"), history=False)
    return round_doubles(out.select(*O.PIPELINE_COLUMNS))


def q_stream_with_history(spark, sf_dir):
    """As ``stream_microbatch`` with the 118-bar look-back state: every column
    equals the full-history batch result, except ``next_day_return`` on the
    last bar of each batch (its next bar has not arrived yet)."""
    out = replay_in_periods(spark, flag_bars(spark, sf_dir), year_of("date"), history=True)
    return round_doubles(out.select(*O.PIPELINE_COLUMNS))


def segmented_pipeline(spark, sf_dir) -> DataFrame:
    """The batch job over the dirty bars with every series in chunks, NULL symbols too."""
    bars = segmented_features(dirty_flag_bars(spark, sf_dir), chunk_rows=128)
    return quality_flags(feat.job_columns(bars, with_timestamps=False))


def q_clean_bars_segmented(spark, sf_dir):
    return round_doubles(clean_rows(segmented_pipeline(spark, sf_dir)))


def q_failed_bars_segmented(spark, sf_dir):
    return round_doubles(failed_rows(segmented_pipeline(spark, sf_dir)))


def q_rollup_timestamps(spark, sf_dir):
    """Weekly rollup of hourly bars whose dates come in several forms of a timestamp."""
    t = F.try_to_timestamp("date", F.lit("yyyy-MM-dd HH:mm"))
    form = F.pmod(F.xxhash64("date"), F.lit(4))
    date = (F.when(form == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
            .when(form == 1, F.date_format(t, "yyyy-MM-dd'T'HH:mm"))
            .when(form == 2, F.date_format(t, "yyyy-M-d H:mm")).otherwise(F.col("date")))
    return round_doubles(weekly_rollup(event_hour_bars(spark, sf_dir).withColumn("date", date)))


def q_market_open_instants(spark, sf_dir):
    """Market flags of instants, in a session whose zone is not UTC."""
    local = spark.newSession()
    local.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    holidays = holidays_frame(local, [(m, dt.date.fromisoformat(d)) for m, d in NYSE_HOLIDAYS])
    events = read_table(local, sf_dir, "events").withColumn("ts", F.convert_timezone(
        F.lit("UTC"), F.current_timezone(), F.col("ts").cast("timestamp_ntz")).cast("timestamp"))
    return is_market_open(events, "ts", sessions_frame(local), holidays).select(
        "event_id", "market", "local_time", "is_open")


def q_payload_flatten_crypto(spark, sf_dir):
    """Bars of currency pairs -> provider payloads -> flattened bars under the pair's file stem."""
    payloads = bars_to_payloads(supplier_bars(spark, sf_dir), CRYPTO_SERIES_KEY)
    named = payloads.withColumn("symbol", pair_symbol(F.concat("symbol", F.lit("/USD"))))
    return round_doubles(flatten_payload(named, "body", CRYPTO_SERIES_KEY))


def q_csv_landing_stem(spark, sf_dir):
    """Bars -> one landing CSV per symbol, named by it -> positional CSV scan (equal to the bars)."""
    path = scratch_path(spark, "landing-files")
    write_landing_files(flag_bars(spark, sf_dir), path)
    return round_doubles(read_landing_csv(spark, path, symbol_from="stem"))


def q_stream_labelled(spark, sf_dir):
    """As ``stream_with_history``, with the labels that later batches completed: every column
    equals the full-history batch result."""
    out = replay_in_periods(spark, flag_bars(spark, sf_dir), year_of("date"), history=True, labelled=True)
    return round_doubles(out.select(*O.PIPELINE_COLUMNS))


def q_stream_dirty_with_history(spark, sf_dir):
    """The streaming job with look-back over damaged bars: lost symbols and dates, bars that
    come late, again, or again and changed."""
    arrivals = dirty_arrivals(flag_bars(spark, sf_dir))
    out = replay_in_periods(spark, arrivals, F.col("arrival"), history=True)
    return round_doubles(out.select(*O.PIPELINE_COLUMNS))


def q_stream_resends(spark, sf_dir):
    """The streaming job where every batch sends all bars so far again: the result of
    ``stream_with_history``."""
    bars = flag_bars(spark, sf_dir)
    years = bars.select(year_of("date").alias("arrival")).distinct()
    sent = bars.join(years, F.col("arrival") >= year_of("date"))
    out = replay_in_periods(spark, sent, F.col("arrival"), history=True)
    return round_doubles(out.select(*O.PIPELINE_COLUMNS))


def q_stream_weekly_rollup(spark, sf_dir):
    """Weekly rollup kept by the streaming job over bars that come late, again, or changed."""
    return round_doubles(replay_in_periods(
        spark, dirty_arrivals(flag_bars(spark, sf_dir)), F.col("arrival"), history=True, rollups=True,
        read=lambda s, cfg: read_weekly(s, cfg.rollups_path)))


def q_stream_monthly_rollup(spark, sf_dir):
    """Monthly rollup kept by the streaming job over the same bars."""
    return round_doubles(replay_in_periods(
        spark, dirty_arrivals(flag_bars(spark, sf_dir)), F.col("arrival"), history=True, rollups=True,
        read=lambda s, cfg: read_monthly(s, cfg.rollups_path)))


def q_stream_csv_landing(spark, sf_dir):
    """The landing folder streamed after its files were overwritten with ever longer histories:
    the result of ``stream_with_history``."""
    bars = flag_bars(spark, sf_dir)
    years = sorted(r[0] for r in bars.select(year_of("date")).distinct().collect())
    out = replay_landing(spark, bars, years, year_of("date"), history=True)
    return round_doubles(out.select(*O.PIPELINE_COLUMNS))


def q_stream_offsets_resume(spark, sf_dir):
    """The streaming job from a topic, started again after every append: the result of
    ``stream_with_history``."""
    bars = flag_bars(spark, sf_dir)
    years = sorted(r[0] for r in bars.select(year_of("date")).distinct().collect())
    out = replay_topic(spark, bars, years, year_of("date"), history=True)
    return round_doubles(out.select(*O.PIPELINE_COLUMNS))


def q_stream_with_history_segmented(spark, sf_dir):
    """``stream_with_history`` with every series of a batch, its look-back in front, cut into chunks."""
    out = replay_in_periods(spark, flag_bars(spark, sf_dir), year_of("date"), history=True, chunk_rows=128)
    return round_doubles(out.select(*O.PIPELINE_COLUMNS))


def q_stream_batch_metrics(spark, sf_dir):
    """Quality counts per batch of the dirty bars, as the stream's listener took them."""
    metrics = BatchMetrics()
    replay_in_periods(spark, dirty_flag_bars(spark, sf_dir), year_of("date"), history=False, metrics=metrics)
    return metrics.frame(spark).select("batch_id", "total_records", "clean_records", "failed_records")


# Fixture: a half day and a second market whose local days are not the UTC days.
HALF_DAYS = [("NYSE", "2024-01-03", "13:00")]
MARKETS = [NYSE_SESSION, ("TSE", "Asia/Tokyo", "09:00", "15:00", "TSE"), ("CME", "America/Chicago", "17:00", "16:00", "CME")]


def q_market_open_calendar(spark, sf_dir):
    """Open markets of every event: three zones, holidays, a half day, sessions over midnight."""
    events = read_table(spark, sf_dir, "events")
    holidays = holidays_frame(spark, [(m, dt.date.fromisoformat(d)) for m, d in NYSE_HOLIDAYS])
    half = half_days_frame(spark, [(m, dt.date.fromisoformat(d), t) for m, d, t in HALF_DAYS])
    first, last = span_of_days(events, "ts")
    intervals = open_intervals(sessions_frame(spark, MARKETS), first, last, holidays, half)
    return open_markets(events, "ts", intervals).select("event_id", "ts", F.array_join("open_markets", ",").alias("open_markets"))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "bars_by_supplier": q_bars_by_supplier,
        "bars_by_flag": q_bars_by_flag,
    }
    out.update({name: _stage_query(cols) for name, cols in STAGE_QUERIES.items()})
    out.update({
        "job_columns": q_job_columns,
        "ohlcv_features": q_ohlcv_features,
        "ohlcv_features_flag": q_ohlcv_features_flag,
        "ohlcv_features_segmented": q_ohlcv_features_segmented,
        "bars_by_event_hour": q_bars_by_event_hour,
        "ohlcv_features_event_hour": q_ohlcv_features_event_hour,
        "weekly_rollup": q_weekly_rollup,
        "monthly_rollup": q_monthly_rollup,
        "quality_flags": q_quality_flags,
        "clean_bars": q_clean_bars,
        "failed_bars": q_failed_bars,
        "quality_counts": q_quality_counts,
        "clean_bars_quarantined": q_clean_bars_quarantined,
        "failed_bars_quarantined": q_failed_bars_quarantined,
        "json_roundtrip": q_json_roundtrip,
        "payload_flatten": q_payload_flatten,
        "csv_landing": q_csv_landing,
        "market_open_calendar": q_market_open_calendar,
        "market_open_events": q_market_open_events,
        "gated_events": q_gated_events,
        "payload_validation": q_payload_validation,
        "delta_or_parquet_sink": q_delta_or_parquet_sink,
        "clean_bars_segmented": q_clean_bars_segmented,
        "failed_bars_segmented": q_failed_bars_segmented,
        "rollup_timestamps": q_rollup_timestamps,
        "market_open_instants": q_market_open_instants,
        "payload_flatten_crypto": q_payload_flatten_crypto,
        "csv_landing_stem": q_csv_landing_stem,
        "stream_batch_metrics": q_stream_batch_metrics,
        "stream_csv_landing": q_stream_csv_landing,
        "stream_dirty_with_history": q_stream_dirty_with_history,
        "stream_labelled": q_stream_labelled,
        "stream_microbatch": q_stream_microbatch,
        "stream_monthly_rollup": q_stream_monthly_rollup,
        "stream_offsets_resume": q_stream_offsets_resume,
        "stream_resends": q_stream_resends,
        "stream_weekly_rollup": q_stream_weekly_rollup,
        "stream_with_history": q_stream_with_history,
        "stream_with_history_segmented": q_stream_with_history_segmented,
    })
    return out


def oracle_sql() -> dict[str, str]:
    out = {
        "bars_by_supplier": O.bars_query(O.SUPPLIER_SYMBOL),
        "bars_by_flag": O.bars_query(O.FLAG_SYMBOL),
    }
    for name, cols in STAGE_QUERIES.items():
        out[name] = O.features_query(["symbol", "date", *cols], O.FLAG_SYMBOL)
    out.update({
        "job_columns": O.job_columns_query(),
        "ohlcv_features": O.features_query(BAR_COLUMNS + FEATURE_COLUMNS, O.SUPPLIER_SYMBOL),
        "ohlcv_features_flag": O.features_query(BAR_COLUMNS + FEATURE_COLUMNS, O.FLAG_SYMBOL),
        "ohlcv_features_segmented": O.features_query(BAR_COLUMNS + FEATURE_COLUMNS, O.SUPPLIER_SYMBOL),
        "bars_by_event_hour": O.event_hour_bars_query(),
        "ohlcv_features_event_hour": O.event_hour_features_query(),
        "weekly_rollup": O.weekly_query(O.SUPPLIER_SYMBOL),
        "monthly_rollup": O.monthly_query(O.SUPPLIER_SYMBOL),
        "quality_flags": O.quality_flags_query(),
        "clean_bars": O.pipeline_query("data_quality_status = 'Passed'"),
        "failed_bars": O.pipeline_query("data_quality_status = 'Failed'"),
        "quality_counts": O.quality_counts_query(),
        "clean_bars_quarantined": O.quarantined_pipeline_query("data_quality_status = 'Passed'"),
        "failed_bars_quarantined": O.quarantined_pipeline_query("data_quality_status = 'Failed'"),
        "json_roundtrip": O.bars_query(O.SUPPLIER_SYMBOL),
        "payload_flatten": O.bars_query(O.SUPPLIER_SYMBOL),
        "csv_landing": O.bars_query(O.SUPPLIER_SYMBOL),
        "market_open_calendar": O.market_calendar_query([d for _, d in NYSE_HOLIDAYS], HALF_DAYS),
        "market_open_events": O.market_open_query([d for _, d in NYSE_HOLIDAYS]),
        "gated_events": O.gated_events_query([d for _, d in NYSE_HOLIDAYS]),
        "payload_validation": O.payload_validation_query(),
        "delta_or_parquet_sink": O.bars_query(O.SUPPLIER_SYMBOL),
        "clean_bars_segmented": O.pipeline_query("data_quality_status = 'Passed'"),
        "failed_bars_segmented": O.pipeline_query("data_quality_status = 'Failed'"),
        "rollup_timestamps": O.event_week_query(),
        "market_open_instants": O.market_open_instants_query([d for _, d in NYSE_HOLIDAYS]),
        "payload_flatten_crypto": O.renamed_bars_query("_USD"),
        "csv_landing_stem": O.bars_query(O.FLAG_SYMBOL),
        "stream_batch_metrics": O.batch_metrics_query(),
        "stream_csv_landing": O.stream_query(history=True),
        "stream_dirty_with_history": O.stream_dirty_query(),
        "stream_labelled": O.pipeline_query(None, dirty=False),
        "stream_microbatch": O.stream_query(history=False),
        "stream_monthly_rollup": O.stream_rollup_query("month"),
        "stream_offsets_resume": O.stream_query(history=True),
        "stream_resends": O.stream_query(history=True),
        "stream_weekly_rollup": O.stream_rollup_query("week"),
        "stream_with_history": O.stream_query(history=True),
        "stream_with_history_segmented": O.stream_query(history=True),
    })
    return out
