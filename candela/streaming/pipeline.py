"""The streaming bar job: messages -> features -> quality split -> tables.

``run_pipeline`` reads bar messages with Structured Streaming and hands every
micro-batch to ``process_batch`` through ``foreachBatch`` (row-frame windows
are not allowed on a streaming DataFrame, so the batch API runs them).  Per
non-empty batch:

1. optional dedupe of (symbol, date) re-deliveries inside the batch;
2. with ``history``: bars already stored, as exact copies, are dropped and counted
   (``candela.streaming.redelivery``);
3. features -- restarted per batch, or continued from the per-symbol look-back
   state when ``history`` is on (``candela.streaming.history``);
4. job columns and quality flags (late bars flagged ``late_bar``, bars without a
   date ``missing_date`` where windows run across batches);
5. the feature frame is computed once and persisted; clean and failed rows go to
   two tables partitioned by run and batch, and the new look-back state is derived
   from the same frame; the counts come from one ``observe`` on the first write
   instead of extra jobs;
6. one record makes all of it visible (``candela.streaming.commits``).  Readers see
   recorded batches only, and a recorded batch is not written again.

What differs from batch to batch stays out of the generated code: run and batch stand in
folder names, and the wall clock is a column that joins the bars before the windows.  The
large plan is thus compiled by the first batch alone.

A run is named once, in a file beside its checkpoint, with the sink format that was
available then.  Outputs are keyed by run and batch: a fresh checkpoint on an old
output folder adds to it and replaces nothing.

A failing batch raises: the query stops without committing the batch, and a
restart from the checkpoint replays it, overwriting whatever the failed
attempt wrote and nobody has seen.
"""

from __future__ import annotations

import logging
import math
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.operators import features as feat
from candela.operators.dedupe import latest_bar
from candela.operators.quality import LATE_BAR, MISSING_DATE, count_observation, quality_flag, quality_flags
from candela.operators.segmented import segmented_features
from candela.schema import BAR_COLUMNS, BAR_SCHEMA, LOOKBACK_ROWS
from candela.session import listing_by_cores
from candela.sinks import folders
from candela.sinks.writers import resolve_sink, write_batch
from candela.sources.files import bar_stream, parse_bars
from candela.sources.landing import landing_stream, stage_landing
from candela.sources.topic import topic_stream
from candela.streaming.commits import Commit, committed, newest, record
from candela.streaming.history import (
    batch_rows,
    completed_labels,
    drop_older,
    features_with_history,
    late_rows,
    merged_state,
    next_state,
    read_state,
    write_state,
)
from candela.streaming.metrics import BatchMetrics, observe_arrivals
from candela.streaming.redelivery import digests, hashed, late_months, merged_digests, without_copies, write_known
from candela.streaming.rollups import update_rollups

log = logging.getLogger(__name__)

SHUFFLE_CONF = "spark.sql.shuffle.partitions"
#: Rows, the look-back's among them, that a task of a batch's windows is meant to hold, and
#: by how much the session's number of tasks is exceeded for that at most.
TASK_ROWS, MOST_TASKS = 10_000, 16


@dataclass
class PipelineConfig:
    output_path: str
    checkpoint_path: str
    source_format: str = "kafka"
    source_path: str | None = None
    source_options: dict[str, str] = field(default_factory=dict)
    # ``landing`` source: files a batch reads at most.
    max_files: int | None = None
    sink_format: str = "parquet"
    trigger_seconds: int = 30
    available_now: bool = False
    timeout_minutes: float = 10.0
    history: bool = False
    dedupe: bool = True
    volume_threshold: float = 1_000_000.0
    with_timestamps: bool = True
    # "after": quality flags after the windows (failed bars stay in their
    # neighbours' frames, as the original job does); "before": failed bars are
    # set aside into their own partition, so clean bars only see clean bars.
    quarantine: str = "after"
    # Series longer than this are cut into chunks of so many bars (the results are the
    # same); None keeps one task per symbol and batch.
    chunk_rows: int | None = None
    # Keep weekly and monthly rollups of the stored bars up to date.
    rollups: bool = False
    # Keep the message text of failed rows as ``_raw``.
    keep_raw: bool = False
    # Set by ``run_pipeline`` from the record beside the checkpoint.
    run_id: str = "run"
    clean_folder: str = "clean_data"
    failed_folder: str = "failed_data"

    @property
    def clean_path(self) -> str:
        return f"{self.output_path.rstrip('/')}/{self.clean_folder}"

    @property
    def failed_path(self) -> str:
        return f"{self.output_path.rstrip('/')}/{self.failed_folder}"

    @property
    def labels_path(self) -> str:
        return f"{self.output_path.rstrip('/')}/completed_labels"

    @property
    def staged_path(self) -> str:
        return f"{self.checkpoint_path.rstrip('/')}/candela-landing"

    @property
    def rollups_path(self) -> str:
        return f"{self.output_path.rstrip('/')}/rollups"

    @property
    def known_path(self) -> str:
        return f"{self.output_path.rstrip('/')}/_known_bars"


def prepare_bars(bars: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Bar columns (deduped) plus ``_aside``: rows kept out of the main series' windows.

    An empty symbol counts as missing: a folder or a key cannot hold it.
    """
    bars = bars.select(*BAR_COLUMNS).withColumn(
        "symbol", F.when(F.col("symbol") != "", F.col("symbol")))
    bars = latest_bar(bars) if cfg.dedupe else bars
    if cfg.quarantine not in ("after", "before"):
        raise ValueError(f"quarantine must be 'after' or 'before', got {cfg.quarantine!r}")
    aside = quality_flag().isNotNull() if cfg.quarantine == "before" else F.lit(False)
    return bars.withColumn("_aside", aside)


def plain_features(bars: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Features of prepared bars without history; set-aside rows form their own series."""
    keys = ("symbol", "_aside")
    feats = segmented_features(bars, keys, chunk_rows) if chunk_rows \
        else feat.ohlcv_features(bars, partition_cols=keys)
    return feats.withColumnRenamed("_aside", "_late")


def flag_rows(feats: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Feature rows with ``_late`` -> job columns and quality flags (late bars fail).

    Where windows run across batches, a bar without a date fails too: it has no place
    in its series, and no later batch could put it there.
    """
    out = quality_flags(feat.job_columns(feats, cfg.volume_threshold, cfg.with_timestamps))
    # Both columns from the same input row (one withColumns), flag first-rule-wins.
    dateless = F.lit(cfg.history) & F.col("date").isNull() & F.col("data_quality_flag").isNull()
    late = F.col("_late") & F.col("data_quality_flag").isNull()
    return (out.withColumns({
                "data_quality_flag": F.when(dateless, F.lit(MISSING_DATE)).when(late, F.lit(LATE_BAR))
                                      .otherwise(F.col("data_quality_flag")),
                "data_quality_status": F.when(late | dateless, F.lit("Failed"))
                                        .otherwise(F.col("data_quality_status")),
            })
               .drop("_late"))


def transform_batch(bars: DataFrame, cfg: PipelineConfig,
                    state: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Bars of one batch -> flagged feature rows (and the new look-back state)."""
    bars = prepare_bars(bars, cfg)
    if state is None:
        return flag_rows(plain_features(bars, cfg.chunk_rows), cfg), None
    full = features_with_history(bars, state, cfg.chunk_rows)
    return flag_rows(batch_rows(full), cfg), merged_state(next_state(full), state)


def shuffle_tasks(rows: int, cores: int, configured: int) -> int:
    """Tasks of a batch's shuffles: by its rows, not fewer than the cores."""
    return min(max(min(cores, configured), math.ceil(rows / TASK_ROWS)), MOST_TASKS * configured)


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffles fit for so many rows.  What a batch persists keeps the partitions that it was
    planned with, however empty they are, and every job of the batch reads them."""
    configured = spark.conf.get(SHUFFLE_CONF)
    spark.conf.set(SHUFFLE_CONF, str(shuffle_tasks(rows, spark.sparkContext.defaultParallelism, int(configured))))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CONF, configured)


def process_batch(batch_df: DataFrame, batch_id: int, cfg: PipelineConfig) -> dict[str, int]:
    """The ``foreachBatch`` body; returns the batch counts.

    The feature frame is computed once and persisted; the clean write, the failed write and
    the new look-back state are all read from it.  A batch that is recorded already is left
    alone: its last replay came after its record.
    """
    spark, output = batch_df.sparkSession, cfg.output_path.rstrip("/")
    last = newest(spark, output)
    if last.holds(cfg.run_id, batch_id):
        log.info("batch %s is recorded, skipped", batch_id)
        return last.batches[cfg.run_id]
    rows = batch_df.count()
    if not rows:
        log.info("batch %s empty, skipped", batch_id)
        return {"total_records": 0, "clean_records": 0, "failed_records": 0}
    state, stored = read_state(spark, output, last) if cfg.history else (None, None)
    if last.state is not None and cfg.history:
        rows += min(state.count(), rows) * LOOKBACK_ROWS  # of the symbols that it touches
    with sized_shuffles(spark, rows):
        return _process(batch_df, batch_id, cfg, last, state, stored)


def _process(batch_df: DataFrame, batch_id: int, cfg: PipelineConfig, last: Commit,
             state: DataFrame | None, stored: DataFrame | None) -> dict[str, int]:
    spark, output = batch_df.sparkSession, cfg.output_path.rstrip("/")
    bars, copies = prepare_bars(batch_df, cfg), 0
    if cfg.history:
        if last.state is not None:
            late = late_rows(bars, state).persist(StorageLevel.MEMORY_AND_DISK)
            if not late.isEmpty():
                compared = late_months(late, stored).persist(StorageLevel.MEMORY_AND_DISK)
                fresh = without_copies(bars, late, compared, cfg.known_path, last.visible())
                copies = bars.count() - fresh.count()
                bars = fresh
                compared.unpersist()
            late.unpersist()
        full = features_with_history(bars, state, cfg.chunk_rows)
    else:
        full = plain_features(bars, cfg.chunk_rows)
    full = full.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        flagged = flag_rows(batch_rows(full) if cfg.history else full, cfg)
        observed, obs = count_observation(flagged)
        passed = F.col("data_quality_status") == F.lit("Passed")
        failed = flagged.filter(~passed)
        if cfg.keep_raw and "_raw" in batch_df.columns:
            failed = with_raw(failed, batch_df)
        write_batch(observed.filter(passed), cfg.clean_path, cfg.run_id, batch_id, cfg.sink_format)
        write_batch(failed, cfg.failed_path, cfg.run_id, batch_id, cfg.sink_format)
        name = None
        if cfg.history:
            own = batch_rows(full)
            write_batch(completed_labels(full), cfg.labels_path, cfg.run_id, batch_id, cfg.sink_format)
            write_known(own, cfg.known_path, cfg.run_id, batch_id)
            name = write_state(merged_state(next_state(full), state), merged_digests(stored, digests(hashed(own))),
                               output, last.seq + 1)
        if cfg.rollups:
            update_rollups((batch_rows(full) if cfg.history else full).select(*BAR_COLUMNS), cfg.rollups_path,
                           cfg.run_id, batch_id, last.seq + 1)
        counts = {k: int(v) for k, v in obs.get.items()}
        if copies:
            counts["redelivered_records"] = copies
        record(spark, output, last, cfg.run_id, batch_id, counts, name)
        if name is not None:
            drop_older(spark, output, name)
        log.info("batch %s: %s", batch_id, counts)
        return counts
    finally:
        full.unpersist()


def with_raw(failed: DataFrame, batch_df: DataFrame) -> DataFrame:
    """Failed rows with the message they came from (one of them, where several parse alike)."""
    bar = F.struct(*BAR_COLUMNS[1:])
    raw = (batch_df.select(F.when(F.col("symbol") != "", F.col("symbol")).alias("_s"), bar.alias("_b"), "_raw")
           .groupBy("_s", "_b").agg(F.max("_raw").alias("_raw")))
    same = F.col("symbol").eqNullSafe(F.col("_s")) & bar.eqNullSafe(F.col("_b"))
    return failed.join(raw, same, "left").drop("_s", "_b")


def run_record(spark: SparkSession, cfg: PipelineConfig) -> PipelineConfig:
    """``cfg`` with the run's name and sink, as recorded beside its checkpoint.

    The first start writes the record: a name of its own, and the sink format
    that this session has.  Later starts read it, so a run never changes its folder.
    """
    path = f"{cfg.checkpoint_path.rstrip('/')}/candela-run"
    if not folders.is_complete(spark, path):
        name = time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + f"-{uuid.uuid4().hex[:8]}"
        fmt, clean = resolve_sink(spark, "clean_data", cfg.sink_format)
        failed = clean.replace("clean_data", "failed_data")
        spark.createDataFrame([(name, fmt, clean, failed)], "run_id string, fmt string, clean string, failed string") \
            .coalesce(1).write.mode("overwrite").json(path)
    r = spark.read.schema("run_id string, fmt string, clean string, failed string").json(path).first()
    return replace(cfg, run_id=r["run_id"], sink_format=r["fmt"], clean_folder=r["clean"], failed_folder=r["failed"])


def start_pipeline(spark: SparkSession, cfg: PipelineConfig):
    """Start the streaming query of a recorded run and return it."""
    if cfg.source_format == "landing":
        parsed = landing_stream(spark, cfg.staged_path, cfg.max_files)
    else:
        messages = topic_stream(spark, cfg.source_path, cfg.source_options) if cfg.source_format == "topic" else bar_stream(
            spark, cfg.source_format, cfg.source_path, cfg.source_options)
        parsed = parse_bars(messages, keep_raw=cfg.keep_raw)
    writer = (observe_arrivals(parsed).writeStream
              .foreachBatch(partial(_foreach, cfg=cfg))
              .option("checkpointLocation", cfg.checkpoint_path))
    writer = (writer.trigger(availableNow=True) if cfg.available_now
              else writer.trigger(processingTime=f"{cfg.trigger_seconds} seconds"))
    return writer.start()


def _foreach(batch_df: DataFrame, batch_id: int, cfg: PipelineConfig) -> None:
    """The source is read and parsed once; all jobs of the batch read the persisted bars."""
    batch_df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        process_batch(batch_df, batch_id, cfg)
    finally:
        batch_df.unpersist()


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, poll_seconds: float = 10.0,
                 metrics: BatchMetrics | None = None) -> PipelineConfig:
    """Run the job; returns the configuration with the run's name and folders.

    ``available_now``: until the source is drained, however long that takes.  Otherwise
    a bounded run: new data every ``trigger_seconds`` until ``timeout_minutes`` are over, and
    then to the end of the batch that is running.  The ``landing`` source stages new file
    versions first, and again whenever the run wakes.  ``metrics`` takes a row per batch.
    """
    cfg = run_record(spark, cfg)
    stage = cfg.source_format == "landing"
    if stage:
        stage_landing(spark, cfg.source_path, cfg.staged_path)
    metrics = metrics or BatchMetrics()
    spark.streams.addListener(metrics)
    try:
        query = start_pipeline(spark, cfg)
        metrics.follow(query)
        deadline = None if cfg.available_now else time.monotonic() + cfg.timeout_minutes * 60
        try:
            while query.isActive and (deadline is None or time.monotonic() < deadline):
                left = poll_seconds if deadline is None else deadline - time.monotonic()
                query.awaitTermination(min(poll_seconds, max(0.1, left)))
                if stage and not cfg.available_now and query.isActive:
                    stage_landing(spark, cfg.source_path, cfg.staged_path)
            metrics.behind_a_batch.clear()
            while query.isActive and query.status["isTriggerActive"] and not metrics.behind_a_batch.wait(0.2):
                pass
            if query.exception() is not None:
                raise query.exception()
        finally:
            if query.isActive:
                log.info("run time over, stopping the query")
                query.stop()
    finally:
        if metrics.query_id is not None:
            metrics.ended.wait(10)  # progress is told a moment after the batch
        spark.streams.removeListener(metrics)
    return cfg


def output_schema(cfg: PipelineConfig) -> T.StructType:
    """Columns of the clean and failed tables."""
    spark = SparkSession.active()
    empty = spark.createDataFrame([], BAR_SCHEMA)
    rows, _ = transform_batch(empty, replace(cfg, chunk_rows=None))
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields]
                        + ([T.StructField("_raw", T.StringType())] if cfg.keep_raw else [])
                        + [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())])


def read_output(spark: SparkSession, path: str, cfg: PipelineConfig | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """Read a table of the job: the rows of recorded batches.

    With ``cfg`` the job's schema is given instead of inferred, and a table that no batch
    has written to reads as empty.  Without it a table without run and batch columns
    (written by ``write_table``) is read whole; a ``schema`` that is known spares it a second
    listing of its folders.
    """
    output = path.rstrip("/").rpartition("/")[0]
    if cfg is not None:
        schema = output_schema(cfg)
        if not folders.exists(spark, path):
            return spark.createDataFrame([], schema)
        return committed(spark.read.schema(schema).format(cfg.sink_format).load(path), output)
    kinds = {"symbol": T.StringType(), "run_id": T.StringType(), "batch_id": T.LongType()}
    with listing_by_cores(spark):
        inferred = schema or spark.read.parquet(path).schema
        rows = spark.read.schema(T.StructType([
            T.StructField(f.name, kinds.get(f.name, f.dataType), True) for f in inferred.fields])).parquet(path)
    return committed(rows, output) if {"run_id", "batch_id"} <= set(rows.columns) else rows


def labelled_output(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Clean and failed rows with the labels that later batches completed."""
    rows = read_output(spark, cfg.clean_path, cfg).unionByName(read_output(spark, cfg.failed_path, cfg))
    if not folders.exists(spark, cfg.labels_path):
        return rows
    schema = "symbol string, date string, next_day_return double, run_id string, batch_id long"
    reader = spark.read.format(cfg.sink_format)
    labels = committed((reader if cfg.sink_format == "delta" else reader.schema(schema)).load(cfg.labels_path),
                       cfg.output_path.rstrip("/")).select(
        F.col("symbol").alias("_s"), F.col("date").alias("_d"), F.col("next_day_return").alias("_label"))
    # A late bar is not the bar of its date that the series holds.
    same = (F.col("symbol") == F.col("_s")) & (F.col("date") == F.col("_d")) \
        & ~F.col("data_quality_flag").eqNullSafe(F.lit(LATE_BAR))
    return (rows.join(labels, same, "left")
            .withColumn("next_day_return", F.coalesce("next_day_return", "_label")).select(rows.columns))
