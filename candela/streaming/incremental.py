"""Drive the streaming job over data that arrives in periods.

``replay_in_periods`` lands the bar messages of one period (e.g. a year) at a
time into the source folder and runs the stream with ``availableNow`` from the
same checkpoint after each landing, so every period becomes exactly one
micro-batch, in order -- the arrival pattern of a daily feed, compressed.
Each run resumes from the checkpoint, so this also exercises restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.session import scratch_path
from candela.sinks.writers import publish_bars, write_landing_files
from candela.sources.topic import append_to_topic
from candela.streaming.metrics import BatchMetrics
from candela.streaming.pipeline import PipelineConfig, labelled_output, read_output, run_pipeline

EXCLUDED_OUTPUT = ["processed_timestamp", "processing_date", "run_id", "batch_id"]
#: Periods are landed one after another from the driver: a backlog of days, not a key.
MOST_PERIODS = 10_000


def replay_in_periods(spark: SparkSession, bars: DataFrame, period: Column,
                      history: bool, dedupe: bool = True, labelled: bool = False,
                      read: Callable[[SparkSession, PipelineConfig], DataFrame] | None = None,
                      metrics: BatchMetrics | None = None, **options) -> DataFrame:
    """Stream ``bars`` period by period through the job; return clean + failed rows.

    ``labelled`` fills in the labels that later batches completed; ``read`` returns another
    result of the job; ``metrics`` takes a row per batch.  ``options`` are further fields of the job's configuration.
    """
    root = scratch_path(spark, "stream")
    cfg = PipelineConfig(output_path=f"{root}/out", checkpoint_path=f"{root}/checkpoint",
                         source_format="text", source_path=f"{root}/source/*",
                         available_now=True, history=history, dedupe=dedupe,
                         with_timestamps=True, **options)
    # Rows without a period (no date) arrive first, in a batch of their own.
    # The bars are computed once into a table partitioned by period under the
    # shared scratch folder; each landing then reads one partition (pruned).
    staged = f"{root}/staged"
    (bars.withColumn("_period", F.coalesce(period, F.lit(""))).hint("rebalance", "_period")
         .write.mode("overwrite").partitionBy("_period").parquet(staged))
    schema = T.StructType([*bars.schema.fields, T.StructField("_period", T.StringType())])
    keyed = spark.read.schema(schema).parquet(staged)
    periods = sorted(r[0] or "" for r in keyed.select("_period").distinct().limit(MOST_PERIODS + 1).collect())
    if len(periods) > MOST_PERIODS:
        raise ValueError(f"more than {MOST_PERIODS} periods: choose longer ones")
    for p in periods:
        landed = keyed.filter(F.coalesce("_period", F.lit("")) == F.lit(p))
        publish_bars(landed, fmt="text", path=f"{root}/source/{p or 'undated'}", mode="overwrite")
        cfg = run_pipeline(spark, cfg, poll_seconds=0.5, metrics=metrics)
    if read is not None:
        return read(spark, cfg)
    if labelled:
        return labelled_output(spark, cfg).drop(*EXCLUDED_OUTPUT)
    clean = read_output(spark, cfg.clean_path, cfg)
    failed = read_output(spark, cfg.failed_path, cfg)
    return clean.unionByName(failed).drop(*EXCLUDED_OUTPUT)


def year_of(date_col: str = "date") -> Column:
    return F.substring(F.col(date_col), 1, 4)


def replay_topic(spark: SparkSession, bars: DataFrame, periods: list[str], period: Column, **options) -> DataFrame:
    """Append the bars of each period in turn to a topic, and start the job again after each.

    Every start goes on from the offsets of the checkpoint.  Returns clean + failed rows.
    """
    root = scratch_path(spark, "topic-stream")
    cfg = PipelineConfig(output_path=f"{root}/out", checkpoint_path=f"{root}/checkpoint", source_format="topic",
                         source_path=f"{root}/topic", available_now=True, **options)
    for p in periods:
        append_to_topic(bars.filter(period == F.lit(p)), cfg.source_path)
        cfg = run_pipeline(spark, cfg, poll_seconds=0.5)
    return read_output(spark, cfg.clean_path, cfg).unionByName(read_output(spark, cfg.failed_path, cfg)).drop(*EXCLUDED_OUTPUT)


def replay_landing(spark: SparkSession, bars: DataFrame, periods: list[str], period: Column, **options) -> DataFrame:
    """Overwrite the landing files with all bars up to each period in turn, and stream the folder after each.

    Returns clean + failed rows, as :func:`replay_in_periods` does.
    """
    root = scratch_path(spark, "landing-stream")
    cfg = PipelineConfig(output_path=f"{root}/out", checkpoint_path=f"{root}/checkpoint", source_format="landing",
                         source_path=f"{root}/landing", available_now=True, **options)
    for p in periods:
        write_landing_files(bars.filter(period <= F.lit(p)), cfg.source_path)
        cfg = run_pipeline(spark, cfg, poll_seconds=0.5)
    return read_output(spark, cfg.clean_path, cfg).unionByName(read_output(spark, cfg.failed_path, cfg)).drop(*EXCLUDED_OUTPUT)
