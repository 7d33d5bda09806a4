"""Bar and feature sinks: JSON messages, landing CSV, partitioned tables.

Folder-partitioned writes are rebalanced on their folder columns first: a symbol
is written by one task, and one that holds a large share of the rows by as many as
its size asks for (adaptive execution splits it).  Files thus grow with the data
and the symbols, not with symbols times tasks.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.schema import CSV_COLUMNS
from candela.sinks import folders

log = logging.getLogger(__name__)

# Fixed value: key order of a published bar message.
MESSAGE_FIELDS = ["date", "open", "high", "low", "close", "volume", "symbol"]

# On a local disk (``file:``) Hadoop writes a checksum file beside every file and starts a
# ``chmod`` process for each: with a file per symbol that is a third of the write.  Other
# file systems do not read these options.
PLAIN_LOCAL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
                     "fs.file.impl.disable.cache": "true"}


def bars_to_messages(df: DataFrame) -> DataFrame:
    """Bars -> one JSON message per bar in a ``value`` column (NULL fields are omitted)."""
    return df.select(F.to_json(F.struct(*MESSAGE_FIELDS)).alias("value"))


def publish_bars(df: DataFrame, fmt: str = "kafka", path: str | None = None,
                 options: dict[str, str] | None = None, mode: str = "append") -> None:
    """Write bar messages to a topic (``fmt="kafka"``, needs ``topic`` and
    ``kafka.bootstrap.servers``) or to a folder of JSON-lines files (``fmt="text"``)."""
    writer = bars_to_messages(df).write.format(fmt).mode(mode).options(**(options or {}))
    writer.save(path) if path else writer.save()


def write_landing_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bars -> CSV under ``<path>/symbol=<symbol>/``, one header line per file.

    Read back with ``read_landing_csv(..., symbol_from="partition")``.
    """
    (df.select("symbol", *CSV_COLUMNS).hint("rebalance", "symbol").write.mode(mode)
       .options(**PLAIN_LOCAL_FILES).option("header", True).partitionBy("symbol").csv(path))


def write_landing_files(df: DataFrame, path: str) -> None:
    """Bars -> one CSV file ``<path>/<symbol>.csv`` per symbol, the layout an extractor leaves.

    One file means one task per symbol, and the files are named one by one from the driver:
    for a feed's daily landing.  Larger tables go to ``write_landing_csv``.  Bars without a
    symbol have no file name and are refused.  Read back with ``symbol_from="stem"``.
    """
    spark, staged = df.sparkSession, f"{path.rstrip('/')}-staged"
    if not df.filter(F.col("symbol").isNull()).isEmpty():
        raise ValueError("bars without a symbol have no landing file")
    (df.select("symbol", *CSV_COLUMNS).repartition("symbol").write.mode("overwrite")
       .option("header", True).partitionBy("symbol").csv(staged))
    folders.name_files(spark, staged, path, "csv")


def format_available(spark: SparkSession, fmt: str) -> bool:
    """Whether this session has the data source ``fmt`` at all.

    Any other fault of a sink (disk, permission, a half-written job) is a fault,
    not a reason to write somewhere else.
    """
    try:
        spark.read.format(fmt).load()
    except Exception as err:  # noqa: BLE001 - only one of them is looked for
        return "DATA_SOURCE_NOT_FOUND" not in str(err)
    return True


def resolve_sink(spark: SparkSession, path: str, fmt: str, fallback_format: str | None = "parquet",
                 fallback_suffix: str = "_parquet_fallback") -> tuple[str, str]:
    """(format, path) to write with: the preferred ones, or the fallback if the format is absent."""
    if format_available(spark, fmt):
        return fmt, path
    if not fallback_format or fallback_format == fmt:
        raise ValueError(f"data source {fmt!r} is not available and there is no fallback")
    log.warning("data source %s is not available; writing %s to %s%s", fmt, fallback_format, path,
                fallback_suffix)
    return fallback_format, path + fallback_suffix


def write_table(df: DataFrame, path: str, fmt: str = "delta",
                partition_cols: Sequence[str] = ("symbol",), mode: str = "append",
                fallback_format: str | None = "parquet",
                fallback_suffix: str = "_parquet_fallback",
                options: dict[str, str] | None = None) -> str:
    """Append ``df`` to a table partitioned by ``partition_cols``; return the path written.

    The preferred format is Delta by default, with schema merge; where the session does
    not have it, the same frame goes to ``<path><fallback_suffix>`` in ``fallback_format``.
    Errors of the write itself are raised.
    """
    chosen, target = resolve_sink(df.sparkSession, path, fmt, fallback_format, fallback_suffix)
    opts = {"mergeSchema": "true"} if chosen == "delta" else dict(PLAIN_LOCAL_FILES)
    opts.update(options or {} if chosen == fmt else {})
    out = df.hint("rebalance", *partition_cols) if partition_cols else df
    w = out.write.format(chosen).mode(mode).options(**opts)
    (w.partitionBy(*partition_cols) if partition_cols else w).save(target)
    return target


RUN_COLUMNS = ["run_id", "batch_id"]


def write_batch(df: DataFrame, path: str, run_id: str, batch_id: int, fmt: str = "parquet") -> str:
    """Replay-safe write of one micro-batch of one run.

    The table is partitioned by run and batch; a symbol's rows stay together inside the
    files.  Parquet: the batch's own folder is written, and overwritten by a later attempt
    of the same batch; no other run's rows are touched (batch numbers restart with every
    checkpoint).  Run and batch stand in the folder's name alone, so the generated code of
    the write is the same for every batch and is compiled once.  Delta: an idempotent append
    keyed by the run and the batch.
    """
    if fmt == "delta":
        out = df.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(int(batch_id)).cast("long")})
        (out.write.format("delta").mode("append")
            .option("txnAppId", f"{run_id}:{path}").option("txnVersion", int(batch_id))
            .option("mergeSchema", "true")
            .partitionBy(*RUN_COLUMNS).save(path))
        return path
    df.write.format(fmt).mode("overwrite").save(f"{path}/run_id={run_id}/batch_id={int(batch_id)}")
    return path


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "append", num_partitions: int | None = None) -> None:
    """Relational load of a result table (the relational sink the original
    design advertises).  Writes in parallel from ``num_partitions`` tasks."""
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.jdbc(url=url, table=table, mode=mode, properties=properties or {})
