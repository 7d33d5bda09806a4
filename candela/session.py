"""Session construction and shared-storage helpers.

Every job takes a ``SparkSession`` from the caller.  ``get_session`` is only a
convenience for scripts, tests and the bench; on a cluster the submitter owns
the session configuration.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "candela") -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes.

    * AQE on, so shuffle partition counts and skewed joins are re-planned at run time.
    * Session time zone UTC: market-hour logic converts explicitly.
    * UI off: no server is opened by library jobs.
    * Generated methods above 8,000 bytes of bytecode fall back from whole-stage
      codegen (Spark's documented setting for HotSpot, whose JIT skips larger
      methods).  The feature composite projects ~60 columns after its windows;
      one fused method for them would run interpreted.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can reach
    (HDFS/S3/...).  Only when it is unset and the master is local -- tests, scripts
    -- a fresh local folder is created and registered; on any other master a missing
    setting is an error, since executors do not see each other's disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None) \
        or sc.getConf().get(CHECKPOINT_CONF, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not is_local_master(sc.master):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder shared by all executors "
                           f"(master {sc.master})")
    local = tempfile.mkdtemp(prefix="candela-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set(CHECKPOINT_CONF, local)
    return sc.getCheckpointDir() or local


def is_local_master(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` runs real executors)."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Used for intermediate tables and streaming round trips, so that everything a
    job writes lands on storage the whole cluster sees.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # getCheckpointDir() appends a per-application uuid folder; sit next to it.
    return f"{base}/candela-{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def listing_by_cores(spark: SparkSession) -> Iterator[None]:
    """Inside, the folders of a table are listed by a few tasks per core.

    Spark's own setting is a task per folder, up to 10,000 tasks of one folder each, which
    take longer to hand out than to run.  A lower setting of the session stays.
    """
    before = spark.conf.get(LISTING_CONF, None)
    few = 4 * spark.sparkContext.defaultParallelism
    spark.conf.set(LISTING_CONF, str(min(few, int(before)) if before else few))
    try:
        yield
    finally:
        if before:
            spark.conf.set(LISTING_CONF, before)
        else:
            spark.conf.unset(LISTING_CONF)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends.

    Otherwise they stay until the driver happens to collect its garbage.  For queries that
    write a table which is read from then on.
    """
    before = spark.conf.get(CLEANUP_CONF)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_CONF, before)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side helpers can read local test folders."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
