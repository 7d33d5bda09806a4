"""A topic with offsets and no broker: append-only logs per partition, read as a stream.

A topic is a folder with one folder per partition, ``partition=<n>``, that holds segments
``<first offset>-<messages>.jsonl``.  The streaming source ``candela_topic`` reads them by
offset ranges: a batch is a range per partition, ranges are read by the tasks, and a query
that starts again goes on from the offsets of its checkpoint.  ``startingOffsets`` is
``earliest`` or ``latest`` and counts for a new query only.  Retention may have dropped
segments that a query had not read: with ``failOnDataLoss`` the query fails, else it goes on
from the earliest message there is.

Driver and executors read the folder as files, so it has to be mounted on all of them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from candela.session import local_path
from candela.sinks import folders
from candela.sinks.writers import MESSAGE_FIELDS

NAME = "candela_topic"
SCHEMA = "value string, partition int, offset long"


def _segments(path: str, partition: str) -> list[tuple[int, int, str]]:
    """(first offset, offset behind the last, file) of a partition's segments, in order."""
    found = []
    for name in os.listdir(f"{path}/partition={partition}"):
        stem, _, suffix = name.rpartition(".")
        first, _, count = stem.partition("-")
        if suffix == "jsonl" and first.isdigit() and count.isdigit():
            found.append((int(first), int(first) + int(count), f"{path}/partition={partition}/{name}"))
    return sorted(found)


def _partitions(path: str) -> list[str]:
    there = os.listdir(path) if os.path.isdir(path) else []
    return sorted((n.partition("=")[2] for n in there if n.startswith("partition=")), key=int)


def ends(path: str, which: str) -> dict[str, int]:
    """By partition: the first offset there is (``earliest``), or the one behind the last (``latest``)."""
    out = {}
    for p in _partitions(path):
        some = _segments(path, p)
        if some:
            out[p] = some[0][0] if which == "earliest" else some[-1][1]
    return out


class OffsetRange(InputPartition):
    def __init__(self, partition: str, start: int, end: int):
        super().__init__(partition)
        self.partition, self.start, self.end = partition, start, end


class TopicReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str, strict: bool):
        self.path, self.starting, self.strict = path, starting, strict

    def initialOffset(self) -> dict:
        return ends(self.path, self.starting)

    def latestOffset(self) -> dict:
        return ends(self.path, "latest")

    def partitions(self, start: dict, end: dict) -> list[OffsetRange]:
        there, out = ends(self.path, "earliest"), []
        for p, stop in end.items():
            begin, earliest = start.get(p, 0), there.get(p, stop)
            if begin < earliest:
                if self.strict and begin < stop:
                    raise RuntimeError(f"offsets {begin} to {earliest} of partition {p} are lost")
                begin = earliest
            if begin < stop:
                out.append(OffsetRange(p, begin, stop))
        return out

    def read(self, partition: OffsetRange) -> Iterator[tuple]:
        for first, behind, name in _segments(self.path, partition.partition):
            if behind > partition.start and first < partition.end:
                with open(name, encoding="utf-8") as lines:
                    for offset, line in enumerate(lines, first):
                        if partition.start <= offset < partition.end:
                            yield line.rstrip("\n"), int(partition.partition), offset

    def commit(self, end: dict) -> None:
        """Nothing is kept for the reader."""


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TopicReader:
        starting = self.options.get("startingOffsets", "earliest")
        if starting not in ("earliest", "latest"):
            raise ValueError(f"startingOffsets must be 'earliest' or 'latest', got {starting!r}")
        return TopicReader(local_path(self.options["path"]), starting, self.options.get("failOnDataLoss", "true").lower() == "true")


def append_to_topic(df: DataFrame, path: str, partitions: int = 3) -> dict[str, int]:
    """Append bars as messages, a symbol's always to the same partition in order of date; returns the new ends.

    One segment per partition and call: for batches of a feed.  One writer at a time.
    """
    spark, staged = df.sparkSession, f"{path.rstrip('/')}-staged"
    part = F.pmod(F.xxhash64(F.coalesce("symbol", F.lit(""))), F.lit(partitions)).cast("int")
    keyed = df.withColumn("_p", part).repartition(partitions, "_p").sortWithinPartitions("_p", F.asc_nulls_first("date"))
    keyed.select("_p", F.to_json(F.struct(*MESSAGE_FIELDS)).alias("value")).write.mode("overwrite").partitionBy("_p").text(staged)
    counts = {str(r["_p"]): r["n"] for r in spark.read.text(staged).groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = ends(local_path(path), "latest")
    for p, n in counts.items():
        folders.make(spark, f"{path}/partition={p}")
        folders.take_file(spark, f"{staged}/_p={p}", f"{path}/partition={p}/{base.get(p, 0):020d}-{n}.jsonl")
    return ends(local_path(path), "latest")


def topic_stream(spark: SparkSession, path: str, options: dict[str, str] | None = None) -> DataFrame:
    """Streaming messages of a topic, with a ``value`` column."""
    spark.dataSource.register(TopicSource)
    return spark.readStream.format(NAME).options(**(options or {})).load(path)
