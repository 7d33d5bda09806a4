"""The landing folder as a stream.

An extractor overwrites one CSV file per symbol with every run.  Spark's file source reads a
path once and never looks at it again, so a rewritten file would be missed.  ``stage_landing``
gives every version of a file a name of its own, ``<stem>@<modification time>.csv``, in a
folder that the file source watches: a version appears whole, by one rename, and is read
exactly once, by the source's own log.  ``landing_stream`` reads the versions, a bounded
number of files a batch, with the symbol from the file's name.  What a rewritten file repeats
is told apart downstream (``candela.streaming.redelivery``).

Staging copies the files of a feed's landing one by one from the driver: one file per
symbol and run.  Versions that the stream has read may be dropped at any time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.schema import BAR_COLUMNS, CSV_SCHEMA
from candela.sinks import folders
from candela.sources.files import file_stem

VERSION = "@"


def stage_landing(spark: SparkSession, landing: str, staged: str) -> list[str]:
    """Copy every file version of ``landing`` that is not in ``staged`` yet; returns their names."""
    there = set(folders.files(spark, staged))
    added = []
    for name, changed in folders.file_times(spark, landing):
        stem, _, suffix = name.rpartition(".")
        version = f"{stem}{VERSION}{changed:015d}.{suffix}"
        if suffix == "csv" and not name.startswith((".", "_")) and version not in there:
            folders.copy_file(spark, f"{landing}/{name}", f"{staged}/{version}")
            added.append(version)
    return added


def landing_stream(spark: SparkSession, staged: str, max_files: int | None = None) -> DataFrame:
    """Streaming bars of the staged versions: one header line, then ``date,open,high,low,close,volume`` by position."""
    folders.make(spark, staged)
    reader = (spark.readStream.schema(CSV_SCHEMA).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE"))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    stem = F.regexp_extract(file_stem(name), f"^(.*){VERSION}[0-9]+$", 1)
    return reader.csv(staged).withColumn("symbol", stem).select(*BAR_COLUMNS)
