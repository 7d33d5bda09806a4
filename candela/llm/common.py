"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.session import scratch_path

#: White space as the contracts count it: space, tab, line feed, vertical tab, form feed, return.
SPACE_CLASS = r"\x20\x09-\x0D"
LONG_MIN = -(1 << 63)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage at a table that survives lost executors, so that later
    steps which read it twice see the same rows both times.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def order_hash(*keys: Column) -> Column:
    """A uniform 32-bit number for a row: the head of an md5 over its keys (null as empty)."""
    joined = F.concat_ws(":", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("long")


def bucket_count(rows: int, per_bucket: int = 20_000, least: int = 32) -> int:
    """Buckets so that each holds about ``per_bucket`` rows, whatever the table's size."""
    return max(least, -(-rows // per_bucket))


def positions(df: DataFrame, group: list[str], h: str, ties: list[str], value: str,
              buckets: int) -> DataFrame:
    """Number the rows of each group and sum ``value`` before each row, in order of ``h``.

    Adds ``row_no`` (from 0), ``start`` (sum of ``value`` over earlier rows),
    ``group_rows`` and ``group_sum``.  A group is cut into ranges of ``h``
    (uniform in 0..2^32): ranges are totalled first, the totals are summed up
    over ranges, and only one range at a time is sorted in a task.  No group
    meets one task, however large.  ``df`` must be stable under re-reading.
    """
    bucket = F.shiftright(F.col(h) * F.lit(buckets).cast("long"), 32)
    rows = df.withColumn("_bucket", bucket)
    totals = rows.groupBy(*group, "_bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(value).cast("long").alias("_v"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    totals = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_v").over(before), F.lit(0)).alias("_v0"),
        F.sum("_n").over(whole).alias("group_rows"),
        F.sum("_v").over(whole).alias("group_sum"))
    same = F.col("_bucket") == F.col("_b")
    for g in group:
        same = same & (F.col(g) == F.col(f"_g_{g}"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(h, *ties)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(totals, same)
            .withColumn("row_no", F.col("_n0") + F.row_number().over(inside) - 1)
            .withColumn("start", F.col("_v0") + F.coalesce(F.sum(value).over(earlier), F.lit(0)))
            .drop("_bucket", "_b", "_n0", "_v0", *[f"_g_{g}" for g in group]))


def row_id() -> Column:
    """doc_id as a key: null counts as the least long."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LONG_MIN).cast("long"))


def keep_rows(docs: DataFrame, keys: DataFrame, text_hash: Column) -> DataFrame:
    """The rows of ``docs`` whose (row_id, text_hash) is in ``keys`` (_id, _th), columns unchanged.

    Of rows equal in both, one stays.  Texts move once.
    """
    columns = docs.columns
    held = docs.select(F.struct("*").alias("_row"), row_id().alias("_id"), text_hash.alias("_th"))
    one = Window.partitionBy("_id", "_th").orderBy(F.lit(0))
    return (held.join(keys.select("_id", "_th"), ["_id", "_th"], "left_semi")
            .withColumn("_n", F.row_number().over(one)).filter("_n = 1")
            .select(*[F.col("_row").getField(c).alias(c) for c in columns]))
