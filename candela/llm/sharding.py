"""Reproducible sharding by a Feistel permutation over global row numbers.

Rows get dense global numbers in a fixed order (md5 of doc_id and text checksum),
a keyed Feistel network with cycle walking permutes 0..N-1, and the permuted
number p gives shard = p mod shards and slot = p div shards.  Any row's place can
be computed from its number, N and the key alone, and back.  Row counts of shards
differ by at most one; slots are gapless.

Defined results: null text has no bytes; rows that repeat id and text are
neighbours in the numbering and get places of their own.  Fewer rows than shards
leave shards empty.  Equal texts are not kept together, since counts could not be
equal then.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import bucket_count, order_hash, positions, stored

ROUNDS = 6


def _mixed(half: np.ndarray, key: int, turn: int) -> np.ndarray:
    """The round function: a 64-bit multiply-xorshift mix of a half, the key and the round."""
    x = half + np.uint64((key + (turn + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _half_bits(rows: int) -> int:
    """Bits of each half, so that both hold 0..rows-1 with at most fourfold room."""
    return max(1, ((max(rows, 2) - 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, bits: int, key: int, turns) -> np.ndarray:
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    for turn in turns:
        left, right = right, left ^ (_mixed(right, key, turn) & low)
    return (left << np.uint64(bits)) | right


def permuted(numbers: np.ndarray, rows: int, key: int) -> np.ndarray:
    """The places of ``numbers`` (each in 0..rows-1) under the keyed permutation of 0..rows-1."""
    bits = _half_bits(rows)
    x = numbers.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = _network(x, bits, key, range(ROUNDS))
        while (out := x >= rows).any():  # cycle walking: on until it falls inside
            x[out] = _network(x[out], bits, key, range(ROUNDS))
    return x.astype(np.int64)


def unpermuted(places: np.ndarray, rows: int, key: int) -> np.ndarray:
    """The row numbers that ``permuted`` sends to ``places``."""
    bits = _half_bits(rows)
    low = np.uint64((1 << bits) - 1)
    swap = lambda v: ((v & low) << np.uint64(bits)) | (v >> np.uint64(bits))
    back = lambda v: swap(_network(swap(v), bits, key, reversed(range(ROUNDS))))
    with np.errstate(over="ignore"):
        x = back(places.astype(np.uint64))
        while (out := x >= rows).any():
            x[out] = back(x[out])
    return x.astype(np.int64)


def assign_shards(docs: DataFrame, shards: int = 24, key: int = 7) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, row_no, place, shard, slot."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
        .withColumn("h", order_hash(F.col("doc_id"), F.col("text_crc32")))
        .withColumn("all", F.lit(0)), "shard-rows")
    rows = positions(slim, ["all"], "h", ["doc_id", "text_crc32", "size"], "size",
                     bucket_count(slim.count()))

    @F.pandas_udf("long")
    def place(number: pd.Series, total: pd.Series) -> pd.Series:
        if not len(number):
            return pd.Series([], dtype="int64")
        return pd.Series(permuted(number.to_numpy(), int(total.iloc[0]), key))

    return (rows.withColumn("place", place("row_no", "group_rows"))
            .select("doc_id", "size", "text_crc32", "row_no", "place",
                    (F.col("place") % shards).cast("int").alias("shard"),
                    F.expr(f"place div {shards}").cast("long").alias("slot")))
