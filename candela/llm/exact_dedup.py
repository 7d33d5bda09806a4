"""Exact de-duplication by content-defined chunk recipes.

Every text is cut where its own characters say so, so equal passages give equal
chunks wherever they stand.  A chunk's identifier is its 64-bit hash, verified
against its length and SHA-256: a hash that names two different chunks is
ambiguous, and texts that hold it are told apart by their whole digest too.
A document then is the ordered list of its identifiers, about one long per
kilobyte, and documents are compared by these lists; a long text is read once
and never moved.

Defined results: null text counts as empty, and all empty texts form one group.
A null doc_id loses to any other.  Of rows that repeat the winning doc_id, one is
kept.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import keep_rows, row_id, stored, text_of

#: A cut falls behind three letters of these classes, once a chunk has the least length.
CUT_AFTER = "[cgkosw][bfjnrvz][adhlptx]"
LEAST, MOST = 512, 4096


def chunk_pattern(least: int = LEAST, most: int = MOST) -> str:
    return rf"(?s).{{{least},{most}}}?(?<={CUT_AFTER})|.{{1,{most}}}"


def chunks_of(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """Content-defined chunks of a text, in order; joined they give the text back."""
    return F.regexp_extract_all(text, F.lit(chunk_pattern(least, most)), F.lit(0))


def exact_duplicates(docs: DataFrame, least: int = LEAST, most: int = MOST,
                     chunk_hash=F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    ``chunk_hash`` names a chunk (a weaker one may be given in tests: results
    stay the same, only more identifiers turn out ambiguous).
    """
    text = text_of()
    recipes = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.sha2(text, 256).alias("text_sha256"),
        F.transform(chunks_of(text, least, most), lambda c: F.struct(
            chunk_hash(c).cast("long").alias("h"), F.octet_length(c).alias("n"),
            F.unhex(F.sha2(c, 256)).alias("sha"))).alias("chunks")), "chunk-recipes")

    dictionary = recipes.select(F.explode("chunks").alias("c")).select("c.*").distinct()
    ambiguous = dictionary.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    listed = recipes.select("doc_id", "row", "text_sha256", F.col("chunks.h").alias("recipe"))
    if ambiguous.isEmpty():  # as good as always: then identifiers alone prove equality
        listed = listed.withColumn("proof", F.lit(""))
    else:
        doubtful = (recipes.select("text_sha256", F.explode("chunks.h").alias("h"))
                    .join(ambiguous, "h", "left_semi").select("text_sha256").distinct()
                    .withColumn("proof", F.col("text_sha256")))
        listed = (listed.join(doubtful, "text_sha256", "left")
                  .withColumn("proof", F.coalesce("proof", F.lit(""))))

    groups = listed.groupBy("recipe", "proof").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.max_by("row", row_id()).alias("keep_row"))
    return listed.join(groups, ["recipe", "proof"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256", F.size("recipe").alias("n_chunks"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns unchanged."""
    found = exact_duplicates(docs.select("doc_id", "text"))
    kept = found.filter("kept").select(row_id().alias("_id"), F.col("text_sha256").alias("_th"))
    return keep_rows(docs, kept, F.sha2(text_of(), 256))
