"""Mixing sources to target weights.

Every source's documents are laid on an axis of words in a fixed random order,
once per epoch (a target above the source's size takes it again).  The axis up to
the target is cut into blocks; a document belongs to the block in which it begins.
A multivariate-hypergeometric splitting tree deals exact numbers of each source's
blocks to the output shards: a node's blocks are split in two, the left half
drawn without replacement source by source, until each node is one shard.  Shards
then draw disjoint ranges of each source's permuted blocks and shuffle locally.

Defined results: null text has size 0; a null source is a source of its own, the
last in order; sources without words have target 0.  Rows that repeat an id are
separate documents.  Extra columns are carried along; an empty table gives no rows.
Sources are few: their block counts are one array.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import (
    SPACE_CLASS, bucket_count, order_hash, positions, row_id, stored, text_of)

BLOCK_WORDS = 8192
SHARD_BLOCKS = 512
MOST_TIMES = 3
#: Prime multiplier of the block permutation; it shares no factor with any block count below it.
STRIDE = 1_000_000_007


def words_in(text: Column) -> Column:
    """Number of runs of non-space characters."""
    parts = F.split(text, f"[{SPACE_CLASS}]+")
    # A split has an empty part before leading and after trailing space, and one for an empty text.
    edge = lambda i: F.when(F.element_at(parts, i) == "", 1).otherwise(0)
    return F.greatest(F.size(parts) - edge(1) - edge(-1), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: tuple[float, ...] = (5, 2, 1)) -> DataFrame:
    """Targets per source from (source, source_size): adds source_no, weight and target.

    Sources share the sum of all sizes by weight, a target stops at three times
    its source's size, and the excess is shared again.  That ends at one level L
    with target = min(3 * size, L * weight): in order of 3 * size / weight the
    capped sources come first, so prefix sums give the level without a loop.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "source_no")
    early = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    late = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                          (F.col("source_no") % len(weights) + 1).cast("int"))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(early), F.lit(0.0))
    open_here = F.when(F.col("ratio") > F.col("level_here"), F.struct("rank", "level_here"))
    return (totals.withColumn("source_no", F.row_number().over(by_name) - 1)
            .withColumn("weight", weight)
            .withColumn("cap", (F.col("source_size") * MOST_TIMES).cast("double"))
            .withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("rank", F.row_number().over(by_ratio))
            .withColumn("level_here", left / F.sum("weight").over(late))
            # The first source whose cap lies above its level sets it for all that follow.
            .withColumn("level", F.min(open_here).over(every)["level_here"])
            .withColumn("target", F.least("cap", F.coalesce(
                F.col("level") * F.col("weight"), F.col("cap"))))
            .select("source", "source_size", "source_no", "weight", "target"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (an expression would be repeated at each use)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series at n + 9, brought down by a product of eight factors."""
    return let(n + 1.0, lambda x: (
        (x + 7.5) * F.log(x + 8) - (x + 8) + 0.5 * math.log(2 * math.pi) + 1 / (12 * (x + 8))
        - 1 / (360 * F.pow(x + 8, F.lit(3)))
        - F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(0.0), lambda a, i: a + F.log(x + i))))


def hypergeometric(drawn: Column, good: Column, total: Column, u: Column) -> Column:
    """How many of ``good`` among ``total`` blocks are in a draw of ``drawn``, from a uniform ``u``.

    The distribution is inverted from its mode outwards, alternately up and down,
    over at most 14 standard deviations each way; what rounding leaves of ``u``
    falls to the mode.  The result always lies in the distribution's range.
    """
    summed = lambda *xs: F.aggregate(F.array(*xs), F.lit(0.0), lambda a, v: a + log_factorial(v))

    def ranged(r):
        d, g, n = r["d"], r["g"], r["n"]
        low, high = F.greatest(F.lit(0.0), d + g - n), F.least(d, g)
        return F.struct(d.alias("d"), g.alias("g"), n.alias("n"), r["u"].alias("u"), low.alias("low"),
                        high.alias("high"), F.least(high, F.greatest(low, F.floor(
                            (d + 1) * (g + 1) / (n + 2)).cast("double"))).alias("mode"))

    def weighed(r):
        d, g, n, m = r["d"], r["g"], r["n"], r["mode"]
        log_p = (summed(g, n - g, d, n - d) - summed(n, m, g - m, d - m, n - g - d + m))
        spread = F.sqrt(F.greatest(F.lit(0.0), d * g * (n - g) * (n - d)
                                   / (F.greatest(n, F.lit(1.0)) * n * F.greatest(n - 1, F.lit(1.0)) + 1e-9)))
        return F.struct(r.alias("r"), F.exp(log_p).alias("p"), F.least(
            r["high"] - r["low"], F.ceil(spread * 14) + 20).cast("int").alias("steps"))

    def walked(w):
        r, p = w["r"], w["p"]
        start = F.struct((r["u"] - p).alias("u"), r["mode"].alias("up"), p.alias("p_up"),
                         r["mode"].alias("down"), p.alias("p_down"),
                         F.when(r["u"] < p, r["mode"]).alias("got"))

        def step(s, _):
            x, y = s["up"], s["down"]
            d, g, n = r["d"], r["g"], r["n"]
            sides = F.struct(
                F.when(x < r["high"], s["p_up"] * (g - x) * (d - x)
                       / ((x + 1) * (n - g - d + x + 1))).otherwise(0.0).alias("up"),
                F.when(y > r["low"], s["p_down"] * y * (n - g - d + y)
                       / ((g - y + 1) * (d - y + 1))).otherwise(0.0).alias("down"))
            return let(sides, lambda side: F.struct(
                (s["u"] - side["up"] - side["down"]).alias("u"),
                F.least(x + 1, r["high"]).alias("up"), side["up"].alias("p_up"),
                F.greatest(y - 1, r["low"]).alias("down"), side["down"].alias("p_down"),
                F.coalesce(s["got"], F.when(s["u"] < side["up"], x + 1),
                           F.when(s["u"] < side["up"] + side["down"], y - 1)).alias("got")))

        return F.when(r["high"] <= r["low"], r["low"]).otherwise(F.aggregate(
            F.sequence(F.lit(0), w["steps"]), start, step, lambda s: F.coalesce(s["got"], r["mode"])))

    given = F.struct(drawn.cast("double").alias("d"), good.cast("double").alias("g"),
                     total.cast("double").alias("n"), u.alias("u"))
    return let(let(let(given, ranged), weighed), walked).cast("long")


def _uniform(*keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 53).cast("long")).cast("double") / float(1 << 53)


def split_quotas(quotas: Column, drawn: Column, *seed: Column) -> Column:
    """One multivariate-hypergeometric draw: how many of each entry's blocks are among ``drawn``."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, x: a + x)
    start = F.struct(drawn.cast("long").alias("drawn"), total.alias("total"),
                     F.lit(0).alias("i"), F.array().cast("array<bigint>").alias("got"))

    def step(s, good):
        x = hypergeometric(s["drawn"], good, s["total"], _uniform(s["i"], *seed))
        return let(x, lambda v: F.struct(
            (s["drawn"] - v).alias("drawn"), (s["total"] - good).alias("total"),
            (s["i"] + 1).alias("i"), F.concat(s["got"], F.array(v)).alias("got")))

    return F.aggregate(quotas, start, step, lambda s: s["got"])


def splitting_tree(root: DataFrame, shards: int, seed: int) -> DataFrame:
    """Leaves (shard, quotas) of the tree over ``root`` (quotas: array of block counts per source)."""
    nodes = root.select(F.lit(0).alias("first"), F.lit(shards).alias("n"), "quotas")
    for depth in range((shards - 1).bit_length()):
        half = F.expr("n div 2").cast("int")
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, x: a + x)
        drawn = F.floor(total * half / F.col("n"))
        nodes = nodes.select("first", "n", "quotas", half.alias("half"), F.when(
            F.col("n") > 1, split_quotas(F.col("quotas"), drawn, F.col("first"), F.lit(depth),
                                         F.lit(seed))).alias("left"))
        children = F.when(F.col("n") > 1, F.array(
            F.struct(F.col("first"), F.col("half").alias("n"), F.col("left").alias("quotas")),
            F.struct((F.col("first") + F.col("half")).alias("first"),
                     (F.col("n") - F.col("half")).alias("n"),
                     F.zip_with("quotas", "left", lambda a, b: a - b).alias("quotas")))
        ).otherwise(F.array(F.struct("first", "n", "quotas")))
        # Each level is written: plans stay small, and a lost executor costs one level.
        nodes = stored(nodes.select(F.explode_outer(children).alias("c")).select("c.*"), "split-nodes")
    return nodes.select(F.col("first").alias("shard"), "quotas")


def draws(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), block_words: int = BLOCK_WORDS,
          shard_blocks: int = SHARD_BLOCKS, seed: int = 11) -> DataFrame:
    """What the mix takes: one row per document and epoch in which words of it are drawn.

    Columns: doc (``docs`` without its text), size, source_no, source_size, target,
    row_no, epoch, words, shard, place (order in the shard).  Words are taken only by a
    shard that drew their block from the tree.  A document that is not drawn has one row
    with null epoch and 0 words.
    """
    rest = [c for c in docs.columns if c not in ("text", "source")]
    slim = stored(docs.select(
        F.struct(*rest, F.col("source").alias("source")).alias("doc"),
        F.struct(F.col("source").isNull(), F.coalesce("source", F.lit(""))).alias("s"),
        words_in(text_of()).alias("size"), F.md5(text_of().cast("binary")).alias("digest"))
        .withColumn("h", order_hash(F.col("doc.doc_id"), F.col("digest")))
        .withColumn("doc_id", F.col("doc.doc_id")), "mix-rows")
    totals = slim.groupBy("s").agg(F.first("doc.source").alias("source"),
                                   F.sum("size").cast("long").alias("source_size"))
    targets = stored(source_targets(totals.select("source", "source_size")), "mix-targets")
    summed = targets.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    block = max(block_words, -(-summed * MOST_TIMES // (STRIDE - 7)))
    axis = F.round("target").cast("long")
    blocks = F.ceil(axis / F.lit(block)).cast("long")
    shards = max(1, -(-summed // (block * shard_blocks)))

    root = targets.agg(F.transform(F.array_sort(F.collect_list(F.struct("source_no", blocks.alias("q")))),
                                   lambda x: x["q"]).alias("quotas"))
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    dealt = (splitting_tree(root, shards, seed)
             .select("shard", F.posexplode_outer("quotas").alias("source_no", "count"))
             .withColumn("lo", F.coalesce(F.sum("count").over(before), F.lit(0)))
             .filter("count > 0")
             .select("source_no", "shard",
                     F.explode(F.expr("sequence(lo, lo + count - 1)")).alias("turn")))

    placed = positions(slim, ["s"], "h", ["doc_id", "digest"], "size",
                       bucket_count(slim.count()))
    known = targets.select(
        F.struct(F.col("source").isNull(), F.coalesce("source", F.lit(""))).alias("s"),
        "source_no", "source_size", "target", axis.alias("axis"), blocks.alias("blocks"))
    begun = lambda e: e * F.col("source_size") + F.col("start")
    pieces = F.filter(F.transform(F.sequence(F.lit(0), F.lit(MOST_TIMES - 1)), lambda e: F.struct(
        e.alias("epoch"),
        F.greatest(F.lit(0), F.least(F.col("size"), F.col("axis") - begun(e))).alias("words"),
        F.floor(begun(e) / F.lit(block)).cast("long").alias("block"))), lambda p: p["words"] > 0)
    taken = (placed.join(known, "s")
             .select("doc", "size", "source_no", "source_size", "target", "row_no", "blocks", "h",
                     F.explode_outer(pieces).alias("p"))
             .select("*", "p.epoch",
                     F.pmod(F.col("p.block") * STRIDE + F.xxhash64("source_no", F.lit(seed)) % 1000,
                            F.col("blocks")).alias("turn")))
    return (taken.join(dealt, ["source_no", "turn"], "left")
            .withColumn("words", F.when(F.col("shard").isNotNull(), F.col("p.words")).otherwise(0).cast("long"))
            .withColumn("place", F.xxhash64("h", "epoch", F.lit(seed)))
            .select("doc", "size", "source_no", "source_size", "target", "row_no",
                    "epoch", "words", "shard", "place"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, draws.

    ``taken`` sums the words of its drawn blocks; ``draws`` lists where they went, as
    (epoch, shard, place, words) in that order, three at most.
    """
    pieces = draws(docs.select("doc_id", "source", "text"), **options)
    return (pieces.groupBy("source_no", "row_no", F.col("doc.doc_id").alias("doc_id"), "size",
                           "source_size", "target")
            .agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list(F.when(
                F.col("shard").isNotNull(), F.struct("epoch", "shard", "place", "words")))).alias("draws"))
            .select("doc_id", "size", "source_size", "target", "taken", "draws"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    words = F.regexp_extract_all(text, F.lit(f"[{SPACE_CLASS}]*[^{SPACE_CLASS}]+"), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each draw, shard by shard, shuffled within shards.

    A document cut by its source's target keeps its first words; ``n_chars``, if
    there, is set anew.
    """
    columns = docs.columns
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    keyed = docs.withColumn("_th", F.xxhash64(*hashed)).withColumn("_id", row_id())
    drawn = (draws(keyed.select("doc_id", "source", "text", "_th", "_id"), **options)
             .filter("words > 0")
             .groupBy(F.col("doc._id").alias("_id"), F.col("doc._th").alias("_th"))
             .agg(F.collect_list(F.struct("shard", "place", "words", "size")).alias("draws")))
    one = Window.partitionBy("_id", "_th").orderBy(F.lit(0))
    held = docs.select(F.struct("*").alias("row"), F.xxhash64(*hashed).alias("_th"),
                       row_id().alias("_id"))
    rows = (held.join(drawn, ["_id", "_th"]).withColumn("_n", F.row_number().over(one))
            .filter("_n = 1").select("row", F.explode("draws").alias("d")))
    text = F.when(F.col("d.words") < F.col("d.size"), first_words(F.col("row.text"), F.col("d.words"))
                  ).otherwise(F.col("row.text"))
    out = {c: F.col("row").getField(c) for c in columns} | {"text": text}
    rows = rows.select("d.shard", "d.place", *[v.alias(f"c{i}") for i, v in enumerate(out.values())])
    shuffled = rows.repartition("shard").sortWithinPartitions("shard", "place")
    named = shuffled.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(out)])
    return named.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in columns else named
