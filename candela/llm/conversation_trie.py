"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

Every distinct sequence of first turns (role, text) is a node; the root is the empty one.
A node is named by the exclusive or of SHA-256 halves over its (place, turn) pairs, so the
names of a conversation's prefixes are running totals: they are summed per range of the
sorted turns and over the ranges, and a conversation of any length is cut over tasks.
Equal names mean equal sequences up to a collision of 128-bit digests.

Subtree totals come from contraction rounds on the live tree, each a few joins on unique
node names or sums that are pre-aggregated, so that a node with a third of all nodes below
it meets no task whole:

* rake: leaves leave the tree; what they hold goes to their parents;
* compress: of the nodes with one live child, those that come before their unary
  neighbours (fewest times two in the depth, then depth) are cut out; the child takes over
  the parent, and its edge the cut node's sum.  On a chain every round cuts half.

Rounds thus grow with the logarithm of the nodes, not with the depth.  Each round's live
tree is a table in the shared scratch folder.  The rounds are then read backwards: a raked
node's total is what it held, a cut node's is what it held plus its child's total.

Defined results: rows are ordered by turn (null first), then by the digests of role and
text, so equal turn numbers have a fixed order and repeated rows count as turns of their
own; null role or text counts as empty; rows without conv_id belong to no conversation and
are left out; extra columns are ignored; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import bucket_count, stored

ROOT = "0" * 32
#: Bits of ``monotonically_increasing_id`` below the partition's number.
ROW_BITS = 33
#: Members whose numbers are joined to one string; longer lists are digested as a stream.
LISTED = 4096
NOTHING = hashlib.sha256(b"").hexdigest()


def _halves(digest: Column) -> list[Column]:
    """The first two 64-bit words of a hex digest, as signed longs."""
    def word(at: int) -> Column:
        high = F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
        low = F.conv(F.substring(digest, at + 8, 8), 16, 10).cast("long")
        return F.shiftleft(high, 32).bitwiseOR(low)
    return [word(1), word(17)]


def _name(a: str, b: str) -> Column:
    return F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0"))


def ordered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, turn_digest, n_bytes) of every turn, places from 0, ``part`` the sorted range.

    Rows are sorted over ranges of (conv_id, turn, digests, a row number): ranges are even
    however many rows one conversation has, and places follow from counts per range.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = stored(rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(role, 256).alias("r"), F.sha2(text, 256).alias("t"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row")), "turns")
    keys = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("r"), F.asc("t"), F.asc("row")]
    placed = stored(turns.repartitionByRange(bucket_count(turns.count()), *keys).sortWithinPartitions(*keys).select(
        "conv_id", F.sha2(F.concat("r", "t"), 256).alias("turn_digest"), "n_bytes",
        F.monotonically_increasing_id().alias("seq")), "ordered-turns").withColumn("part", F.shiftright("seq", ROW_BITS))
    spans = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("seq0"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv_id", "part", "seq0", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
                         F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    return placed.join(spans, ["conv_id", "part"]).select(
        "conv_id", "part", (F.col("n0") + F.col("seq") - F.col("seq0")).alias("place"), "turn_digest", "n_bytes", "n_turns")


def rebuilt_turns(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations with their first turns taken from the first one of their ``group``.

    Conversation c begins with the first h turns of c - c % group, h = crc32(c) % heads, and
    goes on with its own turns after its first h.  Returns the rebuilt turns (conv_id, depth
    from 1, ...) and one row per conversation (conv_id, length); ``turns`` must be stored.
    """
    c = F.col("conv_id")
    per = turns.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns")).select(
        "conv_id", (c - c % group).alias("base"), "n_turns",
        (F.crc32(c.cast("string").cast("binary")) % heads).alias("h"))
    of_base = per.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    convs = stored(per.join(of_base, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("base_turns", F.lit(0)))).select(
        "conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("length")),
        "rebuilt")
    first = turns.filter(F.col("place") < heads - 1).select(F.col("conv_id").alias("base"), "place", "turn_digest", "n_bytes")
    head = convs.join(first, "base").filter("place < taken").select(
        "conv_id", F.lit(-1).cast("long").alias("part"), (F.col("place") + 1).alias("depth"), "turn_digest", "n_bytes", "length")
    # Joined per sorted range: a long conversation's rows stay spread.
    spans = turns.select("conv_id", "part").distinct().join(convs, "conv_id")
    tail = turns.join(spans, ["conv_id", "part"]).filter("place >= h").select(
        "conv_id", "part", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "turn_digest", "n_bytes", "length")
    return head.unionByName(tail), convs.select("conv_id", "length")


def named_turns(rebuilt: DataFrame) -> DataFrame:
    """The rebuilt turns with ``id`` and ``parent``, the names of the node they reach and leave."""
    a, b = _halves(F.sha2(F.concat_ws(":", F.col("depth").cast("string"), "turn_digest"), 256))
    rows = stored(rebuilt.withColumns({"a": a, "b": b}), "rebuilt-turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    spans = rows.groupBy("conv_id", "part").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).select(
        "conv_id", "part", F.coalesce(F.bit_xor("a").over(earlier), zero).alias("a0"),
        F.coalesce(F.bit_xor("b").over(earlier), zero).alias("b0"))
    running = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.join(spans, ["conv_id", "part"])
            .withColumns({"ra": F.bit_xor("a").over(running).bitwiseXOR(F.col("a0")),
                          "rb": F.bit_xor("b").over(running).bitwiseXOR(F.col("b0"))})
            .withColumns({"pa": F.col("ra").bitwiseXOR(F.col("a")), "pb": F.col("rb").bitwiseXOR(F.col("b"))})
            .select("conv_id", "depth", "n_bytes", (F.col("depth") == F.col("length")).alias("ends"),
                    _name("ra", "rb").alias("id"), _name("pa", "pb").alias("parent")))


def _state(adds: list[Column]) -> list[Column]:
    return [x.alias(n) for x, n in zip(adds, ("leaves", "saved", "edge_leaves", "edge_saved"))]


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """(id, n_leaves, saved_tokens) of every node of ``nodes`` (id, parent, depth, n_children, saved).

    ``nodes`` holds one tree whose root has no parent, and must be stable under re-reading.
    """
    none = F.lit(None)
    zero = F.lit(0).cast("long")
    cut_columns = [none.cast("string").alias("cut_id"), none.cast("long").alias("cut_leaves"), none.cast("long").alias("cut_saved")]
    live = stored(nodes.select("id", "parent", "depth", F.col("n_children").alias("kids"), *_state(
        [(F.col("n_children") == 0).cast("long"), F.col("saved"), zero, zero]), *cut_columns), "live-tree")
    rounds = [live]
    while live.count() > 1:
        raked = live.filter("kids = 0").groupBy(F.col("parent").alias("id")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("leaves") + F.col("edge_leaves")).alias("dl"),
            F.sum(F.col("saved") + F.col("edge_saved")).alias("ds"))
        inner = live.filter("kids > 0").join(raked, "id", "left").select(
            "id", "parent", "depth", (F.col("kids") - F.coalesce("n", zero)).alias("kids"), *_state([
                F.col("leaves") + F.coalesce("dl", zero), F.col("saved") + F.coalesce("ds", zero),
                F.col("edge_leaves"), F.col("edge_saved")]))
        inner = stored(inner, "raked-tree")
        unary = inner.filter("kids = 1 and parent is not null")
        # What a unary node knows of its one live child, found from the child's side.
        child = inner.groupBy(F.col("parent").alias("id")).agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("child"), F.min("depth").alias("child_depth"),
            (F.min("kids") == 1).alias("child_unary"), F.min("edge_leaves").alias("child_el"),
            F.min("edge_saved").alias("child_es")).filter("n = 1").drop("n")
        chain = stored(unary.join(child, "id").withColumns({
            "rank": _order("depth"), "child_rank": _order("child_depth")}), "chains")
        # Of two unary neighbours the later one stays.
        stays = chain.filter("child_unary").select(
            F.when(F.col("rank") < F.col("child_rank"), F.col("child")).otherwise(F.col("id")).alias("id")).distinct()
        cut = chain.join(stays, "id", "left_anti").select(
            F.col("child").alias("id"), F.col("parent").alias("new_parent"), F.col("id").alias("gone"),
            (F.col("leaves") + F.col("edge_leaves")).alias("up_l"), (F.col("saved") + F.col("edge_saved")).alias("up_s"),
            (F.col("leaves") + F.col("child_el")).alias("cut_leaves"), (F.col("saved") + F.col("child_es")).alias("cut_saved"))
        cut = stored(cut, "cuts")
        gone = cut.select(F.col("gone").alias("id"))
        live = stored(inner.join(gone, "id", "left_anti").join(cut, "id", "left").select(
            "id", F.coalesce("new_parent", "parent").alias("parent"), "depth", "kids", *_state([
                F.col("leaves"), F.col("saved"), F.col("edge_leaves") + F.coalesce("up_l", zero),
                F.col("edge_saved") + F.coalesce("up_s", zero)]),
            F.col("gone").alias("cut_id"), "cut_leaves", "cut_saved"), "live-tree")
        rounds.append(live)
    # Backwards: the totals of one round's live nodes give those of the round before.
    done = live.select("id", "leaves", "saved")
    for at in range(len(rounds) - 1, 0, -1):
        cuts = rounds[at].filter("cut_id is not null").select("id", "cut_id", "cut_leaves", "cut_saved")
        opened = cuts.join(done, "id").select(F.col("cut_id").alias("id"), (F.col("cut_leaves") + F.col("leaves")).alias("leaves"),
                                              (F.col("cut_saved") + F.col("saved")).alias("saved"))
        leaves = rounds[at - 1].filter("kids = 0").select("id", "leaves", "saved")
        done = stored(reduce(DataFrame.unionByName, [leaves, opened, done]), "totals")
    return done.select("id", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def _order(depth: str) -> Column:
    """Sort key by which unary neighbours are cut: depths divisible by fewer twos first."""
    d = F.col(depth)
    lowest = d.bitwiseAND(-d)
    return F.struct(lowest, d)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined numbers of each id, read in order one batch at a time."""
    name, state = None, None
    for batch in batches:
        ids, digests = [], []
        for node, number in zip(batch.column("id").to_pylist(), batch.column("conv_id").to_pylist()):
            if node != name:
                if name is not None:
                    ids.append(name)
                    digests.append(state.hexdigest())
                name, state = node, hashlib.sha256(str(number).encode())
            else:
                state.update(f",{number}".encode())
        if ids:
            yield pa.RecordBatch.from_pydict({"id": ids, "ends_sha256": digests})
    if name is not None:
        yield pa.RecordBatch.from_pydict({"id": [name], "ends_sha256": [state.hexdigest()]})


def ends_digests(ends: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, ends_sha256) of nodes where two or more conversations end.

    Short lists are joined to strings.  A list of any other length has to be digested in one
    order, so it is sorted and streamed through one task, which holds one batch of it.
    """
    several = nodes.filter("n_ends > 1").select("id", "n_ends")
    rows = ends.join(several, "id")
    listed = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    short = rows.filter(F.col("n_ends") <= LISTED).groupBy("id").agg(
        F.sha2(F.array_join(listed, ","), 256).alias("ends_sha256"))
    long = (rows.filter(F.col("n_ends") > LISTED).select("id", "conv_id").repartition("id")
            .sortWithinPartitions("id", "conv_id").mapInArrow(_digests, "id string, ends_sha256 string"))
    return short.unionByName(long)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rebuilt, convs = rebuilt_turns(stored(ordered_turns(conversations.select("conv_id", "turn", "role", "text")), "turns"))
    turns = stored(named_turns(rebuilt), "node-turns")
    root = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("n_bytes"),
                        (F.col("length") == 0).alias("ends"), F.lit(ROOT).alias("id"), F.lit(None).cast("string").alias("parent"))
    visits = turns.unionByName(root)
    found = visits.groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"), F.min("n_bytes").alias("n_bytes"),
        F.sum(F.col("ends").cast("long")).alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv_id"))).alias("first_end"))
    found = stored(found, "found-nodes")
    below = found.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    # Children of one parent are spread by ranges before its conv_id comes to them.
    keys = ["parent", "id"]
    nodes = stored(found.join(below, "id", "left").select(
        "id", "parent", "depth", "conv_id", "n_convs", "n_ends", "first_end",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
        .repartitionByRange(bucket_count(found.count()), *keys).sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id()), "nodes")
    totals = subtree_totals(nodes)
    parents = nodes.filter("parent is not null").select("parent", "part").distinct().join(
        nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    digests = ends_digests(visits.filter("ends").select("id", "conv_id"), nodes)
    one = F.when(F.col("n_ends") == 0, F.lit(NOTHING)).when(F.col("n_ends") == 1, F.sha2(F.col("first_end").cast("string"), 256))
    return (nodes.join(parents, ["parent", "part"], "left").join(totals, "id").join(digests, "id", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce(one, F.col("ends_sha256")).alias("ends_sha256")))
