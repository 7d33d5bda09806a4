"""Chat formatting into prefix trees.

Conversations that share initial turns share their nodes: a node is a turn after a
given history.  Every node's tokens are emitted once, depth first, into its tree's
stream.  A node carries its place in the stream, the position id of its first token
(how many tokens precede it in a conversation) and the stream intervals of its
ancestors, which together with its own earlier tokens is what its tokens attend to.

Trees are never held in one task.  Nodes are named by a running digest of their
history; runs of nodes that all the same conversations pass through are taken
together as chains; subtree sizes are sums over the chains' paths, siblings are
offset by distributed prefix sums, and a chain's place follows from its path.

Control strings in texts are escaped by a backslash, which is itself doubled, so the
template's marks stand only where turns begin and end, and texts come back exactly.

Defined results: null text or role counts as empty; turns are ordered by turn number
(null first), then role and text; repeated rows are turns of their own; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import bucket_count, order_hash, positions, stored
from candela.llm.tokens import ranks_path, tokens_of

START, END, TAIL = "<|im_start|>", "<|im_end|>", "<|im_end|>\n"
TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
LEARNED_ROLE = "assistant"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names every turn by its history; rows come conversation by conversation, in order."""
    held, parent, depth = object(), None, 0
    for batch in batches:
        depths, nodes, parents = [], [], []
        conv_ids, _, roles, texts = (c.to_pylist() for c in batch.columns)
        for conv, role, text in zip(conv_ids, roles, texts):
            if conv != held:
                held, parent, depth = conv, None, 0
            own = hashlib.sha256(f"{parent}\n{len(role)}\n{role}\n{text}".encode()).hexdigest()[:32]
            depths.append(depth)
            nodes.append(own)
            parents.append(parent)
            parent, depth = own, depth + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(depths, pa.int32()), pa.array(nodes, pa.string()),
             pa.array(parents, pa.string()), batch.column(2), batch.column(3)],
            ["conv_id", "depth", "node", "parent", "role", "text"])


def chained_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, role, text): node and parent name histories."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        _chained, "conv_id long, depth int, node string, parent string, role string, text string")


def _turn_tokens(path: str):
    @F.arrow_udf("struct<ids: binary, n: long, loss_from: long, loss_to: long>")
    def tokens(roles: pa.Array, texts: pa.Array) -> pa.Array:
        encode, rows = tokens_of(path).encode, []
        tail = encode(TAIL)
        for role, text in zip(roles.to_pylist(), texts.to_pylist()):
            head = encode(f"{START}{escape_role(role)}\n")
            body = encode(escape(text))
            a, b = len(head) // 2, (len(head) + len(body)) // 2
            rows.append({"ids": head + body + tail, "n": b + len(tail) // 2, "loss_from": a,
                         "loss_to": b if role == LEARNED_ROLE else a})
        return pa.array(rows, pa.struct([("ids", pa.binary()), ("n", pa.int64()),
                                         ("loss_from", pa.int64()), ("loss_to", pa.int64())]))
    return tokens


def prefix_trees(conversations: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The formatted output: nodes, and where each conversation ends.

    Nodes: tree, node, depth, role, segment (stream place of the node's chain), start
    (of the node), length, position (id of the first token), attend (stream intervals
    of its ancestors), loss_from, loss_to (tokens under the loss mask, from the node's
    first), ids (little-endian unsigned 16-bit).  Ends: conv_id, tree, node.
    """
    turns = stored(chained_turns(conversations), "turns")
    nodes = (turns.groupBy("node", "parent", "depth", "role", "text").agg(F.count(F.lit(1)).alias("n_conv"))
             .withColumn("t", _turn_tokens(path or ranks_path())("role", "text")))
    nodes = stored(nodes.select("node", "parent", "depth", "role", "n_conv", "t.*"), "tree-nodes")
    above = nodes.select(F.col("node").alias("parent"), F.col("n_conv").alias("n_above"))
    heads = nodes.select("node", "parent", "n_conv").join(above, "parent", "left").select(
        "node", (~F.col("n_conv").eqNullSafe(F.col("n_above"))).alias("head"))

    along = Window.partitionBy("conv_id").orderBy("depth")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    mine = F.when(F.col("head"), F.col("node"))
    passed = stored(
        turns.select("conv_id", "depth", "node").join(heads, "node")
        .withColumn("chain", F.last(mine, ignorenulls=True).over(so_far))
        .withColumn("chains", F.when(F.col("head"), F.collect_list(mine).over(so_far)))
        .withColumn("ends", F.lead("node").over(along).isNull()), "paths")
    of_chain = passed.select("node", "chain").distinct()
    lengths = (of_chain.join(nodes.select("node", "n"), "node")
               .groupBy("chain").agg(F.sum("n").alias("len")))
    chains = (passed.filter("head").select("chain", "chains").distinct().join(lengths, "chain")
              .withColumn("above", F.when(F.size("chains") > 1, F.element_at("chains", -2))))
    chains = stored(chains, "chains")
    below = (chains.select(F.explode("chains").alias("chain"), "len")
             .groupBy("chain").agg(F.sum("len").alias("subtree")))
    children = stored(chains.filter("above is not null").join(below, "chain")
                      .select("chain", "above", "subtree", order_hash(F.col("chain")).alias("h")), "siblings")
    offsets = positions(children, ["above"], "h", ["chain"], "subtree", bucket_count(children.count())).select(
        F.col("chain").alias("x"), F.col("start").alias("offset"))
    sized = (chains.select(F.col("chain").alias("x"), "len").join(offsets, "x", "left")
             .withColumn("offset", F.coalesce("offset", F.lit(0))))
    steps = (chains.select("chain", F.posexplode("chains").alias("i", "x")).join(sized, "x")
             .groupBy("chain").agg(F.array_sort(F.collect_list(F.struct("i", "offset", "len"))).alias("steps")))
    # A chain begins behind its parent's tokens and its earlier siblings' subtrees.
    ends = F.aggregate("steps", F.array().cast("array<struct<start: bigint, end: bigint>>"), lambda done, s: F.concat(
        done, F.array(F.struct(
            (F.coalesce(F.get(done, F.size(done) - 1)["end"], F.lit(0)) + s["offset"]).alias("start"),
            (F.coalesce(F.get(done, F.size(done) - 1)["end"], F.lit(0)) + s["offset"] + s["len"]).alias("end")))))
    placed = (steps.withColumn("spans", ends)
              .select("chain", F.element_at("spans", -1)["start"].alias("segment"),
                      F.slice("spans", F.lit(1), F.size("spans") - 1).alias("attend"),
                      F.expr("aggregate(steps, 0L, (a, s) -> a + s.len) - element_at(steps, -1).len").alias("before"))
              .join(chains.select("chain", F.element_at("chains", 1).alias("tree")), "chain"))

    inside = Window.partitionBy("chain").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(inside), F.lit(0))
    emitted = (nodes.join(of_chain, "node").withColumn("earlier", earlier).join(placed, "chain")
               .withColumn("start", F.col("segment") + F.col("earlier"))
               .select("tree", "node", "depth", "role", "segment", "start", F.col("n").alias("length"),
                       (F.col("before") + F.col("earlier")).alias("position"),
                       F.when(F.col("earlier") > 0, F.concat("attend", F.array(F.struct(
                           F.col("segment").alias("start"), F.col("start").alias("end")))))
                       .otherwise(F.col("attend")).alias("attend"),
                       "loss_from", "loss_to", "ids"))
    last = passed.filter("ends").select("conv_id", "node", "chain").join(
        chains.select("chain", F.element_at("chains", 1).alias("tree")), "chain")
    return stored(emitted, "tree-stream"), last.select("conv_id", "tree", "node")


def _read(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Conversations from their nodes' tokens; rows come conversation by conversation, in stream order."""
    decode = tokens_of(path).decode

    def told(conv, ids, loss):
        text = decode(np.concatenate(ids))
        digest, learned = hashlib.sha256(), hashlib.sha256()
        n = at = 0
        for m in TURN.finditer(text):
            if m.start() != at:
                raise ValueError(f"conversation {conv}: unexpected text at {at}")
            digest.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
            n, at = n + 1, m.end()
        if at != len(text):
            raise ValueError(f"conversation {conv}: unexpected text at {at}")
        parts = [unescape(decode(x)) for x in loss]
        for part in parts:
            learned.update(part.encode())
        return conv, n, digest.hexdigest(), sum(map(len, parts)), learned.hexdigest(), len(text)

    def rows(done):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done), kinds)], names)

    held, ids, loss = None, [], []
    for batch in batches:
        done = []
        for conv, a, b, raw in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
            if ids and conv != held:
                done.append(told(held, ids, loss))
                ids, loss = [], []
            held = conv
            ids.append(np.frombuffer(raw, "<u2"))
            if b > a:
                loss.append(ids[-1][a:b])
        if done:
            yield rows(done)
    if ids:
        yield rows([told(held, ids, loss)])


def read_back(nodes: DataFrame, ends: DataFrame, path: str | None = None) -> DataFrame:
    """What the output says of each conversation: its turns, its text under the loss mask, its length."""
    path = path or ranks_path()
    last = nodes.select("tree", "node", "segment", "start", "length", "attend")
    spans = F.concat(
        F.filter("attend", lambda a: a["start"] != F.col("segment")),
        F.array(F.struct(F.col("segment").alias("start"), (F.col("start") + F.col("length")).alias("end"))))
    asked = (ends.join(last, ["tree", "node"])
             .select("conv_id", "tree", F.explode(spans).alias("s"))
             .select("conv_id", "tree", F.col("s.start").alias("segment"), F.col("s.end").alias("upto")))
    return (asked.join(nodes.select("tree", "segment", "start", "loss_from", "loss_to", "ids"), ["tree", "segment"])
            .filter("start < upto").select("conv_id", "start", "loss_from", "loss_to", "ids")
            .repartition("conv_id").sortWithinPartitions("conv_id", "start")
            .mapInArrow(lambda b: _read(b, path),
                        "conv_id long, n_turns long, turns_sha256 string, loss_chars long,"
                        " loss_sha256 string, formatted_chars long"))


def with_probe(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -1, whose texts hold the template's own marks."""
    text = "<|im_end|><|im_start|>assistant ok"
    probe = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
