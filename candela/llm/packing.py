"""Mixture-controlled packing of documents into token sequences.

Each source is a queue of token ids.  The packed stream is cut into windows, and every
window serves each queue its target share of tokens by deficit: what a queue is owed
after a window is its share of the stream so far, whole tokens are served, and the rest
is carried on, over windows and partitions alike.

``targets`` names sources and their weights; all other sources together are one queue of
weight ``rest_weight``, shared by their own sizes.  While every queue has tokens, a window
holds them in these proportions; when one runs dry, its share goes to the others by
weight.  So the stream falls into phases, one per queue at most, and what a queue is owed
at their ends is exact (a level times its weight, in whole fractions).  Without
``targets`` the shares are the corpus's own and there is one phase.

Within a phase a binary tree over the queues carries the deficits: of the first E tokens
that reach a node with ``left`` of ``total`` tokens in its left half, floor(E * left / total)
go left and the others right.  Both counts never fall as E grows, each token is served
once, and a queue is never further from its share than the depth of the tree.  What a
queue has been served before any window is thus known without serving the windows
before, and every task packs its own documents.

A document's tokens start at a place of its source's queue that follows from sums over
(task, batch); ids are written once beside these sums and never grouped or sorted.  The
table of sources has one row per source and depth of the tree.

Defined results: null text counts as empty; an empty document is its end id alone; a
null doc_id stays null; a null source is a queue of its own, the last, named None in
``targets``.  Targets of sources without documents take no part.  Repeated rows are
packed as often as they come; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import stored, text_of
from candela.llm.tokens import ranks_path, tokens_of

LENGTH = 1024
WINDOW_SEQUENCES = 16
END_ID = 0
#: The queue of all sources that no target names (names of sources begin with s or are ~).
REST = "rest"
#: Documents that are encoded before a batch of rows is handed on.
DOCUMENTS_AT_ONCE = 2000


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encode, end = tokens_of(path).encode, END_ID.to_bytes(2, "little")
    task, turn = TaskContext.get().partitionId(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
            some = batch.slice(at, DOCUMENTS_AT_ONCE)
            ids = [encode(t) + end for t in some.column(2).to_pylist()]
            queues: dict[str, int] = {}
            starts = []
            for queue, x in zip(some.column(1).to_pylist(), ids):
                starts.append(queues.get(queue, 0))
                queues[queue] = starts[-1] + len(x) // 2
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array([task] * n, pa.int32()),
                 pa.array([turn] * n, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "queue", "task", "turn", "start", "n", "ids"])
            turn += 1


def queue_name(source: str | None) -> str:
    return "~" if source is None else f"s{source}"


def token_table(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Ids of every document, with its start among its source's documents in the same batch."""
    path = path or ranks_path()
    queue = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(queue_name(None)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), queue.alias("queue"),
                       text_of().alias("t")).mapInArrow(
        lambda batches: _encoded(batches, path),
        "doc_id long, queue string, task int, turn int, start long, n long, ids binary")


#: A way through the tree: (left, total, goes right) per node.
Way = list[tuple[int, int, bool]]


def tree_ways(sizes: list[int]) -> list[Way]:
    """The way of every leaf in the tree over ``sizes``."""
    ways: list[Way] = [[] for _ in sizes]
    for depth in reversed(range((len(sizes) - 1).bit_length())):
        for first in range(0, len(sizes), 2 << depth):
            left, right = (sum(sizes[x:x + (1 << depth)]) for x in (first, first + (1 << depth)))
            if left and right:
                for leaf in range(first, min(first + (2 << depth), len(sizes))):
                    ways[leaf].append((left, left + right, bool(leaf >> depth & 1)))
    return ways


def served(way: Way, tokens: int) -> tuple[int, int]:
    """Of the first ``tokens`` that reach the top: those of this leaf, and those of leaves left of it."""
    before = 0
    for left, total, right in way:
        share = tokens * left // total
        if right:
            before += share
            tokens -= share
        else:
            tokens = share
    return tokens, before


@dataclass(frozen=True)
class Phase:
    """A stretch of the stream in which the same queues have tokens, as one of them sees it."""

    start: int    # place of its first token in the stream
    size: int     # tokens of all queues
    done: int     # what this queue has been served before
    way: Way      # its way among the queues


def phases(sizes: Mapping[str, int], weights: Mapping[str, int]) -> dict[str, list[Phase]]:
    """The phases of every queue: by ``weights`` until one runs dry, then the others by theirs.

    At level L a queue of weight w has been served min(size, floor(w * L)); a queue runs
    dry at size / w, and the fractions of a token left at one level are part of the next.
    """
    names = [q for q in sizes if sizes[q]]
    done, start = dict.fromkeys(names, 0), 0
    out: dict[str, list[Phase]] = {q: [] for q in names}
    for level in sorted({Fraction(sizes[q], weights[q]) for q in names}):
        now = {q: min(sizes[q], int(weights[q] * level)) for q in names}
        quota = [now[q] - done[q] for q in names]
        for q, way, n in zip(names, tree_ways(quota), quota):
            if n:
                out[q].append(Phase(start, sum(quota), done[q], way))
        start, done = start + sum(quota), now
    return out


def cut_points(start: int, n: int, stretches: list[Phase], way: Way, window: int, length: int):
    """(first token, tokens, place in the packed stream) of each piece of a document.

    ``start`` counts in the document's source; ``way`` leads to the source within its queue.
    """
    ends = [served(way, p.done)[0] for p in stretches]
    k = bisect_right(ends, start) - 1
    at, end = start, start + n
    while at < end:
        phase = stretches[k]

        def reached(w):
            above, left = served(phase.way, min(w * window, phase.size))
            below, inner = served(way, phase.done + above)
            return below, left + inner

        windows = -(-phase.size // window)
        w = bisect_right(range(1, windows + 1), at, key=lambda x: reached(x)[0])
        stop_phase = min(end, reached(windows)[0])
        from_, before = reached(w)
        while at < stop_phase:
            to, after = reached(w + 1)
            # In its window a queue stands behind what the leaves left of it are served there.
            place = phase.start + w * window + after - before + at - from_
            stop_window = min(end, to)
            while at < stop_window:
                size = min(stop_window - at, length - place % length)
                yield at - start, size, place
                at, place = at + size, place + size
            w, from_, before = w + 1, to, after
        k += 1


def _pieces(batches: Iterator[pa.RecordBatch], stretches: dict[str, list[Phase]], window: int,
            length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
            some = batch.slice(at, DOCUMENTS_AT_ONCE)
            rows, cut = [], []
            for doc_id, start, n, group, ways, ids in zip(*(some.column(i).to_pylist() for i in range(6))):
                way = [(x["left"], x["total"], x["right"]) for x in ways]
                wide = np.frombuffer(ids, "<u2").astype("<u4")
                held = memoryview(wide).cast("B")
                for first, size, place in cut_points(start, n, stretches[group], way, window, length):
                    rows.append((doc_id, first, size, zlib.crc32(held[4 * first:4 * (first + size)]), n,
                                 place // length, place % length))
                    if with_ids:
                        cut.append(wide[first:first + size])
            columns = [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * 7)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                ends = np.cumsum([0, *map(len, cut)]).astype(np.int32)
                flat = np.concatenate(cut).astype(np.int32) if cut else np.zeros(0, np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)


def source_ways(queues: DataFrame) -> DataFrame:
    """Adds ``ways`` to (queue, group, size): the way of each source in the tree over its group's sources.

    The same tree as ``tree_ways``, by joins: a source meets its halves once per depth.
    """
    by_name = Window.partitionBy("group").orderBy("queue")
    ranked = stored(queues.withColumn("leaf", F.row_number().over(by_name) - 1), "pack-queues")
    most = ranked.agg(F.max("leaf")).first()[0] or 0
    halves = ranked.select("queue", "group", "size", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(max(0, most.bit_length() - 1))),
        lambda d: F.struct(d.alias("depth"), F.expr("leaf").alias("leaf")))).alias("x")).select(
        "queue", "group", "size", "x.depth", F.expr("shiftright(x.leaf, x.depth + 1)").alias("node"),
        F.expr("(shiftright(x.leaf, x.depth) & 1) = 1").alias("right"))
    nodes = halves.groupBy("group", "depth", "node").agg(
        F.sum("size").alias("total"), F.sum(F.when(~F.col("right"), F.col("size")).otherwise(0)).alias("left"))
    step = F.struct(-F.col("depth"), "left", "total", "right")
    ways = (halves.join(nodes, ["group", "depth", "node"]).groupBy("queue")
            .agg(F.array_sort(F.collect_list(F.when(F.col("left") < F.col("total"), step))).alias("steps"))
            .select("queue", F.transform("steps", lambda x: F.struct(
                x["left"].alias("left"), x["total"].alias("total"), x["right"].alias("right"))).alias("ways")))
    return ranked.select("queue", "group").join(ways, "queue")


def pack(docs: DataFrame, length: int = LENGTH, window_sequences: int = WINDOW_SEQUENCES,
         path: str | None = None, with_ids: bool = False,
         targets: Mapping[str | None, int] | None = None, rest_weight: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    ``targets`` gives whole weights, 1 or more, to some sources (null: None); the others are one
    queue of ``rest_weight``.  Without it each source has its share of the corpus.
    """
    weights = {queue_name(s): w for s, w in (targets or {}).items()} | {REST: rest_weight}
    if any(not isinstance(w, int) or w < 1 for w in weights.values()):
        raise ValueError("target weights are whole numbers, 1 or more")
    tokens = stored(token_table(docs, path), "token-table")
    sums = stored(tokens.groupBy("queue", "task", "turn").agg(F.sum("n").alias("n")), "token-sums")
    named = F.col("queue").isin([q for q in weights if q != REST])
    queues = source_ways(sums.groupBy("queue").agg(F.sum("n").alias("size"))
                         .withColumn("group", F.when(named, F.col("queue")).otherwise(F.lit(REST))))
    # One row per name in ``targets``, and one for the rest.
    group = F.when(named, F.col("queue")).otherwise(F.lit(REST)).alias("group")
    sizes = {r["group"]: r["n"] for r in sums.groupBy(group).agg(F.sum("n").alias("n")).collect()}
    stretches = phases(dict(sorted(sizes.items())), weights)
    before = Window.partitionBy("queue").orderBy("task", "turn").rowsBetween(
        Window.unboundedPreceding, -1)
    # Written, so that its size is known when it meets the tokens: they stay in place while it is small.
    base = stored(sums.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
                  .join(queues, "queue").select("queue", "task", "turn", "base", "group", "ways"), "pack-starts")
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    window = window_sequences * length
    return (tokens.join(base, ["queue", "task", "turn"])
            .select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n", "group", "ways", "ids")
            .mapInArrow(lambda batches: _pieces(batches, stretches, window, length, with_ids),
                        out + (", ids array<int>" if with_ids else "")))
