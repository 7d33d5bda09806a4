"""Exact top-k search by inner product, with a KD-tree per shard.

Vectors become integers floor(scale * x) and are dealt to shards of bounded size.
Each shard's tree splits at medians of the widest dimension and keeps tight bounding
boxes.  A query goes best box first: a box's bound is the sum over dimensions of the
larger of query * low and query * high, and the search ends when no open box reaches
the query's kth score.  Queries travel in blocks; the task that holds a block takes
the shard trees one after another and carries each query's kth score on, so later
trees are searched only where they can still matter.

Trees and query blocks are rows of bounded size that meet in a join on the shard's
number: the stated queries against all vectors, in blocks, never row by row.

Defined results: vectors that are null, or hold null or non-finite components, take no
part, as queries or candidates; nor do vectors without a vec_id.  A query finds only vectors of its own length; a query
without candidates has no rows.  Ties go to the smaller vec_id.  A query is a row: only that
row itself is no candidate, other rows with its vec_id are, and each is a query of its own.
Scores are exact: where products may pass 2^53, boxes' bounds take their rounding into
account and scores are added as whole numbers; one beyond a long is given as the nearest
long.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import stored

SHARD_VECTORS = 4096
QUERY_BLOCK = 1024
LEAF = 128
#: Relative rounding of a bound's sum, for vectors of up to a thousand dimensions and more.
ROUNDING = 1e-12
LONG = (1 << 63) - 1
#: Shards that one task searches for one block, carrying the kth scores along.
SHARDS_IN_TURN = 4


class KdTree:
    """Median splits with tight boxes over integer vectors (held as doubles); ``marks`` tell rows apart."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, marks: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors
        self.marks = ids if marks is None else marks
        self.largest = float(np.abs(vectors).max(initial=0.0))
        order = np.arange(len(ids))
        self.low, self.high, self.child, self.rows = [], [], [], []
        self._grow(order, leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        mine = len(self.rows)
        some = self.vectors[rows]
        low, high = some.min(0), some.max(0)
        self.low.append(low)
        self.high.append(high)
        self.child.append(None)
        self.rows.append(rows)
        wide = int(np.argmax(high - low)) if len(low) else 0
        if len(rows) > leaf and len(low) and high[wide] > low[wide]:
            order = rows[np.argsort(some[:, wide], kind="stable")]
            half = len(order) // 2
            self.rows[mine] = None
            self.child[mine] = (self._grow(order[:half], leaf), self._grow(order[half:], leaf))
        return mine

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No vector in a node's box scores above this (queries x nodes).

        sum(max(q * low, q * high)) = max(q, 0) . high + min(q, 0) . low
        """
        found = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        if not self.small(queries):  # rounded: each bound rises by more than all its additions can lose
            found += ROUNDING * (np.abs(queries) @ np.maximum(np.abs(self.low), np.abs(self.high)).T)
        return found

    def small(self, queries: np.ndarray) -> bool:
        """Whether doubles hold every score, and every sum on the way to it, exactly."""
        return self.largest * float(np.abs(queries).max(initial=0.0)) * max(1, queries.shape[-1]) < 2.0 ** 53

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self.small(query):
            return self.vectors[rows] @ query
        whole = [int(x) for x in query]
        return np.array([sum(int(a) * b for a, b in zip(v, whole)) for v in self.vectors[rows].tolist()] + [None], object)[:-1]

    def search(self, mark: int, query: np.ndarray, bound: np.ndarray, best: list[tuple[float, int]],
               k: int) -> None:
        """Improve ``best``, a heap of the k highest (score, -id), best box first."""
        open_boxes = [(-bound[0], 0)]
        while open_boxes:
            reach, node = heapq.heappop(open_boxes)
            if len(best) == k and -reach < best[0][0]:
                return  # an equal score may still win by its smaller id
            if self.child[node] is not None:
                for c in self.child[node]:
                    if len(best) < k or bound[c] >= best[0][0]:
                        heapq.heappush(open_boxes, (-bound[c], c))
                continue
            rows = self.rows[node]
            ids, scores = self.ids[rows], self.scores(rows, query)
            keep = self.marks[rows] != mark
            if len(best) == k:
                keep &= (scores >= best[0][0]).astype(bool)
            ids, scores = ids[keep], scores[keep]
            if len(ids) > k:
                first = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[first], scores[first]
            for score, i in zip(scores.tolist(), ids.tolist()):
                if len(best) < k:
                    heapq.heappush(best, (score, -i))
                elif (score, -i) > best[0]:
                    heapq.heapreplace(best, (score, -i))


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, dim, vec_id, v, mark) sorted by (key, dim) as blocks of at most ``size`` vectors each."""
    def block(key, dim, ids, marks, flat):
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.int64()), pa.array([dim], pa.int32()),
             pa.array([np.asarray(ids, np.int64).tobytes()], pa.binary()),
             pa.array([np.asarray(marks, np.int64).tobytes()], pa.binary()),
             pa.array([np.concatenate(flat).astype(np.float64).tobytes() if dim else b""], pa.binary())],
            ["key", "dim", "ids", "marks", "vectors"])

    held, ids, marks, flat = None, [], [], []
    for batch in batches:
        keys, dims, vec_ids = (batch.column(i).to_pylist() for i in range(3))
        lists, own = batch.column(3), batch.column(4).to_pylist()
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        for i, here in enumerate(zip(keys, dims)):
            if ids and (here != held or len(ids) >= size):
                yield block(*held, ids, marks, flat)
                ids, marks, flat = [], [], []
            held = here
            ids.append(vec_ids[i])
            marks.append(own[i])
            flat.append(values[offsets[i]:offsets[i + 1]])
    if ids:
        yield block(*held, ids, marks, flat)


def blocked(vectors: DataFrame, size: int, parts: int) -> DataFrame:
    """Rows (dim, ids, marks, vectors) of at most ``size`` vectors, dealt by a hash of the id."""
    return (vectors.withColumn("key", F.pmod(F.xxhash64("vec_id"), F.lit(parts)))
            .select("key", "dim", "vec_id", "v", "mark").repartition(max(1, min(parts, 2000)), "key")
            .sortWithinPartitions("key", "dim")
            .mapInArrow(lambda b: _blocks(b, size), "key long, dim int, ids binary, marks binary, vectors binary")
            .drop("key"))


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Best candidates of query blocks; rows (run, block, q_ids, q_marks, q_vectors, ids, marks, vectors, dim) come run by run."""
    def result(block, q_ids, best):
        rows = [(q, -i, s) for q, heap in zip(q_ids.tolist(), best) for s, i in heap]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([max(-LONG - 1, min(LONG, int(r[2]))) for r in rows], pa.int64()),
             pa.array([block] * len(rows), pa.int64()),
             pa.array([i for i, heap in enumerate(best) for _ in heap], pa.int64())],
            ["query_id", "vec_id", "score", "block", "slot"])

    run = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["run"] != run:
                if run is not None:
                    yield result(block, q_ids, best)
                run, block = row["run"], row["block"]
                q_ids, q_marks = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_marks"], np.int64)
                queries = np.frombuffer(row["q_vectors"]).reshape(len(q_ids), row["dim"])
                best = [[] for _ in q_ids]
            ids = np.frombuffer(row["ids"], np.int64)
            tree = KdTree(ids, np.frombuffer(row["vectors"]).reshape(len(ids), row["dim"]),
                          marks=np.frombuffer(row["marks"], np.int64))
            bounds = tree.bounds(queries)
            for i, q in enumerate(queries):
                tree.search(int(q_marks[i]), q, bounds[i], best[i], k)
    if run is not None:
        yield result(block, q_ids, best)


def scaled(embeddings: DataFrame, scale: float = 256) -> DataFrame:
    """(vec_id, dim, v, mark): vectors as whole numbers, without those that cannot take part; stored.

    ``mark`` numbers the rows.
    """
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    sound = F.forall("embedding", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return stored(embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
                  .select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), v.alias("v"),
                          F.monotonically_increasing_id().alias("mark")), "scaled-vectors")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_vectors: int = SHARD_VECTORS,
          query_block: int = QUERY_BLOCK, shards_in_turn: int = SHARDS_IN_TURN) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` best of ``vectors`` (both vec_id, dim, v, mark)."""
    n, m = vectors.count(), queries.count()
    trees = stored(blocked(vectors, shard_vectors, -(-n // shard_vectors) or 1), "shards")
    blocks = stored(blocked(queries, query_block, -(-m // query_block) or 1), "query-blocks")
    numbered = trees.withColumn("shard", F.monotonically_increasing_id())
    numbered = stored(numbered.withColumn("lane", F.pmod(F.xxhash64("shard"), F.lit(
        -(-n // (shard_vectors * shards_in_turn)) or 1))), "shard-trees")
    # Every block visits every lane of shards: explode block rows over the lanes, then an equi-join.
    lanes = numbered.select("lane", "dim").distinct()
    asked = stored(blocks.withColumn("block", F.monotonically_increasing_id()), "query-rows")
    lane_lists = lanes.groupBy("dim").agg(F.collect_list("lane").alias("lanes"))
    visits = (asked.join(lane_lists, "dim")
              .select("block", "dim", F.col("ids").alias("q_ids"), F.col("marks").alias("q_marks"), F.col("vectors").alias("q_vectors"),
                      F.explode("lanes").alias("lane")))
    met = (visits.join(numbered, ["lane", "dim"])
           .withColumn("run", F.xxhash64("block", "lane", "dim"))
           .select("run", "block", "q_ids", "q_marks", "q_vectors", "dim", "ids", "marks", "vectors"))
    found = (met.repartition("run").sortWithinPartitions("run")
             .mapInArrow(lambda b: _searched(b, k), "query_id long, vec_id long, score long, block long, slot long"))
    order = Window.partitionBy("query_id", "block", "slot").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
