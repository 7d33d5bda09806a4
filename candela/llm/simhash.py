"""SimHash near-duplicates by BK-trees.

A text's fingerprint has 64 bits, each the majority of that bit over the hashes of
its word shingles.  Fingerprints link at ``radius`` or fewer differing bits, and
documents of one connected component form a group.

Two fingerprints within the radius agree wholly on one of radius + 1 bit bands, so
distinct fingerprints are dealt to shards by (band, its bits); a shard too large for
one tree is dealt again by bands of its remaining bits, down to shards that cannot
exceed the limit.  Every shard gets a BK-tree (children keyed by the Hamming distance
to their parent) beside its own fingerprints, and a query follows only edges within
the radius.  Trees are thus sent to their queries by the shuffle, in bounded pieces;
sending every tree to every executor would need all pairs of shards.

Links found in a shard are reduced to a spanning forest there, and the forests are
joined into components.

Defined results: null text counts as empty; texts without words have fingerprint zero
and link like any other.  A null doc_id is never a component's name unless all ids
are null.  Components may share a name (null ids, or one id with several texts); ``root``,
the smallest fingerprint of a component, tells them apart.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import keep_rows, row_id, stored, text_of
from candela.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
TREE_SIZE = 4096
#: (query, node) pairs that a tree search holds at once.
FRONTIER = 1_000_000


def text_fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a UTF-8 text (0 without words)."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # on bytes: lowers A-Z only, splits at ASCII white space
    if not words:
        return 0
    if len(words) <= shingle:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter((xxh64_intdigest(x, seed) for x in runs), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(some.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed long."""

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        found = (text_fingerprint(x, shingle, seed) for x in texts.cast(pa.binary()).to_pylist())
        return pa.array(np.fromiter(found, np.uint64, len(texts)).view(np.int64))

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("t"))
    return text.select("doc_id", F.xxhash64("t").alias("text_hash"), fingerprint("t").alias("fp"))


class Trees:
    """One BK-tree for each run of equal ``group`` in ``points`` (distinct within a group)."""

    def __init__(self, points: np.ndarray, group: np.ndarray):
        n = len(points)
        self.points = points
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, int)
        self.sizes = np.diff(np.r_[first, n])
        self.root = np.repeat(first, self.sizes)
        edges, children = [], []
        active = np.setdiff1d(np.arange(n), first, assume_unique=True)
        at = self.root[active]
        while len(active):  # all trees grow a level at a time
            key = at * 65 + np.bitwise_count(points[active] ^ points[at])
            order = np.argsort(key, kind="stable")
            active, key = active[order], key[order]
            head = np.r_[True, key[1:] != key[:-1]]
            node = np.repeat(active[head], np.diff(np.r_[np.flatnonzero(head), len(key)]))
            edges.append(key[head])
            children.append(active[head])
            active, at = active[~head], node[~head]
        edges = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        children = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(edges)
        self.edges, self.children = edges[order], children[order]

    def near(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, other), other < query, within the radius, a level of the trees at a time."""
        q, node = queries, self.root[queries]
        while len(q):
            d = np.bitwise_count(self.points[q] ^ self.points[node]).astype(np.int64)
            hit = (d <= radius) & (node < q)
            if hit.any():
                yield q[hit], node[hit]
            lo = np.searchsorted(self.edges, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.edges, node * 65 + np.minimum(d + radius, 64), "right")
            many = hi - lo
            q = np.repeat(q, many)
            offset = np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many)
            node = self.children[np.repeat(lo, many) + offset]

    def forest(self, radius: int) -> np.ndarray:
        """For each point the smallest point it reaches by links in its tree."""
        label = np.arange(len(self.points))
        cost = np.cumsum(np.repeat(self.sizes, self.sizes))
        blocks = np.searchsorted(cost, np.arange(FRONTIER, cost[-1] + FRONTIER, FRONTIER)) if len(cost) else []
        start = 0
        for end in [*blocks, len(label)]:
            if end <= start:
                continue
            for a, b in self.near(np.arange(start, end), radius):
                while True:
                    x, y = label[a], label[b]
                    apart = x != y
                    if not apart.any():
                        break
                    a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                    np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
                    while (label[label] != label).any():
                        label = label[label]
            start = end
        return label


def _tree_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Forest links of the shards in a partition sorted by (path, bits)."""
    def links(path, bits, fp):
        turn = np.cumsum(np.r_[True, (path[1:] != path[:-1]) | (bits[1:] != bits[:-1])])
        label = Trees(fp.view(np.uint64), turn).forest(radius)
        a = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[label[a]])], ["a", "b"])

    held = None
    for batch in batches:
        now = [batch.column(i).to_numpy() for i in range(3)]
        held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
        path, bits, _ = held
        last = np.flatnonzero((path != path[-1]) | (bits != bits[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0  # the last shard may go on in the next batch
        if cut:
            yield links(*(x[:cut] for x in held))
            held = [x[cut:] for x in held]
    if held is not None and len(held[0]):
        yield links(*held)


def _bands(free: list[int], parts: int) -> list[list[int]]:
    return [free[len(free) * i // parts:len(free) * (i + 1) // parts] for i in range(parts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(points: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """(a, b): links that span every component of ``points`` (distinct longs ``fp``; stable)."""
    mask = lambda bits: sum(1 << i for i in bits)
    paths = [(mask(b), sorted(set(range(64)) - set(b))) for b in _bands(list(range(64)), radius + 1)]
    deal = lambda nos: F.explode(F.array(*[F.struct(
        F.lit(no).alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(paths[no][0])).cast("long")).alias("bits"))
        for no in nos]))
    rows = points.select("fp", deal(range(len(paths))).alias("s")).select("s.path", "s.bits", "fp")
    ready, level = [], list(range(len(paths)))
    while True:
        # Below this many free bits no shard can exceed the limit.
        if max(len(paths[no][1]) for no in level) <= tree_size.bit_length() - 1:
            ready.append(rows)
            break
        large = stored(rows.groupBy("path", "bits").count().filter(F.col("count") > tree_size)
                       .select("path", "bits"), "large-shards")
        if large.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(large, ["path", "bits"], "left_anti"))
        children: dict[int, list[int]] = {}
        for no in level:
            fixed, free = paths[no]
            for band in _bands(free, radius + 1):
                children.setdefault(no, []).append(len(paths))
                paths.append((fixed | mask(band), sorted(set(free) - set(band))))
        again = rows.join(large, ["path", "bits"], "left_semi")
        parts = [again.filter(F.col("path") == no).select("fp", deal(nos).alias("s"))
                 .select("s.path", "s.bits", "fp") for no, nos in children.items()]
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        rows = stored(rows, "shard-rows")
        level = [no for nos in children.values() for no in nos]
    every = ready[0]
    for more in ready[1:]:
        every = every.unionByName(more.select("path", "bits", "fp"))
    return (every.select("path", "bits", "fp").repartition("path", "bits")
            .sortWithinPartitions("path", "bits", "fp")
            .mapInArrow(lambda batches: _tree_links(batches, radius), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, radius: int = RADIUS,
                    tree_size: int = TREE_SIZE) -> DataFrame:
    """One row per document: doc_id, text_hash, fingerprint (hex), root, component_id, group_size."""
    rows = stored(fingerprints(docs, shingle, seed), "fingerprints")
    points = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"),
                                           F.count(F.lit(1)).alias("n")), "points")
    roots = components(near_links(points.select("fp"), radius, tree_size))
    named = (points.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    groups = named.groupBy("root").agg(F.min("first_id").alias("component_id"),
                                       F.sum("n").alias("group_size"))
    known = named.select("fp", "root").join(groups, "root").select("fp", "root", "component_id", "group_size")
    return rows.join(known, "fp").select(
        "doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "root", "component_id", "group_size")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component: the smallest id (null last), then hash; columns unchanged."""
    found = near_duplicates(docs.select("doc_id", "text"), **options)
    first = F.min(F.struct(F.col("doc_id").isNull(), row_id().alias("_id"), F.col("text_hash").alias("_th")))
    kept = found.groupBy("root").agg(first.alias("k")).select("k._id", "k._th")
    return keep_rows(docs, kept, F.xxhash64(text_of()))
