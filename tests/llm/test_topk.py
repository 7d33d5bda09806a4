import math
import random

import numpy as np

from candela.llm.topk import KdTree, scaled, top_k
from llm_helpers import same_rows

SCHEMA = "vec_id long, embedding array<float>"


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, k=5, every=50):
    out = []
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if sound(v)]
    for row, (i, q) in enumerate(whole):
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c)), j) for at, (j, c) in enumerate(whole) if at != row and len(c) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def asked(spark, rows, every=50, **options):
    v = scaled(spark.createDataFrame(rows, SCHEMA))
    return sorted(tuple(r) for r in top_k(v, v.filter(f"vec_id % {every} = 0"), **options).collect())


def vectors(n, dim=16, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # one very common vector
    rows += [(2000, None), (2050, [1.0] * (dim - 1) + [None]), (2100, [float("nan")] * dim), (2150, [float("inf")] + [0.0] * (dim - 1)),
             (2200, []), (2250, []), (2300, [1.0, -1.0]), (2350, [0.0, 0.0]), (2351, [-2.0, 1.0]), (2400, [0.0] * dim)]
    return rows


def test_matches_brute_force(spark):
    rows = vectors(700)
    want = brute(rows)
    assert asked(spark, rows) == want
    assert asked(spark, rows, shard_vectors=64, query_block=3, shards_in_turn=2) == want
    assert asked(spark, rows, every=1, shard_vectors=100, query_block=64) == brute(rows, every=1)


def test_rows_of_one_id_find_each_other_and_large_scores_are_exact(spark):
    rows = [(0, [1.0, 2.0]), (0, [5.0, 5.0]), (1, [1.0, 0.0]), (50, [5.0, 5.0]), (50, [5.0, 5.0])]
    want = brute(rows, k=2)
    assert (0, 1, 0, 256 * 256 * 15) in want and asked(spark, rows, k=2) == want
    rng = random.Random(6)
    big = [(i, [float(np.float32(rng.choice([-1, 1]) * rng.uniform(2e5, 4e5))) + rng.randrange(8) for _ in range(6)]) for i in range(300)]
    want = brute(big)
    assert max(abs(r[3]) for r in want) > 2 ** 53 and (asked(spark, big) == want) is True
    assert (asked(spark, big, shard_vectors=40) == want) is True
    past = asked(spark, [(0, [1e20]), (1, [1e20]), (2, [-1e20])])
    assert past == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 2, -2 ** 63)]


def test_search_visits_few_leaves_when_boxes_tell_apart():
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 4000, (40, 8)).round()
    points = (centres[rng.integers(0, 40, 4000)] + rng.normal(0, 20, (4000, 8))).round()
    tree = KdTree(np.arange(4000), points, leaf=64)
    leaves = [r for r in tree.rows if r is not None]
    assert sorted(np.concatenate(leaves).tolist()) == list(range(4000))
    seen = []
    tree.rows = Watched(tree.rows, seen)
    q = points[5]
    best = []
    tree.search(5, q, tree.bounds(q[None])[0], best, 5)
    scores = points @ q
    want = sorted(((s, -i) for i, s in enumerate(scores.tolist()) if i != 5), reverse=True)[:5]
    assert sorted(best, reverse=True) == want
    assert 0 < len(seen) < len(leaves) / 4


class Watched(list):
    def __init__(self, rows, seen):
        super().__init__(rows)
        self.seen = seen

    def __getitem__(self, node):
        self.seen.append(node)
        return super().__getitem__(node)


def test_fewer_candidates_than_k(spark):
    assert asked(spark, [(0, [1.0, 2.0]), (1, [3.0, 1.0])]) == [(0, 1, 1, 256 * 256 * 5)]
    assert asked(spark, [(0, [1.0])]) == []
    assert asked(spark, []) == []


def test_extra_columns(spark):
    rows = vectors(120)
    from pyspark.sql import functions as F

    plain = spark.createDataFrame(rows, SCHEMA)
    more = plain.select("*", *[F.lit("x").alias(c) for c in ("dim", "v", "key", "shard", "lane", "rank", "score")])
    a, b = scaled(plain), scaled(more)
    assert same_rows(top_k(a, a.filter("vec_id % 50 = 0")), top_k(b, b.filter("vec_id % 50 = 0")))


def test_vectors_without_an_id_take_no_part(spark):
    rows = vectors(60)
    assert asked(spark, rows + [(None, rows[0][1]), (None, [9.0] * 16), (None, None)]) == brute(rows)
