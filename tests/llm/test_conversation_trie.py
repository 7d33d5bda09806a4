import hashlib
import random
from collections import defaultdict
from zlib import crc32

from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.llm import conversation_trie as trie
from candela.llm.conversation_trie import conversation_trie, ordered_turns, subtree_totals
from llm_helpers import same_rows

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                      T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, sha(role), sha(text), role, text))
    own = {c: [x[4:] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        whole = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(kids[p]), leaves[p],
                   saved[p], sha(",".join(map(str, ends[p])))) for p in members)


def got(rows):
    return sorted(tuple(r) for r in rows.collect())


def key(rows):
    return sorted(rows, key=repr)


def odd_turns():
    rng = random.Random(3)
    rows = [(c, t, ("user", "assistant")[t % 2], f"text {rng.randrange(3)} é") for c in range(60) for t in range(rng.randrange(1, 12))]
    rows += [(-c, t, "user", "minus") for c in range(1, 9) for t in range(c)]
    rows += [(503, 0, "user", "no base"), (504, 0, "user", "no base either")]           # conversation 500 is absent
    rows += [(600, None, None, None), (600, 0, "", ""), (600, 0, "b", "tie"), (600, 0, "a", "tie"), (600, 0, "a", "tie")]
    rows += [(None, 0, "user", "lost"), (None, None, None, None)]
    rows += [(700, t, "user", "x" * (t % 7)) for t in range(900)]                        # one long unary chain
    rows += [(705, t, "user", "x" * (t % 7) + ("!" if t == 700 else "")) for t in range(900)]
    rows += [(800 + 5 * i, 0, "user", "all alike") for i in range(300)]                  # many ends at one node
    rows += [(9000, 0, "user", "long " * 60_000)]
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(trie, "LISTED", 100)  # the longer list goes through the stream
    rows = odd_turns()
    frame = spark.createDataFrame(rows, TURNS).repartition(5)
    out = conversation_trie(frame)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert key(tuple(r) for r in out.collect()) == key(brute(rows))


def test_turns_of_one_conversation_are_spread(spark):
    rows = spark.range(40_000).select(F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                      F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    placed = ordered_turns(rows)
    assert placed.agg(F.count_distinct("place"), F.min("place"), F.max("place")).first()[:] == (40_000, 0, 39_999)
    assert placed.groupBy("part").count().agg(F.max("count")).first()[0] < 4000


def test_contraction_of_chains_stars_and_brooms(spark):
    rng = random.Random(8)
    parent = {0: None}
    for i in range(1, 200):                      # a chain
        parent[i] = i - 1
    for i in range(200, 400):                    # a star on its middle
        parent[i] = 100
    for i in range(400, 700):                    # twigs anywhere
        parent[i] = rng.randrange(i)
    depth, kids = {}, defaultdict(int)
    for i, p in parent.items():
        depth[i] = 0 if p is None else depth[p] + 1
        kids[p] += 1
    leaves, saved = {}, {}
    for i in sorted(parent, reverse=True):
        leaves[i] = leaves.get(i, 0) + (kids[i] == 0)
        saved[i] = saved.get(i, 0) + i
        if parent[i] is not None:
            leaves[parent[i]] = leaves.get(parent[i], 0) + leaves[i]
            saved[parent[i]] = saved.get(parent[i], 0) + saved[i]
    nodes = spark.createDataFrame([(str(i), None if p is None else str(p), depth[i], kids[i], i) for i, p in parent.items()],
                                  "id string, parent string, depth long, n_children long, saved long")
    assert {int(r.id): (r.n_leaves, r.saved_tokens) for r in subtree_totals(nodes).collect()} == {
        i: (leaves[i], saved[i]) for i in parent}


def test_empty_clashing_and_turnless(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_trie(empty).count() == 0
    assert conversation_trie(spark.createDataFrame([(None, 0, "user", "x")], TURNS)).count() == 0
    # Its base is absent and its own turns all stand before its h: the root alone.
    alone = next(c for c in range(1, 100) if c % 5 and crc32(str(c).encode()) % 9 > 1)
    rows = [(alone, 0, "user", "x")]
    frame = spark.createDataFrame(rows, TURNS)
    assert got(conversation_trie(frame)) == brute(rows) and len(brute(rows)) == 1
    rows = [r for r in odd_turns() if r[0] is not None and r[0] < 20]
    frame = spark.createDataFrame(rows, TURNS)
    clash = frame.select("*", *[F.lit(1).alias(c) for c in ("id", "parent", "depth", "place", "part", "n", "h", "base", "row", "seq", "kids")])
    assert same_rows(conversation_trie(frame), conversation_trie(clash))
