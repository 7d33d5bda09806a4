import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from candela.llm.components import components
from candela.llm.simhash import Trees, drop_near_duplicates, near_duplicates, near_links, text_fingerprint
from llm_helpers import DOCUMENTS, SF_SMALL, same_rows, words


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(points, radius):
    points = np.asarray(points, np.uint64)
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= radius
    label = np.arange(len(points))
    while True:
        new = np.array([label[n].min() for n in near])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def test_fingerprints(odd):
    for r in odd.collect():
        assert text_fingerprint((r.text or "").encode()) == brute_fingerprint(r.text)


def test_groups_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rng = random.Random(3)
    near = []
    for i in range(40):
        base = words(rng, 400).split()
        for j in range(4):
            base[rng.randrange(400)] = f"new{i}{j}"
            near.append((1000 + 4 * i + j, " ".join(base)))
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    rows = docs.collect()
    label = brute_groups([brute_fingerprint(r.text) for r in rows], 2)
    least = {x: min(r.doc_id for r, y in zip(rows, label) if y == x) for x in set(label)}
    want = {r.doc_id: least[x] for r, x in zip(rows, label)}
    assert len(set(want.values())) < len(rows) - 10
    for tree_size in (4096, 8):
        got = near_duplicates(docs, tree_size=tree_size).collect()
        assert {r.doc_id: r.component_id for r in got} == want
        assert all(int(r.fingerprint, 16) == brute_fingerprint(t) for r, t in zip(
            sorted(got, key=lambda r: r.doc_id), [r.text for r in sorted(rows, key=lambda r: r.doc_id)]))


def dense(rng, n):
    """Distinct fingerprints of which many lie within a few bits of one of two centres."""
    out = set()
    while len(out) < n:
        x = rng.choice([0x1234567890ABCDEF, 0xFEDCBA9876543210])
        for _ in range(rng.randrange(9)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


def test_trees_find_all_pairs():
    rng = random.Random(1)
    points = np.array(dense(rng, 500), np.uint64)
    group = np.sort(np.array([rng.randrange(3) for _ in points]))
    trees = Trees(points, group)
    found = {(int(a), int(b)) for q, o in trees.near(np.arange(500), 3) for a, b in zip(q, o)}
    d = np.bitwise_count(points[:, None] ^ points[None, :])
    assert found == {(i, j) for i in range(500) for j in range(i) if d[i, j] <= 3 and group[i] == group[j]}


def test_crowded_shards_are_split_without_loss(spark):
    points = np.array(dense(random.Random(2), 1500), np.uint64)
    frame = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
    roots = components(near_links(frame, 2, tree_size=32)).collect()
    got = {r.node: r.root for r in roots}
    label = brute_groups(points, 2)
    signed = points.view(np.int64).tolist()
    for i, x in enumerate(signed):
        same = [signed[j] for j in np.flatnonzero(label == label[i])]
        assert got.get(x, x) == (min(same) if len(same) > 1 else x)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(5, 5), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 180)}, 200: 200, 201: 200}


def test_edges(odd, clashing, none):
    assert near_duplicates(none).count() == 0
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.doc_id in (100, 101, 102)} == {100}
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    # One row per component: a name may stand for two of them (here the two texts of 103).
    assert kept.count() == len({r.root for r in rows})
    assert drop_near_duplicates(clashing).columns == clashing.columns
    assert drop_near_duplicates(clashing).count() == kept.count()
    assert drop_near_duplicates(none).count() == 0
    assert same_rows(near_duplicates(odd), near_duplicates(clashing))
    assert kept.filter(F.col("doc_id").isin(101, 102)).count() == 0


def test_components_that_share_a_name_keep_one_document_each(spark):
    rng = random.Random(8)
    a, b, c, d, e = (words(rng, 300) for _ in range(5))
    rows = [(None, a), (None, a), (None, b), (7, c), (7, c), (7, d), (None, e), (9, e), (8, e)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS).repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in drop_near_duplicates(docs).collect()), key=repr)
    assert kept == sorted([(None, a), (None, b), (7, c), (7, d), (8, e)], key=repr)
    found = near_duplicates(docs).collect()
    assert len({r.root for r in found}) == 5 and {r.component_id for r in found} == {None, 7, 8}


def test_odd_rows_keep_one_document_per_root(odd, clashing, none):
    kept, roots = drop_near_duplicates(odd), {r.root for r in near_duplicates(odd).collect()}
    assert kept.count() == len(roots) == drop_near_duplicates(clashing).count()
    assert drop_near_duplicates(clashing).columns == clashing.columns
    assert kept.filter(F.col("doc_id").isin(101, 102)).count() == 0
    assert drop_near_duplicates(none).count() == 0
