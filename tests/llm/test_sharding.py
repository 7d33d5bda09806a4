import zlib
from collections import Counter, defaultdict

import numpy as np

from candela.llm.sharding import assign_shards, permuted, unpermuted
from llm_helpers import same_rows


def test_permutation_is_one_to_one_and_invertible():
    for n in (1, 2, 3, 7, 24, 100, 1000, 4097, 65_537):
        x = np.arange(n)
        y = permuted(x, n, key=7)
        assert sorted(y.tolist()) == x.tolist()
        assert (unpermuted(y, n, key=7) == x).all()
    a, b = permuted(np.arange(5000), 5000, 1), permuted(np.arange(5000), 5000, 2)
    assert (a == b).mean() < 0.01
    assert abs(np.corrcoef(np.arange(5000), a)[0, 1]) < 0.05


def test_counts_slots_and_digests(odd):
    rows = assign_shards(odd, shards=24).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in odd.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert len(slots) == 24
    counts = [len(x) for x in slots.values()]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_place_can_be_computed(odd):
    rows = assign_shards(odd, shards=5, key=3).collect()
    places = permuted(np.array([r.row_no for r in rows]), len(rows), 3)
    assert [(r.shard, r.slot) for r in rows] == [(p % 5, p // 5) for p in places.tolist()]
    assert sorted(r.row_no for r in rows) == list(range(len(rows)))


def test_edges(odd, clashing, none):
    assert assign_shards(none).count() == 0
    columns = ["doc_id", "size", "text_crc32"]
    assert same_rows(assign_shards(odd).select(columns), assign_shards(clashing).select(columns))
    few = odd.filter("doc_id < 3")
    assert sorted(r.shard for r in assign_shards(few).collect()) == [0, 1, 2]
