import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from candela.llm.packing import cut_points, pack, phases, served, tree_ways
from candela.llm.tokens import ranks_path, tokens_of
from llm_helpers import CLASHING, same_rows


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


STRINGS = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b c", "a\n b", "a \nb", "a\n\n  b\n", "\n", "\t\ta\t b", "it's 'quoted' 's", " 's",
           "<|endoftext|>", "a<|endoftext|> b", "x" * 500, "word " * 300, "12 345,6 - (7)", "été  naïve \u00a0 x \u3000y", "\U0001f600 \U0001f600",
           "a \u2003 b", "don't  stop", "A B C  D\r\n E", "\x1c \x1d a", "a\x85 b", "٣ ٤", "...  ... ---", "e\u0301 \u200b x"]


def test_ids_equal_the_tokenizers(reference):
    encode = tokens_of(ranks_path()).encode
    for text in STRINGS + [a + b for a in STRINGS for b in STRINGS]:
        assert np.frombuffer(encode(text), "<u2").tolist() == reference.encode(text, add_special_tokens=False).ids, repr(text)


def check(rows, docs, reference):
    ids = [reference.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs]
    want = Counter((r.doc_id, tuple(x)) for r, x in zip(docs, ids))
    by_doc = defaultdict(list)
    for r in rows:
        assert r.length > 0 and 0 <= r.offset and r.offset + r.length <= 1024
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        by_doc[r.doc_id].append(r)
    for doc_id, pieces in by_doc.items():
        same = sorted(x for (i, x), n in want.items() for _ in range(n) if i == doc_id)
        whole = [t for x in same for t in x]
        assert sum(p.length for p in pieces) == len(whole)
        if len(same) == 1:
            pieces.sort(key=lambda p: p.start)
            assert [p.start for p in pieces] == np.cumsum([0] + [p.length for p in pieces])[:-1].tolist()
            assert [t for p in pieces for t in p.ids] == whole
            assert {p.doc_tokens for p in pieces} == {len(whole)}
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    total = sum(map(len, ids))
    assert sorted(filled) == list(range(-(-total // 1024)))
    for s, parts in filled.items():
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert sum(n for _, n in parts) == (1024 if s < max(filled) else total - 1024 * max(filled))


def test_round_trip_and_gapless_sequences(odd, reference):
    check(pack(odd, with_ids=True).collect(), odd.collect(), reference)
    check(pack(odd, with_ids=True, window_sequences=1).collect(), odd.collect(), reference)


def test_windows_hold_the_target_proportions(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * 90, f"s{i % 5 if i % 2 else 0}") for i in range(400)], "doc_id long, text string, source string")
    rows = pack(docs, window_sequences=4).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    seen, all_of = defaultdict(Counter), Counter()
    for r in rows:
        seen[r.sequence_id // 4][source[r.doc_id]] += r.length
        all_of[source[r.doc_id]] += r.length
    total, full = sum(all_of.values()), [w for w in seen if sum(seen[w].values()) == 4096]
    assert len(full) > 5
    for w in full:
        for s, n in all_of.items():
            assert abs(seen[w][s] - 4096 * n / total) < 2


def layout(groups, weights, window, length):
    """Every token's place: groups is {queue: [sizes of its sources]}."""
    stretches = phases({q: sum(x) for q, x in groups.items()}, weights)
    places, by_queue = [], defaultdict(list)
    for q, sizes in groups.items():
        for size, way in zip(sizes, tree_ways(sizes)):
            at = 0
            for n in (1, 700, 2, size):
                n = min(n, size - at)
                cuts = list(cut_points(at, n, stretches[q], way, window, length)) if n else []
                assert [a for a, _, _ in cuts] == np.cumsum([0] + [k for _, k, _ in cuts])[:-1].tolist() or not n
                assert sum(k for _, k, _ in cuts) == n
                assert all(p % length + k <= length for _, k, p in cuts)
                for _, k, p in cuts:
                    places.extend(range(p, p + k))
                    by_queue[q].extend(range(p, p + k))
                at += n
    return places, by_queue


def test_each_token_has_its_own_place_however_small_its_source():
    rng = random.Random(4)
    for trial in range(40):
        groups = {f"q{i}": [rng.choice((1, 2, 3, 50, 3000, 20_000)) for _ in range(rng.randrange(1, 9))] for i in range(rng.randrange(1, 5))}
        places, _ = layout(groups, {q: rng.randrange(1, 7) for q in groups}, rng.choice((64, 256, 1000)), 64)
        assert sorted(places) == list(range(sum(map(sum, groups.values()))))


def test_dry_queues_hand_their_share_on():
    groups, weights, window = {"a": [30_000], "b": [4000, 2001], "c": [9000]}, {"a": 1, "b": 2, "c": 3}, 600
    places, by_queue = layout(groups, weights, window, 60)
    assert sorted(places) == list(range(45_001))
    seen = {q: Counter(p // window for p in x) for q, x in by_queue.items()}
    # b and c run dry together (6001 / 2 against 9000 / 3: c first, at 3000 a weight), a alone goes on.
    for w in range(29):
        for q, share in weights.items():
            assert abs(seen[q][w] - window * share / 6) < 2
    assert all(seen["a"][w] == window for w in range(32, 75))


def test_deficits_stay_below_the_depth():
    sizes = [10**17 // 3, 10**17 // 2, 5, 10**16, 1]
    total, ways = sum(sizes), tree_ways(sizes)
    for e in (0, 1, 1024, 10**12, total - 1, total):
        got = [served(way, e)[0] for way in ways]
        assert sum(got) == e
        assert all(abs(Fraction(x) - Fraction(e * n, total)) <= 3 for x, n in zip(got, sizes))
    cuts = list(cut_points(10**15, 5000, phases({"x": total}, {"x": 1})["x"], ways[1], 16384, 1024))
    assert sum(n for _, n, _ in cuts) == 5000 and [a for a, _, _ in cuts] == np.cumsum([0] + [n for _, n, _ in cuts])[:-1].tolist()


def test_target_weights(odd, spark, reference):
    check(pack(odd, with_ids=True, targets={"src1": 3, None: 2, "absent": 9}, window_sequences=2).collect(), odd.collect(), reference)
    docs = spark.createDataFrame([(i, f"w{i} " * 90, ["a", "b", "c", "d"][i % 4]) for i in range(400)], "doc_id long, text string, source string")
    rows = pack(docs, window_sequences=4, targets={"a": 6, "b": 3}, rest_weight=1).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    seen, of = Counter(), Counter()
    for r in rows:
        of[source[r.doc_id]] += r.length
    first = 4 * (of["a"] * 10 // 6 // 4096)
    for r in rows:
        if r.sequence_id < first:
            seen[r.sequence_id // 4, source[r.doc_id]] += r.length
    assert first >= 8
    for w in range(first // 4):
        assert abs(seen[w, "a"] - 4096 * 0.6) < 3 and abs(seen[w, "b"] - 4096 * 0.3) < 3
        assert abs(seen[w, "c"] + seen[w, "d"] - 4096 * 0.1) < 3
    with pytest.raises(ValueError):
        pack(docs, targets={"a": 0})


def test_small_source_beside_large_ones(spark, reference):
    docs = spark.createDataFrame([(i, f"w{i} " * 300, f"s{i % 3}") for i in range(60)] + [(90, "", "tiny"), (91, "", None)],
                                 "doc_id long, text string, source string")
    check(pack(docs, with_ids=True, window_sequences=1).collect(), docs.collect(), reference)


def test_edges(odd, none):
    from pyspark.sql import functions as F

    assert pack(none).count() == 0
    more = odd.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])
    order = ["doc_id", "doc_tokens"]
    assert same_rows(pack(odd).select(order).distinct(), pack(more).select(order).distinct())
