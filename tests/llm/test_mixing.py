import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from candela.llm import mixing as M
from llm_helpers import DOCUMENTS, same_rows


def brute_targets(sizes, weights=(5, 2, 1)):
    """The stated rule, step by step: share by weight, stop at three times the size, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, target, still = float(sum(sizes.values())), {}, set(names)
    while still:
        share = {s: left * w[s] / sum(w[x] for x in still) for s in still}
        above = {s for s in still if share[s] > 3 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        still -= above
    return target


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_sizes_and_taken(odd):
    rows = odd.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += size_of(r.text)
    want = brute_targets(sizes)
    got = M.mix_report(odd, block_words=100, shard_blocks=7).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, size_of(r.text)) for r in rows)
    taken, of_source = defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source_size, round(r.target, 6)] += r.taken
    for s, n in sizes.items():
        of_source[n, round(want[s], 6)] = want[s]
    assert set(taken) == set(of_source)
    for k, n in taken.items():
        assert abs(n - of_source[k]) <= 0.5


def test_capped_targets_reshare(spark):
    for seed in range(6):
        rng = random.Random(seed)
        sizes = {f"s{i}": int(10 ** rng.uniform(0, 5)) for i in range(9)} | {None: 40, "zero": 0}
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in M.source_targets(table).collect()}
        want = brute_targets(sizes)
        assert all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in sizes)


def test_reruns_agree(odd):
    assert same_rows(M.mix_report(odd), M.mix_report(odd))


def test_hypergeometric_draws(spark):
    u = M._uniform(F.col("id"), F.lit(3))
    x = np.array([r.x for r in spark.range(3000).select(
        M.hypergeometric(F.lit(300), F.lit(400), F.lit(1000), u).alias("x")).collect()])
    assert abs(x.mean() - 120) < 0.6 and abs(x.std() - 7.1) < 0.4
    rows = [(2, 0, 5), (0, 3, 5), (5, 3, 5), (1, 1, 1), (0, 0, 0), (4, 5, 6)]
    got = [r.x for r in spark.createDataFrame(rows, "d int, g int, n int").select(
        M.hypergeometric(F.col("d"), F.col("g"), F.col("n"), F.lit(0.99)).alias("x")).collect()]
    assert got[:5] == [0, 0, 3, 1, 0] and got[5] in (3, 4)


def test_tree_keeps_quotas(spark):
    quotas = [50, 0, 3, 1000, 7]
    root = spark.createDataFrame([(quotas,)], "quotas array<bigint>")
    leaves = M.splitting_tree(root, 5, 9).collect()
    assert sorted(r.shard for r in leaves) == list(range(5))
    assert [sum(x) for x in zip(*(r.quotas for r in leaves))] == quotas
    assert {sum(r.quotas) for r in leaves} <= {212} and min(min(r.quotas) for r in leaves) >= 0


def test_shards_get_disjoint_blocks(odd):
    pieces = M.draws(odd.select("doc_id", "source", "text"), block_words=50, shard_blocks=5).filter("words > 0")
    assert pieces.filter("shard is null").count() == 0
    assert pieces.select("shard").distinct().count() > 3
    assert pieces.groupBy("source_no", "row_no", "epoch").count().filter("count > 1").count() == 0


def test_taken_words_come_through_the_tree(odd, monkeypatch):
    small = dict(block_words=50, shard_blocks=5)
    got = M.mix_report(odd, **small).collect()
    assert all(r.taken == sum(d.words for d in r.draws) for r in got)
    assert len({d.shard for r in got for d in r.draws}) > 3
    other = M.mix_report(odd, seed=12, **small).collect()
    where = lambda rows: Counter((r.doc_id, r.taken, d.epoch, d.shard) for r in rows for d in r.draws)
    assert where(got) != where(other) and sum(r.taken for r in got) == sum(r.taken for r in other)
    whole, fullest = M.splitting_tree, Counter(d.shard for r in got for d in r.draws).most_common(1)[0][0]
    lost = lambda root, shards, seed: whole(root, shards, seed).filter(F.col("shard") != fullest)
    monkeypatch.setattr(M, "splitting_tree", lost)
    less = M.mix_report(odd, **small).collect()
    # Without a shard the others' ranges close up: as many turns stay undrawn as it had blocks.
    assert sum(r.taken for r in less) < sum(r.taken for r in got)
    assert M.mix(odd, **small).count() == sum(len(r.draws) for r in less)


def test_mix_gives_whole_documents_and_cuts_few(odd, clashing, none):
    report = M.mix_report(odd)
    out = M.mix(odd)
    assert out.columns == odd.columns
    rows = out.collect()
    assert sum(size_of(r.text) for r in rows) == report.agg(F.sum("taken")).first()[0]
    texts = {r.text for r in odd.collect()}
    cut = [r for r in rows if r.text not in texts]
    assert len(cut) <= odd.select("source").distinct().count()
    assert all(any(t and t.startswith(r.text) for t in texts) for r in cut)
    assert all(r.n_chars == len(r.text) for r in rows)
    assert M.mix(clashing).columns == clashing.columns
    assert M.mix(clashing).count() == len(rows)
    assert M.mix(none).count() == M.mix_report(none).count() == 0
    assert same_rows(report, M.mix_report(clashing))


def test_only_empty_texts(spark):
    docs = spark.createDataFrame([(1, None, "en", "a", 0), (2, "  ", "en", None, 0)], DOCUMENTS)
    assert {(r.doc_id, r.size, r.target, r.taken) for r in M.mix_report(docs).collect()} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}
    assert M.mix(docs).count() == 0
