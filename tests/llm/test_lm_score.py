import math
import pickle
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from candela.llm import attention
from candela.llm.attention import PIECE, Attention, window_starts
from candela.llm.lm_score import (
    END,
    IDS,
    LanguageModel,
    Unigrams,
    counts_behind,
    drawn_windows,
    encoded,
    fit_language_model,
    frequency_classes,
    id_counts,
    lm_scores,
    trained_on_all,
    vocabulary_path,
    words_of,
)
from candela.llm.tokens import tokens_of
from llm_helpers import DOCUMENTS, same_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = {"classes": 16, "before": 64, "common": 200, "size": 8, "fit_windows": 300, "epochs": 1}


def is_held(doc_id):
    return crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def brute_base(rows):
    split = [(i, WORD.findall((t or "").translate(LOWER))) for i, t in rows]
    counts = Counter()
    for i, words in split:
        if not is_held(i):
            counts.update([*words, None])  # None: the end
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, words in split:
        tokens = [*words, None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        out.append((i, is_held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, base))
    return out


def check_base(got, want):
    key = lambda r: repr(r[:5])
    got = sorted([tuple(r)[:6] for r in got], key=lambda r: (key(r), r[5]))
    want = sorted(want, key=lambda r: (key(r), r[5]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got, want))


def test_base_counts_and_edges(spark, odd, clashing, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    out = lm_scores(odd, **SMALL)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = out.collect()
    check_base(got, brute_base(rows))
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_scores(none, **SMALL).count() == 0
    a, b = ({(r.doc_id, r.n_tokens, round(r.score, 2)) for r in lm_scores(x, **SMALL).collect()} for x in (odd, clashing))
    assert a == b


def test_words_beyond_the_frequent_ones(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["The", "the", "é", "a b", f"w{i % 7}", "m" * 5000]) for _ in range(rng.randrange(30)))) for i in range(80)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)
    for frequent in (2, 5, 100):
        check_base(lm_scores(docs, frequent=frequent, **SMALL).collect(), brute_base(rows))


def test_no_training_rows(spark):
    ids = [i for i in range(200) if is_held(i)][:3]
    docs = spark.createDataFrame([(i, "some words here", None, None, None) for i in ids], DOCUMENTS)
    got = lm_scores(docs, **SMALL).collect()
    assert {tuple(r)[2:6] for r in got} == {(4, 0, 0, 0.0)} and all(math.isfinite(r.score) for r in got)


def test_words_are_those_of_the_pattern():
    for text in ("", " \t a\x0bB\x0cc\r\nÉÀ\u00a0x\u2003y\x1cz\x85 ", "İSTANBUL ẞ <|endoftext|>"):
        assert [w.decode() for w in words_of(text)] == WORD.findall(text.translate(LOWER))


def test_windows_score_every_token_once():
    for width, stride in ((32, 24), (8, 8), (5, 1)):
        lengths = np.array([0, 1, 4, 5, 8, 9, 31, 32, 33, 56, 57, 200])
        seq, start, first = window_starts(lengths, width, stride)
        for s, n in enumerate(lengths):
            places = [p for q, a, f in zip(seq, start, first) if q == s for p in range(a + f, min(a + width, n))]
            assert places == list(range(n))
        later = start > 0
        assert (first[later] >= width - stride).all()  # context before what is scored


def test_attention_is_causal_and_its_gradients_are_right():
    rng = np.random.default_rng(0)
    net = Attention(30, 7, size=6, width=5)
    ids = rng.integers(0, 30, (4, 5))
    changed = ids.copy()
    changed[:, 3:] = (changed[:, 3:] + 1) % 30
    a, b = net.hidden(ids), net.hidden(changed)
    assert np.allclose(a[:, :3], b[:, :3]) and not np.allclose(a[:, 3:], b[:, 3:])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    targets, valid = rng.integers(0, 7, (4, 5)), rng.random((4, 5)) < 0.7
    _, g = net.gradients(ids, targets, valid)
    for name, value in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in value.shape)
            kept, losses = value[at], []
            for step in (1e-4, -1e-4):
                value[at] = kept + step
                losses.append(net.gradients(ids, targets, valid)[0])
            value[at] = kept
            assert math.isclose((losses[0] - losses[1]) / 2e-4, g[name][at], rel_tol=1e-2, abs_tol=1e-5), name


def test_model_probabilities_sum_to_one_and_beat_a_uniform_guess(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = encoded(docs, vocabulary_path())
    train = rows.filter("not held_out")
    model = fit_language_model(train, classes=64, before=256, common=700, fit_windows=2000, epochs=3)
    ids = np.arange(IDS)
    for before in (END, int(ids[model.classes[model.column] == 3][0]), 50_000):
        inside = np.exp(model.inside(np.full(IDS, before), ids))
        sums = np.bincount(model.classes[model.column], weights=inside, minlength=64)
        assert np.allclose(sums[sums > 0], 1, atol=1e-3)
    # Batched scores are those of one sequence at a time, and of the chain rule by hand.
    held = rows.filter("held_out").limit(6).collect()
    seqs = [np.concatenate([[END], np.frombuffer(r.ids, "<u2")]).astype(np.uint16) for r in held]
    together = model.score(seqs)
    assert np.allclose(together, [model.score([s])[0] for s in seqs], rtol=1e-4)
    s = next(s for s in seqs if len(s) > 3)[:20]
    by_hand = 0.0
    for t in range(1, len(s)):
        y = model.net.hidden(model.column[np.pad(s[:t], (0, model.width - t))][None])[0, t - 1] @ model.net.p["c"] + model.net.p["c0"]
        y = y - y.max()
        by_hand += (y - np.log(np.exp(y).sum()))[model.classes[model.column[s[t]]]] + model.inside(s[t - 1:t], s[t:t + 1])[0]
    assert math.isclose(model.score([s])[0], by_hand / math.log(10), rel_tol=1e-3)
    assert (together / [len(s) - 1 for s in seqs] > -math.log10(IDS)).all()
    # Ids are those of the lower-cased words, as the tokenizer encodes the whole text.
    bpe = tokens_of(vocabulary_path()).bpe
    for r in rows.limit(40).collect():
        words = WORD.findall((docs.filter(F.col("doc_id") == r.doc_id).first().text or "").translate(LOWER))
        assert np.frombuffer(r.ids, "<u2").tolist() == [*bpe.encode_ordinary("".join(" " + w for w in words)), END]
        assert r.n_words == len(words) and np.frombuffer(r.counts, "<u4").sum() == len(words)
    text = " ".join(WORD.findall((docs.filter(F.col("doc_id") == held[0].doc_id).first().text or "").translate(LOWER)))
    assert bpe.decode(seqs[0][1:-1].tolist()) == (" " + text if text else "")


def test_counts_cover_all_training_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = encoded(docs, vocabulary_path())
    train = rows.filter("not held_out")
    ids = [np.frombuffer(r.ids, "<u2").astype(int) for r in train.collect()]
    counts = id_counts(train)
    assert (counts == np.bincount(np.concatenate(ids), minlength=IDS)).all()
    kind = frequency_classes(counts, 32)
    assert len(set(kind)) == 32 and (np.diff(kind[np.argsort(-counts, kind="stable")]) >= 0).all()
    column = np.minimum(np.argsort(np.argsort(-counts, kind="stable")), 100)
    want = np.zeros((32, 101))
    for x in ids:
        np.add.at(want, (kind[np.r_[END, x[:-1]]], column[x]), 1)
    assert (counts_behind(train, kind, column) == want).all()
    some = drawn_windows(train, 32, 24, 50)
    assert some.shape == (50, 34) and (some == drawn_windows(train.repartition(3), 32, 24, 50)).all()


def test_held_out_texts_do_not_reach_the_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 60")
    other = docs.withColumn("text", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit("zz qq")).otherwise(F.col("text")))
    a, b = ({r.doc_id: r for r in lm_scores(x, **SMALL).collect()} for x in (docs, other))
    for i, r in a.items():
        if not r.held_out:
            assert math.isclose(r.score, b[i].score, rel_tol=1e-4) and math.isclose(r.base_score, b[i].base_score, rel_tol=1e-12)
    assert same_rows(docs.select("doc_id"), other.select("doc_id"))


def test_the_network_learns_from_every_training_document(spark):
    texts = [" ".join(f"w{(i + j) % 9}" for j in range(60)) for i in range(40)] + ["", "one"]
    docs = lambda own: spark.createDataFrame([(5, t, None, None, None) for t in own], DOCUMENTS).repartition(3)
    rows = encoded(docs(texts), vocabulary_path())
    column, classes = np.arange(IDS) % 50, np.arange(50) % 6
    seqs = [np.frombuffer(END.to_bytes(2, "little") + r.ids, "<u2") for r in rows.select("ids").collect()]
    net = Attention(50, 6, size=6, width=8)
    first = {k: v.copy() for k, v in net.p.items()}
    assert trained_on_all(rows, net, column, classes, 8, batch=4, rate=0.02) == sum(-(-(len(s) - 1) // 8) for s in seqs)
    assert net.p["c"].dtype == np.float32 and any(not np.array_equal(first[k], net.p[k]) for k in first)

    def loss(p):
        net_ = Attention(50, 6, size=6, width=8)
        net_.p, total = p, 0.0
        for s in seqs:
            ids, n = column[s], min(8, len(s) - 1)
            window = np.resize(ids[:n], 8)[None]
            total -= net_.log_probabilities(window, np.zeros(n, int), np.arange(n), classes[ids[1:n + 1]]).sum()
        return total

    assert loss(net.p) < loss(first)
    # With one drawn window, documents that are not drawn still change the weights.
    few = {**SMALL, "fit_windows": 1}
    a, b = (fit_language_model(encoded(docs(own), vocabulary_path()), **few).net.p["q"] for own in (texts, texts[:20]))
    assert not np.array_equal(a, b)
    assert trained_on_all(rows.limit(0), net, column, classes, 8) == 0


def test_work_in_pieces_is_that_of_all_windows_at_once(monkeypatch):
    rng = np.random.default_rng(3)
    net = Attention(30, 7, size=6, width=5)
    ids, targets = rng.integers(0, 30, (2 * PIECE + 3, 5)), rng.integers(0, 7, (2 * PIECE + 3, 5))
    valid = rng.random(ids.shape) < 0.7
    valid[PIECE:2 * PIECE] = False  # a piece without a place to learn from
    loss, g = net.gradients(ids, targets, valid)
    asked = []
    monkeypatch.setattr(attention, "PIECE", 1000)
    monkeypatch.setattr(attention.batches, "__defaults__", (1000,))
    whole, h = net.gradients(ids, targets, valid)
    assert math.isclose(loss, whole, rel_tol=1e-5) and set(g) == set(h) == set(net.p)
    assert all(np.allclose(g[k], h[k], rtol=1e-3, atol=1e-6) for k in g)
    monkeypatch.undo()
    # No more than PIECE windows are held at a time, when learning and when scoring.
    monkeypatch.setattr(net, "hidden", lambda ids, *kept: asked.append(len(ids)) or Attention.hidden(net, ids, *kept))
    net.gradients(ids, targets, valid)
    column = np.arange(IDS) % 30
    model = LanguageModel(net, column, column % 3, np.arange(30) % 7, np.ones(30, np.float32), np.ones(IDS, np.float32),
                          np.ones((3, 30), np.float32), np.ones((3, 7), np.float32), 5, 3, np.float32(1))
    seqs = [np.array([END, 5, 6][:1 + i % 3] + [7] * (i % 50), "<u2") for i in range(200)] + [np.array([END], "<u2")]
    scores = model.score(seqs)
    assert max(asked) == PIECE and scores[-1] == 0
    assert np.allclose(scores, [model.score([s])[0] for s in seqs], rtol=1e-4)
    assert not pickle.loads(pickle.dumps(Attention(30, 7))).kept and not net.__getstate__()["kept"]


def test_frequent_words_are_found_by_their_digests():
    rng = np.random.default_rng(6)
    for own in (rng.integers(-2**63, 2**63, 3000), np.arange(-40, 40), np.array([-2**63, 2**63 - 1]), np.array([7]), np.zeros(0)):
        own = np.unique(own.astype(np.int64))
        known = Unigrams(0, 0, 0, own, np.ones(len(own), np.int64))
        asked = np.concatenate([own, rng.integers(-2**63, 2**63, 500), np.arange(-60, 60), [-2**63, 2**63 - 1]])
        at, hit = known.place(asked)
        assert (hit == np.isin(asked, own)).all() and (own[at[hit]] == asked[hit]).all()


def test_large_logits_keep_finite_gradients_of_the_right_size():
    rng = np.random.default_rng(8)
    net = Attention(30, 7, size=6, width=5)
    net.p["c"] *= np.float32(300)
    ids, targets, valid = rng.integers(0, 30, (9, 5)), rng.integers(0, 7, (9, 5)), np.ones((9, 5), bool)
    y = net.hidden(ids).astype(np.float64) @ net.p["c"] + net.p["c0"]
    assert np.abs(y).max() > 200
    shares = np.exp(y - y.max(2, keepdims=True))
    shares /= shares.sum(2, keepdims=True)
    loss, g = net.gradients(ids, targets, valid)
    want = (shares - np.eye(7)[targets]).sum((0, 1)) / 45
    assert all(np.isfinite(d).all() for d in g.values()) and np.allclose(g["c0"], want, atol=1e-4)
    own = np.take_along_axis(y - y.max(2, keepdims=True) - np.log(np.exp(y - y.max(2, keepdims=True)).sum(2, keepdims=True)), targets[:, :, None], 2)
    assert math.isclose(loss, -own.mean(), rel_tol=1e-3)


def test_steps_of_adam_work_in_kept_memory():
    rng = np.random.default_rng(1)
    net = Attention(30, 7, size=6, width=5)
    p = {k: v.copy() for k, v in net.p.items()}
    m, s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    adam = attention.Adam(net)
    held = {k: v.ctypes.data for k, v in net.p.items()}
    for step in range(1, 6):
        ids, targets = rng.integers(0, 30, (9, 5)), rng.integers(0, 7, (9, 5))
        _, g = net.gradients(ids, targets, np.ones((9, 5), bool))
        adam.step(ids, targets, np.ones((9, 5), bool), 0.01)
        for k, d in g.items():
            m[k] += np.float32(0.1) * (d - m[k])
            s[k] += np.float32(0.01) * (d * d - s[k])
            p[k] -= np.float32(0.01) * (m[k] / np.float32(1 - 0.9 ** step)) / (np.sqrt(s[k] / np.float32(1 - 0.99 ** step)) + np.float32(1e-6))
            assert np.allclose(net.p[k], p[k], rtol=1e-5, atol=1e-7)
    assert held == {k: v.ctypes.data for k, v in net.p.items()} and all(a.shape == p[k].shape for k, (a, _) in adam.kept.items())
