import itertools
import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from candela.llm.crf import Chain
from candela.llm.toxicity import drop_toxic, fit_model, fit_on, toxic_spans, toxicity_report
from llm_helpers import DOCUMENTS, same_rows


def test_marginals_match_enumeration():
    chain = Chain(0)
    chain.bias, chain.trans = -1.3, np.array([[0.4, -0.7], [0.2, 0.9]])
    chain.prepare()
    at, scores, n = [0, 2, 3, 6], [2.0, -0.5, 1.1, 3.0], 8
    extra = dict(zip(at, scores))
    weight, ones = 0.0, np.zeros(n)
    for tags in itertools.product((0, 1), repeat=n):
        s = sum(chain.bias + extra.get(t, 0.0) for t in range(n) if tags[t])
        s += sum(chain.trans[a, b] for a, b in zip(tags, tags[1:]))
        weight += np.exp(s)
        ones += np.exp(s) * np.array(tags)
    assert np.allclose(chain.marginals(at, scores, n), (ones / weight)[at])


def test_fit_climbs_to_the_observed_tags():
    rng = np.random.default_rng(0)
    combos = rng.integers(0, 3, (300, 12))
    tags = (combos == 2).astype(int)
    chain = Chain(2).fit(combos, [(), (0,), (1,)], tags, np.full(300, 12), np.ones(300)).prepare()
    p = chain.marginals([1, 4, 7], [chain.emit[0], chain.emit[1], chain.emit[0]], 9)
    assert p[1] > 0.9 and max(p[0], p[2]) < 0.1


@pytest.fixture(scope="module")
def given(spark):
    d = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")


def test_held_out_accuracy(given):
    docs, labels = given
    rows = toxicity_report(docs, labels, fit_rows=3000).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    right = np.mean([r.predicted == r.toxic for r in held])
    false_alarms = sum(r.predicted and not r.toxic for r in held) / sum(not r.toxic for r in held)
    toxic, clean = ([r.score for r in held if r.toxic == y] for y in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert right > 0.97 and false_alarms < 0.01 and auc > 0.95


def texts(spark):
    rng = random.Random(2)
    pool = ["".join(rng.choices("abcdefghilmnoprstu", k=7)) for _ in range(3000)]
    rows = []
    for i in range(400):
        words = ["calm", "words", "flow", *rng.choices(pool, k=30)]
        for word in rng.choices(("vile", "nasty", "rot"), k=3) if i % 4 == 0 else ():
            words.insert(rng.randrange(len(words)), word)
        rows.append((i, " ".join(words), "en", "s", None))
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    return spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_spans_point_at_the_words(spark):
    docs, labels = texts(spark)
    model = fit_on(docs, labels)
    probe = spark.createDataFrame([(1, "Ünd VILE calm words, nasty flow", "en", "s", 1), (2, "calm words", "en", "s", 1)], DOCUMENTS)
    a, b = toxic_spans(probe, model).orderBy("doc_id").collect()
    assert [a.text[s.start:s.end] for s in a.toxicity.spans] == ["VILE", "nasty"]
    assert a.toxicity.score > 0.5 > b.toxicity.score and not b.toxicity.spans


def test_held_out_labels_are_never_read(spark):
    docs, labels = texts(spark)
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert same_rows(toxicity_report(docs, labels), toxicity_report(docs, flipped))


def test_edges(spark, odd, none, clashing):
    docs, labels = texts(spark)
    both = docs.unionByName(odd)
    kept = drop_toxic(both, labels)
    assert kept.columns == both.columns
    assert {r.doc_id for r in kept.collect()} >= {r.doc_id for r in odd.collect()} | {1, 2, 3}
    assert kept.filter("text like '%vile%' or text like '%nasty%'").count() <= 2
    assert kept.filter("text is null").count() == odd.filter("text is null").count()
    no_labels = spark.createDataFrame([], labels.schema)
    assert toxicity_report(odd, no_labels).select("score").distinct().collect()[0].score == 0
    hollow = spark.createDataFrame([(None, None, None), (1, None, None), (2, 1, 7), (9999, 0, 1)], labels.schema)
    assert toxicity_report(odd, hollow).count() == odd.count()
    one_class = labels.withColumn("toxic", F.lit(0))
    assert toxicity_report(docs, one_class).filter("predicted = 1").count() == 0
    assert toxicity_report(none, labels).count() == drop_toxic(none, labels).count() == 0
    assert drop_toxic(clashing, labels).columns == clashing.columns


def few_toxic(n_toxic, n_clean, seed):
    """Documents of 30 rare words, the toxic ones with three of three marking words."""
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcdefghilmnoprstu", k=7)) for _ in range(3000)]
    draw = lambda y: " ".join(["calm", *rng.choices(pool, k=30), *(rng.choices(("vile", "nasty", "rotten"), k=3) if y else [])])
    toxic = [1] * n_toxic + [0] * n_clean
    return [draw(y) for y in toxic], toxic


def test_few_toxic_rows_still_train(spark):
    model = fit_model(*few_toxic(5, 1500, 1))
    texts, toxic = few_toxic(40, 400, 2)
    found = [model.score(t, {})[0] >= 0.5 for t in texts]
    assert sum(found[:40]) >= 20 and sum(found[40:]) <= 4


def test_sample_is_bounded_per_label_after_the_join(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("candela.llm.toxicity.fit_model", lambda *a: seen.append(a) or fit_model(*a))
    texts, toxic = few_toxic(20, 600, 3)
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    rows += [(700, f"{t} again", None, None, None) for t in texts] + [(701, texts[30], None, None, None)] * 300
    labels = [(i, 1, y) for i, y in enumerate(toxic)] + [(700, 1, 0), (701, 1, 0)] + [(10_000 + i, 1, 0) for i in range(5000)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(3)
    fit_on(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), fit_rows=100)
    used, given_labels, sizes = seen[0]
    out = {i for i in [*range(620), 700, 701] if crc32(str(i).encode()) % 5 == 0}
    assert len(used) == 100 and sum(given_labels) == sizes[1] == len(set(range(20)) - out)
    assert sum(sizes) == sum(i not in out for i in range(620)) + (0 if 700 in out else 620) + (701 not in out)
