import random
import re
from collections import Counter
from zlib import crc32

from pyspark.sql import functions as F

from candela.llm.spelling import KEY_POINTS, MARK, near_words, ranked, roots, rotations, spelling_variants
from llm_helpers import DOCUMENTS, same_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    form, out = {}, {}
    for w, n in words.items():
        near = [v for v in words if v != w and is_near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = len(near)
    rows = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, out[w], words.get(form[w])))
    return rows


def counted(rows, every=97):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def got(frame):
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in frame.collect()}


def odd_documents():
    rng = random.Random(4)
    stems = ["aabba", "ababab", "éàüöä", "Kelvin", "straße", "aaaaaa", "aaaaa", "naïve", "Ünder"]
    long = "".join(rng.choice("ab") for _ in range(KEY_POINTS - 1))
    stems += [long, long + "a", long + "ab", "x" * 400, "x" * 399, "z" * 30_000, "y" * KEY_POINTS, "y" * (KEY_POINTS + 1)]
    rows = []
    for i in range(160):
        words = []
        for _ in range(rng.randrange(0, 60)):
            w = rng.choice(stems)
            for _ in range(rng.randrange(3) if len(w) < 1000 else 0):
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + rng.choice("abéÉ") + w[at:], w[:at] + w[at + 1:], w[:at] + rng.choice("abé") + w[at + 1:]])
            words.append(w)
        rows.append((i, " ,7_".join(words)))
    rows += [(1000, None), (1001, ""), (None, "without any number " * 4), (None, None), (1002, "twice twice"), (1002, "twice twice")]
    rows += [(1003, "spread " * 30_000)]
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS).repartition(4)


def test_against_brute_force(spark):
    rows = odd_documents()
    for every in (97, 2):
        words = counted(rows, every)
        assert max(map(len, words)) >= 30_000
        assert any(len(w) > KEY_POINTS for w in words) and len(words) > 100
        assert got(spelling_variants(frame_of(spark, rows), every)) == brute(words)


def test_rotations_are_those_of_the_marked_word():
    for word in ("cat", "aab", "éa" * 40, "b" * KEY_POINTS, "ab" * (KEY_POINTS // 2) + "c"):
        marked = word + MARK
        turned = {marked[i:] + marked[:i] for i in range(len(marked))}
        keys = list(rotations(word))
        assert len(keys) == 2 * len(word) + 1 == len(set(k for k, _, _ in keys))
        if len(word) < KEY_POINTS:
            assert {k for k, whole, _ in keys if whole} == turned
            assert all(any(t.startswith(k) for t in turned) for k, whole, _ in keys if not whole)
    # A long word's edit keys are the whole keys of the words without the code point.
    word = "".join(random.Random(1).choice("abc") for _ in range(90))
    edits = [k for k, whole, _ in rotations(word) if not whole]
    for i in (0, 1, 50, 89):
        assert edits[i] in {k for k, whole, _ in rotations(word[:i] + word[i + 1:]) if whole}


def by_word(frame):
    words = ranked(frame)
    names = {r.rank: r.word for r in words.collect()}
    return {names[r["rank"]]: (r.n_near, names.get(r.best)) for r in near_words(words).collect()}


def test_long_chains_of_forms(spark):
    words = {"a" * (5 + i): 2 ** (i + 2) for i in range(30)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    near = by_word(frame)
    assert near["a" * 5][0] == 1 and near["a" * 20] == (2, "a" * 21)
    forms = spark.createDataFrame([(w, w + "a" if w + "a" in words else None) for w in words], "word string, form string")
    assert {r.root for r in roots(forms).collect()} == {"a" * 34}


def test_a_hub_with_many_variants(spark):
    hub = "abcdefghij"
    words = {hub: 10_000, **{hub[:i] + c + hub[i + 1:]: 3 for i in range(10) for c in "0klmnopqrstuvwxyzé"}}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = by_word(frame)
    assert found[hub][0] == 180 and {x for w, x in found.items() if w != hub} == {(18, hub)}


def test_empty_and_clashing(spark, odd, clashing, none):
    assert spelling_variants(none).count() == 0
    assert spelling_variants(frame_of(spark, [(1, None), (2, "")])).count() == 0
    assert same_rows(spelling_variants(odd), spelling_variants(clashing))
    more = odd.select("*", *[F.lit("x").alias(c) for c in ("word", "run", "key", "form", "root")])
    assert same_rows(spelling_variants(odd), spelling_variants(more))
