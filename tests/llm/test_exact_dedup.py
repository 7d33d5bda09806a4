import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from candela.llm.exact_dedup import chunks_of, drop_exact_duplicates, exact_duplicates
from llm_helpers import DOCUMENTS, same_rows


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    return sorted(((r.doc_id, max((i for i in groups[r.text or ""] if i is not None), default=None),
                    len(groups[r.text or ""]), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows), key=repr)


def shown(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def test_matches_brute_force(odd):
    got = exact_duplicates(odd)
    assert shown(got) == brute(odd.collect())
    kept = got.filter("kept").collect()
    assert len(kept) == odd.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert all(r.doc_id == r.keep_id for r in kept)


def test_ambiguous_identifiers_change_nothing(odd):
    weak = exact_duplicates(odd, least=8, most=32, chunk_hash=lambda c: F.xxhash64(c) % 3)
    assert shown(weak) == brute(odd.collect())


def test_texts_that_differ_in_one_character(spark):
    a = "abc def " * 2000
    rows = [(1, a), (2, a[:-1] + "!"), (3, "!" + a[1:]), (4, a), (5, a + " "), (6, a[:5000] + "x" + a[5001:])]
    got = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.keep_id for r in got} == {1: 4, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6}


def test_chunks_join_to_the_text_and_follow_content(spark, odd):
    joined = odd.select("text", F.array_join(chunks_of(F.coalesce("text", F.lit(""))), "").alias("j"))
    assert joined.filter("coalesce(text, '') <> j").count() == 0
    rng = random.Random(1)
    body = " ".join("".join(rng.choices("etaoinshrdlcumwfgypbvk", k=rng.randrange(2, 9))) for _ in range(9000))
    parts = spark.createDataFrame([(body,), ("inserted " + body,)], "text string").select(chunks_of(F.col("text")).alias("c")).collect()
    shared = set(parts[0].c) & set(parts[1].c)
    assert len(shared) > 0.8 * len(parts[0].c)


def test_drop_keeps_one_row_each(odd, clashing, none):
    kept = drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and kept.schema == DOCUMENTS
    texts = [r.text or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == odd.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert drop_exact_duplicates(clashing).columns == clashing.columns
    assert drop_exact_duplicates(clashing).count() == len(texts)
    assert exact_duplicates(none).count() == drop_exact_duplicates(none).count() == 0
    assert same_rows(exact_duplicates(odd), exact_duplicates(clashing))
