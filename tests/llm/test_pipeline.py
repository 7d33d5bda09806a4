from collections import Counter
from zlib import crc32

import corpus_pipeline as P
from llm_helpers import SF_MID


def test_each_stage_on_what_the_last_one_kept(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    before = docs
    rows = {}
    for name, stage in P.STAGES[:4]:
        after = stage(spark, before, SF_MID)
        assert after.columns == docs.columns
        before = spark.createDataFrame(after.collect(), docs.schema)
        rows[name] = before.collect()
    given = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows["toxicity"]}
    toxic = {i for i in given if labels.get(i) == 1}
    # Labelled clean rows that no fit has seen; documents without a label are neither clean nor toxic.
    clean = [i for i in given if labels.get(i) == 0 and crc32(str(i).encode()) % 5 == 0]
    assert len(toxic - kept) > 0.6 * len(toxic) and sum(i in kept for i in clean) > 0.95 * len(clean)
    last = {}
    for r in rows["toxicity"]:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert {r.doc_id for r in rows["exact_dedup"]} == set(last.values())
    assert all(r == given[r.doc_id] for r in rows["exact_dedup"])
    assert {r.doc_id for r in rows["near_dedup"]} <= set(last.values())
    assert set(Counter(r.doc_id for r in rows["mixing"]).values()) <= {1, 2, 3}
    packed = P.STAGES[4][1](spark, before, SF_MID).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows["mixing"]}
    assert sum(r.length for r in packed) == sum({(r.doc_id, r.sequence_id, r.offset): r.length for r in packed}.values())


def test_run_goes_through(spark):
    out = P.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "sequence_id", "offset", "ids"} <= set(out.columns) and out.count() > 0
