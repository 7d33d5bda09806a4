"""Offsets of a topic: resume, new partitions, starting points, lost messages."""

import os

import pytest

from bar_helpers import bars_df
from candela.sources.topic import TopicReader, append_to_topic, ends
from candela.streaming.pipeline import PipelineConfig, read_output, run_pipeline


def bars(spark, days, symbols="ABCDEF"):
    return bars_df(spark, [(s, f"2024-01-{d:02d}", 1.0, 9.0, 1.0, float(d), 10.0) for s in symbols for d in days])


def run(spark, tmp_dir, name="ck", **options):
    cfg = PipelineConfig(output_path=f"{tmp_dir}/out-{name}", checkpoint_path=f"{tmp_dir}/{name}", source_format="topic",
                         source_path=f"{tmp_dir}/topic", available_now=True, history=True, source_options=options)
    done = run_pipeline(spark, cfg, poll_seconds=0.3)
    return sorted((r.symbol, r.date) for r in read_output(spark, done.clean_path, done).collect())


def test_reader_ranges(spark, tmp_dir):
    path = f"{tmp_dir}/topic"
    append_to_topic(bars(spark, [1, 2]), path)
    first = ends(path, "latest")
    assert sum(first.values()) == 12 and set(ends(path, "earliest").values()) == {0}
    append_to_topic(bars(spark, [3]), path)
    last = ends(path, "latest")
    reader = TopicReader(path, "earliest", True)
    assert reader.initialOffset() == ends(path, "earliest") and reader.latestOffset() == last
    rows = [r for p in reader.partitions(first, last) for r in reader.read(p)]
    assert len(rows) == 6 and all('"2024-01-03"' in v for v, _, _ in rows)
    assert all(first[str(p)] <= o < last[str(p)] for _, p, o in rows) and reader.partitions(last, last) == []
    everything = [r for p in reader.partitions({}, last) for r in reader.read(p)]
    assert sorted((p, o) for _, p, o in everything) == [(int(p), o) for p in sorted(last, key=int) for o in range(last[p])]
    for p in first:  # retention drops the first segments
        os.remove(f"{path}/partition={p}/{0:020d}-{first[p]}.jsonl")
    with pytest.raises(RuntimeError, match="lost"):
        reader.partitions({}, last)
    assert [r for p in TopicReader(path, "earliest", False).partitions({}, last) for r in TopicReader(path, "earliest", False).read(p)] == rows
    assert TopicReader(f"{tmp_dir}/none", "latest", True).initialOffset() == {}


def test_a_started_again_query_goes_on_from_its_offsets(spark, tmp_dir):
    append_to_topic(bars(spark, [1, 2], "AB"), f"{tmp_dir}/topic")
    assert len(run(spark, tmp_dir)) == 4
    append_to_topic(bars(spark, [3], "ABCDEF"), f"{tmp_dir}/topic")  # new partitions too
    assert len(run(spark, tmp_dir)) == 10 and len(run(spark, tmp_dir)) == 10
    assert run(spark, tmp_dir, "late", startingOffsets="latest") == []
