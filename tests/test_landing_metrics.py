"""The landing folder as a stream, and what the listener tells."""

import os

from bar_helpers import bars_df
from candela.sinks.writers import publish_bars
from candela.sources.landing import stage_landing
from candela.streaming.metrics import BatchMetrics
from candela.streaming.pipeline import PipelineConfig, read_output, run_pipeline


def put(folder, name, rows, when):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as out:
        out.write(",1. open,2. high,3. low,4. close,5. volume\n" + "".join(",".join(map(str, r)) + "\n" for r in rows))
    os.utime(path, (when, when))


def day(d, close):
    return (f"2024-01-{d:02d}", 1.0, 9.0, 1.0, close, 10)


def test_rewritten_files_are_read_again_and_only_then(spark, tmp_dir):
    land = f"{tmp_dir}/land"
    cfg = PipelineConfig(output_path=f"{tmp_dir}/out", checkpoint_path=f"{tmp_dir}/ck", source_format="landing", source_path=land,
                         available_now=True, history=True, max_files=1)
    put(land, "AAPL.csv", [day(2, 3.0), day(1, 2.0)], 1_000_000)
    put(land, "BTC_USD.csv", [day(1, 5.0)], 1_000_000)
    put(land, "notes.txt", [], 1_000_000)
    metrics = BatchMetrics()
    done = run_pipeline(spark, cfg, poll_seconds=0.3, metrics=metrics)
    assert [r[:4] for r in metrics.frame(spark).collect()] in ([(0, 2, 2, 0), (1, 1, 1, 0)], [(0, 1, 1, 0), (1, 2, 2, 0)])  # one file a batch
    run_pipeline(spark, cfg, poll_seconds=0.3)  # nothing new: nothing read
    put(land, "AAPL.csv", [day(3, 4.0), day(2, 3.0), day(1, 2.0)], 1_000_060)  # the whole history again
    done = run_pipeline(spark, cfg, poll_seconds=0.3)
    rows = {(r.symbol, r.date): r for r in read_output(spark, done.clean_path, done).collect()}
    assert sorted(rows) == [("AAPL", "2024-01-01"), ("AAPL", "2024-01-02"), ("AAPL", "2024-01-03"), ("BTC_USD", "2024-01-01")]
    assert rows["AAPL", "2024-01-03"].close_lag_1 == 3.0 and read_output(spark, done.failed_path, done).count() == 0
    assert stage_landing(spark, land, cfg.staged_path) == []


def test_stems_with_odd_names(spark, tmp_dir):
    land = f"{tmp_dir}/land"
    for name in ("BRK.B.csv", "a b+c@d.csv", "100%.csv"):
        put(land, name, [day(1, 2.0)], 1_000_000)
    cfg = PipelineConfig(output_path=f"{tmp_dir}/out", checkpoint_path=f"{tmp_dir}/ck", source_format="landing", source_path=land, available_now=True)
    done = run_pipeline(spark, cfg, poll_seconds=0.3)
    assert sorted(r.symbol for r in read_output(spark, done.clean_path, done).collect()) == ["100%", "BRK.B", "a b+c@d"]


def test_listener_counts_and_a_bounded_run_that_ends_behind_a_batch(spark, tmp_dir):
    publish_bars(bars_df(spark, [("A", "2024-01-01", 1.0, 2.0, 1.0, 1.0, 1.0), (None, "2024-01-01", 1.0, 2.0, 1.0, 1.0, 1.0),
                                 ("A", "2024-01-02", 1.0, 2.0, 1.0, None, 1.0)]), fmt="text", path=f"{tmp_dir}/src/a")
    cfg = PipelineConfig(output_path=f"{tmp_dir}/out", checkpoint_path=f"{tmp_dir}/ck", source_format="text",
                         source_path=f"{tmp_dir}/src/*", trigger_seconds=1, timeout_minutes=0.01)  # over before the batch is
    metrics = BatchMetrics()
    done = run_pipeline(spark, cfg, poll_seconds=0.2, metrics=metrics)
    assert [r[:4] for r in metrics.frame(spark).collect()] == [(0, 3, 1, 2)]
    assert read_output(spark, done.clean_path, done).count() == 1 and read_output(spark, done.failed_path, done).count() == 2
    assert not [q for q in spark.streams.active if q.isActive]
