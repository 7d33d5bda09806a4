"""Batches that appear whole, bars sent again, and rollups kept by the stream."""

import math

import pytest
from pyspark.sql import functions as F

from bar_helpers import bars_df
from candela.operators.rollup import monthly_rollup, weekly_rollup
from candela.sinks import folders
from candela.streaming import commits, pipeline, redelivery
from candela.streaming.history import read_state
from candela.streaming.pipeline import PipelineConfig, labelled_output, process_batch, read_output, shuffle_tasks
from candela.streaming.redelivery import OTHER, digests, hashed, merged_digests
from candela.streaming.rollups import read_monthly, read_weekly


def bar(symbol, day, close, volume=10.0):
    return (symbol, day, 1.0, 2.0, 1.0, close, volume)


def cfg_of(tmp_dir, **more):
    return PipelineConfig(output_path=f"{tmp_dir}/out", checkpoint_path=f"{tmp_dir}/ck", history=True, with_timestamps=False, **more)


def seen(spark, cfg):
    """All that readers see: rows, labels, state, rollups."""
    rows = labelled_output(spark, cfg).select("symbol", "date", "close", "next_day_return", "data_quality_flag").collect()
    state, stored = read_state(spark, cfg.output_path)
    return (sorted(map(repr, rows)), sorted(map(repr, state.collect())), sorted(map(repr, stored.collect())),
            sorted(map(repr, read_weekly(spark, cfg.rollups_path).collect())))


def test_a_half_written_batch_is_never_seen(spark, tmp_dir, monkeypatch):
    cfg = cfg_of(tmp_dir, rollups=True)
    first = bars_df(spark, [bar("A", "2024-01-02", 1.5), bar("B", "2024-01-02", 5.0), bar(None, "2024-01-02", 1.0)])
    second = bars_df(spark, [bar("A", "2024-01-03", 1.6), bar("A", "2024-01-01", 9.0), bar("B", "2024-01-04", 6.0)])
    process_batch(first, 0, cfg)
    before = seen(spark, cfg)
    for broken in ["clean", "failed", "labels", "write_known", "write_state", "update_rollups", "record"]:
        name = broken if hasattr(pipeline, broken) else "write_batch"
        true = getattr(pipeline, name)

        def failing(*args, true=true, name=name, broken=broken, **more):
            done = true(*args, **more) if name != "record" else None
            if name != "write_batch" or args[1] == getattr(cfg, f"{broken}_path"):
                raise OSError("lost")  # written, then lost
            return done

        monkeypatch.setattr(pipeline, name, failing)
        with pytest.raises(OSError, match="lost"):
            process_batch(second, 1, cfg)
        monkeypatch.setattr(pipeline, name, true)
        assert seen(spark, cfg) == before, broken
    counts = process_batch(second, 1, cfg)
    assert counts == {"total_records": 3, "clean_records": 2, "failed_records": 1}
    after = seen(spark, cfg)
    assert len(after[0]) == 6 and sum("late_bar" in r for r in after[0]) == 1
    assert process_batch(second, 1, cfg) == counts and seen(spark, cfg) == after  # recorded: not written again
    rows = {(r.symbol, r.date): r for r in labelled_output(spark, cfg).collect() if r.data_quality_flag is None}
    assert math.isclose(rows["A", "2024-01-02"].next_day_return, (1.6 - 1.5) / 1.5)


def test_sending_the_whole_history_again_reads_none_of_it(spark, tmp_dir, monkeypatch):
    cfg = cfg_of(tmp_dir)
    days = [f"2024-{1 + i // 20:02d}-{1 + i % 20:02d}" for i in range(60)]
    read = []
    true = redelivery.known_bars
    monkeypatch.setattr(redelivery, "known_bars", lambda s, p, months, v: read.append(list(months)) or true(s, p, months, v))
    process_batch(bars_df(spark, [bar(s, d, 1.0 + i) for i, d in enumerate(days[:50]) for s in "AB"]), 0, cfg)
    for k in range(1, 6):
        sent = [bar(s, d, 1.0 + i) for i, d in enumerate(days[:50 + k]) for s in "AB"]
        counts = process_batch(bars_df(spark, sent), k, cfg)
        assert counts["total_records"] == 2 and counts["redelivered_records"] == 2 * (49 + k)
    assert read == [[]] * 5
    rows = read_output(spark, cfg.clean_path, cfg)
    assert rows.count() == 110 and read_output(spark, cfg.failed_path, cfg).count() == 0
    last = rows.filter("symbol = 'A'").orderBy(F.desc("date")).first()
    assert last.close_lag_1 == 54.0 and math.isclose(last.sma_7, sum(range(49, 56)) / 7)
    # A month sent in part, with one bar changed: that month alone is read.
    counts = process_batch(bars_df(spark, [bar("A", days[0], 1.0), bar("A", days[1], 77.0), bar("B", days[45], 46.0)]), 8, cfg)
    assert read[-1] == ["2024-01", "2024-03"] and counts == {
        "total_records": 1, "clean_records": 0, "failed_records": 1, "redelivered_records": 2}
    # Now the changed bar is stored too; sent again it goes, and so does the whole of January with it.
    again = [bar("A", d, 1.0 + i) for i, d in enumerate(days[:20])] + [bar("A", days[1], 77.0)]
    no_dedupe = cfg_of(tmp_dir, dedupe=False)
    assert process_batch(bars_df(spark, again), 9, no_dedupe) == {
        "total_records": 0, "clean_records": 0, "failed_records": 0, "redelivered_records": 21}
    assert read[-1] == []


def test_digests_tell_sets_of_bars_apart(spark):
    rows = [bar("A", "2024-01-02", 1.5), bar("A", "2024-01-03", None), bar("A", "soon", 1.0), (None, "2024-01-02", 1.0, 2.0, 1.0, 1.0, 1.0)]
    one = {(r.symbol, r.month): (r.n, r.x1, r.x2) for r in digests(hashed(bars_df(spark, rows + rows))).collect()}
    assert set(one) == {("A", "2024-01"), ("A", OTHER)} and one["A", "2024-01"][0] == 2
    # A NULL is not left out of the hash: it matters where it stands.
    a = digests(hashed(bars_df(spark, [("A", "2024-01-02", None, 3.0, 1.0, 1.0, 1.0)]))).first()
    b = digests(hashed(bars_df(spark, [("A", "2024-01-02", 3.0, None, 1.0, 1.0, 1.0)]))).first()
    assert (a.x1, a.x2) != (b.x1, b.x2)
    split = merged_digests(digests(hashed(bars_df(spark, rows[:1]))), digests(hashed(bars_df(spark, rows[1:]))))
    assert {(r.symbol, r.month): (r.n, r.x1, r.x2) for r in split.collect()} == one


def test_records_are_few_and_ordered_by_their_sequence(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    last = commits.newest(spark, out)
    assert last.seq == 0 and not last.holds("a", 0)
    for k in range(20):  # two runs whose names do not sort by time
        run = "zz" if k < 10 else "aa"
        last = commits.record(spark, out, last, run, k % 10, {"total_records": k}, f"s{k}")
    assert commits.newest(spark, out) == last and last.runs == {"zz": 9, "aa": 9} and last.state == "s19"
    assert len(folders.files(spark, f"{out}/{commits.FOLDER}")) <= 2 * commits.KEPT  # and their check sums
    with pytest.raises(FileExistsError):  # another writer was first
        commits.record(spark, out, commits.Commit(last.seq - 1), "bb", 0, {}, None)
    rows = spark.createDataFrame([("aa", 9), ("aa", 10), ("bb", 0)], "run_id string, batch_id long")
    assert [tuple(r) for r in commits.committed(rows, out).collect()] == [("aa", 9)]


def test_rollups_of_batches_are_those_of_all_bars(spark, tmp_dir):
    cfg = cfg_of(tmp_dir, rollups=True)
    batches = [
        [bar("A", f"2024-01-{d:02d}", 10.0 + d % 5, d * 1.0) for d in range(1, 20)] + [bar(None, "2024-01-03", 4.0), bar("A", None, 2.0)],
        [bar("A", f"2024-01-{d:02d}", 11.0 + d % 7, d * 1.0) for d in range(20, 32)] + [bar("A", "2023-12-30", 3.0), bar("B", "2024-01-30", None)],
        [bar("A", "2024-02-01", float("nan")), bar("B", "2024-01-29", 8.0), bar("A", "not a day", 1.0)]]
    for k, rows in enumerate(batches):
        process_batch(bars_df(spark, rows), k, cfg)
    everything = bars_df(spark, [r for rows in batches for r in rows])

    def same(got, want):
        got, want = ({(r[0], r[1]): r for r in x.collect()} for x in (got, want))
        assert set(got) == set(want)
        for k, r in want.items():
            for a, b in zip(got[k], r):
                assert a == b or (isinstance(a, float) and isinstance(b, float) and (
                    math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12))), (k, got[k], r)

    same(read_weekly(spark, cfg.rollups_path), weekly_rollup(everything))
    same(read_monthly(spark, cfg.rollups_path), monthly_rollup(everything))


def test_a_batch_has_tasks_for_its_rows_and_files_for_its_months(spark, tmp_dir, monkeypatch):
    assert [shuffle_tasks(n, 8, 200) for n in (1, 80_000, 1_000_000, 10**9)] == [8, 8, 100, 3200]
    assert shuffle_tasks(1, 8, 3) == 3
    seen, whole = [], pipeline._process

    def process(batch_df, *rest):
        seen.append(batch_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return whole(batch_df, *rest)

    monkeypatch.setattr(pipeline, "_process", process)
    monkeypatch.setattr(pipeline, "TASK_ROWS", 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        cfg = PipelineConfig(output_path=f"{tmp_dir}/out", checkpoint_path=f"{tmp_dir}/c", history=True, rollups=True)
        days = [f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}" for i in range(84)]
        bars = bars_df(spark, [(s, d, 1.0, 2.0, 1.0, 1.5, 10.0) for d in days for s in "ABCDEF"]).repartition(16)
        assert process_batch(bars, 0, cfg)["total_records"] == 504
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
        assert process_batch(bars_df(spark, [("A", "2024-06-01", 1.0, 2.0, 1.0, 1.5, 10.0)]), 1, cfg)["total_records"] == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    cores = min(64, spark.sparkContext.defaultParallelism)
    assert seen == [str(max(cores, 6)), str(max(cores, 2))]  # 504 rows; one row and a look-back
    for folder in (f"{cfg.known_path}/month=2024-02", f"{cfg.rollups_path}/begins=2024-02"):
        assert len(folders.files(spark, folder)) == 1, folder  # not one a task


def test_task_sizes_do_not_change_a_batch(spark, tmp_dir, monkeypatch):
    bars = bars_df(spark, [(s, f"2024-01-{1 + i:02d}", 1.0 + i, 2.0 + i, 1.0, 1.5 + i, 10.0) for i in range(28) for s in "ABCDEF"])
    found = []
    monkeypatch.setattr(pipeline, "MOST_TASKS", 3)
    for rows in (12, 10_000):
        monkeypatch.setattr(pipeline, "TASK_ROWS", rows)
        cfg = PipelineConfig(output_path=f"{tmp_dir}/{rows}", checkpoint_path=f"{tmp_dir}/c{rows}", history=True, with_timestamps=False)
        process_batch(bars.filter("date < '2024-01-15'"), 0, cfg)
        process_batch(bars.filter("date >= '2024-01-13'"), 1, cfg)
        found.append(sorted(tuple(r) for r in read_output(spark, cfg.clean_path).drop("run_id").fillna(-1.0).collect()))
    assert found[0] == found[1] and len(found[0]) == 168
