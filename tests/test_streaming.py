import math

from pyspark.sql import functions as F

from candela.operators import features as feat
from candela.schema import BAR_COLUMNS, FEATURE_COLUMNS
from candela.sources.bars import bars_by_flag
from candela.streaming.history import read_state
from candela.streaming.incremental import replay_in_periods, year_of
from candela.streaming.pipeline import PipelineConfig, process_batch, read_output
from bar_helpers import bars_df


def flag_bars(spark):
    return bars_by_flag(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"))


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_stream_with_history_equals_batch(spark):
    bars = flag_bars(spark)
    streamed = {(r.symbol, r.date): r for r in
                replay_in_periods(spark, bars, year_of("date"), history=True).collect()}
    batch = feat.ohlcv_features(bars).collect()
    assert len(streamed) == len(batch)
    # The label of the last bar of every yearly batch is not known when it is written.
    nxt = {}
    for r in sorted(batch, key=lambda r: (r.symbol, r.date)):
        nxt.setdefault(r.symbol, []).append(r.date)
    last_in_batch = set()
    for sym, dates in nxt.items():
        for d, d2 in zip(dates, dates[1:]):
            if d[:4] != d2[:4]:
                last_in_batch.add((sym, d))
    for r in batch:
        s = streamed[(r.symbol, r.date)]
        for c in BAR_COLUMNS + FEATURE_COLUMNS:
            if c == "next_day_return" and (r.symbol, r.date) in last_in_batch:
                assert s[c] is None
            else:
                assert close(s[c], r[c]), (c, r.symbol, r.date, s[c], r[c])


def test_stream_without_history_restarts_windows(spark):
    bars = flag_bars(spark)
    streamed = replay_in_periods(spark, bars, year_of("date"), history=False)
    per_year = feat.ohlcv_features(bars.withColumn("y", year_of("date")), ("symbol", "y"))
    a = sorted((r.symbol, r.date, r.sma_50, r.cumulative_return) for r in streamed.collect())
    b = sorted((r.symbol, r.date, r.sma_50, r.cumulative_return) for r in per_year.collect())
    assert len(a) == len(b)
    assert all(x[:2] == y[:2] and close(x[2], y[2]) and close(x[3], y[3]) for x, y in zip(a, b))


def _cfg(tmp_dir, history=True):
    return PipelineConfig(output_path=f"{tmp_dir}/out", checkpoint_path=f"{tmp_dir}/ckpt",
                          history=history, with_timestamps=False)


def test_replayed_batch_overwrites_its_own_output(spark, tmp_dir):
    cfg = _cfg(tmp_dir)
    b0 = bars_df(spark, [("A", f"2024-01-0{d}", 1.0, 2.0, 1.0, 1.0 + d, 10.0) for d in range(1, 6)])
    c1 = process_batch(b0, 0, cfg)
    c2 = process_batch(b0, 0, cfg)  # the same batch again, as after a failure before commit
    assert c1 == c2 == {"total_records": 5, "clean_records": 5, "failed_records": 0}
    assert read_output(spark, cfg.clean_path).count() == 5
    assert read_state(spark, cfg.output_path)[0].count() == 1


def test_late_and_duplicate_bars(spark, tmp_dir):
    cfg = _cfg(tmp_dir)
    process_batch(bars_df(spark, [("A", "2024-01-02", 1.0, 2.0, 1.0, 1.5, 10.0),
                                  ("A", "2024-01-03", 1.0, 2.0, 1.0, 1.6, 10.0)]), 0, cfg)
    counts = process_batch(bars_df(spark, [
        ("A", "2024-01-01", 1.0, 2.0, 1.0, 1.4, 10.0),   # older than stored: late
        ("A", "2024-01-04", 1.0, 2.0, 1.0, 1.7, 10.0),
        ("A", "2024-01-04", 1.0, 2.0, 1.0, 1.7, 10.0),   # re-delivered copy
    ]), 1, cfg)
    assert counts == {"total_records": 2, "clean_records": 1, "failed_records": 1}
    failed = read_output(spark, cfg.failed_path).collect()
    assert [(r.date, r.data_quality_flag) for r in failed] == [("2024-01-01", "late_bar")]
    clean = {r.date: r for r in read_output(spark, cfg.clean_path).collect()}
    # The new bar continues the stored series: 3-bar SMA and the running sum carry over.
    assert math.isclose(clean["2024-01-04"].sma_7, (1.5 + 1.6 + 1.7) / 3)
    assert math.isclose(clean["2024-01-04"].cumulative_return, 50 + 60 + 70)
    assert clean["2024-01-04"].close_lag_1 == 1.6


def test_empty_batch_is_skipped(spark, tmp_dir):
    cfg = _cfg(tmp_dir)
    assert process_batch(bars_df(spark, []), 0, cfg)["total_records"] == 0


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 57
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert {"ohlcv_features", "weekly_rollup", "stream_with_history", "market_open_events"} <= set(qs)


def test_cli_runs_file_source(spark, tmp_dir):
    from candela.sinks.writers import publish_bars
    from candela.streaming.cli import config_from_args, parse_args
    publish_bars(bars_df(spark, [("A", "2024-01-02", 1.0, 2.0, 1.0, 1.5, 10.0),
                                 (None, "2024-01-02", 1.0, 2.0, 1.0, 1.5, 10.0)]),
                 fmt="text", path=f"{tmp_dir}/src/a")
    args = parse_args(["--output_path", f"{tmp_dir}/out", "--checkpoint_path", f"{tmp_dir}/ck",
                       "--source_format", "text", "--source_path", f"{tmp_dir}/src/*",
                       "--available_now", "--history", "--execution_date", "2024-01-02"])
    from candela.streaming.pipeline import run_pipeline
    cfg = config_from_args(args)
    run_pipeline(spark, cfg, poll_seconds=0.5)
    assert read_output(spark, cfg.clean_path).count() == 1
    assert [r.data_quality_flag for r in read_output(spark, cfg.failed_path).collect()] == ["missing_symbol"]


def test_quarantine_before_keeps_failed_bars_out_of_windows(spark):
    from candela.streaming.pipeline import PipelineConfig, transform_batch
    rows = [("A", "2024-01-01", 1.0, 2.0, 1.0, 1.0, 10.0),
            ("A", "2024-01-02", 1.0, 2.0, 1.0, None, 10.0),      # missing close: fails
            ("A", "2024-01-03", 1.0, 2.0, 1.0, 3.0, 10.0)]
    after, _ = transform_batch(bars_df(spark, rows), PipelineConfig("", "", with_timestamps=False))
    before, _ = transform_batch(bars_df(spark, rows),
                                PipelineConfig("", "", with_timestamps=False, quarantine="before"))
    a = {r.date: r for r in after.collect()}
    b = {r.date: r for r in before.collect()}
    assert a["2024-01-03"].close_lag_1 is None        # the failed bar is its neighbour
    assert b["2024-01-03"].close_lag_1 == 1.0         # set aside: the clean bar before it
    assert b["2024-01-02"].data_quality_flag == "missing_price_data"


def bar(symbol, day, close, volume=10.0):
    return (symbol, day, 1.0, 2.0, 1.0, close, volume)


def test_fresh_checkpoint_on_an_old_folder_replaces_nothing(spark, tmp_dir):
    from candela.sinks.writers import publish_bars
    from candela.streaming.pipeline import run_pipeline

    def run(name, rows):
        publish_bars(bars_df(spark, rows), fmt="text", path=f"{tmp_dir}/src-{name}/a")
        cfg = PipelineConfig(output_path=f"{tmp_dir}/out", checkpoint_path=f"{tmp_dir}/ck-{name}", source_format="text",
                             source_path=f"{tmp_dir}/src-{name}/*", available_now=True, history=True,
                             sink_format="delta")  # absent here: the run falls back to Parquet, once
        return run_pipeline(spark, cfg, poll_seconds=0.5)

    first = run("one", [bar("A", f"2024-01-0{d}", 1.0 + d) for d in range(1, 6)])
    again = run("two", [bar("A", "2024-01-06", 7.0), bar("A", "2024-01-03", 4.0)])  # one new, one sent again
    assert first.run_id != again.run_id and again.sink_format == "parquet"
    assert again.clean_path.endswith("clean_data_parquet_fallback")
    rows = {r.date: r for r in read_output(spark, again.clean_path, again).collect()}
    assert sorted(rows) == [f"2024-01-0{d}" for d in range(1, 7)]
    assert rows["2024-01-06"].close_lag_1 == 6.0  # the look-back of the earlier run goes on
    assert read_output(spark, again.failed_path, again).count() == 0


def test_a_drain_has_no_deadline_and_failures_surface(spark, tmp_dir):
    import pytest

    from candela.sinks.writers import publish_bars
    from candela.streaming import pipeline
    from candela.streaming.pipeline import run_pipeline

    publish_bars(bars_df(spark, [bar("A", "2024-01-01", 1.0), bar(None, "2024-01-01", 1.0)]), fmt="text", path=f"{tmp_dir}/src/a")
    cfg = PipelineConfig(output_path=f"{tmp_dir}/out", checkpoint_path=f"{tmp_dir}/ck", source_format="text",
                         source_path=f"{tmp_dir}/src/*", available_now=True, timeout_minutes=1e-9, history=True)
    write, calls = pipeline.write_batch, []

    def failing(df, path, *rest):
        calls.append(path)
        if path.endswith("failed_data"):
            raise OSError("disk full")
        return write(df, path, *rest)

    pipeline.write_batch = failing
    try:
        with pytest.raises(Exception, match="disk full"):
            run_pipeline(spark, cfg, poll_seconds=0.2)
    finally:
        pipeline.write_batch = write
    done = run_pipeline(spark, cfg, poll_seconds=0.2)  # the batch is replayed from the checkpoint
    assert read_output(spark, done.clean_path, done).count() == 1
    assert read_output(spark, done.failed_path, done).count() == 1
    assert read_state(spark, done.output_path)[0].count() == 1


def test_broken_state_raises_and_old_snapshots_go(spark, tmp_dir):
    import glob

    import pytest

    from candela.sinks import folders

    cfg = _cfg(tmp_dir)
    for b in range(4):
        process_batch(bars_df(spark, [bar("A", f"2024-01-0{b + 1}", 1.0 + b), bar(f"S{b}", "2024-01-01", 1.0)]), b, cfg)
    kept = folders.subfolders(spark, f"{cfg.output_path}/_history_state")
    assert [x.partition("-")[0][-1] for x in kept] == ["3", "4"]  # of the third and fourth batch
    assert read_state(spark, cfg.output_path)[0].count() == 5  # untouched symbols are carried over
    for f in glob.glob(f"{cfg.output_path}/_history_state/{kept[-1]}/tails/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"broken")
    for f in glob.glob(f"{cfg.output_path}/_history_state/{kept[-1]}/tails/.*.crc"):
        with open(f, "wb") as out:
            out.write(b"")
    with pytest.raises(Exception):
        process_batch(bars_df(spark, [bar("A", "2024-01-09", 9.0)]), 4, cfg)


def test_bars_without_date_or_symbol_stay_out_of_the_series(spark, tmp_dir):
    cfg = _cfg(tmp_dir)
    series = [bar("A", f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", 1.0 + i % 9) for i in range(151)]
    process_batch(bars_df(spark, series[:150]), 0, cfg)
    counts = process_batch(bars_df(spark, [bar("A", None, 5.0), bar(None, "2024-01-01", 5.0), bar("", "2024-01-01", 5.0)]), 1, cfg)
    assert counts == {"total_records": 3, "clean_records": 0, "failed_records": 3}
    process_batch(bars_df(spark, series[150:]), 2, cfg)
    want = {r.date: r for r in feat.ohlcv_features(bars_df(spark, series)).collect()}[series[150][1]]
    got = read_output(spark, cfg.clean_path, cfg).filter(F.col("date") == series[150][1]).first()
    for c in FEATURE_COLUMNS:
        assert close(got[c], want[c]), c
    flags = sorted(r.data_quality_flag for r in read_output(spark, cfg.failed_path, cfg).collect())
    assert flags == ["missing_date", "missing_symbol", "missing_symbol"]


def test_redelivered_bars_are_dropped_and_changed_ones_are_late(spark, tmp_dir):
    cfg = _cfg(tmp_dir)
    series = [bar("A", f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", 1.0 + i) for i in range(140)]
    process_batch(bars_df(spark, series), 0, cfg)
    sent = [*series, bar("A", "2024-12-01", 500.0), bar("A", "2024-01-05", 77.0)]  # all again, one new, one changed
    counts = process_batch(bars_df(spark, sent).filter("not (date = '2024-01-05' and close = 5.0)"), 1, cfg)
    assert counts == {"total_records": 2, "clean_records": 1, "failed_records": 1, "redelivered_records": 139}
    assert read_output(spark, cfg.clean_path, cfg).count() == 141
    assert [r.data_quality_flag for r in read_output(spark, cfg.failed_path, cfg).collect()] == ["late_bar"]


def test_raw_messages_of_failed_rows(spark, tmp_dir):
    from pyspark.sql import Row

    from candela.sources.files import parse_bars

    cfg = PipelineConfig(output_path=f"{tmp_dir}/out", checkpoint_path=f"{tmp_dir}/ck", keep_raw=True, with_timestamps=False)
    lines = spark.createDataFrame([Row(value="garbage"), Row(value='{"symbol": "A", "date": "2024-01-01", "open": 1, "high": 2, "low": 1, "close": 1, "volume": 1}')])
    process_batch(parse_bars(lines, keep_raw=True), 0, cfg)
    assert [r._raw for r in read_output(spark, cfg.failed_path, cfg).collect()] == ["garbage"]
    assert read_output(spark, cfg.clean_path, cfg).count() == 1


def test_processing_time_trigger_ends_with_its_time(spark, tmp_dir):
    from candela.sinks.writers import publish_bars
    from candela.streaming.pipeline import run_pipeline

    publish_bars(bars_df(spark, [bar("A", "2024-01-01", 1.0)]), fmt="text", path=f"{tmp_dir}/src/a")
    cfg = PipelineConfig(output_path=f"{tmp_dir}/out", checkpoint_path=f"{tmp_dir}/ck", source_format="text",
                         source_path=f"{tmp_dir}/src/*", trigger_seconds=1, timeout_minutes=0.4)
    done = run_pipeline(spark, cfg, poll_seconds=0.5)
    rows = read_output(spark, done.clean_path, done).collect()
    assert len(rows) == 1 and rows[0].processing_date is not None and rows[0].processed_timestamp is not None
    assert not [q for q in spark.streams.active if q.isActive]
