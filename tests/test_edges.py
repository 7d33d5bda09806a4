"""Inputs that the fixtures lack: overflow, undefined moments, zones, date forms, odd payloads, writers."""

import datetime as dt
import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from candela.operators import features as feat
from candela.operators.market import holidays_frame, is_market_open, sessions_frame
from candela.operators.rollup import weekly_rollup
from candela.session import LISTING_CONF, is_local_master
from candela.sinks.writers import format_available, write_landing_csv, write_landing_files, write_table
from candela.sources.files import CRYPTO_SERIES_KEY, flatten_payload, read_landing_csv
from candela.streaming.pipeline import read_output
from bar_helpers import bars_df


def test_running_return_beyond_the_decimal_falls_back_to_doubles(spark):
    rows = [("A", f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", 1e-15, 2.0, 1e-15, 5.0, 1.0) for i in range(300)]
    got = [r.cumulative_return for r in feat.ohlcv_features(bars_df(spark, rows)).orderBy("date").collect()]
    one = (5.0 - 1e-15) / 1e-15 * 100
    assert all(math.isclose(x, one * (i + 1), rel_tol=1e-9) for i, x in enumerate(got))


def test_moments_of_frames_without_a_finite_value(spark):
    nan, inf = float("nan"), float("inf")
    for values in ([nan, nan, nan], [inf, inf], [-inf], [nan, 1.0], [3.0, 3.0], [None, None]):
        rows = [("A", f"2024-01-{i + 1:02d}", 1.0, 1.0, 1.0, v, 1.0) for i, v in enumerate(values)]
        got = feat.ohlcv_features(bars_df(spark, rows)).orderBy(F.desc("date")).first()
        want = bars_df(spark, rows).agg(F.skewness("close").alias("s"), F.kurtosis("close").alias("k")).first()
        for a, b in ((got.price_skewness_30d, want.s), (got.price_kurtosis_30d, want.k)):
            assert (a is None) == (b is None) and (a is None or math.isnan(a) == math.isnan(b)), (values, a, b)


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_instants_are_right_in_any_session_zone(spark, zone):
    local = spark.newSession()
    local.conf.set("spark.sql.session.timeZone", zone)
    ticks = local.sql("SELECT timestamp '2024-01-02 15:00:00Z' AS ts UNION ALL SELECT timestamp '2024-01-02 03:00:00Z'"
                      " UNION ALL SELECT timestamp '2024-07-02 13:30:00Z'")
    holidays = holidays_frame(local, [("NYSE", dt.date(2024, 1, 1))])
    got = {r.local_time: r.is_open for r in is_market_open(ticks, "ts", sessions_frame(local), holidays).collect()}
    assert got == {"2024-01-02 10:00:00": True, "2024-01-01 22:00:00": False, "2024-07-02 09:30:00": True}


def test_rollup_takes_every_form_that_casts(spark):
    dates = ["2024-01-02", "2024-01-02 10:15:30", "2024-01-02T10:16", "2024-1-3", "2024-01-04 09:00"]
    rows = [("A", d, float(i), 9.0, 0.0, float(i), 1.0) for i, d in enumerate(dates, 1)] + [("A", "rubbish", 1.0, 1.0, 1.0, 1.0, 1.0)]
    got = {str(r.week): r for r in weekly_rollup(bars_df(spark, rows)).collect()}
    assert set(got) == {"2024-01-01", "None"}
    assert (got["2024-01-01"].week_open, got["2024-01-01"].week_close, got["2024-01-01"].trading_days) == (1.0, 5.0, 5)


def test_payload_fields_go_by_name(spark):
    bodies = [('{"%s": {"2024-01-02": {"10. volume": "7", "1a. open (USD)": "1", "1b. open (EUR)": "2", "2. high": "4",'
               ' "3a. low (USD)": "0.5", "4. close": "3", "6. market cap": "99"}}}' % CRYPTO_SERIES_KEY,)]
    r = flatten_payload(spark.createDataFrame(bodies, "body string").withColumn("symbol", F.lit("X")), "body", CRYPTO_SERIES_KEY).first()
    assert (r.open, r.high, r.low, r.close, r.volume) == (None, 4.0, 0.5, 3.0, 7.0)


def test_a_failing_writer_is_not_an_absent_format(spark, tmp_dir):
    assert format_available(spark, "parquet") and not format_available(spark, "no_such_format")
    bars = bars_df(spark, [("A", "2024-01-01", 1.0, 1.0, 1.0, 1.0, 1.0)])
    with open(f"{tmp_dir}/blocked", "w"):
        pass
    with pytest.raises(Exception):
        write_table(bars, f"{tmp_dir}/blocked/table", fmt="parquet")
    assert not os.path.exists(f"{tmp_dir}/blocked/table_parquet_fallback")


def test_files_per_symbol_are_bounded(spark, tmp_dir):
    rows = [(f"S{i % 40}", f"2024-01-{1 + i % 28:02d}", 1.0, 1.0, 1.0, float(i), 1.0) for i in range(4000)]
    bars = bars_df(spark, rows).repartition(16)
    write_landing_csv(bars, f"{tmp_dir}/csv")
    written = write_table(bars, f"{tmp_dir}/table", fmt="parquet")
    for pattern in (f"{tmp_dir}/csv/symbol=*/part-*", f"{written}/symbol=*/part-*"):
        assert len(glob.glob(pattern)) <= 80  # 40 symbols, 16 tasks
    assert read_landing_csv(spark, f"{tmp_dir}/csv", symbol_from="partition").count() == 4000


def listing_tasks(spark, group, read):
    """(jobs, tasks of the largest) that a read takes before any row is asked for."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        read()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = tracker.getJobIdsForGroup(group)
    stages = [tracker.getStageInfo(i) for j in jobs for i in tracker.getJobInfo(j).stageIds]
    return len(jobs), max(s.numTasks for s in stages)


def test_folders_per_symbol_are_listed_once_by_few_tasks(spark, tmp_dir):
    few = 4 * spark.sparkContext.defaultParallelism
    rows = [(f"{i:03d}", "2024-01-01", 1.0, 1.0, 1.0, float(i), 1.0) for i in range(few + 20)]
    rows += [(None, "2024-01-02", 1.0, 1.0, None, math.nan, 1.0), ("a/b=é%", "2024-01-03", 1.0, 1.0, 1.0, math.inf, 1.0)]
    bars = bars_df(spark, rows)
    write_landing_csv(bars, f"{tmp_dir}/csv")
    written = write_table(bars, f"{tmp_dir}/table", fmt="parquet")
    assert not glob.glob(f"{tmp_dir}/*/symbol=*/.*.crc")  # no second file and process for each
    reads = {"csv": lambda: read_landing_csv(spark, f"{tmp_dir}/csv", symbol_from="partition"),
             "table": lambda: read_output(spark, written, schema=bars.schema)}
    for name, read in reads.items():
        before = spark.conf.get(LISTING_CONF, None)
        assert listing_tasks(spark, f"{tmp_dir}-{name}", read) == (1, few)
        assert spark.conf.get(LISTING_CONF, None) == before
        got = read().select(bars.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, bars.collect()))
    # Appended once more, to folders that are there: every row twice, also without a given schema.
    write_table(bars, f"{tmp_dir}/table", fmt="parquet", mode="append")
    assert read_output(spark, written).count() == 2 * len(rows)


def test_landing_files_are_named_by_symbol(spark, tmp_dir):
    rows = [(s, f"2024-01-{d:02d}", 1.0, 2.0, 0.5, float(d), 3.0) for s in ("AAPL", "BTC_USD", "a b%") for d in (1, 2, 3)]
    write_landing_files(bars_df(spark, rows), f"{tmp_dir}/landing")
    assert sorted(os.path.basename(f) for f in glob.glob(f"{tmp_dir}/landing/*.csv")) == ["AAPL.csv", "BTC_USD.csv", "a b%.csv"]
    got = read_landing_csv(spark, f"{tmp_dir}/landing")
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)
    with pytest.raises(ValueError):
        write_landing_files(bars_df(spark, [(None, "2024-01-01", 1.0, 1.0, 1.0, 1.0, 1.0)]), f"{tmp_dir}/none")


def test_only_a_local_master_may_use_a_local_folder():
    assert is_local_master("local") and is_local_master("local[8]")
    assert not is_local_master("local-cluster[3,2,1024]") and not is_local_master("spark://h:7077") and not is_local_master("yarn")
