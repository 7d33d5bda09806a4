import datetime as dt
import math

from pyspark.sql import functions as F

from candela.operators.dedupe import latest_bar
from candela.operators.quality import (
    count_observation,
    quality_counts,
    quality_flags,
    split,
)
from candela.operators.rollup import monthly_rollup, weekly_rollup
from bar_helpers import bars_df

WEEK = [
    ("A", "2024-01-03", 10.0, 12.0, 9.0, 11.0, 100.0),   # Wednesday
    ("A", "2024-01-01", 8.0, 9.0, 7.0, 8.5, 50.0),       # Monday, same week, arrives later
    ("A", "2024-01-08", 11.0, 11.0, 10.0, 10.5, 10.0),   # next week
    ("B", "2024-01-02", 1.0, 2.0, 0.5, 1.5, 5.0),
]


def test_weekly_rollup_orders_by_date_not_arrival(spark):
    rows = {(r.symbol, r.week): r for r in weekly_rollup(bars_df(spark, WEEK)).collect()}
    a = rows[("A", dt.date(2024, 1, 1))]
    assert (a.week_open, a.week_high, a.week_low, a.week_close) == (8.0, 12.0, 7.0, 11.0)
    assert a.week_volume == 150.0 and a.trading_days == 2
    assert math.isclose(a.weekly_change_pct, 37.5)
    assert rows[("A", dt.date(2024, 1, 8))].trading_days == 1
    assert rows[("B", dt.date(2024, 1, 1))].week_close == 1.5


def test_monthly_rollup(spark):
    rows = {(r.symbol, r.month): r for r in monthly_rollup(bars_df(spark, WEEK)).collect()}
    a = rows[("A", dt.date(2024, 1, 1))]
    assert (a.month_open, a.month_close, a.month_volume) == (8.0, 10.5, 160.0)
    assert math.isclose(a.month_avg_price, 10.0)
    assert math.isclose(a.month_volatility, math.sqrt(((8.5 - 10) ** 2 + 1 + 0.25) / 2))
    assert rows[("B", dt.date(2024, 1, 1))].month_volatility is None


def test_unparseable_date_gives_null_period_not_error(spark):
    rows = weekly_rollup(bars_df(spark, [("A", "not-a-date", 1.0, 1.0, 1.0, 1.0, 1.0)])).collect()
    assert rows[0].week is None


DIRTY = [
    (None, "2024-01-01", 1.0, 2.0, 1.0, 1.0, 1.0),          # missing_symbol
    ("A", "2024-01-02", 1.0, 2.0, 1.0, None, 1.0),          # missing_price_data
    ("A", "2024-01-03", 1.0, 2.0, 1.0, 1.0, None),          # missing_volume
    ("A", "2024-01-04", 1.0, 1.0, 2.0, 1.0, 1.0),           # invalid_high_low
    ("A", "2024-01-05", 1.0, float("nan"), 1.0, 1.0, 1.0),  # NaN high: passes
    ("A", "2024-01-06", 1.0, 2.0, float("nan"), 1.0, 1.0),  # NaN low: high < NaN -> invalid
    (None, "2024-01-07", None, None, None, None, None),     # first rule wins
    ("A", "2024-01-08", 1.0, 2.0, 1.0, 1.5, 1.0),           # clean
]


def test_quality_flags_first_rule_wins(spark):
    got = [(r.date, r.data_quality_flag, r.data_quality_status)
           for r in quality_flags(bars_df(spark, DIRTY)).orderBy("date").collect()]
    assert got == [
        ("2024-01-01", "missing_symbol", "Failed"),
        ("2024-01-02", "missing_price_data", "Failed"),
        ("2024-01-03", "missing_volume", "Failed"),
        ("2024-01-04", "invalid_high_low", "Failed"),
        ("2024-01-05", None, "Passed"),
        ("2024-01-06", "invalid_high_low", "Failed"),
        ("2024-01-07", "missing_symbol", "Failed"),
        ("2024-01-08", None, "Passed"),
    ]


def test_optional_nan_rule(spark):
    flags = {r.date: r.data_quality_flag for r in quality_flags(bars_df(spark, DIRTY), nan_rule=True).collect()}
    assert flags["2024-01-05"] == "nan_price"


def test_split_and_counts_partition_the_input(spark):
    flagged = quality_flags(bars_df(spark, DIRTY))
    clean, failed = split(flagged)
    assert clean.count() + failed.count() == len(DIRTY)
    (c,) = quality_counts(flagged).collect()
    assert (c.total_records, c.clean_records, c.failed_records) == (8, 2, 6)
    observed, obs = count_observation(flagged)
    observed.filter(F.col("data_quality_status") == "Passed").write.format("noop").mode("overwrite").save()
    assert obs.get == {"total_records": 8, "clean_records": 2, "failed_records": 6}


def test_latest_bar_keeps_one_per_key_and_all_malformed(spark):
    rows = [("A", "2024-01-01", 1.0, 1.0, 1.0, 1.0, 1.0), ("A", "2024-01-01", 1.0, 1.0, 1.0, 1.0, 1.0),
            ("A", "2024-01-01", 2.0, 2.0, 2.0, 2.0, 2.0), (None, "2024-01-01", 1.0, 1.0, 1.0, 1.0, 1.0),
            (None, "2024-01-01", 1.0, 1.0, 1.0, 1.0, 1.0)]
    out = latest_bar(bars_df(spark, rows))
    assert out.filter(F.col("symbol").isNull()).count() == 2
    keyed = out.filter(F.col("symbol") == "A").collect()
    assert len(keyed) == 1 and keyed[0].close == 2.0
