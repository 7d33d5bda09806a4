import datetime as dt

from pyspark.sql import functions as F

from candela.operators.market import holidays_frame, is_market_open, sessions_frame
from candela.operators.sessions import half_days_frame, open_intervals, open_markets, span_of_days

MARKETS = [("NYSE", "America/New_York", "09:30", "16:00", None), ("LSE", "Europe/London", "08:00", "16:30", None),
           ("ASX", "Australia/Sydney", "10:00:00", "16:00:00", None), ("CME", "America/Chicago", "17:00", "16:00", None)]


def test_intervals_settle_clock_changes_half_days_and_midnight(spark):
    holidays = holidays_frame(spark, [("NYSE", dt.date(2024, 3, 8))])
    half = half_days_frame(spark, [("NYSE", dt.date(2024, 3, 12), "13:00"), ("NYSE", dt.date(2024, 3, 12), "14:00")])
    got = {(r.market, r.day): (r.opens, r.closes) for r in open_intervals(
        sessions_frame(spark, MARKETS), dt.date(2024, 3, 7), dt.date(2024, 3, 12), holidays, half).collect()}
    at = lambda *x: dt.datetime(2024, 3, *x)
    assert got["NYSE", dt.date(2024, 3, 7)] == (at(7, 14, 30), at(7, 21))       # winter time
    assert got["NYSE", dt.date(2024, 3, 11)] == (at(11, 13, 30), at(11, 20))    # summer time
    assert got["NYSE", dt.date(2024, 3, 12)] == (at(12, 13, 30), at(12, 17))    # half day, the earlier one
    assert ("NYSE", dt.date(2024, 3, 8)) not in got and ("LSE", dt.date(2024, 3, 8)) in got
    assert ("LSE", dt.date(2024, 3, 9)) not in got                              # a Saturday
    assert got["CME", dt.date(2024, 3, 8)] == (at(8, 23), at(9, 22))            # to the next day
    assert got["ASX", dt.date(2024, 3, 11)] == (at(10, 23), at(11, 5))          # opens on the UTC day before


def test_open_markets_agree_with_the_flag_of_each_row(spark):
    day = [MARKETS[0], MARKETS[1], MARKETS[2]]
    sessions = sessions_frame(spark, day)
    holidays = holidays_frame(spark, [("NYSE", dt.date(2024, 3, 8)), ("LSE", dt.date(2024, 3, 29))])
    ticks = spark.range(0, 60 * 24 * 4).select(F.col("id"), (F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
                                               + F.make_dt_interval(mins=(F.col("id") * 10).cast("int"))).alias("ts"))
    first, last = span_of_days(ticks, "ts")
    got = {r.id: set(r.open_markets) for r in open_markets(ticks, "ts", open_intervals(sessions, first, last, holidays)).collect()}
    for m, *_ in day:
        flags = is_market_open(ticks, "ts", sessions, holidays, market=m).collect()
        assert all((m in got[r.id]) == r.is_open for r in flags) and any(r.is_open for r in flags)
    assert len(got) == 60 * 24 * 4


def test_edges_of_open_markets(spark):
    intervals = open_intervals(sessions_frame(spark, MARKETS[:1]), dt.date(2024, 1, 1), dt.date(2024, 1, 5))
    rows = [("2024-01-02 14:29:59.999999",), ("2024-01-02 14:30:00",), ("2024-01-02 21:00:00",), ("2024-01-02 21:00:00.000001",),
            (None,), ("2030-01-01 15:00:00",)]
    ticks = spark.createDataFrame(rows, "t string").select("t", F.col("t").cast("timestamp_ntz").alias("ts"), F.lit(1).alias("opens"))
    got = {r.t: r.open_markets for r in open_markets(ticks, "ts", intervals).collect()}
    assert [got[t] for t, in rows] == [[], ["NYSE"], ["NYSE"], [], [], []]
    instants = ticks.select("t", F.col("t").cast("timestamp").alias("ts"))  # the session's zone is UTC
    assert {r.t: r.open_markets for r in open_markets(instants, "ts", intervals).collect()} == got
    assert open_markets(ticks.limit(0), "ts", intervals).count() == 0 and span_of_days(ticks.limit(0), "ts")[0].year == 1970
