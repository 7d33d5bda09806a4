import math

import pytest
from pyspark.sql import functions as F

from candela.operators import features as feat
from candela.schema import FEATURE_COLUMNS
from bar_helpers import bars_df


def approx(a, b, tol=1e-9):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)


def one(spark, rows):
    return [r.asDict() for r in feat.ohlcv_features(bars_df(spark, rows)).orderBy("date").collect()]


def test_golden_single_bar(spark):
    (r,) = one(spark, [("AAPL", "2024-01-02", 10.0, 12.0, 9.0, 11.0, 100.0)])
    assert r["daily_change"] == 1 and r["daily_change_pct"] == 10
    assert r["daily_range"] == 3 and r["daily_range_pct"] == 30
    assert approx(r["typical_price"], 32 / 3) and r["ohlc4"] == 10.5
    assert r["volume_weighted_price"] == 1100
    assert r["sma_7"] == r["sma_20"] == r["sma_50"] == 11
    assert r["gain"] == 0 and r["loss"] == 0
    for c in ["price_stddev_20", "bollinger_upper", "bollinger_lower", "price_zscore",
              "volume_zscore", "combined_anomaly_score", "next_day_return", "close_lag_1",
              "close_lag_2", "close_lag_3", "price_momentum_1d", "price_momentum_7d",
              "return_volatility_30d"]:
        assert r[c] is None, c
    assert r["volume_ratio"] == 1 and r["volume_category"] == "Normal"
    assert approx(r["stochastic_k"], 200 / 3) and approx(r["price_position"], 2 / 3)
    assert (r["short_trend"], r["medium_trend"], r["trend_regime"]) == (0, 0, "Sideways")
    assert r["price_movement_category"] == "Strong_Up"
    assert (r["is_green_candle"], r["is_high_volume"]) == (1, 0)
    assert r["volatility_regime"] == "Low_Volatility"
    assert r["price_anomaly_flag"] == r["volume_anomaly_flag"] == "Normal"
    assert r["cumulative_return"] == 10 and r["drawdown"] == 0
    assert r["avg_return_30d"] == 10


def test_golden_second_flat_bar(spark):
    a, b = one(spark, [("AAPL", "2024-01-02", 10.0, 12.0, 9.0, 11.0, 100.0),
                       ("AAPL", "2024-01-03", 11.0, 11.0, 11.0, 11.0, 300.0)])
    assert b["daily_range_pct"] == 0 and b["sma_7"] == 11
    assert b["price_stddev_20"] == 0 and b["price_zscore"] is None
    assert b["price_skewness_30d"] is None and b["price_kurtosis_30d"] is None
    assert b["volume_ratio"] == 1.5 and b["volume_category"] == "Normal"  # strict >
    assert b["highest_20d"] == 12 and b["lowest_20d"] == 9
    assert a["next_day_return"] == 0 and b["next_day_return"] is None
    assert b["gain"] == 0 and b["loss"] == 0


def test_column_order_and_count(spark):
    df = feat.ohlcv_features(bars_df(spark, [("A", "2024-01-02", 1.0, 1.0, 1.0, 1.0, 1.0)]))
    assert df.columns[7:] == FEATURE_COLUMNS
    assert len(df.columns) == 57


@pytest.mark.parametrize("volumes,label", [
    ((1.0, 1.0, 7.0), "High Volume"),      # 7 / 3 = 2.33
    ((1.0, 1.0, 4.0), "Above Average"),    # 4 / 2 = 2 exactly: not > 2
    ((1.0, 2.0, 3.0), "Normal"),           # 3 / 2 = 1.5 exactly: not > 1.5
])
def test_volume_category_boundaries(spark, volumes, label):
    rows = [("A", f"2024-01-0{i + 1}", 1.0, 1.0, 1.0, 1.0, v) for i, v in enumerate(volumes)]
    *_, last = one(spark, rows)
    assert last["volume_category"] == label


def test_volume_ratio_exact_two_is_above_average(spark):
    # three bars 0, 0, 3: mean 1 -> ratio 3 -> High; bars 1,1,4: mean 2 -> ratio 2 exactly -> Above Average
    rows = [("A", f"2024-01-0{i}", 1.0, 1.0, 1.0, 1.0, v) for i, v in ((1, 1.0), (2, 1.0), (3, 4.0))]
    *_, c = one(spark, rows)
    assert c["volume_ratio"] == 2.0 and c["volume_category"] == "Above Average"


@pytest.mark.parametrize("close,label", [
    (105.0, "Up"), (105.0001, "Strong_Up"), (102.0, "Neutral"), (102.0001, "Up"),
    (98.0, "Down"), (98.0001, "Neutral"), (95.0, "Strong_Down"), (95.0001, "Down"),
])
def test_movement_category_boundaries(spark, close, label):
    (r,) = one(spark, [("A", "2024-01-02", 100.0, 200.0, 1.0, close, 1.0)])
    assert r["price_movement_category"] == label


def test_null_conditions_fall_to_otherwise(spark):
    (r,) = one(spark, [("A", "2024-01-02", None, None, None, None, None)])
    assert r["price_movement_category"] == "Strong_Down"
    assert r["volume_category"] == "Normal"
    assert r["short_trend"] == 0 and r["medium_trend"] == 0
    assert r["volatility_regime"] == "Low_Volatility"
    assert r["is_green_candle"] is None and r["is_high_volume"] is None


def test_zero_open_and_zero_range_give_null_not_error(spark):
    (r,) = one(spark, [("A", "2024-01-02", 0.0, 5.0, 5.0, 5.0, 0.0)])
    assert r["daily_change_pct"] is None and r["daily_range_pct"] is None
    assert r["stochastic_k"] is None and r["price_position"] is None
    assert r["volume_ratio"] is None


def test_invariants_on_real_bars(spark):
    from candela.sources.bars import bars_by_flag
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    df = feat.ohlcv_features(bars_by_flag(li))
    bad = df.filter(
        (F.col("lowest_20d") > F.col("close")) | (F.col("close") > F.col("highest_20d"))
        | (F.col("drawdown") > 0)
        | (F.col("price_position") < 0) | (F.col("price_position") > 1)
        | (F.col("gain") * F.col("loss") != 0)).count()
    assert bad == 0


def test_single_symbol_partitioned_equals_unpartitioned(spark):
    from candela.sources.bars import bars_by_flag
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    one_sym = bars_by_flag(li).filter(F.col("symbol") == "NO")
    a = feat.ohlcv_features(one_sym, ("symbol",)).orderBy("date").collect()
    b = feat.ohlcv_features(one_sym, ()).orderBy("date").collect()
    assert len(a) == len(b) > 100
    for x, y in zip(a, b):
        for k in x.asDict():
            assert approx(x[k], y[k]) if isinstance(x[k], float) else x[k] == y[k], k


def test_ties_on_date_are_deterministic(spark):
    rows = [("A", "2024-01-01", 1.0, 2.0, 1.0, 2.0, 10.0), ("A", "2024-01-01", 1.0, 3.0, 1.0, 3.0, 10.0),
            ("A", "2024-01-02", 2.0, 2.0, 2.0, 2.0, 10.0)]
    r1 = sorted(map(str, feat.ohlcv_features(bars_df(spark, rows)).collect()))
    r2 = sorted(map(str, feat.ohlcv_features(bars_df(spark, rows[::-1]).repartition(3)).collect()))
    assert r1 == r2


def test_job_columns(spark):
    df = feat.job_columns(bars_df(spark, [("A", "2024-01-02", 1.0, 3.0, 1.0, 2.0, 2e6),
                                          ("A", "2024-01-03", 1.0, 3.0, 1.0, 2.0, None)]))
    rows = df.orderBy("date").collect()
    assert [r["is_volume_high"] for r in rows] == [True, False]
    assert rows[0]["price_range"] == 2.0
    assert rows[0]["processed_timestamp"] is not None and rows[0]["processing_date"] is not None


def test_30_bar_moments_match_spark_window_aggregates(spark):
    """The lag-column moments and quartiles equal Spark's own window aggregates,
    with NULL closes, flat runs and short series start-up frames in the data."""
    import random
    rnd = random.Random(7)
    rows = []
    for sym, n in (("A", 95), ("B", 40), ("C", 3)):
        for i in range(n):
            close = None if i % 17 == 5 else (50.0 if 20 <= i < 55 else round(rnd.uniform(10, 90), 2))
            rows.append((sym, f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", 1.0, 99.0, 0.5, close, 10.0))
    feats = feat.ohlcv_features(bars_df(spark, rows))
    w30 = feat.trailing(("symbol",), 30)
    ref = feats.select(
        "symbol", "date", "price_skewness_30d", "price_kurtosis_30d", "price_q1_30d", "price_q3_30d",
        F.skewness("close").over(w30).alias("sk"), F.kurtosis("close").over(w30).alias("ku"),
        F.percentile_approx("close", 0.25).over(w30).alias("q1"),
        F.percentile_approx("close", 0.75).over(w30).alias("q3")).collect()
    assert len(ref) == 138
    for r in ref:
        assert r["price_q1_30d"] == r["q1"] and r["price_q3_30d"] == r["q3"], r
        for ours, theirs in (("price_skewness_30d", "sk"), ("price_kurtosis_30d", "ku")):
            if r[theirs] is None or math.isnan(r[theirs]):
                assert r[ours] is None, r
            else:
                assert r[ours] == pytest.approx(r[theirs], rel=1e-9, abs=1e-9), r


def test_chained_stages_equal_composite(spark):
    """The eight stage functions chained give the composite's columns and values."""
    from bar_helpers import SF_SMALL
    from candela.plans.queries import flag_bars
    bars = flag_bars(spark, SF_SMALL)
    chained = bars
    for stage in feat.STAGES.values():
        chained = chained.transform(stage)
    composite = feat.ohlcv_features(bars)
    assert chained.columns == composite.columns
    key = ["symbol", "date"]
    a = {tuple(r[k] for k in key): r for r in chained.collect()}
    b = {tuple(r[k] for k in key): r for r in composite.collect()}
    assert a.keys() == b.keys()
    for k, ra in a.items():
        rb = b[k]
        for c in composite.columns:
            x, y = ra[c], rb[c]
            if isinstance(x, float) and isinstance(y, float):
                assert x == pytest.approx(y, rel=1e-9, abs=1e-9, nan_ok=True), (k, c)
            else:
                assert x == y, (k, c)
