import math
import random
import time

import pytest
from pyspark.sql import functions as F

from candela.operators import features as feat
from candela.operators import segmented
from candela.operators.segmented import segmented_features, series_ordinals
from candela.schema import BAR_COLUMNS, FEATURE_COLUMNS
from candela.sources.bars import bars_by_flag
from bar_helpers import bars_df


def flag_bars(spark):
    return bars_by_flag(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"))


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_ordinals_are_exact(spark):
    bars = flag_bars(spark)
    got = {(r.symbol, r.date): r._ord for r in series_ordinals(bars).collect()}
    ref = {}
    for r in bars.orderBy("symbol", *feat.ORDER_COLS).collect():
        ref[(r.symbol, r.date)] = sum(1 for k in ref if k[0] == r.symbol)
    assert got == ref


@pytest.mark.parametrize("chunk", [119, 300])
def test_segmented_equals_plain(spark, chunk):
    bars = flag_bars(spark)
    plain = {(r.symbol, r.date): r for r in feat.ohlcv_features(bars).collect()}
    seg = {(r.symbol, r.date): r for r in segmented_features(bars, chunk_rows=chunk).collect()}
    assert seg.keys() == plain.keys()
    for k, r in plain.items():
        for c in BAR_COLUMNS + FEATURE_COLUMNS:
            assert same(seg[k][c], r[c]), (c, k, seg[k][c], r[c])


def test_null_symbols_take_plain_path(spark):
    rows = [(None, f"2024-01-0{d}", 1.0, 2.0, 1.0, float(d), 1.0) for d in range(1, 4)]
    rows += [("A", f"2024-01-0{d}", 1.0, 2.0, 1.0, float(d), 1.0) for d in range(1, 4)]
    out = segmented_features(bars_df(spark, rows), chunk_rows=120)
    assert out.count() == 6
    assert out.filter(F.col("symbol").isNull()).agg(F.max("sma_7")).first()[0] == 2.0


def test_chunk_must_cover_lookback(spark):
    with pytest.raises(ValueError):
        segmented_features(flag_bars(spark), chunk_rows=100)


def rows_of(df):
    return sorted((tuple(r[c] for c in BAR_COLUMNS + FEATURE_COLUMNS) for r in df.collect()), key=repr)


def test_ties_null_symbols_and_null_dates_equal_the_plain_plan(spark):
    rng = random.Random(8)
    rows = []
    for symbol in ("A", "B", None, ""):
        for i in range(500):
            date = None if i % 11 == 0 else f"2024-{1 + i // 60:02d}-{1 + (i // 20) % 28:02d}"  # up to 20 bars a date
            price = [round(rng.uniform(1, 9), 2) for _ in range(4)]
            rows.append((symbol, date, *price, None if i % 37 == 0 else float(rng.randrange(1, 99))))
    rows += rows[40:60]  # identical rows
    bars = bars_df(spark, rows)
    want = rows_of(feat.ohlcv_features(bars))
    for chunk in (119, 130, 257):
        got = rows_of(segmented_features(bars, chunk_rows=chunk))
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert all(same(x, y) for x, y in zip(a, b)), [(c, x, y) for c, x, y in zip(BAR_COLUMNS + FEATURE_COLUMNS, a, b) if not same(x, y)]


def test_one_date_over_many_chunks(spark):
    rows = [("A", "2024-01-01" if i < 700 else "2024-01-02", 1.0 + i % 7, 9.0, 1.0, 2.0 + i % 5, 1.0) for i in range(1000)]
    bars = bars_df(spark, rows)
    want = {r.date: r.cumulative_return for r in feat.ohlcv_features(bars).collect()}
    got = segmented_features(bars, chunk_rows=120).collect()
    assert all(r.cumulative_return == want[r.date] for r in got) and len(got) == 1000


def test_two_keys_and_no_key(spark):
    bars = flag_bars(spark).withColumn("_aside", F.col("volume") > 500)
    for keys in (("symbol", "_aside"), ()):
        assert rows_of(segmented_features(bars, keys, chunk_rows=400)) == rows_of(feat.ohlcv_features(bars, keys))


def test_chunks_go_on_from_a_state(spark):
    import math

    from candela.streaming.history import batch_rows, empty_state, features_with_history, next_state

    rows = [("A", f"{2020 + i // 300}-{1 + i % 300 // 25:02d}-{1 + i % 25:02d}", 10.0, 12.0, 9.0, 10.0 + (i * 7) % 13 / 4, 5.0 + i % 3)
            for i in range(700)] + [("B", "2020-01-01", 1.0, 2.0, 1.0, 500.0, 1.0), ("B", "2021-06-01", 1.0, 2.0, 1.0, 3.0, 1.0)]
    first, second = (bars_df(spark, [r for r in rows if (r[1] < "2020-08") == early]) for early in (True, False))
    state = next_state(features_with_history(first, empty_state(spark)))
    cut_state = next_state(features_with_history(first, empty_state(spark), 130))
    assert sorted(map(repr, state.collect())) == sorted(map(repr, cut_state.collect()))
    whole, cut = (features_with_history(second, state, n) for n in (None, 130))
    want, got = ({(r.symbol, r.date): r for r in batch_rows(x).collect()} for x in (whole, cut))
    assert set(want) == set(got) and len(want) > 400
    for k, r in want.items():
        for c in FEATURE_COLUMNS:
            a, b = r[c], got[k][c]
            assert a == b or (isinstance(a, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)), (k, c, a, b)
    assert sorted(map(repr, next_state(whole).collect())) == sorted(map(repr, next_state(cut).collect()))


@pytest.mark.parametrize("rows, test", [(1, test_ties_null_symbols_and_null_dates_equal_the_plain_plan),
                                        (200, test_one_date_over_many_chunks), (200, test_chunks_go_on_from_a_state)])
def test_series_longer_than_a_block(spark, monkeypatch, rows, test):
    monkeypatch.setattr(segmented, "BLOCK_ROWS", rows)
    test(spark)


def test_whole_and_cut_series_together(spark, monkeypatch):
    monkeypatch.setattr(segmented, "BLOCK_ROWS", 200)  # blocks of two chunks
    rows = [(s, f"2024-{1 + i // 56:02d}-{1 + i // 2 % 28:02d}", 10.0, 12.0, 9.0, 10.0 + (i * 7) % 13 / 4, 5.0 + i % 3)
            for s, n in (("long", 600), ("short", 250), ("B", 30), (None, 255)) for i in range(n)]
    bars = bars_df(spark, rows)
    for a, b in zip(rows_of(segmented_features(bars, chunk_rows=120)), rows_of(feat.ohlcv_features(bars)), strict=True):
        assert all(same(x, y) for x, y in zip(a, b)), (a, b)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_rows_of_whole_series_move_once(spark):
    before = shuffle_files(spark)
    out = segmented_features(flag_bars(spark), chunk_rows=128)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(symbol" in plan, plan
    assert out.count() == flag_bars(spark).count() > 0
    out = segmented_features(flag_bars(spark), chunk_rows=128)
    for _ in range(50):  # files are dropped in the background
        left = {x.split("_")[1] for x in shuffle_files(spark) - before}
        if len(left) <= 3:  # those of the counts above
            break
        time.sleep(0.2)
    assert len(left) <= 3
