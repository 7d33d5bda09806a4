import datetime as dt
import os

from pyspark.sql import functions as F

from candela.operators.market import (
    extraction_plan,
    holidays_frame,
    is_market_open,
    sessions_frame,
)
from candela.operators.payload import bars_to_payloads, validate_payloads
from candela.schema import BAR_COLUMNS
from candela.sinks.writers import bars_to_messages, publish_bars, write_landing_csv, write_table
from candela.sources.files import (
    CRYPTO_SERIES_KEY,
    flatten_payload,
    pair_symbol,
    parse_bars,
    read_bar_messages,
    read_landing_csv,
)
from bar_helpers import bars_df

BARS = [("AAPL", "2024-01-02", 10.0, 12.0, 9.0, 11.0, 100.0),
        ("AAPL", "2024-01-03", 11.0, 13.0, 10.5, 12.5, 1e-7),
        ("BTC_USD", "2024-01-02", 42000.5, 43000.25, 41000.0, 42500.0, 1234.5678)]


def rows(df):
    return sorted(tuple(r) for r in df.select(*BAR_COLUMNS).collect())


def test_json_message_round_trip(spark, tmp_dir):
    df = bars_df(spark, BARS)
    msg = bars_to_messages(df).first().value
    assert msg.startswith('{"date":') and msg.endswith('"symbol":"AAPL"}') or '"symbol"' in msg
    publish_bars(df, fmt="text", path=f"{tmp_dir}/msgs")
    assert rows(read_bar_messages(spark, f"{tmp_dir}/msgs")) == sorted(BARS)


def test_permissive_parse(spark):
    msgs = spark.createDataFrame([("garbage",), (None,), ('{"symbol":"A","open":',),
                                  ('{"symbol":"A","date":"2024-01-02","open":"x","close":1.5}',),
                                  ('{"symbol":"A","high":NaN}',)], "value string")
    got = parse_bars(msgs).collect()
    assert sum(r.symbol is None and r.date is None for r in got) == 3
    typed = [r for r in got if r.date == "2024-01-02"][0]
    assert typed.open is None and typed.close == 1.5 and typed.symbol == "A"


def test_landing_csv_symbol_from_stem(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/landing")
    with open(f"{tmp_dir}/landing/AAPL.csv", "w") as f:
        # Provider-style header, newest first: position decides, not the header.
        f.write(",1. open,2. high,3. low,4. close,5. volume\n")
        f.write("2024-01-03,11.0,13.0,10.5,12.5,1e-07\n2024-01-02,10.0,12.0,9.0,11.0,100\n")
    with open(f"{tmp_dir}/landing/BTC_USD.csv", "w") as f:
        f.write("date,open,high,low,close,volume\n2024-01-02,42000.5,43000.25,41000.0,42500.0,1234.5678\n")
    assert rows(read_landing_csv(spark, f"{tmp_dir}/landing")) == sorted(BARS)


def test_landing_csv_round_trip_by_partition(spark, tmp_dir):
    write_landing_csv(bars_df(spark, BARS), f"{tmp_dir}/csv")
    assert rows(read_landing_csv(spark, f"{tmp_dir}/csv", symbol_from="partition")) == sorted(BARS)


def test_payload_flatten_stock_and_crypto(spark):
    df = bars_df(spark, BARS)
    for key in ("Time Series (Daily)", CRYPTO_SERIES_KEY):
        assert rows(flatten_payload(bars_to_payloads(df, key), "body", key)) == sorted(BARS)
    # A body without the key (an error response) yields no rows; a bad number is NULL.
    bad = spark.createDataFrame([("X", '{"Note": "rate limited"}'),
                                 ("Y", '{"Time Series (Daily)": {"2024-01-02": {"1. open": "oops", '
                                       '"2. high": "2", "3. low": "1", "4. close": "1.5", "5. volume": "9"}}}')],
                                "symbol string, body string")
    out = flatten_payload(bad).collect()
    assert len(out) == 1 and out[0].open is None and out[0].close == 1.5


def test_pair_symbol(spark):
    df = spark.createDataFrame([("BTC/USD",)], "pair string")
    assert df.select(pair_symbol(F.col("pair")).alias("s")).first().s == "BTC_USD"


def test_table_falls_back_to_parquet(spark, tmp_dir):
    written = write_table(bars_df(spark, BARS), f"{tmp_dir}/table", fmt="delta")
    # No Delta package in this environment: the Parquet fallback is used.
    assert written.endswith("_parquet_fallback")
    back = spark.read.parquet(written)
    assert back.count() == len(BARS) and "symbol" in back.columns


def _ticks(spark, stamps):
    return spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "id long, ts timestamp_ntz")


def test_market_open_boundaries(spark):
    utc = lambda s: dt.datetime.fromisoformat(s)
    stamps = [
        utc("2024-01-02 14:30:00"),         # Tue 09:30:00 NY: open (inclusive)
        utc("2024-01-02 14:29:59.999999"),  # before open
        utc("2024-01-02 21:00:00"),         # 16:00:00 NY: open (inclusive)
        utc("2024-01-02 21:00:00.000001"),  # after close
        utc("2024-01-06 15:00:00"),         # Saturday
        utc("2024-01-15 15:00:00"),         # holiday (Monday)
        utc("2024-07-02 13:30:00"),         # summer time: 09:30 EDT
    ]
    hol = holidays_frame(spark, [("NYSE", dt.date(2024, 1, 1)), ("NYSE", dt.date(2024, 1, 15))])
    out = is_market_open(_ticks(spark, stamps), "ts", sessions_frame(spark), hol).orderBy("id").collect()
    assert [r.is_open for r in out] == [True, False, True, False, False, False, True]
    assert out[0].local_time == "2024-01-02 09:30:00"


def test_extraction_plan(spark):
    ticks = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_open boolean")
    got = sorted((r.id, r.task) for r in extraction_plan(ticks).collect())
    assert got == [(1, "extract_crypto_data"), (1, "extract_stocks_data"),
                   (2, "extract_crypto_data"), (3, "extract_crypto_data")]


def test_validate_payloads(spark):
    df = spark.createDataFrame([
        ("alpha_vantage", 200, '{"Time Series (Daily)": {}}'),
        ("alpha_vantage", 200, '{"Note": "limit"}'),
        ("binance", 200, '{"symbol": "BTCUSDT", "price": null}'),
        ("binance", 429, '{"price": "1"}'),
        ("binance", 200, "not json"),
        ("other", 200, "{}"),
    ], "source string, status int, body string")
    got = [(r.is_valid, r.error) for r in validate_payloads(df).collect()]
    assert got == [
        (True, None),
        (False, "alpha_vantage response invalid: missing key 'Time Series (Daily)'"),
        (True, None),
        (False, "binance API failed with status 429"),
        (False, "binance response invalid: missing key 'price'"),
        (True, None),
    ]


def test_payload_fields_are_named_per_payload_and_read_per_bar(spark):
    import json

    from candela.sources.files import STOCK_SERIES_KEY

    day = lambda **f: {k.replace("__", ". "): v for k, v in f.items()}
    mixed = {"2024-01-02": day(**{"1__open": "1.5", "4__close": 2, "5__volume": "x"}),
             "2024-01-03": {"1a. open (USD)": "3", "1b. open (EUR)": "4", "4. close": "5"},   # open is there twice
             "2024-01-04": {"1a. open (USD)": "6", "CLOSE": "7"},
             "2024-01-05": "no object", "2024-01-06": None, "2024-01-07": {}}
    bodies = [json.dumps({STOCK_SERIES_KEY: mixed}), "{truncated", None, "[]", json.dumps({"Note": "limit"}),
              json.dumps({STOCK_SERIES_KEY: {}}), json.dumps({STOCK_SERIES_KEY: None})]
    rows = flatten_payload(spark.createDataFrame([("A", b) for b in bodies], "symbol string, body string")).collect()
    got = {r.date: (r.open, r.close, r.volume) for r in rows}
    assert got == {"2024-01-02": (1.5, 2.0, None), "2024-01-03": (None, 5.0, None), "2024-01-04": (6.0, 7.0, None),
                   "2024-01-05": (None, None, None), "2024-01-06": (None, None, None), "2024-01-07": (None, None, None)}
