"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is written independently of the Spark code, from the column
definitions.  Engine differences it bridges:

* Spark ``skewness`` is the population skewness; DuckDB's is sample-adjusted,
  so it is scaled back by ``(n-2)/sqrt(n(n-1))`` (0 at n = 2, NULL on zero
  variance, as in Spark).  Spark ``kurtosis`` = DuckDB ``kurtosis_pop``.
* ``percentile_approx`` over at most 30 values is exact = ``quantile_disc``.
* ``try_divide(a, b)`` = ``a / nullif(b, 0)``.
* ``cumulative_return`` is an exact DECIMAL(36, 18) running sum, converted to
  double once (IEEE double sum if a frame holds a non-finite return).
* Spark sorts NULL first in ascending order.
"""

from __future__ import annotations

from candela.plans.report import bits_of, sql_round
from candela.schema import (
    BAR_COLUMNS,
    FEATURE_COLUMNS,
    MONTHLY_COLUMNS,
    QUALITY_COLUMNS,
    WEEKLY_COLUMNS,
)

# Window order: date, then the bar values as a tie-break (Spark: NULL first, NaN last).
ORDER_BY = ", ".join(f"{c} NULLS FIRST" for c in ("date", "open", "high", "low", "close", "volume"))
SUPPLIER_SYMBOL = "CAST(l_suppkey AS VARCHAR)"
FLAG_SYMBOL = "l_returnflag || l_linestatus"

# Columns of the feature frame that are not doubles.
NON_DOUBLE = {
    "symbol", "date", "volume_category", "short_trend", "medium_trend",
    "price_movement_category", "is_green_candle", "is_high_volume",
    "price_anomaly_flag", "volume_anomaly_flag", "volatility_regime", "trend_regime",
    "data_quality_flag", "data_quality_status", "is_volume_high",
    "week", "month", "trading_days",
}


def project(columns: list[str], non_double: set[str] = NON_DOUBLE) -> str:
    """Select list in the given order, doubles rounded like the Spark report."""
    return ",\n  ".join(c if c in non_double else f"{sql_round(c, bits_of(c))} AS {c}" for c in columns)


def bars_ctes(symbol_sql: str = SUPPLIER_SYMBOL, name: str = "bars") -> str:
    """``trades`` + ``<name>``: one bar per (symbol, ship day)."""
    return f"""
{name}_trades AS (
  SELECT {symbol_sql} AS symbol,
         strftime(l_shipdate, '%Y-%m-%d') AS date,
         l_extendedprice / nullif(l_quantity, 0) AS p,
         l_quantity AS q, l_orderkey AS k0, l_linenumber AS k1
  FROM lineitem
),
{name} AS (
  SELECT symbol, date,
         first(p ORDER BY k0, k1, p) AS open,
         max(p) AS high,
         min(p) AS low,
         first(p ORDER BY k0 DESC, k1 DESC, p DESC) AS close,
         sum(q) AS volume
  FROM {name}_trades
  GROUP BY symbol, date
)"""


def _over(keys: str, n: int | None = None, unbounded: bool = False) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    spec = f"{part}ORDER BY {ORDER_BY}"
    if unbounded:
        return f"OVER ({spec} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    if n is None:
        return f"OVER ({spec})"
    return f"OVER ({spec} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def feature_ctes(src: str, out: str = "feat", keys: str = "symbol") -> str:
    """CTE chain appending the 50 feature columns to ``src``; the result is ``out``."""
    w = _over(keys)
    w7, w20, w30, w50, w100 = (_over(keys, n) for n in (7, 20, 30, 50, 100))
    wall = _over(keys, unbounded=True)
    return f"""
{out}_b AS (
  SELECT *,
    close - open AS daily_change,
    (close - open) / nullif(open, 0) * 100 AS daily_change_pct,
    high - low AS daily_range,
    (high - low) / nullif(open, 0) * 100 AS daily_range_pct,
    (high + low + close) / 3 AS typical_price,
    (open + high + low + close) / 4 AS ohlc4,
    close * volume AS volume_weighted_price
  FROM {src}
),
{out}_w AS (
  SELECT *,
    avg(close) {w7} AS sma_7,
    avg(close) {w20} AS sma_20,
    avg(close) {w50} AS sma_50,
    avg(volume) {w20} AS avg_volume_20,
    close - lag(close, 1) {w} AS price_momentum_1d,
    close - lag(close, 7) {w} AS price_momentum_7d,
    greatest(close - lag(close, 1) {w}, 0) AS gain,
    greatest(lag(close, 1) {w} - close, 0) AS loss,
    stddev_samp(close) {w20} AS price_stddev_20,
    volume / nullif(avg(volume) {w20}, 0) AS volume_ratio,
    max(high) {w20} AS highest_20d,
    min(low) {w20} AS lowest_20d,
    count(close) {w30} AS o_n30,
    var_pop(close) {w30} AS o_vp30,
    skewness(close) {w30} AS o_sk30,
    kurtosis_pop(close) {w30} AS o_ku30,
    quantile_disc(close, 0.25) {w30} AS price_q1_30d,
    quantile_disc(close, 0.75) {w30} AS price_q3_30d,
    stddev_samp(volume) {w20} AS o_sdvol20,
    lag(close, 1) {w} AS close_lag_1,
    lag(close, 2) {w} AS close_lag_2,
    lag(close, 3) {w} AS close_lag_3,
    lead(close, 1) {w} AS o_next_close,
    CASE WHEN max(CASE WHEN isnan(daily_change_pct) OR isinf(daily_change_pct)
                            OR (daily_change_pct IS NOT NULL
                                AND TRY_CAST(daily_change_pct AS DECIMAL(36, 18)) IS NULL)
                       THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY date NULLS FIRST) > 0
         THEN sum(daily_change_pct) OVER (PARTITION BY {keys} ORDER BY date NULLS FIRST)
         ELSE CAST(sum(TRY_CAST(daily_change_pct AS DECIMAL(36, 18)))
                   OVER (PARTITION BY {keys} ORDER BY date NULLS FIRST) AS DOUBLE)
    END AS cumulative_return,
    max(close) {wall} AS o_peak,
    avg(daily_change_pct) {w30} AS avg_return_30d,
    stddev_samp(daily_change_pct) {w30} AS return_volatility_30d
  FROM {out}_b
),
{out}_a AS (
  SELECT *,
    sma_20 + 2 * price_stddev_20 AS bollinger_upper,
    sma_20 - 2 * price_stddev_20 AS bollinger_lower,
    (close - lowest_20d) / nullif(highest_20d - lowest_20d, 0) * 100 AS stochastic_k,
    (close - lowest_20d) / nullif(highest_20d - lowest_20d, 0) AS price_position,
    CASE WHEN volume_ratio > 2 THEN 'High Volume'
         WHEN volume_ratio > 1.5 THEN 'Above Average' ELSE 'Normal' END AS volume_category,
    CASE WHEN close > sma_7 THEN 1 WHEN close < sma_7 THEN -1 ELSE 0 END AS short_trend,
    CASE WHEN sma_7 > sma_20 THEN 1 WHEN sma_7 < sma_20 THEN -1 ELSE 0 END AS medium_trend,
    CASE WHEN o_n30 < 2 OR o_vp30 = 0 THEN NULL
         WHEN o_n30 = 2 THEN 0.0
         ELSE o_sk30 * (o_n30 - 2) / sqrt(o_n30 * (o_n30 - 1)) END AS price_skewness_30d,
    CASE WHEN o_n30 < 2 OR o_vp30 = 0 THEN NULL ELSE o_ku30 END AS price_kurtosis_30d,
    (close - sma_20) / nullif(price_stddev_20, 0) AS price_zscore,
    (volume - avg_volume_20) / nullif(o_sdvol20, 0) AS volume_zscore,
    close / nullif(sma_7, 0) - 1 AS price_deviation_sma7,
    close / nullif(sma_20, 0) - 1 AS price_deviation_sma20,
    CASE WHEN daily_change_pct > 5 THEN 'Strong_Up'
         WHEN daily_change_pct > 2 THEN 'Up'
         WHEN daily_change_pct > -2 THEN 'Neutral'
         WHEN daily_change_pct > -5 THEN 'Down' ELSE 'Strong_Down' END AS price_movement_category,
    CAST(close > open AS INTEGER) AS is_green_candle,
    CAST(volume > avg_volume_20 AS INTEGER) AS is_high_volume,
    (o_next_close - close) / nullif(close, 0) AS next_day_return,
    close / nullif(o_peak, 0) - 1 AS drawdown,
    avg(price_stddev_20) {w100} AS o_sdavg100
  FROM {out}_w
),
{out} AS (
  SELECT *,
    CASE WHEN abs(price_zscore) > 2 THEN 'Price_Anomaly' ELSE 'Normal' END AS price_anomaly_flag,
    CASE WHEN abs(volume_zscore) > 2 THEN 'Volume_Anomaly' ELSE 'Normal' END AS volume_anomaly_flag,
    abs(price_zscore) + abs(volume_zscore) AS combined_anomaly_score,
    CASE WHEN price_stddev_20 > o_sdavg100 THEN 'High_Volatility'
         ELSE 'Low_Volatility' END AS volatility_regime,
    CASE WHEN short_trend = 1 AND medium_trend = 1 THEN 'Uptrend'
         WHEN short_trend = -1 AND medium_trend = -1 THEN 'Downtrend'
         ELSE 'Sideways' END AS trend_regime
  FROM {out}_a
)"""


def dirty_ctes(src: str = "bars", out: str = "dirty") -> str:
    return f"""
{out}_n AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date NULLS FIRST) AS o_n FROM {src}
),
{out} AS (
  SELECT CASE WHEN o_n % 97 = 0 THEN NULL ELSE symbol END AS symbol,
         date,
         open,
         CASE WHEN o_n % 73 = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN o_n % 79 = 0 THEN low ELSE high END AS high,
         CASE WHEN o_n % 79 = 0 THEN high + 1.0 ELSE low END AS low,
         CASE WHEN o_n % 89 = 0 THEN NULL ELSE close END AS close,
         CASE WHEN o_n % 83 = 0 THEN NULL ELSE volume END AS volume
  FROM {out}_n
)"""


QUALITY_FLAG_SQL = """CASE WHEN symbol IS NULL THEN 'missing_symbol'
         WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL THEN 'missing_price_data'
         WHEN volume IS NULL THEN 'missing_volume'
         WHEN high < low THEN 'invalid_high_low' END"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


def bars_query(symbol_sql: str = SUPPLIER_SYMBOL) -> str:
    return f"{with_(bars_ctes(symbol_sql))}\nSELECT\n  {project(BAR_COLUMNS)}\nFROM bars"


def features_query(columns: list[str], symbol_sql: str = SUPPLIER_SYMBOL) -> str:
    return (f"{with_(bars_ctes(symbol_sql), feature_ctes('bars'))}\n"
            f"SELECT\n  {project(columns)}\nFROM feat")


def weekly_query(symbol_sql: str = SUPPLIER_SYMBOL) -> str:
    body = f"""
per_week AS (
  SELECT symbol,
         CAST(date_trunc('week', TRY_CAST(date AS DATE)) AS DATE) AS week,
         arg_min(open, date) AS week_open,
         max(high) AS week_high,
         min(low) AS week_low,
         arg_max(close, date) AS week_close,
         sum(volume) AS week_volume,
         count(*) AS trading_days
  FROM bars GROUP BY 1, 2
),
weekly AS (
  SELECT *, (week_close - week_open) / nullif(week_open, 0) * 100 AS weekly_change_pct FROM per_week
)"""
    return f"{with_(bars_ctes(symbol_sql), body)}\nSELECT\n  {project(WEEKLY_COLUMNS)}\nFROM weekly"


def monthly_query(symbol_sql: str = SUPPLIER_SYMBOL) -> str:
    body = """
monthly AS (
  SELECT symbol,
         CAST(date_trunc('month', TRY_CAST(date AS DATE)) AS DATE) AS month,
         arg_min(open, date) AS month_open,
         max(high) AS month_high,
         min(low) AS month_low,
         arg_max(close, date) AS month_close,
         sum(volume) AS month_volume,
         avg(close) AS month_avg_price,
         stddev_samp(close) AS month_volatility
  FROM bars GROUP BY 1, 2
)"""
    return f"{with_(bars_ctes(symbol_sql), body)}\nSELECT\n  {project(MONTHLY_COLUMNS)}\nFROM monthly"


def job_columns_query() -> str:
    return (f"{with_(bars_ctes(FLAG_SYMBOL))}\n"
            f"SELECT symbol, date, {sql_round('high - low')} AS price_range,\n"
            "  CASE WHEN volume > 1000000.0 THEN true ELSE false END AS is_volume_high\nFROM bars")


def quality_flags_query() -> str:
    body = f"""
flagged AS (
  SELECT *, {QUALITY_FLAG_SQL} AS data_quality_flag FROM dirty
),
checked AS (
  SELECT *, CASE WHEN data_quality_flag IS NULL THEN 'Passed' ELSE 'Failed' END AS data_quality_status
  FROM flagged
)"""
    return (f"{with_(bars_ctes(FLAG_SYMBOL), dirty_ctes(), body)}\n"
            f"SELECT\n  {project(BAR_COLUMNS + QUALITY_COLUMNS)}\nFROM checked")


PIPELINE_COLUMNS = BAR_COLUMNS + FEATURE_COLUMNS + ["price_range", "is_volume_high"] + QUALITY_COLUMNS


def pipeline_ctes(src: str, keys: str = "symbol") -> str:
    """Features -> job columns (no wall clock) -> quality flags, over ``src``."""
    body = f"""
piped AS (
  SELECT *,
    high - low AS price_range,
    CASE WHEN volume > 1000000.0 THEN true ELSE false END AS is_volume_high,
    {QUALITY_FLAG_SQL} AS data_quality_flag
  FROM feat
),
checked AS (
  SELECT *, CASE WHEN data_quality_flag IS NULL THEN 'Passed' ELSE 'Failed' END AS data_quality_status
  FROM piped
)"""
    return ",".join(c.strip("\n") for c in (feature_ctes(src, keys=keys), body))


def pipeline_query(where: str | None, dirty: bool = True, symbol_sql: str = FLAG_SYMBOL) -> str:
    ctes = [bars_ctes(symbol_sql)]
    src = "bars"
    if dirty:
        ctes.append(dirty_ctes())
        src = "dirty"
    ctes.append(pipeline_ctes(src))
    cond = f"\nWHERE {where}" if where else ""
    return f"{with_(*ctes)}\nSELECT\n  {project(PIPELINE_COLUMNS)}\nFROM checked{cond}"


def quality_counts_query() -> str:
    body = f"""
flagged AS (
  SELECT {QUALITY_FLAG_SQL} AS data_quality_flag FROM dirty
)"""
    return (f"{with_(bars_ctes(FLAG_SYMBOL), dirty_ctes(), body)}\n"
            "SELECT count(*) AS total_records,\n"
            "       count(*) FILTER (WHERE data_quality_flag IS NULL) AS clean_records,\n"
            "       count(*) FILTER (WHERE data_quality_flag IS NOT NULL) AS failed_records\n"
            "FROM flagged")


def batch_metrics_query() -> str:
    """Quality counts of the dirty bars by year, each a batch."""
    body = f"""
flagged AS (
  SELECT dense_rank() OVER (ORDER BY substr(date, 1, 4)) - 1 AS batch_id, {QUALITY_FLAG_SQL} AS data_quality_flag FROM dirty
)"""
    return (f"{with_(bars_ctes(FLAG_SYMBOL), dirty_ctes(), body)}\n"
            "SELECT batch_id, count(*) AS total_records,\n"
            "       count(*) FILTER (WHERE data_quality_flag IS NULL) AS clean_records,\n"
            "       count(*) FILTER (WHERE data_quality_flag IS NOT NULL) AS failed_records\n"
            "FROM flagged GROUP BY batch_id")


def _market_ctes(holidays: list[str]) -> str:
    hol = ", ".join(f"DATE '{d}'" for d in holidays) or "NULL"
    return f"""
loc AS (
  SELECT event_id, ts, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS lt FROM events
),
flags AS (
  SELECT event_id, ts, 'NYSE' AS market,
         strftime(lt, '%Y-%m-%d %H:%M:%S') AS local_time,
         COALESCE(isodow(lt) <= 5
                  AND strftime(lt, '%H:%M:%S.%f') >= '09:30:00.000000'
                  AND strftime(lt, '%H:%M:%S.%f') <= '16:00:00.000000'
                  AND CAST(lt AS DATE) NOT IN ({hol}), false) AS is_open
  FROM loc
)"""


def market_calendar_query(holidays: list[str], half_days: list[tuple[str, str, str]]) -> str:
    """Open markets by wall-clock rules in each market's zone, not by intervals."""
    hol = ", ".join(f"DATE '{d}'" for d in holidays) or "NULL"
    early = " ".join(f"WHEN CAST(ny AS DATE) = DATE '{d}' THEN '{t}:00.000000'" for m, d, t in half_days if m == "NYSE")
    return f"""
WITH loc AS (
  SELECT event_id, ts, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS ny,
         (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Tokyo' AS tk, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS ch
  FROM events),
f AS (
  SELECT event_id, ts,
         isodow(ny) <= 5 AND CAST(ny AS DATE) NOT IN ({hol}) AND strftime(ny, '%H:%M:%S.%f') >= '09:30:00.000000'
           AND strftime(ny, '%H:%M:%S.%f') <= CASE {early} ELSE '16:00:00.000000' END AS n,
         isodow(tk) <= 5 AND strftime(tk, '%H:%M:%S.%f') BETWEEN '09:00:00.000000' AND '15:00:00.000000' AS t,
         (isodow(ch) <= 5 AND strftime(ch, '%H:%M:%S.%f') >= '17:00:00.000000')
           OR (isodow(ch) BETWEEN 2 AND 6 AND strftime(ch, '%H:%M:%S.%f') <= '16:00:00.000000') AS c
  FROM loc)
SELECT event_id, ts, concat_ws(',', CASE WHEN c THEN 'CME' END, CASE WHEN n THEN 'NYSE' END, CASE WHEN t THEN 'TSE' END) AS open_markets
FROM f"""


def market_open_query(holidays: list[str]) -> str:
    return f"{with_(_market_ctes(holidays))}\nSELECT event_id, ts, market, local_time, is_open FROM flags"


def gated_events_query(holidays: list[str]) -> str:
    return (f"{with_(_market_ctes(holidays))}\n"
            "SELECT event_id, 'crypto' AS asset_class, 'extract_crypto_data' AS task FROM flags\n"
            "UNION ALL\n"
            "SELECT event_id, 'stock' AS asset_class, 'extract_stocks_data' AS task FROM flags WHERE is_open")


_PAYLOAD_CTES = """
responses AS (
  SELECT 'alpha_vantage' AS source, symbol || '/' || substr(date, 1, 7) AS request_id, 200 AS status,
         json_object('Time Series (Daily)',
                     json_group_object(date, json_object('1. open', open, '2. high', high, '3. low', low,
                                                         '4. close', close, '5. volume', volume))) AS body,
         'Time Series (Daily)' AS required_key
  FROM bars GROUP BY symbol, substr(date, 1, 7)
  UNION ALL
  SELECT 'binance', CAST(event_id AS VARCHAR),
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END,
         CASE WHEN event_type = 'signup' THEN CAST(props AS JSON)
              ELSE json_object('symbol', upper(event_type), 'price', CAST(value AS VARCHAR)) END,
         'price'
  FROM events
),
checked AS (
  SELECT source, request_id, status,
         CASE WHEN status IS DISTINCT FROM 200
                THEN source || ' API failed with status ' || COALESCE(CAST(status AS VARCHAR), 'NULL')
              WHEN NOT COALESCE(json_type(body) = 'OBJECT'
                                AND list_contains(json_keys(body), required_key), false)
                THEN source || ' response invalid: missing key ' || chr(39) || required_key || chr(39)
         END AS error
  FROM responses
)"""


def payload_validation_query() -> str:
    return (f"{with_(bars_ctes(SUPPLIER_SYMBOL), _PAYLOAD_CTES)}\n"
            "SELECT source, request_id, status, error IS NULL AS is_valid, error FROM checked")


def stream_query(history: bool) -> str:
    """The streaming job over the flag bars, one calendar year per micro-batch.

    Without history the windows restart each batch: features partitioned by
    (symbol, year).  With history they run over the whole series, and only the
    label of the last bar of each year is unknown when its batch is written.
    """
    if not history:
        ctes = [bars_ctes(FLAG_SYMBOL),
                ",".join(c.strip("\n") for c in (feature_ctes("bars", keys="symbol, substr(date, 1, 4)"),))]
        body = """
piped AS (
  SELECT *,
    high - low AS price_range,
    CASE WHEN volume > 1000000.0 THEN true ELSE false END AS is_volume_high,
    """ + QUALITY_FLAG_SQL + """ AS data_quality_flag
  FROM feat
),
checked AS (
  SELECT *, CASE WHEN data_quality_flag IS NULL THEN 'Passed' ELSE 'Failed' END AS data_quality_status
  FROM piped
)"""
        return f"{with_(*ctes, body)}\nSELECT\n  {project(PIPELINE_COLUMNS)}\nFROM checked"
    labels = f"""
labelled AS (
  SELECT * REPLACE (
    CASE WHEN substr(lead(date) OVER (PARTITION BY symbol ORDER BY {ORDER_BY}), 1, 4) = substr(date, 1, 4)
         THEN next_day_return END AS next_day_return)
  FROM checked
)"""
    return (f"{with_(bars_ctes(FLAG_SYMBOL), pipeline_ctes('bars'), labels)}\n"
            f"SELECT\n  {project(PIPELINE_COLUMNS)}\nFROM labelled")


def event_hour_bars_ctes(name: str = "bars") -> str:
    """Hourly bars per event type from ``events``: value as the price, one unit per event."""
    return f"""
{name}_trades AS (
  SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d %H:00') AS date,
         value AS p, 1.0 AS q, ts AS k0, event_id AS k1
  FROM events
),
{name} AS (
  SELECT symbol, date,
         first(p ORDER BY k0, k1, p) AS open,
         max(p) AS high,
         min(p) AS low,
         first(p ORDER BY k0 DESC, k1 DESC, p DESC) AS close,
         sum(q) AS volume
  FROM {name}_trades
  GROUP BY symbol, date
)"""


def event_hour_bars_query() -> str:
    return f"{with_(event_hour_bars_ctes())}\nSELECT\n  {project(BAR_COLUMNS)}\nFROM bars"


def event_hour_features_query() -> str:
    return (f"{with_(event_hour_bars_ctes(), feature_ctes('bars'))}\n"
            f"SELECT\n  {project(BAR_COLUMNS + FEATURE_COLUMNS)}\nFROM feat")


def quarantined_pipeline_query(where: str) -> str:
    """Quality first: bars that fail a rule form their own window series."""
    aside = f"""
flagged_in AS (
  SELECT *, ({QUALITY_FLAG_SQL}) IS NOT NULL AS o_failed FROM dirty
)"""
    return (f"{with_(bars_ctes(FLAG_SYMBOL), dirty_ctes(), aside, pipeline_ctes('flagged_in', 'symbol, o_failed'))}\n"
            f"SELECT\n  {project(PIPELINE_COLUMNS)}\nFROM checked\nWHERE {where}")


def renamed_bars_query(suffix: str) -> str:
    """Supplier bars with a suffix on the symbol."""
    named = f"""
named AS (SELECT * REPLACE (symbol || '{suffix}' AS symbol) FROM bars)"""
    return f"{with_(bars_ctes(SUPPLIER_SYMBOL), named)}\nSELECT\n  {project(BAR_COLUMNS)}\nFROM named"


def event_week_query() -> str:
    """Weekly rollup of the hourly event bars."""
    body = """
weekly AS (
  SELECT symbol, CAST(date_trunc('week', CAST(substr(date, 1, 10) AS DATE)) AS DATE) AS week,
         arg_min(open, date) AS week_open, max(high) AS week_high, min(low) AS week_low,
         arg_max(close, date) AS week_close, sum(volume) AS week_volume, count(*) AS trading_days,
         (arg_max(close, date) - arg_min(open, date)) / nullif(arg_min(open, date), 0) * 100 AS weekly_change_pct
  FROM bars GROUP BY symbol, 2
)"""
    return f"{with_(event_hour_bars_ctes(), body)}\nSELECT\n  {project(WEEKLY_COLUMNS)}\nFROM weekly"


def market_open_instants_query(holidays: list[str]) -> str:
    return f"{with_(_market_ctes(holidays))}\nSELECT event_id, market, local_time, is_open FROM flags"


#: The damaged bars as they arrive, exact copies of stored ones left out.
ARRIVED = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date NULLS FIRST) AS o_n,
         CAST(substr(date, 1, 4) AS INTEGER) AS o_year FROM bars
),
damaged AS (
  SELECT o_n, o_year, CASE WHEN o_n % 97 = 0 THEN NULL ELSE symbol END AS symbol,
         CASE WHEN o_n % 101 = 0 THEN NULL ELSE date END AS date, open,
         CASE WHEN o_n % 79 = 0 THEN low ELSE high END AS high,
         CASE WHEN o_n % 79 = 0 THEN high + 1.0 ELSE low END AS low,
         CASE WHEN o_n % 89 = 0 THEN NULL ELSE close END AS close,
         CASE WHEN o_n % 83 = 0 THEN NULL ELSE volume END AS volume
  FROM numbered
),
arrived AS (
  SELECT symbol, date, open, high, low, close, volume,
         CASE WHEN date IS NULL THEN 0 ELSE o_year + (o_n % 61 = 0)::INTEGER END AS o_batch FROM damaged
  UNION ALL
  SELECT symbol, date, open, high, low, close + 1, volume, o_year + 1 FROM damaged
  WHERE symbol IS NOT NULL AND date IS NOT NULL AND close IS NOT NULL
    AND o_n % 59 = 0 AND o_n % 7 <> 0 AND o_n % 61 <> 0
),
"""


def stream_rollup_query(unit: str) -> str:
    """Rollup by week or month of all bars that the dirty stream stores; of bars of one day the least open and greatest close."""
    first = "(list(open ORDER BY date, open NULLS FIRST) FILTER (WHERE date IS NOT NULL))[1]"
    last = "(list(close ORDER BY date DESC, close DESC NULLS LAST) FILTER (WHERE date IS NOT NULL))[1]"
    if unit == "week":
        rest = f"""{first} AS week_open, max(high) AS week_high, min(low) AS week_low, {last} AS week_close,
         sum(volume) AS week_volume, count(*) AS trading_days"""
        more = ", (week_close - week_open) / nullif(week_open, 0) * 100 AS weekly_change_pct"
    else:
        rest = f"""{first} AS month_open, max(high) AS month_high, min(low) AS month_low, {last} AS month_close,
         sum(volume) AS month_volume, avg(close) AS month_avg_price, stddev_samp(close) AS month_volatility"""
        more = ""
    body = ARRIVED.rstrip().rstrip(",") + f""",
rolled AS (
  SELECT symbol, CAST(date_trunc('{unit}', TRY_CAST(date AS DATE)) AS DATE) AS {unit}, {rest}
  FROM arrived GROUP BY 1, 2
),
finished AS (SELECT *{more} FROM rolled)"""
    columns = WEEKLY_COLUMNS if unit == "week" else MONTHLY_COLUMNS
    return f"{with_(bars_ctes(FLAG_SYMBOL), body)}\nSELECT\n  {project(columns)}\nFROM finished"


def stream_dirty_query() -> str:
    """Dirty bars that arrive late, twice or changed, streamed by arrival with the look-back state.

    Exact copies of stored bars vanish.  Bars without a symbol or a date are series of their own.
    A bar is late if an earlier batch stored its date or a later one for its symbol; late bars
    form a series per batch.  The label of a batch's last bar is unknown when it is written.
    """
    body = ARRIVED + f"""
newest AS (SELECT symbol, o_batch, max(date) AS d FROM arrived WHERE symbol IS NOT NULL AND date IS NOT NULL GROUP BY 1, 2),
stored AS (SELECT symbol, o_batch, max(d) OVER (PARTITION BY symbol ORDER BY o_batch
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_date FROM newest),
dirty AS (
  SELECT a.*, coalesce(a.date <= s.last_date, false) AS o_late,
         CASE WHEN a.symbol IS NULL OR a.date IS NULL THEN row_number() OVER () ELSE 0 END AS o_alone,
         CASE WHEN coalesce(a.date <= s.last_date, false) THEN a.o_batch ELSE -1 END AS o_set
  FROM arrived a LEFT JOIN stored s ON a.symbol = s.symbol AND a.o_batch = s.o_batch
)"""
    keys = "symbol, o_alone, o_set"
    labels = f"""
labelled AS (
  SELECT * REPLACE (
    CASE WHEN lead(o_batch) OVER (PARTITION BY {keys} ORDER BY {ORDER_BY}) = o_batch THEN next_day_return END AS next_day_return,
    CASE WHEN data_quality_flag IS NULL AND date IS NULL THEN 'missing_date'
         WHEN data_quality_flag IS NULL AND o_late THEN 'late_bar' ELSE data_quality_flag END AS data_quality_flag,
    CASE WHEN data_quality_flag IS NULL AND date IS NOT NULL AND NOT o_late THEN 'Passed' ELSE 'Failed' END AS data_quality_status)
  FROM checked
)"""
    return (f"{with_(bars_ctes(FLAG_SYMBOL), body, pipeline_ctes('dirty', keys), labels)}\n"
            f"SELECT\n  {project(PIPELINE_COLUMNS)}\nFROM labelled")
