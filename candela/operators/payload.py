"""Provider-response validation and the payload fixture builder.

``validate_payloads`` turns (source, status, body) rows into ``is_valid`` and
``error``: a response is valid when its status is 200 and its JSON body has the
key its source must return.  The HTTP calls themselves are outside Spark; this
operator checks responses once they are landed as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.sources.files import STOCK_SERIES_KEY

# The key each source must return, the payload field names and the error texts.
REQUIRED_KEYS = {
    "alpha_vantage": "Time Series (Daily)",
    "binance": "price",
}
PAYLOAD_FIELDS = ["1. open", "2. high", "3. low", "4. close", "5. volume"]
STATUS_ERROR = " API failed with status "
KEY_ERROR = " response invalid: missing key '"


def _required_key(source: Column, required: dict[str, str]) -> Column:
    expr = None
    for src, key in required.items():
        cond = source == F.lit(src)
        expr = F.when(cond, F.lit(key)) if expr is None else expr.when(cond, F.lit(key))
    return expr if expr is not None else F.lit(None).cast("string")


def validate_payloads(df: DataFrame, source_col: str = "source", status_col: str = "status",
                      body_col: str = "body", required: dict[str, str] | None = None) -> DataFrame:
    """Append ``is_valid`` (boolean) and ``error`` (NULL when valid).

    The key test is presence of a top-level key (its value may be anything);
    a body that is not a JSON object has no keys.  Sources without a required
    key are checked on status only.
    """
    required = REQUIRED_KEYS if required is None else required
    source, status = F.col(source_col), F.col(status_col)
    key = _required_key(source, required)
    top = F.from_json(F.col(body_col), T.MapType(T.StringType(), T.StringType()))
    has_key = F.coalesce(F.map_contains_key(top, key), F.lit(False))
    status_ok = F.coalesce(status == F.lit(200), F.lit(False))
    error = (F.when(~status_ok, F.concat(source, F.lit(STATUS_ERROR),
                                         F.coalesce(status.cast("string"), F.lit("NULL"))))
              .when(key.isNotNull() & ~has_key,
                    F.concat(source, F.lit(KEY_ERROR), key, F.lit("'"))))
    return (df.withColumn("error", error)
              .withColumn("is_valid", F.col("error").isNull()))


def bars_to_payloads(bars: DataFrame, series_key: str = STOCK_SERIES_KEY) -> DataFrame:
    """Bars -> one provider-style JSON payload per (symbol, calendar month).

    Each payload maps date -> {"1. open": "...", ...} with values as strings.
    A provider answers with daily bars, so a group has at most 31; finer bars need a
    finer period.
    """
    fields = F.create_map(*[x for name, c in zip(PAYLOAD_FIELDS, ["open", "high", "low", "close", "volume"])
                            for x in (F.lit(name), F.col(c).cast("string"))])
    return (bars
            .withColumn("period", F.substring("date", 1, 7))
            .groupBy("symbol", "period")
            .agg(F.map_from_entries(F.collect_list(F.struct(F.col("date"), fields))).alias("series"))
            .select("symbol", "period",
                    F.to_json(F.create_map(F.lit(series_key), F.col("series"))).alias("body")))
