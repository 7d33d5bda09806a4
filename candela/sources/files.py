"""Bar sources: the JSON message stream, landing CSV folders, provider payloads.

All readers are plain ``spark.read`` / ``spark.readStream`` scans with a fixed
schema (no inference pass over the data), so they split by file and by block
across the cluster, and Catalyst prunes columns and pushes filters into them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.schema import BAR_COLUMNS, BAR_SCHEMA, CSV_COLUMNS, CSV_SCHEMA
from candela.session import listing_by_cores

# The provider's series keys and the file-stem pattern.
STOCK_SERIES_KEY = "Time Series (Daily)"
CRYPTO_SERIES_KEY = "Time Series (Digital Currency Daily)"
FIELD_DECORATION = r"^\s*[0-9]+[a-z]?\.\s*|\s*(\([^)]*\))?\s*$"
FILE_STEM_PATTERN = r"^(.*)\.[^.]*$"


# --------------------------------------------------------------------------- JSON messages

def parse_bars(df: DataFrame, value_col: str = "value", keep_raw: bool = False) -> DataFrame:
    """Message value (binary or string) -> the 7 bar columns.

    PERMISSIVE parsing: garbage, truncated or NULL messages give an all-NULL
    row (later flagged ``missing_symbol``); a field of the wrong type is NULL
    on its own.  ``keep_raw`` keeps the message text as ``_raw`` for the
    failed table.
    """
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, BAR_SCHEMA, {"mode": "PERMISSIVE"})
    cols = [parsed.getField(c).alias(c) for c in BAR_COLUMNS]
    if keep_raw:
        cols.append(text.alias("_raw"))
    return df.select(*cols)


def bar_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    """Streaming source of bar messages, with a ``value`` column.

    ``fmt="kafka"`` takes ``kafka.bootstrap.servers`` / ``subscribe`` options
    (needs the Kafka connector on the classpath); ``fmt="text"`` reads a folder
    of JSON-lines files, one bar per line, which is what tests use.
    """
    opts = {"startingOffsets": "earliest", "failOnDataLoss": "false"} if fmt == "kafka" else {}
    opts.update(options or {})
    reader = spark.readStream.format(fmt).options(**opts)
    return reader.load(path) if path else reader.load()


def read_bar_messages(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a folder of JSON-lines bar messages (same layout as the stream)."""
    return parse_bars(spark.read.text(path))


# --------------------------------------------------------------------------- landing CSV

def file_stem(path_col: Column) -> Column:
    return F.regexp_extract(path_col, FILE_STEM_PATTERN, 1)


def read_landing_csv(spark: SparkSession, path: str, symbol_from: str = "stem") -> DataFrame:
    """Landing CSV files -> bars.

    Every file has one header line (skipped) and then ``date,open,high,low,close,volume``
    by position, whatever the header says.  The symbol comes from

    * ``"stem"``: the file name without extension (``AAPL.csv`` -> ``AAPL``), the
      layout an extractor writes, or
    * ``"partition"``: a ``symbol=<value>`` folder, the layout Spark writes.
    """
    reader = (spark.read.option("header", True).option("enforceSchema", True)
              .option("mode", "PERMISSIVE"))
    if symbol_from == "partition":
        schema = T.StructType(CSV_SCHEMA.fields + [T.StructField("symbol", T.StringType(), True)])
        with listing_by_cores(spark):  # a folder per symbol
            return reader.schema(schema).csv(path).select(*BAR_COLUMNS)
    if symbol_from != "stem":
        raise ValueError(f"symbol_from must be 'stem' or 'partition', got {symbol_from!r}")
    df = reader.schema(CSV_SCHEMA).csv(path)
    # The metadata column gives names as in a URL, but for plus signs.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return df.select(file_stem(name).alias("symbol"), *CSV_COLUMNS)


# --------------------------------------------------------------------------- provider payloads

def pair_symbol(pair: Column) -> Column:
    """``BTC/USD`` -> ``BTC_USD`` (the landing-file stem of a currency pair)."""
    return F.array_join(F.split(pair, "/"), "_")


def flatten_payload(df: DataFrame, body_col: str = "body", series_key: str = STOCK_SERIES_KEY,
                    symbol_col: str = "symbol") -> DataFrame:
    """Provider payload rows -> one bar per (symbol, date) in the payload.

    The series object maps a date to ``{"1. open": "...", ..., "5. volume": "..."}``.
    Fields are taken by name: what stands behind the number, without a currency in
    parentheses.  A field that is absent, or there twice (one per currency), is NULL, and so
    are all fields of a bar that is no object.  Values are strings or numbers and are cast
    with ``try_cast`` (a bad number is NULL, not an error).  A body that is no JSON, or
    without the series key, gives no rows (see ``validate_payloads`` for the reason).

    The body is parsed once, to a VARIANT, and the names are resolved once per payload: a
    bar only looks its fields up under the keys that its payload uses for them.  The explode
    is per payload row, so payloads spread over all tasks.
    """
    series = F.try_variant_get(F.try_parse_json(F.col(body_col)), f"$['{series_key}']", "map<string,variant>")
    bars = F.transform_values("_series", lambda _, bar: F.try_variant_get(bar, "$", "map<string,string>"))
    used = F.array_distinct(F.flatten(F.transform(
        F.filter(F.map_values("_bars"), lambda bar: bar.isNotNull()), F.map_keys)))
    plain = lambda key: F.regexp_replace(F.lower(key), FIELD_DECORATION, "")
    named = lambda c: F.filter("_used", lambda key: plain(key) == c).alias(f"_{c}")
    keys = {c: named(c) for c in CSV_COLUMNS[1:]}
    rows = (df.select(F.col(symbol_col).alias("symbol"), series.alias("_series")).withColumn("_bars", bars)
            .withColumn("_used", used).select("symbol", "_bars", *keys.values())
            .select("symbol", F.explode("_bars").alias("date", "_fields"), *[f"_{c}" for c in keys]))

    def value(c: str) -> Column:
        one = F.element_at("_fields", F.get(f"_{c}", F.lit(0)))
        # A payload whose bars name the field in several ways: the one that this bar has.
        there = F.filter(f"_{c}", lambda key: F.map_contains_key("_fields", key))
        several = F.when(F.size(there) == 1, F.element_at("_fields", F.get(there, F.lit(0))))
        return F.when(F.size(f"_{c}") == 1, one).otherwise(several).try_cast("double").alias(c)

    day = F.try_to_timestamp(F.col("date"), F.lit("yyyy-MM-dd")).cast("date").cast("string")
    return rows.select("symbol", F.coalesce(day, F.col("date")).alias("date"), *[value(c) for c in keys])
