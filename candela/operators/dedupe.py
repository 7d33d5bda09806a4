"""Keep one bar per (symbol, date).

Sources re-deliver bars (a publisher re-sends the whole history on every run),
and row-frame windows need a unique (symbol, date) to be meaningful.  The
dedupe is a ``groupBy`` with ``max_by`` -- partial aggregation collapses copies
map-side -- rather than a window, so a key delivered a million times never
lands in one task as a million rows.  Rows with a NULL symbol or date are not
collapsed (they are distinct malformed inputs, kept for the failed table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.schema import BAR_COLUMNS

VALUE_COLUMNS = ["open", "high", "low", "close", "volume"]


def latest_bar(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row per (symbol, date): the copy with the greatest ``order_col``
    (an ingest time or offset), ties and the no-order case broken by the values."""
    keyed = df.filter(F.col("symbol").isNotNull() & F.col("date").isNotNull())
    loose = df.filter(F.col("symbol").isNull() | F.col("date").isNull()).select(*BAR_COLUMNS)
    values = F.struct(*[F.col(c) for c in VALUE_COLUMNS])
    rank = F.struct(F.col(order_col), values) if order_col else values
    best = (keyed.groupBy("symbol", "date")
                 .agg(F.max_by(values, rank).alias("_v"))
                 .select("symbol", "date", *[F.col("_v").getField(c).alias(c) for c in VALUE_COLUMNS]))
    return best.unionByName(loose)
