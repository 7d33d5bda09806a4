"""Helpers of the bar tests, in a module of their own name: any folder may have a conftest."""

from candela.schema import BAR_SCHEMA

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def bars_df(spark, rows):
    """rows: (symbol, date, open, high, low, close, volume)"""
    return spark.createDataFrame(rows, BAR_SCHEMA)


def by_date(df, *cols):
    return [r.asDict() for r in df.orderBy("symbol", "date").collect()] if not cols else \
        [tuple(r[c] for c in cols) for r in df.orderBy("symbol", "date").collect()]
