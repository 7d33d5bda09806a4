"""Spark-native analytics for daily market bars (OHLCV).

Operators are plain ``DataFrame -> DataFrame`` functions built on Spark SQL
functions and windows; they run in batch jobs and inside Structured Streaming
micro-batches alike.
"""

__version__ = "0.1.0"
