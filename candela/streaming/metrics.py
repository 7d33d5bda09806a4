"""What the running query tells about its batches.

``BatchMetrics`` listens to the query's progress: it keeps one row per batch, with the
quality counts that the stream observed on its way into the batch and the batch's duration,
and lets a bounded run end right behind a batch instead of in the middle of one.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from candela.operators.quality import quality_flag

OBSERVED = "arrived"
METRICS = "batch_id long, total_records long, clean_records long, failed_records long, seconds double"


def observe_arrivals(bars: DataFrame) -> DataFrame:
    """Count the arriving bars, and those that pass and fail the quality rules, as they stream by.

    The counts are right where every partition of a batch is read once, as from a batch that is persisted.
    """
    failed = quality_flag().isNotNull()
    return bars.observe(OBSERVED, F.count(F.lit(1)).alias("total_records"),
                        F.count_if(~failed).alias("clean_records"), F.count_if(failed).alias("failed_records"))


class BatchMetrics(StreamingQueryListener):
    """Rows of one query's batches that had data, in order.

    ``behind_a_batch`` is set at every progress, ``ended`` when all progress has been told.
    """

    def __init__(self):
        self.query_id, self.rows = None, {}
        self.behind_a_batch, self.ended = threading.Event(), threading.Event()

    def follow(self, query) -> None:
        self.query_id = str(query.id)
        self.ended.clear()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.query_id in (None, str(p.id)):
            counts = p.observedMetrics.get(OBSERVED)
            if counts is not None and counts["total_records"]:
                self.rows[(str(p.id), p.batchId)] = (
                    p.batchId, counts["total_records"], counts["clean_records"], counts["failed_records"], p.batchDuration / 1000)
            self.behind_a_batch.set()

    def onQueryIdle(self, event) -> None:
        if self.query_id in (None, str(event.id)):
            self.behind_a_batch.set()

    def onQueryTerminated(self, event) -> None:
        if self.query_id in (None, str(event.id)):
            self.behind_a_batch.set()
            self.ended.set()

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per batch of this run."""
        rows = [r for k, r in sorted(self.rows.items(), key=lambda x: x[1][0]) if self.query_id in (None, k[0])]
        return spark.createDataFrame(rows, METRICS)
