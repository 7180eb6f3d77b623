"""Streaming uniqueness: first arrival per id wins within a bounded horizon.

State is bounded by event time (the watermark), not by a count of ids; the RocksDB state
store keeps it off-heap.  Rows without an id are never duplicates: they pass beside the
stateful operator.  Rows arriving behind the watermark are dropped by Spark's operator;
``DroppedRows`` counts them over all batches, so the loss is visible (the ``foreachBatch``
silver path never drops)."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

DEFAULT_HORIZON = "2 hours"


def dedup_within_watermark(stream: DataFrame, key: str = "_event_id", event_time: str = "meta_dt",
                           horizon: str = DEFAULT_HORIZON) -> DataFrame:
    df = stream
    if dict(df.dtypes).get(event_time) == "timestamp_ntz":
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    df = df.withWatermark(event_time, horizon)
    unique = df.where(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return unique.unionByName(df.where(F.col(key).isNull()))


class DroppedRows(StreamingQueryListener):
    """Counts late rows discarded by stateful operators, batch by batch.

        with DroppedRows(spark) as dropped:
            query = ...start(); query.awaitTermination()
        dropped.total(query)
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.counts, self.ended = spark, {}, {}

    def __enter__(self) -> "DroppedRows":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        for run in list(self.ended):
            self.ended[run].wait(60)        # the end is reported after the last batch
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.counts[str(event.runId)] = 0
        self.ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.counts[run] = self.counts.get(run, 0) + sum(
            op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def total(self, query) -> int:
        return self.counts[str(query.runId)]
