"""Raw landing: events partitioned by *event* time (dt, hour from meta.dt).

Writes are rebalanced by (dt, hour): adaptive execution splits a busy hour over
several tasks by its bytes and joins quiet hours, whatever their number.  Streams
land batch by batch under ``batch_id``, so a retried batch replaces its own files.  A
mirror of files that lie in their partitions already is written without a shuffle: it gets
no more files than it read.

An overwrite is staged in a folder of its own and published at the end.  Tasks move their
files there themselves (committer version 2), so the driver only moves whole folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

PARTITION_COLUMNS = ("dt", "hour")


def event_time_partitions(meta_dt_text: Column) -> tuple[Column, Column]:
    """dt = text before 'T'; hour = first two characters after it."""
    dt = F.substring_index(meta_dt_text, "T", 1)
    hour = F.substring(F.substring_index(meta_dt_text, "T", -1), 1, 2).try_cast("int")
    return dt, hour


def with_partitions(events: DataFrame) -> DataFrame:
    dt, hour = event_time_partitions(F.col("meta.dt"))
    return events.withColumn("dt", dt).withColumn("hour", hour)


def staged_overwrite(writer: DataFrameWriter) -> DataFrameWriter:
    """Overwrites only the folders that the rows belong to."""
    return (writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2"))


def write_partitioned(df: DataFrame, path: str, partitions: tuple[str, ...] = PARTITION_COLUMNS,
                      mode: str = "append", max_records_per_file: int = 1_000_000, gathered: bool = False) -> int:
    """Write rows to their partition folders; returns the number of rows written.
    ``mode="overwrite"`` replaces only the folders that the rows belong to.  ``gathered``
    rows come from files of one partition each and are not shuffled."""
    written = Observation()
    rows = df if gathered else df.hint("rebalance", *[c for c in PARTITION_COLUMNS if c in df.columns])
    writer = rows.observe(written, F.count(F.lit(1)).alias("rows")).write
    writer = staged_overwrite(writer) if mode == "overwrite" else writer.mode(mode)
    writer.option("maxRecordsPerFile", max_records_per_file).partitionBy(*partitions).parquet(path)
    return written.get["rows"]


def write_raw(events: DataFrame, path: str, max_records_per_file: int = 1_000_000,
              mode: str = "append") -> int:
    """Batch landing of parsed events (needs ``meta``; adds dt/hour if absent)."""
    df = events if "dt" in events.columns else with_partitions(events)
    return write_partitioned(df, path, mode=mode, max_records_per_file=max_records_per_file)


def start_raw_ingest(events_stream: DataFrame, path: str, checkpoint: str,
                     trigger: dict | None = None, max_records_per_file: int = 1_000_000):
    """Streaming landing.  ``trigger`` sets the flush cadence, e.g.
    ``{"processingTime": "60 seconds"}``; the default drains what is there and stops."""
    def land(batch: DataFrame, batch_id: int) -> None:
        write_partitioned(with_partitions(batch).withColumn("batch_id", F.lit(batch_id)), path,
                          (*PARTITION_COLUMNS, "batch_id"), "overwrite", max_records_per_file)

    return (events_stream.writeStream.foreachBatch(land)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
