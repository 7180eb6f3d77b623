"""Bronze: a typed, append-only mirror of raw, built incrementally.

The raw folder is read as a file stream with an explicit schema; the
checkpoint records which files were consumed, so a rerun with no new files
adds nothing and new files add only themselves.  Each micro-batch writes its own
``batch_id`` folders, so a retried batch replaces what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.operators import contracts
from chalkline.schemas import RAW_SCHEMA
from chalkline.streaming import changes
from chalkline.streaming.raw import PARTITION_COLUMNS, write_partitioned


def _file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def raw_stream(spark: SparkSession, raw_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return _file_stream(spark, raw_path, RAW_SCHEMA, max_files_per_trigger)


def bronze_rows(raw: DataFrame) -> DataFrame:
    return raw.select(*RAW_SCHEMA.fieldNames(), F.current_timestamp().alias("_bronze_loaded_at"))


def run_bronze(spark: SparkSession, raw_path: str, bronze_path: str, checkpoint: str,
               max_files_per_trigger: int | None = None, commits: str | None = None) -> int:
    """Drain new raw files into bronze and stop; returns the rows written, counted at
    the sink for every batch.  Raises before reading if raw breaks the contract.  Each batch
    is published as a commit under ``commits``, if given."""
    stream = bronze_rows(raw_stream(spark, raw_path, max_files_per_trigger))
    contracts.assert_types_conform(stream, contracts.load("bronze_recentchange"))
    added: dict[int, int] = {}

    def mirror(batch: DataFrame, batch_id: int) -> None:
        added[batch_id] = write_partitioned(batch.withColumn("batch_id", F.lit(batch_id)), bronze_path,
                                            (*PARTITION_COLUMNS, "batch_id"), "overwrite", gathered=True)
        if commits:
            changes.publish_batch(spark, commits, batch_id)

    (stream.writeStream.foreachBatch(mirror).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return sum(added.values())


def bronze_schema() -> T.StructType:
    """Raw columns plus the load stamp and the batch."""
    return T.StructType(RAW_SCHEMA.fields + [T.StructField("_bronze_loaded_at", T.TimestampType()),
                                             T.StructField("batch_id", T.IntegerType())])


def bronze_stream(spark: SparkSession, bronze_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental read of the bronze table (for silver)."""
    return _file_stream(spark, bronze_path, bronze_schema(), max_files_per_trigger)
