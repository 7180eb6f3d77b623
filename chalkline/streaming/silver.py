"""Silver fan-out: every micro-batch is judged once and written once, partitioned by
verdict - clean, rejected, duplicates - so that ``bronze rows = clean + rejected +
duplicates`` for every batch.

Uniqueness is traceable.  Repeated ids inside a batch are found on narrow rows (id,
arrival order, row number); only ids that occur twice are joined back.  Repeats of
earlier batches are found among the ids already written in the (dt, hour) partitions
that can collide: those of the batch's own rows, widened by the dedup horizon.  Rows
without an event time have a partition of their own (NULL) and are checked against it.

Layout: ``<root>/verdict=/dt=/hour=/batch_id=``, written with dynamic partition
overwrite.  A batch's "now" is stored on its first attempt, and its own rows are left
out of the history it is checked against, so a replay gives the same verdicts and
replaces exactly its own folders.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.operators import contracts, dq
from chalkline.plans import silver as plan
from chalkline.sources import files
from chalkline.streaming.bronze import bronze_schema, bronze_stream
from chalkline.streaming.raw import write_partitioned

OUTPUTS = ("clean", "rejected", "duplicates")
PARTITIONS = ("verdict", "dt", "hour", "batch_id")
DEDUP_HORIZON_HOURS = 2


def _staged_schema(spark: SparkSession) -> T.StructType:
    return plan.stage(spark.createDataFrame([], bronze_schema()), dq.DQConfig(as_of="2000-01-01T00:00:00Z")).schema


def output_schema(spark: SparkSession) -> T.StructType:
    """Columns of a written verdict partition (analysis only, no job)."""
    staged = [f for f in _staged_schema(spark).fields if f.name not in PARTITIONS]
    return T.StructType(staged + [T.StructField("dt", T.StringType()), T.StructField("hour", T.IntegerType()),
                                  T.StructField("batch_id", T.IntegerType())])


def _slots(staged: DataFrame) -> DataFrame:
    """(dt, hour) partitions in which a repeat of one of these rows may lie."""
    own = staged.select("dt", "hour").distinct()
    at = F.try_to_timestamp(F.concat_ws(" ", "dt", F.format_string("%02d:00:00", "hour")))
    near = F.transform(F.sequence(F.lit(-DEDUP_HORIZON_HOURS), F.lit(DEDUP_HORIZON_HOURS)),
                       lambda h: F.unix_seconds(at) + h * 3600)
    widened = own.where(at.isNotNull()).select(F.explode(near).alias("s")).select(
        F.date_format(F.timestamp_seconds("s"), "yyyy-MM-dd").alias("dt"),
        F.hour(F.timestamp_seconds("s")).alias("hour"))
    return widened.unionByName(own.where(at.isNull())).distinct()


def history_ids(spark: SparkSession, root: str, batch_id: int, slots: DataFrame) -> DataFrame | None:
    """Ids kept by other batches in the given partitions; lists and reads only the date
    folders named by ``slots`` (one driver-side name per day that the batch touches)."""
    days = [r["dt"] for r in slots.select("dt").distinct().toLocalIterator()]
    kept = [f"{root}/verdict={v}/dt={d if d is not None else files.NULL_PARTITION}"
            for v in ("clean", "rejected") for d in days]
    paths = files.existing(spark, kept)
    if not paths:
        return None
    written = spark.read.schema(output_schema(spark)).option("basePath", root).parquet(*paths)
    same_hour = (F.col("dt").eqNullSafe(F.col("s_dt"))) & (F.col("hour").eqNullSafe(F.col("s_hour")))
    return (written.where((F.col("batch_id") != batch_id) & F.col("_event_id").isNotNull())
            .select("_event_id", "dt", "hour")
            .join(slots.select(F.col("dt").alias("s_dt"), F.col("hour").alias("s_hour")), same_hour, "left_semi")
            .select("_event_id").distinct())


def judged(staged: DataFrame, seen: DataFrame | None) -> DataFrame:
    """``staged`` (with a row number ``_rid``) plus ``verdict``."""
    narrow = staged.where(F.col("_event_id").isNotNull()).select("_event_id", *plan.ARRIVAL_ORDER, "_rid")
    repeated = (narrow.groupBy("_event_id").agg(F.min(F.struct(*plan.ARRIVAL_ORDER, "_rid"))["_rid"].alias("_first"),
                                                F.count(F.lit(1)).alias("_n"))
                .where("_n > 1").select("_event_id", "_first"))
    rows = staged.join(repeated, "_event_id", "left")
    copy = F.col("_first").isNotNull() & (F.col("_rid") != F.col("_first"))
    if seen is not None:
        rows = rows.join(seen.withColumn("_seen", F.lit(True)), "_event_id", "left")
        copy = copy | F.coalesce("_seen", F.lit(False))
    verdict = F.when(copy, "duplicates").when(dq.passed(), "clean").otherwise("rejected")
    return rows.withColumn("verdict", verdict).select(*staged.columns, "verdict").drop("_rid")


def _fixed(spark: SparkSession, root: str, batch_id: int, cfg: dq.DQConfig) -> dq.DQConfig:
    """The configuration with the batch's own instant, stored on the first attempt."""
    if cfg.as_of is not None:
        return cfg
    path = f"{root}/_instants/batch_id={batch_id}"
    if not files.existing(spark, [f"{path}/_SUCCESS"]):
        now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        spark.range(1).select(now.alias("as_of")).write.mode("overwrite").parquet(path)
    return dataclasses.replace(cfg, as_of=spark.read.schema("as_of string").parquet(path).first()["as_of"])


def fan_out(spark: SparkSession, batch: DataFrame, batch_id: int, root: str, cfg: dq.DQConfig) -> int:
    """Judge and write one batch; returns the rows written."""
    cfg = _fixed(spark, root, batch_id, cfg)
    staged = plan.stage(batch, cfg).withColumn("_rid", F.monotonically_increasing_id()).persist()
    try:
        seen = history_ids(spark, root, batch_id, _slots(staged))
        out = judged(staged, seen).withColumn("batch_id", F.lit(batch_id))
        return write_partitioned(out, root, PARTITIONS, "overwrite")
    finally:
        staged.unpersist()


def run_silver(spark: SparkSession, bronze_path: str, root: str, checkpoint: str,
               cfg: dq.DQConfig = dq.DQConfig(), max_files_per_trigger: int | None = None) -> int:
    """Drain new bronze rows into the three outputs and stop; returns the rows written.
    Raises before reading if bronze or the staged rows break their contracts."""
    stream = bronze_stream(spark, bronze_path, max_files_per_trigger)
    contracts.assert_types_conform(stream, contracts.load("bronze_recentchange"))
    contracts.assert_types_conform(_staged_schema(spark), contracts.load("silver_recentchange"))
    written: dict[int, int] = {}

    def judge(batch: DataFrame, batch_id: int) -> None:
        written[batch_id] = fan_out(spark, batch, batch_id, root, cfg)

    (stream.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return sum(written.values())


def read_output(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One verdict's rows; empty where no batch has produced any."""
    schema, path = output_schema(spark), f"{root}/verdict={name}"
    if not files.existing(spark, [path]):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
