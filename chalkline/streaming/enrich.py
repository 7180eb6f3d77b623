"""Stream-static enrichment: each micro-batch is joined with one version of a reference
table, and the next batch sees the version that is current by then.

The reference is a versioned table (``files.write_version``).  A batch pins the version that
is current on its first attempt and stores the pin, so that a replay joins the same rows;
all tasks of a batch read that one version, whatever is written meanwhile.  The join is a
left join on the latest snapshot per code: rows without a match stay, with NULL attributes.
The reference side is never broadcast by hand: adaptive execution measures it.

Layout: ``<root>/rows/dt=/batch_id=`` with dynamic overwrite, ``<root>/_pins/batch_id=``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.operators import joins
from chalkline.sources import files, sitematrix
from chalkline.streaming.raw import write_partitioned

ATTRIBUTES = ("language_name", "project_type")
VERSION = "reference_version"


def pinned_version(spark: SparkSession, reference_path: str, root: str, batch_id: int) -> str:
    """Folder of the reference version of a batch: the stored pin, or else the current one."""
    path = f"{root}/_pins/batch_id={batch_id}"
    if not files.existing(spark, [f"{path}/_SUCCESS"]):
        current = files.current_version(spark, reference_path)
        spark.range(1).select(F.lit(current).alias("path")).write.mode("overwrite").parquet(path)
    return spark.read.schema("path string").parquet(path).first()["path"]


def enrich_batch(spark: SparkSession, batch: DataFrame, batch_id: int, reference_path: str, root: str,
                 code: str = "wiki", attributes: tuple[str, ...] = ATTRIBUTES) -> int:
    """Join and write one batch; returns the rows written, as many as came."""
    version = pinned_version(spark, reference_path, root, batch_id)
    latest = sitematrix.latest_snapshot(spark.read.parquet(version)).select(F.col("wiki_code").alias(code), *attributes)
    rows = joins.enrich_left(batch.drop(*attributes), latest, code)
    stamped = rows.select(*[c for c in batch.columns if c not in attributes], *attributes,
                          F.element_at(F.split(F.lit(version), "/"), -1).alias(VERSION)).withColumn("batch_id", F.lit(batch_id))
    return write_partitioned(stamped, f"{root}/rows", ("dt", "batch_id"), "overwrite")


def enriched_schema(rows: T.StructType, attributes: tuple[str, ...] = ATTRIBUTES) -> T.StructType:
    given = [f for f in rows.fields if f.name not in (*attributes, "dt", "batch_id")]
    made = [T.StructField(a, T.StringType()) for a in (*attributes, VERSION)]
    return T.StructType([*given, *made, T.StructField("dt", T.StringType()), T.StructField("batch_id", T.IntegerType())])


def run_enriched(spark: SparkSession, stream: DataFrame, reference_path: str, root: str, checkpoint: str,
                 code: str = "wiki", attributes: tuple[str, ...] = ATTRIBUTES) -> int:
    """Drain ``stream`` into ``root`` and stop; returns the rows written by this run."""
    written: dict[int, int] = {}

    def enrich(batch: DataFrame, batch_id: int) -> None:
        written[batch_id] = enrich_batch(spark, batch, batch_id, reference_path, root, code, attributes)

    (stream.writeStream.foreachBatch(enrich).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return sum(written.values())


def read_enriched(spark: SparkSession, root: str, rows: T.StructType,
                  attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    return spark.read.schema(enriched_schema(rows, attributes)).parquet(f"{root}/rows")
