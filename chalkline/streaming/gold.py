"""Gold, incrementally: each micro-batch of clean silver rows adds its dimension rows
first, checks that every foreign key of the batch resolves, then appends the batch's
fact rows (dims before fact, fail fast on a bad key).

A batch costs what it brings, not what the dimensions hold: it writes its own rows as a
delta, ``<dim>/delta/bucket=/batch_id=``, where the bucket is a hash of the key.  Readers
merge the deltas with the last compaction of each bucket; ``compact`` rewrites only the
buckets that have new deltas.  A replayed batch replaces its own folders.

``scd_type`` is one parameter: type 1 keeps the latest attributes of a member, type 2
all versions.  A compaction of type 2 stores finished versions; what came after it is spliced
in: only keys with new observations are looked at, from the version on that the first of
these falls into, so a late observation changes the versions next to it.  Attributes of the wiki reference are joined when the dimension is read,
so a new snapshot shows without new events.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.operators import cdc, contracts, gold
from chalkline.sources import files
from chalkline.streaming import silver as ssilver
from chalkline.streaming.raw import staged_overwrite

BUCKETS = 64
_BUILD = {"dim_editor": gold.dim_editor, "dim_page": gold.dim_page, "dim_wiki": gold.dim_wiki}


def _delta(silver: DataFrame, name: str, scd_type: int) -> DataFrame:
    """A batch's rows of a dimension: one per member (type 1), or every observation
    (type 2: a late one may fall between any two)."""
    if scd_type == 1:
        return _BUILD[name](silver, with_sequence=True)
    if scd_type != 2:
        raise ValueError(f"scd_type must be 1 or 2, not {scd_type!r}")
    return gold.dimension_changes(silver, name)


def _write(df: DataFrame, path: str, key: str, stamp: str, number: int) -> None:
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
    rows = df.withColumn("bucket", bucket).withColumn(stamp, F.lit(number)).hint("rebalance", "bucket")
    staged_overwrite(rows.write).partitionBy("bucket", stamp).parquet(path)


def _read_delta(spark: SparkSession, path: str, rows: T.StructType) -> DataFrame:
    """A delta folder under its own schema; it may hold no file yet."""
    schema = T.StructType([*rows.fields, T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", T.IntegerType())])
    if not files.existing(spark, [path]):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _delta_schema(spark: SparkSession, name: str, scd_type: int) -> T.StructType:
    return _delta(spark.createDataFrame([], ssilver.output_schema(spark)), name, scd_type).schema


def _stored(spark: SparkSession, root: str, name: str, scd_type: int) -> DataFrame:
    """All rows that count: the last compaction of each bucket and the deltas after it."""
    path = f"{root}/{name}"
    delta = _read_delta(spark, f"{path}/delta", _delta_schema(spark, name, scd_type))
    if not files.existing(spark, [f"{path}/base"]):
        return delta.drop("bucket", "batch_id")
    base = spark.read.parquet(f"{path}/base")
    last = base.groupBy("bucket").agg(F.max("upto").alias("_upto"))       # one row per bucket
    new = delta.join(last, "bucket", "left").where(F.col("_upto").isNull() | (F.col("batch_id") > F.col("_upto")))
    old = base.join(last, "bucket").where("upto = _upto")
    cols = [c for c in delta.columns if c not in ("bucket", "batch_id")]
    return old.select(*cols).unionByName(new.select(*cols))


def _merged(rows: DataFrame, name: str, scd_type: int) -> DataFrame:
    key, attrs = gold.TRACKED[name]
    if scd_type == 1:
        return gold.latest_members(rows, key)
    return cdc.scd2(rows, [key], gold.SCD2_SEQUENCE, list(attrs))


def _versions(spark: SparkSession, root: str, name: str, upto: int | None = None) -> DataFrame:
    """Type 2 versions: the last compaction of each bucket, and the observations since (up to
    a batch) spliced in."""
    key, attrs = gold.TRACKED[name]
    keys, tracked, path = [key], list(attrs), f"{root}/{name}"
    delta = _read_delta(spark, f"{path}/delta", _delta_schema(spark, name, 2))
    if upto is not None:
        delta = delta.where(F.col("batch_id") <= upto)
    if not files.existing(spark, [f"{path}/versions"]):
        return cdc.scd2(delta, keys, gold.SCD2_SEQUENCE, tracked, last_seen=True)
    base = spark.read.parquet(f"{path}/versions")
    last = base.groupBy("bucket").agg(F.max("upto").alias("_upto"))       # one row per bucket
    known = delta.join(last, "bucket", "left")
    new = known.where(F.col("_upto").isNull() | (F.col("batch_id") > F.col("_upto")))
    old = base.join(last, "bucket").where("upto = _upto").select(key, *tracked, "__START_AT", "__END_AT", cdc.LAST_SEEN)
    return cdc.splice_scd2(old, known.where(F.col("batch_id") <= F.col("_upto")), new, keys, gold.SCD2_SEQUENCE, tracked)


def compact(spark: SparkSession, root: str, name: str, upto: int, scd_type: int = 1) -> int:
    """Merge the deltas of dimension ``name`` up to batch ``upto`` into a new base of the
    buckets that have any; returns how many buckets were rewritten.  Type 2 stores versions;
    its deltas stay, as a later observation may fall between any two."""
    path, (key, _) = f"{root}/{name}", gold.TRACKED[name]
    place = f"{path}/base" if scd_type == 1 else f"{path}/versions"
    delta = _read_delta(spark, f"{path}/delta", _delta_schema(spark, name, scd_type)).where(F.col("batch_id") <= upto)
    touched = delta.select("bucket", "batch_id").distinct()
    if files.existing(spark, [place]):
        done = spark.read.parquet(place).groupBy("bucket").agg(F.max("upto").alias("_upto"))
        touched = touched.join(done, "bucket", "left").where("_upto IS NULL OR batch_id > _upto")
    buckets = [r["bucket"] for r in touched.select("bucket").distinct().collect()]      # at most BUCKETS
    if buckets:
        rows = _stored(spark, root, name, 1) if scd_type == 1 else _versions(spark, root, name, upto)
        rows = rows.where(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).isin(buckets))
        _write(_merged(rows, name, 1) if scd_type == 1 else rows, place, key, "upto", upto)
    return len(buckets)


def gold_batch(spark: SparkSession, clean: DataFrame, batch_id: int, root: str, scd_type: int = 1) -> None:
    contract = contracts.load("gold_star_schema")
    s = clean.persist()
    days = s.select(F.to_date("meta_dt").alias("full_date")).distinct()

    def dimension(name: str) -> DataFrame:
        key, _ = gold.TRACKED[name]
        delta, path = _delta(s, name, scd_type), f"{root}/{name}/delta"
        _write(delta, path, key, "batch_id", batch_id)
        # every key of this batch is in this batch's delta
        return _read_delta(spark, path, delta.schema).where(F.col("batch_id") == batch_id)

    def dates() -> DataFrame:
        staged_overwrite(days.withColumn("batch_id", F.lit(batch_id)).write).partitionBy("batch_id").parquet(f"{root}/dim_date/delta")
        return gold.calendar(days)

    try:
        # the dimensions do not depend on each other: one's folders are published while
        # another's rows are made
        with ThreadPoolExecutor(len(gold.TRACKED) + 1) as pool:
            made = {name: pool.submit(dimension, name) for name in gold.TRACKED} | {"dim_date": pool.submit(dates)}
        dims = {name: job.result() for name, job in made.items()}
        dims["dim_change_type"] = gold.dim_change_type(spark)
        fact = gold.fact_edit_event(s)
        contracts.assert_types_conform(fact, contracts.table_contract(contract, "fact_edit_event"))
        gold.assert_integrity(gold.integrity_report(s, fact, dims))
        fact.write.mode("overwrite").parquet(f"{root}/fact/batch_id={batch_id}")
    finally:
        s.unpersist()


def run_gold(spark: SparkSession, silver_root: str, root: str, checkpoint: str,
             max_files_per_trigger: int | None = None, scd_type: int = 1) -> None:
    """Drain new clean silver rows into the star schema and stop.  Raises before reading
    if silver breaks its contract."""
    schema = ssilver.output_schema(spark)
    contracts.assert_types_conform(schema, contracts.load("silver_recentchange"))
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(f"{silver_root}/verdict=clean")
    q = (stream.writeStream
         .foreachBatch(lambda df, bid: gold_batch(spark, df, bid, root, scd_type))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def read_dimension(spark: SparkSession, root: str, name: str, reference_latest: DataFrame | None = None,
                   scd_type: int = 1) -> DataFrame:
    """The dimension as of now, under its contract's columns (type 1) or as versions (type 2)."""
    if name == "dim_date":
        return gold.calendar(spark.read.schema("full_date date, batch_id int").parquet(f"{root}/dim_date/delta"))
    if name == "dim_change_type":
        return gold.dim_change_type(spark)
    if scd_type == 2:
        return _versions(spark, root, name).drop(cdc.LAST_SEEN)
    merged = _merged(_stored(spark, root, name, scd_type), name, scd_type).drop(gold.SEQUENCE)
    if name == "dim_wiki" and reference_latest is not None:
        merged = gold.enrich_wiki(merged, reference_latest)
    return merged


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/fact")
