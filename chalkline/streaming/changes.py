"""Change feeds with positions: a keyed table that records what every commit changed, and
consumers that go on from the last commit they have seen.

``ChangeTable.commit`` applies one batch of upserts and deletes.  It reads only the hash
buckets that the batch's keys fall into, joins them with the batch once, and derives from
that join both the change rows (insert, update pre- and post-image, delete) and the new
content of those buckets.  Nothing compares two whole states.

    <root>/changes/_commit_version=N/    change rows of commit N
    <root>/state/_bucket=B/_version=N/   rows of bucket B as of commit N
    <root>/commits/version=N/            the buckets that commit N rewrote; written last

A commit counts once its folder under ``commits`` is complete; a retried commit replaces its
own folders before that.  One writer at a time: a commit that finds its version taken fails.
``consume`` streams over the commit folders, so its checkpoint is the position: every
commit is handed over once, reruns add nothing, and a consumer may start at any version.

A layer that only appends (bronze, clean silver) needs no images: its micro-batches are its
commits.  ``publish_batch`` records them, and consumers get the rows as inserts, read from
the layer itself, without a copy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.operators.cdc import CHANGE_TYPE, COMMIT_VERSION
from chalkline.sources import files

BUCKETS = 64
OP = "_op"                      # of an incoming change: "upsert" or "delete"
_COMMIT = "bucket int, rows_path string"


class VersionTaken(RuntimeError):
    """Another writer has made this commit."""


class ChangeTable:
    """A table with unique, non-null ``keys``; ``schema`` holds keys and payload."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.keys, self.buckets = spark, root.rstrip("/"), schema, list(keys), buckets
        self.payload = [f.name for f in schema.fields if f.name not in self.keys]

    def version(self) -> int:
        """The last complete commit; 0 before the first."""
        return last_commit(self.spark, self.root)

    def current(self, version: int | None = None) -> DataFrame:
        """The rows as of a commit (the last one by default)."""
        return self._state(self.version() if version is None else version).select(*self.schema.fieldNames())

    def _state(self, version: int, only: list[int] | None = None) -> DataFrame:
        """Rows of the buckets, each as of the last commit up to ``version`` that rewrote it."""
        full = T.StructType([*self.schema.fields, T.StructField("_bucket", T.IntegerType()), T.StructField("_version", T.LongType())])
        if version == 0 or not files.existing(self.spark, [f"{self.root}/state"]):
            return self.spark.createDataFrame([], full)
        commits = self.spark.read.schema(f"{_COMMIT}, version long").parquet(f"{self.root}/commits").where(F.col("version") <= version)
        last = commits.groupBy(F.col("bucket").alias("_b")).agg(F.max("version").alias("_v"))      # a row per bucket
        rows = self.spark.read.schema(full).parquet(f"{self.root}/state")
        if only is not None:
            rows = rows.where(F.col("_bucket").isin(only))
        return rows.join(last, (F.col("_bucket") == F.col("_b")) & (F.col("_version") == F.col("_v"))).drop("_b", "_v")

    def commit(self, batch: DataFrame, sequence: Sequence[str] = ()) -> int:
        """Apply ``batch`` (the table's columns and ``_op``; a delete needs the keys only) and
        return the new version.  Of several changes of a key the one with the greatest
        ``sequence`` counts; without one, keys must be unique in the batch."""
        version = self.version() + 1
        if files.existing(self.spark, [f"{self.root}/commits/version={version}/_SUCCESS"]):
            raise VersionTaken(f"version {version} of {self.root}")
        names = self.schema.fieldNames()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        wanted = batch.select(*names, OP, *sequence)
        if sequence:
            rest = [c for c in wanted.columns if c not in self.keys and c not in sequence]
            last = F.max(F.struct(*sequence, *rest)).alias("_l")
            wanted = wanted.groupBy(*self.keys).agg(last).select(*self.keys, *[F.col(f"_l.{c}").alias(c) for c in rest])
        wanted = wanted.select(*names, OP).withColumn("_bucket", bucket).persist()
        try:
            touched = [r[0] for r in wanted.select("_bucket").distinct().collect()]              # at most ``buckets``
            self._write(wanted, touched, version)
        finally:
            wanted.unpersist()
        return version

    def _write(self, wanted: DataFrame, touched: list[int], version: int) -> None:
        old = self._state(version - 1, touched).select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], F.struct(*self.payload).alias("_old"))
        new = wanted.select(*self.keys, F.struct(*self.payload).alias("_new"), OP)
        same = F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & (F.col(f"_k{i}") == F.col(k))
        both = old.join(new, same, "full_outer").select(
            *[F.coalesce(k, f"_k{i}").alias(k) for i, k in enumerate(self.keys)], "_old", "_new", OP)
        had, upsert = F.col("_old").isNotNull(), F.col(OP) == "upsert"
        changed = ~F.col("_old").eqNullSafe(F.col("_new"))

        def row(kind: str, of: str):
            return F.struct(F.lit(kind).alias(CHANGE_TYPE), F.col(of).alias("_p"))

        none = F.array().cast("array<struct<" + f"{CHANGE_TYPE}:string,_p:{self._payload_type()}" + ">>")
        images = (F.when(upsert & ~had, F.array(row("insert", "_new")))
                  .when(upsert & changed, F.array(row("update_preimage", "_old"), row("update_postimage", "_new")))
                  .when((F.col(OP) == "delete") & had, F.array(row("delete", "_old"))).otherwise(none))
        out = both.select(*self.keys, F.explode(images).alias("_c"))
        (out.select(*self.keys, *[F.col(f"_c._p.{c}").alias(c) for c in self.payload], f"_c.{CHANGE_TYPE}")
         .write.mode("overwrite").parquet(f"{self.root}/changes/{COMMIT_VERSION}={version}"))
        kept = both.where(upsert | F.col(OP).isNull()).select(
            *self.keys, F.when(upsert, F.col("_new")).otherwise(F.col("_old")).alias("_p"))
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        (kept.select(*self.keys, *[F.col(f"_p.{c}").alias(c) for c in self.payload])
         .withColumn("_bucket", bucket).withColumn("_version", F.lit(version).cast("long")).hint("rebalance", "_bucket")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket", "_version")
         .parquet(f"{self.root}/state"))
        path = f"{self.root}/changes/{COMMIT_VERSION}={version}"
        _publish(self.spark, self.root, version, touched, path)

    def _payload_type(self) -> str:
        return T.StructType([self.schema[c] for c in self.payload]).simpleString()

    def changes(self, first: int, last: int | None = None) -> DataFrame:
        """Change rows of the commits ``first`` to ``last`` (default: all that are complete)."""
        last = self.version() if last is None else last
        return _read_changes(self.spark, [f"{self.root}/changes/{COMMIT_VERSION}={v}" for v in range(first, last + 1)],
                             self.change_schema(), f"{self.root}/changes")

    def change_schema(self) -> T.StructType:
        return T.StructType([*[self.schema[k] for k in self.keys], *[self.schema[c] for c in self.payload],
                             T.StructField(CHANGE_TYPE, T.StringType())])

    def vacuum(self, keep_from: int) -> int:
        """Delete bucket versions that no commit from ``keep_from`` on reads; returns how many."""
        at = self._state(keep_from).select("_bucket", "_version").distinct()
        needed = {(r["_bucket"], r["_version"]) for r in at.collect()}                              # one per bucket
        gone = 0
        for b in files.subfolders(self.spark, f"{self.root}/state", "_bucket="):
            for v in files.subfolders(self.spark, f"{self.root}/state/{b}", "_version="):
                number = int(v.split("=")[1])
                if number <= keep_from and (int(b.split("=")[1]), number) not in needed:
                    files.delete(self.spark, f"{self.root}/state/{b}/{v}")
                    gone += 1
        return gone


def last_commit(spark: SparkSession, root: str) -> int:
    for name in sorted(files.subfolders(spark, f"{root}/commits", "version="), key=lambda n: -int(n.split("=")[1])):
        if files.existing(spark, [f"{root}/commits/{name}/_SUCCESS"]):
            return int(name.split("=")[1])
    return 0


def _publish(spark: SparkSession, root: str, version: int, buckets: list[int], path: str) -> None:
    rows = [(b, path) for b in sorted(buckets)] or [(None, path)]
    (spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("overwrite")
     .parquet(f"{root}/commits/version={version}"))


def publish_batch(spark: SparkSession, root: str, batch_id: int) -> None:
    """Record a micro-batch of an append-only layer as commit ``batch_id + 1``.  A replayed
    batch records the same commit again, under the same version."""
    _publish(spark, root, batch_id + 1, [], f"batch_id={batch_id}")


def _read_changes(spark: SparkSession, paths: list[str], schema: T.StructType, base: str) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(COMMIT_VERSION, T.LongType())])
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", base).parquet(*paths)


def commit_stream(spark: SparkSession, root: str, max_commits: int | None = None) -> DataFrame:
    """The table's commits as a stream: version, and where the change rows are."""
    reader = spark.readStream.schema(f"{_COMMIT}, version long")
    if max_commits:
        reader = reader.option("maxFilesPerTrigger", max_commits)
    return reader.parquet(f"{root.rstrip('/')}/commits")


def consume(spark: SparkSession, root: str, checkpoint: str, handler: Callable[[DataFrame, int], None],
            schema: T.StructType, starting_version: int = 1, max_commits: int | None = None,
            layer: DataFrame | None = None) -> list[int]:
    """Hand the change rows of all commits not yet seen by ``checkpoint`` to
    ``handler(changes, batch_id)`` and stop; returns their versions.  Commits before
    ``starting_version`` are passed over.  For an append-only layer, ``layer`` is a batch
    read of it with its ``batch_id`` column; its rows come as inserts."""
    root, seen = root.rstrip("/"), []
    if not files.existing(spark, [f"{root}/commits"]):
        return seen

    def hand_over(commits: DataFrame, batch_id: int) -> None:
        found = sorted({(r["version"], r["rows_path"]) for r in
                        commits.where(F.col("version") >= starting_version).select("version", "rows_path").distinct().collect()})
        if not found:       # a row per commit, as many as a trigger takes
            return
        versions = [v for v, _ in found]
        if layer is not None:
            rows = layer.where((F.col("batch_id") + 1).isin(versions)).select(
                *schema.fieldNames(), F.lit("insert").alias(CHANGE_TYPE), (F.col("batch_id") + 1).cast("long").alias(COMMIT_VERSION))
        else:
            rows = _read_changes(spark, [p for _, p in found], schema, f"{root}/changes")
        handler(rows, batch_id)
        seen.extend(versions)

    (commit_stream(spark, root, max_commits).writeStream.foreachBatch(hand_over)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    return sorted(seen)
