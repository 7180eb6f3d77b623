"""File sources and sinks: explicit-schema scans, SQL over files,
format-dispatched read/write, snapshot files and versioned tables.

Versioned tables replace content without a table format: each write goes to a
new version folder, and readers take the newest complete one.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Allowed formats (name -> Spark source); anything else is rejected.
FORMATS = {"parquet": "parquet", "ndjson": "json", "json": "json"}


def _format(fmt: str) -> str:
    try:
        return FORMATS[fmt]
    except KeyError:
        raise ValueError(f"unsupported format {fmt!r}; expected one of {sorted(FORMATS)}") from None


def read(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None) -> DataFrame:
    """Format-dispatched batch read with an explicit schema when given."""
    reader = spark.read.format(_format(fmt))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def write(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists",
          partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.format(_format(fmt)).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """NDJSON folder with an explicit schema (no inference); timestamps in the
    files are ISO-8601 text."""
    return spark.read.schema(schema).json(path)


def sql_over_files(spark: SparkSession, path: str, casts: dict[str, str], fmt: str = "json"
                   ) -> DataFrame:
    """``SELECT CAST(c AS t) AS c, ... FROM <the files>`` - typed by casts.  JSON is read as
    text columns of those names, so that no pass over the files infers a schema."""
    cols = ", ".join(f"CAST(`{c}` AS {t}) AS `{c}`" for c, t in casts.items())
    reader = spark.read.format(_format(fmt))
    if _format(fmt) == "json":
        reader = reader.schema(", ".join(f"`{c}` STRING" for c in casts))
    return spark.sql(f"SELECT {cols} FROM {{rows}}", rows=reader.load(path))


def snapshot_name(fetched_at: _dt.datetime) -> str:
    return "snapshot-" + fetched_at.astimezone(_dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def write_snapshot(df: DataFrame, root: str, fetched_at: _dt.datetime) -> str:
    """One NDJSON snapshot folder per fetch; rewriting the same fetch replaces
    it, so a rerun never duplicates rows."""
    path = f"{root.rstrip('/')}/{snapshot_name(fetched_at)}"
    df.write.mode("overwrite").json(path)
    return path


# The folder name of a NULL partition value (fixed value of the file layout).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that exist, asked of the file system that each names."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            out.append(path)
    return out


def subfolders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders directly under ``path`` that start with ``prefix``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if n.startswith(prefix))


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_version(df: DataFrame, table_path: str, fmt: str = "parquet") -> str:
    """Materialize a full recompute as a new version folder.  Readers take the latest
    complete one, which Spark's ``_SUCCESS`` marks, so none sees a half-written version."""
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    path = f"{table_path.rstrip('/')}/v-{stamp}-{uuid.uuid4().hex[:8]}"
    write(df, path, fmt)
    return path


def current_version(spark: SparkSession, table_path: str) -> str:
    root = table_path.rstrip("/")
    for name in reversed(subfolders(spark, root, "v-")):
        if existing(spark, [f"{root}/{name}/_SUCCESS"]):
            return f"{root}/{name}"
    raise FileNotFoundError(f"no complete version under {table_path}")


def expire_versions(spark: SparkSession, table_path: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` versions; returns how many went."""
    root = table_path.rstrip("/")
    old = subfolders(spark, root, "v-")[:-keep]
    for name in old:
        delete(spark, f"{root}/{name}")
    return len(old)


def read_current(spark: SparkSession, table_path: str, fmt: str = "parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    """The table's current content only (never stale versions)."""
    return read(spark, current_version(spark, table_path), fmt, schema)
