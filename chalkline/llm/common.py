"""Shared helpers of the training-data operators: storage, words, hashing."""

from __future__ import annotations

import gc
import sys
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words, as a Java/RE2 character class body.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Bytes of texts that a task hands to its Python worker at a time.
BATCH_BYTES = 4 << 20


def by_value(module_name: str) -> None:
    """Ship a module's task functions inside the job, so that executors need only
    the third-party libraries and not this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Only a local master, where driver and
    tasks share one disk, gets a temporary folder when the setting is missing."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="chalkline-llm-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new location in the shared folder."""
    return f"{shared_root(spark)}/chalkline-llm/{name}-{uuid.uuid4().hex[:12]}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage ends there,
    and a lost executor costs no recomputation of what came before."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession):
    """Rows that are written inside go to Python by at most ``BATCH_BYTES`` at a time: a batch
    is held by the executor and, several times over, by its Python workers, which keep the
    memory for the steps that follow.  Narrow rows are cut by their number as before."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of ``shared_path`` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let go of shuffle files behind landed tables.  Spark deletes them when the driver
    collects the plans that made them, which an idle driver may put off for long; asking
    for a collection between the steps of a long job bounds its disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the input does not use."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def last_name(df: DataFrame, stem: str) -> str:
    """The column that ``free_name`` named last."""
    taken = {c.lower() for c in df.columns}
    while "_" + stem.lower() in taken:
        stem = "_" + stem
    return stem


def positional(df: DataFrame, *named: str) -> tuple[DataFrame, list[str]]:
    """The frame with columns x0, x1, ... and the new names of the given columns: helper
    columns, which start with an underscore, then clash with nothing."""
    names = [f"x{i}" for i in range(len(df.columns))]
    return df.toDF(*names), [names[df.columns.index(c)] for c in named]


def tasks(df: DataFrame) -> int:
    """Partitions for an explicit repartition."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


# ---- used inside tasks ----

def in_slices(batches, rows: int):
    """The batches' rows, so many at a time: Python holds the objects of one slice only."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def words_of(text) -> list[bytes]:
    """Words of a text (null: none), A-Z in lower case, as UTF-8.  ``bytes`` lower-cases
    and splits on exactly the ASCII letters and white space."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), so that sums of mixed ids hash well."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingle_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of n words; a shorter text is one run, no words none."""
    k = len(word_hashes)
    if k == 0:
        return word_hashes
    n = min(n, k)
    out = np.zeros(k - n + 1, dtype=np.uint64)
    for i in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i:k - n + 1 + i] + np.uint64(n))
    return out


by_value(__name__)
