"""Running sums and ordered digests over groups of any size.

Both spread a group over many tasks: rows are range-partitioned by (group, order), every
task works through its own stretch, and a table with one row per (group, task) carries
what the next stretch needs.  No task holds a whole group.

Defined results: an empty table gives an empty one; rows equal in group and order keep any
order among themselves, so the order columns must tell apart rows that differ; a null group
is a group.  The helpers name their own columns ``_g``, ``_part`` and ``_upto_*``; callers
pass frames whose columns do not start with an underscore.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_value, land, tasks

#: A piece of a joined text is closed after this many characters (memory, not results).
PIECE_CHARS = 1 << 20


def _sums(group: str, sums: list[str]):
    """Inclusive running sums within equal neighbours of ``group``, across Arrow batches."""
    def run(batches):
        last, carried = None, np.zeros(len(sums), dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(b.schema.get_field_index(group)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            lengths = np.diff(np.append(starts, len(keys)))
            follows = last is not None and keys[0] == last
            out = list(b.columns)
            for i, name in enumerate(sums):
                v = b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.cumsum(v)
                before = total[starts] - v[starts]
                if follows:
                    before[0] -= carried[i]
                upto = total - np.repeat(before, lengths)
                carried[i] = upto[-1]
                out.append(pa.array(upto, type=pa.int64()))
            last = keys[-1]
            yield pa.RecordBatch.from_arrays(out, names=[*b.schema.names, *[f"_upto_{s}" for s in sums]])
    return run


def running(df: DataFrame, group: str, order: list, sums: dict[str, str]) -> DataFrame:
    """``df`` with a running sum (this row included) of each long column ``c`` of ``sums``
    ({column: name of its sum}) within ``group`` in the given order."""
    rows = df.withColumn("_g", F.coalesce(F.col(group).cast("string"), F.lit("")))
    ranged = (rows.repartitionByRange(tasks(df), "_g", *order).sortWithinPartitions("_g", *order)
              .withColumn("_part", F.spark_partition_id()))
    names = list(sums)
    schema = T.StructType([*ranged.schema.fields, *[T.StructField(f"_upto_{n}", T.LongType()) for n in names]])
    local = land(ranged.mapInArrow(_sums("_g", names), schema), "ranges")
    stretches = local.groupBy("_g", "_part").agg(*[F.sum(n).alias(f"_total_{n}") for n in names])
    earlier = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = land(stretches.select(F.col("_g").alias("_h"), F.col("_part").alias("_p"), *[
        F.coalesce(F.sum(f"_total_{n}").over(earlier), F.lit(0)).alias(f"_shift_{n}") for n in names])
        .where(F.greatest(*[F.abs(f"_shift_{n}") for n in names], F.lit(0)) > 0), "range-shifts")
    joined = local.join(shifts, (F.col("_g") == F.col("_h")) & (F.col("_part") == F.col("_p")), "left")
    return joined.select(*df.columns, *[
        (F.col(f"_upto_{n}") + F.coalesce(f"_shift_{n}", F.lit(0))).alias(out) for n, out in sums.items()])


def _pieces(group: str, text: str, seq: str, sep: str):
    """Texts of equal neighbours joined to pieces; a piece tells where it starts."""
    def run(batches):
        key, start, parts, size = None, None, [], 0

        def piece():
            return {group: [key], seq: [start], text: [sep.join(parts)]}

        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in (group, seq, text)]
            done = []
            for k, s, t in zip(*cols):
                if parts and (k != key or size > PIECE_CHARS):
                    done.append(piece())
                    parts, size = [], 0
                if not parts:
                    key, start = k, s
                parts.append(t)
                size += len(t) + len(sep)
            if done:
                yield pa.RecordBatch.from_pydict({n: pa.array([d[n][0] for d in done], type=kind)
                                                  for n, kind in zip((group, seq, text), KINDS)})
        if parts:
            yield pa.RecordBatch.from_pydict({n: pa.array(v, type=kind) for (n, v), kind in zip(piece().items(), KINDS)})
    return run


KINDS = (pa.string(), pa.int64(), pa.string())


def _digests(group: str, text: str, sha: str, sep: str):
    """SHA-256 over the pieces of equal neighbours, as a stream."""
    def run(batches):
        key, digest = None, None
        for b in batches:
            keys, texts = (b.column(b.schema.get_field_index(c)).to_pylist() for c in (group, text))
            done = []
            for k, t in zip(keys, texts):
                if digest is not None and k != key:
                    done.append((key, digest.hexdigest()))
                    digest = None
                if digest is None:
                    key, digest = k, hashlib.sha256()
                else:
                    digest.update(sep.encode())
                digest.update(t.encode("utf-8", "surrogatepass"))
            if done:
                yield pa.RecordBatch.from_pydict({group: pa.array([d[0] for d in done], type=pa.string()),
                                                  sha: pa.array([d[1] for d in done], type=pa.string())})
        if digest is not None:
            yield pa.RecordBatch.from_pydict({group: pa.array([key], type=pa.string()),
                                              sha: pa.array([digest.hexdigest()], type=pa.string())})
    return run


def joined_sha256(df: DataFrame, group: str, seq: str, text: str, sep: str, sha: str) -> DataFrame:
    """(group, sha): lowercase hex of SHA-256 of each group's texts, joined by ``sep`` in
    ascending ``seq`` (a long, unique in its group).  ``group`` is text.

    Ranges of (group, seq) join their texts to pieces first; what one task then reads of a
    group are its pieces, as a stream.  (SHA-256 has to see a group's bytes in order.)"""
    n = tasks(df)
    schema = f"{group} string, {seq} long, {text} string"
    pieces = (df.select(group, seq, text).repartitionByRange(n, group, seq).sortWithinPartitions(group, seq)
              .mapInArrow(_pieces(group, text, seq, sep), schema))
    return (pieces.repartition(n, group).sortWithinPartitions(group, seq)
            .mapInArrow(_digests(group, text, sha, sep), f"{group} string, {sha} string"))


by_value(__name__)
