"""Uniqueness operators.

Design for skew: one key may hold a large share of all rows, so survivors are
chosen by an aggregation (``min``/``max`` over a struct whose leading fields
are the ordering columns and whose tail is the rest of the row).  Spark runs it
as a partial (map-side) aggregation, so a hot key collapses to one row per
input partition before the shuffle; no task ever holds a whole group.  The
result equals ``row_number() over (partition by key order by ...) = 1`` with
the remaining columns as tie-breakers.

Duplicates (everything that is not a survivor) are ``input EXCEPT ALL
survivors``, multiset-exact: copies are counted per whole-row value (partial
aggregation), and surplus copies are re-emitted in bounded chunks, each by its
own task - a group of identical copies holding a third of the input is spread
like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ordered_struct(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Column:
    rest = [c for c in df.columns if c not in keys and c not in order]
    return F.struct(*[F.col(c) for c in list(order) + rest])


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool) -> DataFrame:
    """One aggregation over rows with a complete key.  Rows with a NULL key
    component never collapse: they bypass the aggregation as a filtered
    branch (no shuffle, and deterministic under task retries)."""
    keys, order = list(keys), list(order)
    null_key = _any_null(keys)
    packed = _ordered_struct(df, keys, order)
    agg = F.max(packed) if latest else F.min(packed)
    picked = df.where(~null_key).groupBy(*keys).agg(agg.alias("_row"))
    picked = picked.select(*[F.col(k) for k in keys],
                           *[F.col(f"_row.{c}").alias(c) for c in df.columns if c not in keys]
                           ).select(*df.columns)
    return picked.unionByName(df.where(null_key))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order`` (then by the other columns).

    Rows with a NULL key component are kept as they are (never collapsed)."""
    return _pick(df, keys, order, latest=False)


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the largest by ``order`` (``row_number() ... DESC = 1``)."""
    return _pick(df, keys, order, latest=True)


# Copies of one row value are re-emitted in chunks of this many rows, each
# chunk by its own task, so a huge group of exact copies is never replicated
# by a single task.
REPLICATION_CHUNK = 100_000


def split_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                     chunk: int = REPLICATION_CHUNK) -> tuple[DataFrame, DataFrame]:
    """(survivors, duplicates) with ``count(df) = count(survivors) + count(duplicates)``.

    First arrival by ``order`` wins; NULL keys are never duplicates.  Survivors are one
    aggregation.  For the duplicates, keys that occur twice are found on the key columns
    alone; only rows of such keys take the path over whole rows, which is multiset-exact
    (``EXCEPT ALL`` the survivors): copies are counted per distinct row value (partial
    aggregation), the survivor is subtracted, and the remaining copies are re-emitted in
    chunks spread over the cluster.  A reader of survivors alone never plans that path."""
    keys = list(keys)
    repeated = (df.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                .where("_n > 1").select(*keys))
    several = df.join(repeated, keys, "left_semi").select(*df.columns)
    return keep_first(df, keys, order), _surplus_copies(several, keep_first(several, keys, order), chunk)


def _surplus_copies(df: DataFrame, survivors: DataFrame, chunk: int) -> DataFrame:
    cols = df.columns
    copies = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).alias("c")
    kept = survivors.groupBy(*cols).agg(F.count(F.lit(1)).alias("_w")).alias("w")
    cond = [F.col(f"c.{x}").eqNullSafe(F.col(f"w.{x}")) for x in cols]
    surplus = (copies.join(kept, cond, "left")
                     .select(*[F.col(f"c.{x}").alias(x) for x in cols],
                             (F.col("c._n") - F.coalesce(F.col("w._w"), F.lit(0))).alias("_d"))
                     .where(F.col("_d") > 0))
    chunks = surplus.select(*cols, "_d", F.explode(
        F.sequence(F.lit(0), ((F.col("_d") - 1) / chunk).cast("long"))).alias("_c"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(n, F.xxhash64(*[F.col(x) for x in cols], F.col("_c")))
    size = F.least(F.lit(chunk).cast("long"), F.col("_d") - F.col("_c") * chunk)
    return (spread.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_i"))
                  .select(*cols))


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once and how often (``n_rows``, ``n_duplicates``)."""
    return (df.where(~_any_null(keys)).groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1)
              .withColumn("n_duplicates", F.col("n_rows") - 1))


def drop_seen(batch: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``history`` (cross-batch uniqueness).

    Callers bound ``history`` by partition predicates (dt/hour around the
    batch's event-time range) so the anti join reads only what can collide."""
    keys = list(keys)
    seen = history.select(*keys).where(~_any_null(keys)).distinct()
    return batch.join(seen, on=keys, how="left_anti").select(*batch.columns)


def split_seen(batch: DataFrame, history: DataFrame, keys: Sequence[str]
               ) -> tuple[DataFrame, DataFrame]:
    """(fresh, seen): rows of ``batch`` whose key is absent from / present in
    ``history``.  Anti and semi join on distinct history keys - exact when
    ``batch`` has at most one row per key (survivors)."""
    keys = list(keys)
    ids = history.select(*keys).where(~_any_null(keys)).distinct()
    fresh = batch.join(ids, on=keys, how="left_anti").select(*batch.columns)
    seen = batch.join(ids, on=keys, how="left_semi").select(*batch.columns)
    return fresh, seen


def _any_null(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        cond = F.col(k).isNull() if cond is None else cond | F.col(k).isNull()
    return cond
