"""Set utilities: union by name, multiset equality, id-set equality and
disjointness.  Each report is a single aggregation (no driver-side compare)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Rows whose ``col`` starts with ``prefix`` (e.g. a run marker on ids)."""
    return df.where(F.col(col).startswith(prefix))


def union_common(left: DataFrame, right: DataFrame) -> DataFrame:
    """Project both frames to their common columns, then union by name."""
    common = [c for c in left.columns if c in set(right.columns)]
    return left.select(*common).unionByName(right.select(*common))


def union_all_by_name(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing from a frame is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("_side"))


def equality_report(left: DataFrame, right: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """(left_only, right_only, equal): multiset difference both ways."""
    cols = [c for c in left.columns if c not in ignore]
    lo = left.select(*cols).exceptAll(right.select(*cols))
    ro = right.select(*cols).exceptAll(left.select(*cols))
    tagged = _count(lo, "left").unionByName(_count(ro, "right"))
    row = tagged.agg(F.count(F.when(F.col("_side") == "left", 1)).alias("left_only"),
                     F.count(F.when(F.col("_side") == "right", 1)).alias("right_only"))
    return row.withColumn("equal", (F.col("left_only") == 0) & (F.col("right_only") == 0))


def id_set_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(only_left, only_right, equal) on distinct ids."""
    l_ids = left.select(key).distinct()
    r_ids = right.select(key).distinct()
    tagged = (_count(l_ids.exceptAll(r_ids), "left")
              .unionByName(_count(r_ids.exceptAll(l_ids), "right")))
    row = tagged.agg(F.count(F.when(F.col("_side") == "left", 1)).alias("only_left"),
                     F.count(F.when(F.col("_side") == "right", 1)).alias("only_right"))
    return row.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def disjoint_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(n_left, n_right, n_overlap) of non-NULL keys; disjoint when overlap = 0."""
    l_ids = left.select(key).where(F.col(key).isNotNull())
    r_ids = right.select(key).where(F.col(key).isNotNull())
    overlap = l_ids.intersect(r_ids)
    tagged = (_count(l_ids, "left").unionByName(_count(r_ids, "right"))
              .unionByName(_count(overlap, "both")))
    return tagged.agg(F.count(F.when(F.col("_side") == "left", 1)).alias("n_left"),
                      F.count(F.when(F.col("_side") == "right", 1)).alias("n_right"),
                      F.count(F.when(F.col("_side") == "both", 1)).alias("n_overlap"))
