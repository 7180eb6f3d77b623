"""Change data: snapshot diff (change feed), SCD type 1 and type 2.

* ``snapshot_diff``: two versions of a keyed table -> change rows (insert /
  update_preimage / update_postimage / delete).  Both versions are read once, dealt out
  by key once, and compared by counting equal rows; no row pairs are formed.
* ``scd1``: latest row per key by a sequence - an aggregation (partial, map-side), so a
  hot key never lands whole in one task.
* ``scd2``: versions with start/end sequence.  Consecutive changes with equal tracked
  attributes collapse into one version.  Rows are range-partitioned by (keys, sequence),
  so a key with a huge history is cut into many ranges; neighbours are looked up inside a
  range, and one summary row per range carries them across its edges.
* ``apply_scd2``: out-of-order changes recompute only the keys they touch.
* ``splice_scd2``: new observations, late ones too, recompute a key only from the version
  on that the first of them falls into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chalkline.session import scratch_path

CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
LAST_SEEN = "__LAST_AT"


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str],
                  commit_version: int) -> DataFrame:
    """Change feed between two versions of a table keyed by ``keys``.

    Equal rows of both versions cancel out (NULLs compare equal).  What is left of the
    old version is a delete, or an update pre-image where the key lives on; what is left
    of the new one is an insert, or a post-image where the key was there before.  The
    union is dealt out by key; the counts per row and per key use that one shuffle."""
    keys, cols = list(keys), after.columns
    both = before.select(*cols, F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(
        after.select(*cols, F.lit(0).alias("_b"), F.lit(1).alias("_a")))
    rows = both.repartition(*keys).groupBy(*cols).agg(F.sum("_b").alias("_b"), F.sum("_a").alias("_a"))
    same_key = Window.partitionBy(*keys)
    net = (rows.withColumn("_kb", F.sum("_b").over(same_key)).withColumn("_ka", F.sum("_a").over(same_key))
           .withColumn("_d", F.col("_a") - F.col("_b")).where("_d <> 0"))
    kind = (F.when(F.col("_d") > 0, F.when(F.col("_kb") > 0, "update_postimage").otherwise("insert"))
            .when(F.col("_ka") > 0, "update_preimage").otherwise("delete"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_d"))).alias("_c")
    return net.select(*cols, kind.alias(CHANGE_TYPE), F.lit(commit_version).cast("long").alias(COMMIT_VERSION),
                      copies).drop("_c")


def as_upserts(changes: DataFrame) -> DataFrame:
    """Rows a downstream layer should ingest from a change feed: inserts and
    update post-images only (pre-images and deletes never re-enter as rows),
    without the change metadata."""
    keep = F.col(CHANGE_TYPE).isin("insert", "update_postimage")
    return changes.where(keep).drop(CHANGE_TYPE, COMMIT_VERSION)


def scd1(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Current row per key: the change with the greatest sequence wins."""
    keys, sequence = list(keys), list(sequence)
    rest = [c for c in changes.columns if c not in keys and c not in sequence]
    packed = F.max(F.struct(*[F.col(c) for c in sequence + rest])).alias("_r")
    return (changes.where(_all_not_null(keys)).groupBy(*keys).agg(packed)
                   .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in sequence + rest])
                   .select(*changes.columns))


def apply_scd1(current: DataFrame, changes: DataFrame, keys: Sequence[str],
               sequence: Sequence[str]) -> DataFrame:
    """Upsert a batch of changes into an SCD1 table (late changes lose to newer rows)."""
    return scd1(current.unionByName(changes.select(*current.columns)), keys, sequence)


# Neighbours across ranges -----------------------------------------------------------

def _ranged(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows in ranges of (keys, order), landed: ``_part`` ascends with the order."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, "scd2-ranges")
    (df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id())
     .write.parquet(path))
    return spark.read.parquet(path)


def scd2(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str],
         tracked: Sequence[str], last_seen: bool = False) -> DataFrame:
    """SCD type 2 versions.

    ``sequence`` totally orders changes within a key.  Output: keys, tracked attributes,
    ``__START_AT`` (struct of sequence), ``__END_AT`` (next version's sequence, NULL
    while current), and with ``last_seen`` also ``__LAST_AT``, the sequence of the last
    change that confirmed the version."""
    keys, sequence, tracked = list(keys), list(sequence), list(tracked)
    rows = _ranged(changes.where(_all_not_null(keys)).select(*keys, *sequence, *tracked), keys, sequence)
    whole, place = F.struct(*keys, *sequence, *tracked), F.struct(*keys, *sequence, "_seen")
    inside, over_parts = Window.partitionBy("_part").orderBy(*keys, *sequence), Window.orderBy("_part")
    earlier = over_parts.rowsBetween(Window.unboundedPreceding, -1)
    later = over_parts.rowsBetween(1, Window.unboundedFollowing)

    def same_key(other: str) -> Column:
        out = F.col(other).isNotNull()
        for k in keys:
            out = out & F.col(k).eqNullSafe(F.col(f"{other}.{k}"))
        return out

    # one summary row per range: its last row is what the next range's first row follows
    last = rows.groupBy("_part").agg(F.max(whole).alias("_last"))
    last = last.select("_part", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    prev = rows.withColumn("_prev", F.lag(whole).over(inside)).join(last, "_part").withColumn(
        "_prev", F.coalesce("_prev", "_before"))
    differs = ~same_key("_prev")
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_prev.{c}"))
    seen = F.struct(*[F.col(f"_prev.{c}").alias(c) for c in sequence]).alias("_seen")     # the change before it
    starts = prev.where(differs).select("_part", *keys, *sequence, *tracked, seen)
    # ... and its first version start is where the version before it ends
    first = rows.select("_part").distinct().join(starts.groupBy("_part").agg(F.min(place).alias("_first")), "_part", "left")
    first = first.select("_part", F.first("_first", ignorenulls=True).over(later).alias("_after"))
    nxt = starts.withColumn("_next", F.lead(place).over(inside)).join(first, "_part").withColumn(
        "_next", F.coalesce("_next", "_after"))
    end = F.struct(*[F.col(f"_next.{c}").alias(c) for c in sequence])
    versions = nxt.select(*keys, *tracked, F.struct(*sequence).alias("__START_AT"),
                          F.when(same_key("_next"), end).alias("__END_AT"),
                          F.when(same_key("_next"), F.col("_next._seen")).alias("_seen"))
    if not last_seen:
        return versions.drop("_seen")
    newest = rows.groupBy(*keys).agg(F.max(F.struct(*sequence)).alias("_newest"))
    return versions.join(newest, keys).select(*[c for c in versions.columns if c != "_seen"],
                                              F.coalesce("_seen", "_newest").alias(LAST_SEEN))


def apply_scd2(versions: DataFrame, change_log: DataFrame, late: DataFrame,
               keys: Sequence[str], sequence: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Apply out-of-order changes: only keys present in ``late`` are rebuilt, from their
    change log plus the late rows (collapsed versions cannot tell whether a state was
    confirmed after the late change); other versions are kept."""
    keys = list(keys)
    touched = late.select(*keys).distinct()
    history = change_log.select(*late.columns).join(touched, keys, "left_semi")
    rebuilt = scd2(history.unionByName(late), keys, sequence, tracked)
    kept = versions.join(touched, keys, "left_anti")
    return kept.unionByName(rebuilt.select(*versions.columns))


def splice_scd2(versions: DataFrame, log: DataFrame, new: DataFrame, keys: Sequence[str], sequence: Sequence[str],
                tracked: Sequence[str]) -> DataFrame:
    """Versions after new observations, without a second look at what they cannot touch.

    ``versions`` carry ``__LAST_AT`` (``scd2`` with ``last_seen``).  Per key the first new observation
    falls into one version; all versions before that one stay as they are.  If it came after
    the version was last confirmed, and no later version exists, the version's own row stands
    for all its observations; only otherwise are observations read from ``log``, from that
    version's start on.  Keys without a new observation are not looked at."""
    keys, sequence, tracked = list(keys), list(sequence), list(tracked)
    place, rows = F.struct(*sequence), [*keys, *sequence, *tracked]
    fresh = new.where(_all_not_null(keys)).select(*rows)
    first = fresh.groupBy(*keys).agg(F.min(place).alias("_first"))
    touched = versions.join(first, keys)
    begun = touched.where(F.col("__START_AT") <= F.col("_first"))
    cut = (touched.groupBy(*keys).agg(F.max("__START_AT").alias("_newest"), F.max("_first").alias("_first"))
           .join(begun.groupBy(*keys).agg(F.max(F.struct(F.col("__START_AT").alias("s"), F.col(LAST_SEEN).alias("l"))).alias("_b")),
                 keys, "left")
           .select(*keys, F.col("_b.s").alias("_from"),
                   ((F.col("_b.s") == F.col("_newest")) & (F.col("_b.l") < F.col("_first"))).alias("_append")))
    late = F.coalesce("_append", F.lit(False)) == F.lit(False)
    kept = versions.join(cut.select(*keys, "_from"), keys, "left_anti").unionByName(
        versions.join(cut.where("_from IS NOT NULL").select(*keys, "_from"), keys)
        .where(F.col("__START_AT") < F.col("_from")).select(*versions.columns))
    at = [F.col(f"_v.{c}").alias(c) for c in sequence]
    stands = (versions.join(cut.where("_append").select(*keys, "_from"), keys).where(F.col("__START_AT") == F.col("_from"))
              .select(*keys, F.explode(F.array_distinct(F.array("__START_AT", LAST_SEEN))).alias("_v"), *tracked)
              .select(*keys, *at, *tracked))
    again = (log.select(*rows).join(cut.where(late).select(*keys, "_from"), keys)
             .where(F.col("_from").isNull() | (place >= F.col("_from"))).select(*rows))
    part = fresh.unionByName(stands).unionByName(again).distinct()
    rebuilt = scd2(part, keys, sequence, tracked, last_seen=True)
    return kept.unionByName(rebuilt.select(*versions.columns))


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond
