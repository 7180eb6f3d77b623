"""Mixing sources to target weights by systematic sampling.

Within a source every document expects ``target / source size`` copies.  Documents
are ordered by (size, id), the expected copies are summed along that order, one
random offset per source is added, and a document is taken once for each integer
that its stretch of the sum crosses.  In size order the words taken differ from the
target by less than about one document; a document is taken at most
ceil(expected) times.  Expected copies are integers in units of 1 / SCALE, so sums
are exact in any order and reruns agree.

The running sum spreads over the cluster: rows are range-partitioned by (source,
size, id), each task sums its own range, and a small table with one row per
(range, source) carries the sums across.  A source that holds a third of all rows
is cut into many ranges.

Defined results: a null text has size 0, a null source is a source of its own,
ordered last; a source without words gets target 0 and no copies; a very long text is one
document like others, taken at most ceil(expected) times; an empty table gives an empty
table; extra columns pass through, whatever their names, and ``_mix`` gives way to one so named.  Rows equal in
source, size and id are ordered by a hash of all their columns; rows equal in
everything are alike, so the result is the same whichever of them is taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, by_value, free_name, land, positional, tasks

SCALE = 10_000_000
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = 42


def source_targets(sizes: DataFrame, source: str, size: str, weights=WEIGHTS,
                   max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """One row per source: (source, source_size, target, expected, offset).

    Targets share the total size by weight, filled like water: in order of
    cap / weight, a source is capped when its share of what is left reaches its
    cap; the others share the rest.  The windows run over one row per source.
    """
    per = sizes.groupBy(F.col(source).alias("_src")).agg(F.sum(size).cast("long").alias("_sz"))
    by_name = Window.orderBy(F.col("_src").asc_nulls_last())
    kinds = F.array(*[F.lit(int(w)) for w in weights])
    per = (per.withColumn("_w", F.element_at(kinds, (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("long"))
           .withColumn("_cap", F.col("_sz") * max_repeat))
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_src").asc_nulls_last())
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    big = "decimal(38,0)"
    per = (per.withColumn("_left", F.sum("_sz").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
           .withColumn("_share", F.sum("_w").over(after))
           .withColumn("_full", F.col("_cap").cast(big) * F.col("_share") <= F.col("_left").cast(big) * F.col("_w")))
    first_open = F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("_w"), F.col("_src").isNull(),
                                                         "_src", "_left", "_share"))).over(everything)
    per = per.withColumn("_open", first_open)
    num, den = F.col("_open._left") * F.col("_w"), F.col("_open._share")
    rate = F.expr(f"CAST(CAST(_open._left AS decimal(20,0)) * CAST(_w * {SCALE} AS decimal(18,0)) AS decimal(38,0)) "
                  "DIV CAST(CAST(_open._share AS decimal(18,0)) * CAST(_sz AS decimal(20,0)) AS decimal(38,0))")
    tag = F.coalesce(F.concat(F.lit("s:"), "_src"), F.lit("none"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), tag)), 1, 8), 16, 10).cast("long") % SCALE
    return per.select(
        F.col("_src").alias(source), F.col("_sz").alias("source_size"),
        F.when(F.col("_full"), F.col("_cap").cast("double"))
         .otherwise(num.cast("double") / den.cast("double")).alias("target"),
        F.when(F.col("_sz") == 0, F.lit(0)).when(F.col("_full"), F.lit(max_repeat * SCALE))
         .otherwise(rate).cast("long").alias("expected"),
        offset.alias("offset"))


def _running_sum(expected: str, out: str):
    def run(batches):
        total = 0
        for b in batches:
            e = b.column(b.schema.get_field_index(expected)).to_numpy(zero_copy_only=False).astype(np.int64)
            s = np.cumsum(e) + total
            total = int(s[-1]) if len(s) else total
            yield b.append_column(out, pa.array(s, type=pa.int64()))
    return run


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED,
        text: str = "text", source: str = "source", key: str = "doc_id", carry_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``_mix``: struct(size, source_size, target, copies).

    ``carry_text=False`` leaves the text column out when only the counts are wanted.
    """
    rows, (text_x, source_x, key_x) = positional(docs, text, source, key)
    keep = [c for c in rows.columns if carry_text or c != text_x]
    body = F.coalesce(F.col(text_x).cast("string"), F.lit(""))
    order = F.struct(F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(*rows.columns).alias("tie"))
    sized = rows.select(*keep, order.alias("_o"))
    if not carry_text:
        sized = land(sized, "mix-sizes")        # one read of the texts for all that follows
    targets = land(source_targets(sized.select(F.col(source_x).alias("_s"), F.col("_o.size").alias("_z")),
                                  "_s", "_z", weights, max_repeat, seed), "mix-targets")
    t = targets.select(F.col("_s"), F.struct("source_size", "target", "expected", "offset").alias("_t"))
    placed = (sized.join(t, F.col(source_x).eqNullSafe(F.col("_s")), "left").drop("_s")
              .withColumn("_e", F.col("_t.expected")))
    sort = [F.col(source_x), F.col("_o.size"), F.col(key_x), F.col("_o.tie")]
    ranged = (placed.repartitionByRange(tasks(docs), *sort).sortWithinPartitions(*sort)
              .withColumn("_part", F.spark_partition_id()))
    schema = T.StructType([*ranged.schema.fields, T.StructField("_sum", T.LongType())])
    summed = land(ranged.mapInArrow(_running_sum("_e", "_sum"), schema), "mix-ranges")
    ranges = summed.groupBy(F.col(source_x).alias("_s"), F.col("_part").alias("_p")).agg(
        F.sum("_e").alias("_total"), F.min(F.col("_sum") - F.col("_e")).alias("_start"))
    earlier = Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shift = land(ranges.select("_s", "_p", (F.coalesce(F.sum("_total").over(earlier), F.lit(0))
                                            - F.col("_start")).alias("_shift")), "mix-shifts")
    joined = summed.join(shift, (F.col("_part") == F.col("_p")) & F.col(source_x).eqNullSafe(F.col("_s")), "left")
    copies = F.expr(f"(_sum + _shift + _t.offset) DIV {SCALE} - (_sum - _e + _shift + _t.offset) DIV {SCALE}")
    return joined.select(
        *[F.col(x).alias(docs.columns[int(x[1:])]) for x in keep],
        F.struct(F.col("_o.size").alias("size"), F.col("_t.source_size").alias("source_size"),
                 F.col("_t.target").alias("target"), copies.cast("long").alias("copies"))
        .alias(free_name(docs, "_mix")))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows themselves: each row as often as it is taken."""
    m = free_name(docs, "_mix")
    mixed = mix(docs, **options).where(F.col(m)["copies"] > 0)
    once = F.explode(F.array_repeat(F.lit(1), F.col(m)["copies"].cast("int"))).alias(free_name(docs, "_copy"))
    return mixed.select(*docs.columns, once).select(*docs.columns)


def op1_mix_sources(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs, carry_text=False).select(
        "doc_id", F.col("_mix.size").alias("size"), F.col("_mix.source_size").alias("source_size"),
        F.col("_mix.target").alias("target"), (F.col("_mix.copies") * F.col("_mix.size")).alias("taken"))


SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
p AS (SELECT source, sum(size)::HUGEINT AS sz FROM d GROUP BY source),
w AS (SELECT source, sz, 3 * sz AS cap,
             [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::HUGEINT AS w FROM p),
f AS (SELECT *, sum(sz) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM w),
o AS (SELECT rest AS orest, share AS oshare FROM f WHERE NOT cap * share <= rest * w
      ORDER BY cap / w, source NULLS LAST LIMIT 1),
t AS (SELECT f.source, sz,
             CASE WHEN cap * share <= rest * w THEN cap::DOUBLE
                  ELSE (orest * w)::DOUBLE / oshare::DOUBLE END AS target,
             CASE WHEN sz = 0 THEN 0 WHEN cap * share <= rest * w THEN 3 * {SCALE}
                  ELSE (orest * w * {SCALE}) // (oshare * sz) END::HUGEINT AS e,
             (('0x' || substr(md5('{SEED}|' || coalesce('s:' || f.source, 'none')), 1, 8))::BIGINT % {SCALE})::HUGEINT AS u
      FROM f LEFT JOIN o ON true),
s AS (SELECT doc_id, size, sz, target, e, u,
             sum(e) OVER (PARTITION BY d.source ORDER BY size, doc_id ROWS UNBOUNDED PRECEDING)::HUGEINT AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, sz::BIGINT AS source_size, target,
       (((upto + u) // {SCALE} - (upto - e + u) // {SCALE}) * size)::BIGINT AS taken
FROM s
"""

by_value(__name__)
