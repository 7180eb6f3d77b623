"""Bronze -> silver: flatten, normalize, judge, split.

Clean, rejected and duplicate rows are complementary, so ``input = clean + rejected +
duplicates`` holds by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions.text import nfc
from chalkline.functions.time import iso_to_timestamp
from chalkline.operators import dedup, dq
from chalkline.schemas import SILVER_COLUMNS

DEDUP_KEY = ("_event_id",)
ARRIVAL_ORDER = ("_ingested_at", "id")


def flatten(bronze: DataFrame, normalize: bool = True) -> DataFrame:
    """Bronze columns under their silver names: structs flattened, event time typed
    (malformed -> NULL), text NFC-normalized; keeps the raw ``id`` (arrival
    tie-breaker) and the partition columns."""
    made = {"meta_dt": iso_to_timestamp(F.col("meta.dt")),
            "length_old": F.col("length.old"), "length_new": F.col("length.new")}
    if normalize:
        made |= {"title": nfc("title"), "user": nfc("user")}
    have = set(bronze.columns)
    names = [n for n in SILVER_COLUMNS if n in made or n in have]
    kept = [n for n in ("dt", "hour", "id") if n in have]
    return bronze.select(*[made.get(n, F.col(n)).alias(n) for n in names], *kept)


def stage(bronze: DataFrame, cfg: dq.DQConfig = dq.DQConfig(), normalize: bool = True,
          load_stamp: bool = True) -> DataFrame:
    """Flattened rows with failed dimensions, timeliness and load stamp."""
    staged = dq.with_timeliness(dq.with_reasons(flatten(bronze, normalize), cfg), cfg)
    return staged.withColumn("_silver_loaded_at", F.current_timestamp()) if load_stamp else staged


def split(staged: DataFrame, deduplicate: bool = True) -> dict[str, DataFrame]:
    """{'clean', 'rejected', 'duplicates'}; first arrival per ``_event_id`` wins."""
    if deduplicate:
        survivors, duplicates = dedup.split_duplicates(staged, DEDUP_KEY, ARRIVAL_ORDER)
    else:
        survivors, duplicates = staged, staged.limit(0)
    return {"clean": survivors.where(dq.passed()), "rejected": survivors.where(~dq.passed()),
            "duplicates": duplicates}


def verdict_counts(staged: DataFrame) -> DataFrame:
    """(verdict, row_count) of the split, in one pass over narrow rows: per id the first
    arrival's outcome and the number of arrivals.  A row without an id stands alone."""
    alone = F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))
    narrow = staged.select(F.coalesce("_event_id", alone).alias("_k"), *ARRIVAL_ORDER, dq.passed().alias("_ok"))
    per_id = narrow.groupBy("_k").agg(F.min(F.struct(*ARRIVAL_ORDER, "_ok"))["_ok"].alias("_ok"),
                                      F.count(F.lit(1)).alias("_n"))
    entries = F.array(
        F.struct(F.when(F.col("_ok"), "clean").otherwise("rejected").alias("verdict"), F.lit(1).cast("long").alias("n")),
        F.struct(F.lit("duplicates").alias("verdict"), (F.col("_n") - 1).alias("n")))
    return (per_id.select(F.explode(entries).alias("e")).groupBy("e.verdict")
            .agg(F.sum("e.n").alias("row_count")).select("verdict", "row_count"))


def silver_projection(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Contract-ordered silver columns, ``extra`` columns, partition columns."""
    return df.select(*[c for c in SILVER_COLUMNS if c in df.columns], *extra, "dt", "hour")
