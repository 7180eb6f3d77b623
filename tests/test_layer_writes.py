"""Layers write what they hold without work that the next step repeats."""

import pytest
from pyspark.sql import functions as F

from chalkline.plans import catalog
from chalkline.streaming import raw


def files_of(path):
    import glob
    return len(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_gathered_rows_are_written_by_the_tasks_that_read_them(spark, scratch):
    path, rows = scratch("mirror"), spark.range(0, 400, 1, 4).select("id", F.lit("2024-01-01").alias("dt"), (F.col("id") % 2).cast("int").alias("hour"))
    for number in range(2):                             # a second attempt replaces the first
        stamped = rows.withColumn("batch_id", F.lit(7))
        assert raw.write_partitioned(stamped, path, ("dt", "hour", "batch_id"), "overwrite", gathered=True) == 400
    assert files_of(path) == 8 and spark.read.parquet(path).agg(F.count_distinct("id")).first()[0] == 400
    more = rows.where("hour = 0").limit(10).withColumn("batch_id", F.lit(7))
    raw.write_partitioned(more, path, ("dt", "hour", "batch_id"), "overwrite", gathered=True)
    assert {r["hour"]: r["count"] for r in spark.read.parquet(path).groupBy("hour").count().collect()} == {0: 10, 1: 200}


class Seen(Exception):
    pass


def test_spliced_parts_read_clean_silver_that_was_landed_once(spark, tmp_path, monkeypatch):
    """Each part used to judge and deduplicate the whole feed again."""
    def batch(spark, clean, batch_id, root, scd_type=1):
        raise Seen([f for f in clean.inputFiles()])
    events = spark.range(300).selectExpr("id AS event_id", "timestamp_ntz'2024-01-15' AS ts", "id % 9 AS user_id",
                                         "'click' AS event_type", "1.5D AS value", "'{}' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog.sgold, "gold_batch", batch)
    with pytest.raises(Seen) as seen:
        catalog.stream_scd2_spliced(spark, str(tmp_path))
    assert seen.value.args[0] and all("/clean-silver-" in f for f in seen.value.args[0])
