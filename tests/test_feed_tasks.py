"""The feed's work is dealt out by rows, not by the bytes of a file."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from chalkline.plans import catalog
from chalkline.sources import adapter


def test_a_file_of_one_row_group_feeds_every_task(spark, tmp_path):
    n = 40_000
    at = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=37 * i % 2_000_000, microseconds=i) for i in range(n)]
    pd.DataFrame({"event_id": range(n), "ts": at, "user_id": [i % 991 for i in range(n)], "event_type": "click",
                  "value": [i * 0.731 for i in range(n)], "props": [f'{{"k": {i}}}' for i in range(n)]}
                 ).to_parquet(tmp_path / "events.parquet", row_group_size=n, coerce_timestamps="us")
    rows = catalog.feed(spark, str(tmp_path))
    shares = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(shares) == n and max(shares) <= 1.1 * n / spark.sparkContext.defaultParallelism


def test_more_rows_give_more_tasks_not_longer_ones(spark, monkeypatch):
    monkeypatch.setattr(adapter, "ROWS_PER_TASK", 50)
    events = spark.range(1000).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' AS ts", "id AS user_id",
                                          "'click' AS event_type", "1.5D AS value", "'{}' AS props")
    shares = [r["count"] for r in adapter.feed_rows(events).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 1000 and len(shares) == 20 and max(shares) <= 60
