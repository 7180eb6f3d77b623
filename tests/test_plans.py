"""Plan-shape checks for the scale-relevant choices."""

import datetime as dt

from pyspark.sql import functions as F

from chalkline.streaming import raw
from chalkline.streaming import silver as ssilver
from tests.helpers import BASE_DT, raw_df, raw_row


def _plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_history_lookup_reads_only_horizon_folders(spark, scratch):
    root = scratch("silver")
    from chalkline.operators import dq
    cfg = dq.DQConfig(as_of="2026-09-01T00:00:00Z")
    for bid, day in enumerate([1, 5, 9]):
        t = BASE_DT + dt.timedelta(days=day)
        batch = raw_df(spark, [raw_row(event_id=f"e{day}", id_=day, meta_dt=t)]) \
            .withColumn("_bronze_loaded_at", F.current_timestamp())
        ssilver.fan_out(spark, batch, bid, root, cfg)
    slots = spark.createDataFrame([("2025-03-19", h) for h in range(24)], "dt string, hour int")
    hist = ssilver.history_ids(spark, root, 99, slots)
    files = hist.inputFiles()
    assert files and all("dt=2025-03-19" in f for f in files)
    assert sorted(r[0] for r in hist.collect()) == ["e5"]


def test_busy_hour_is_written_by_several_tasks(spark, scratch):
    """A third of all rows in one hour: rebalancing splits it by bytes."""
    path = scratch("raw")
    rows = raw_df(spark, [raw_row(event_id=str(i), id_=i, extra="x" * 2000) for i in range(3000)])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        assert raw.write_raw(rows, path) == 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(spark.read.parquet(path).inputFiles()) > 1


def test_silver_counts_read_the_input_once(spark, capsys):
    from chalkline.plans import silver
    from chalkline.operators import dq
    st = silver.stage(raw_df(spark, [raw_row()]), dq.DQConfig(as_of="2025-03-15T00:00:00Z"), normalize=False)
    assert _plan(silver.verdict_counts(st), capsys).count("Scan ExistingRDD") == 1


def test_snapshot_diff_reads_each_version_once_and_deals_out_once(spark, capsys):
    from chalkline.operators import cdc
    a, b = spark.range(10).withColumn("v", F.lit(1)), spark.range(5, 15).withColumn("v", F.lit(2))
    plan = _plan(cdc.snapshot_diff(a, b, ["id"], 1), capsys)
    assert plan.count("Range (") == 2 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_json_parsed_once_per_line(spark, capsys):
    from chalkline.sources import feed
    lines = spark.createDataFrame([('{"id": 1}',)], "value string")
    for df in (feed.parse_events(lines), feed.quarantine(lines)):
        plan = _plan(df, capsys)
        assert plan.count("parse_json") + plan.count("parseJson") == 1 and "from_json(" not in plan
