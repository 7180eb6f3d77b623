"""Bronze and silver runs: incremental, idempotent, reconciling."""

import datetime as dt

from pyspark.sql import functions as F

from chalkline.operators import dq
from chalkline.streaming import bronze, raw
from chalkline.streaming import silver as ssilver
from tests.helpers import BASE_DT, raw_df, raw_row

CFG = dq.DQConfig(as_of="2025-03-15T00:00:00Z")


def land(spark, path, rows):
    raw.write_raw(raw_df(spark, rows), path)


def test_bronze_counts_rerun_and_increment(spark, scratch):
    raw_path, bronze_path, ckpt = scratch("raw"), scratch("bronze"), scratch("ckpt")
    land(spark, raw_path, [raw_row(event_id=str(i), id_=i) for i in range(3)])
    counts = []
    for step in range(3):
        if step == 2:
            later = BASE_DT + dt.timedelta(hours=1)
            land(spark, raw_path, [raw_row(event_id="9", id_=9, meta_dt=later)])
        bronze.run_bronze(spark, raw_path, bronze_path, ckpt)
        counts.append(spark.read.parquet(bronze_path).count())
    assert counts == [3, 3, 4]
    hours = {r["hour"] for r in spark.read.parquet(bronze_path).select("hour").collect()}
    assert hours == {10, 11}


def _silver_case_rows():
    ok = dict()
    late = BASE_DT - dt.timedelta(minutes=11)
    return [
        raw_row(event_id="valid", id_=1, **ok),
        raw_row(event_id="completeness", id_=2, title=None),
        raw_row(event_id="validity", id_=3, title="Bad\x01title"),
        raw_row(event_id="accuracy", id_=4, type_="new", length_old=50),
        raw_row(event_id="consistency", id_=5,
                timestamp=int((BASE_DT - dt.timedelta(days=2)).timestamp())),
        raw_row(event_id="multilingual", id_=6, title="مرحبا 北京市 🚀"),
        raw_row(event_id="dup", id_=7),
        raw_row(event_id="dup", id_=8, ingested_at=(BASE_DT + dt.timedelta(seconds=30)).isoformat()),
        raw_row(event_id="late", id_=9, meta_dt=late, ingested_at=BASE_DT.isoformat(),
                dt_part="2025-03-14", hour=20),
    ]


def test_silver_fanout_cases(spark, scratch):
    raw_path, bronze_path = scratch("raw"), scratch("bronze")
    land(spark, raw_path, _silver_case_rows())
    bronze.run_bronze(spark, raw_path, bronze_path, scratch("ckpt-b"))
    root = scratch("silver")
    ssilver.run_silver(spark, bronze_path, root, scratch("ckpt-s"), CFG)
    clean = {r["_event_id"]: r for r in ssilver.read_output(spark, root, "clean").collect()}
    rejected = {r["_event_id"]: list(r[dq.REASONS_COLUMN])
                for r in ssilver.read_output(spark, root, "rejected").collect()}
    dups = ssilver.read_output(spark, root, "duplicates").collect()
    assert set(clean) == {"valid", "multilingual", "dup", "late"}
    assert rejected == {None: ["completeness"], "validity": ["validity"],
                        "accuracy": ["accuracy"], "consistency": ["consistency"]} or \
        rejected == {"completeness": ["completeness"], "validity": ["validity"],
                     "accuracy": ["accuracy"], "consistency": ["consistency"]}
    assert [r["id"] for r in dups] == [8]             # first arrival survives
    assert clean["late"]["_is_late_arrival"] is True
    assert clean["valid"]["_is_late_arrival"] is False
    assert len(clean) + len(rejected) + len(dups) == len(_silver_case_rows())


def test_cross_batch_duplicates_are_traced(spark, scratch):
    raw_path, bronze_path = scratch("raw"), scratch("bronze")
    root, ckpt_b, ckpt_s = scratch("silver"), scratch("ckpt-b"), scratch("ckpt-s")
    land(spark, raw_path, [raw_row(event_id="a", id_=1), raw_row(event_id="b", id_=2)])
    bronze.run_bronze(spark, raw_path, bronze_path, ckpt_b)
    ssilver.run_silver(spark, bronze_path, root, ckpt_s, CFG)
    # the same id arrives again, in a later batch and a later hour
    land(spark, raw_path, [raw_row(event_id="a", id_=3, meta_dt=BASE_DT + dt.timedelta(hours=1))])
    bronze.run_bronze(spark, raw_path, bronze_path, ckpt_b)
    ssilver.run_silver(spark, bronze_path, root, ckpt_s, CFG)
    clean = ssilver.read_output(spark, root, "clean")
    dups = ssilver.read_output(spark, root, "duplicates")
    assert sorted(r["_event_id"] for r in clean.collect()) == ["a", "b"]
    assert [r["id"] for r in dups.collect()] == [3]
    # rerun with nothing new changes nothing
    ssilver.run_silver(spark, bronze_path, root, ckpt_s, CFG)
    assert ssilver.read_output(spark, root, "clean").count() == 2


def test_replayed_batch_is_not_its_own_duplicate(spark, scratch):
    root = scratch("silver")
    batch = raw_df(spark, [raw_row(event_id="a", id_=1)]).withColumn(
        "_bronze_loaded_at", F.current_timestamp())
    assert ssilver.fan_out(spark, batch, 0, root, dq.DQConfig()) == 1
    assert ssilver.fan_out(spark, batch, 0, root, dq.DQConfig()) == 1      # retry of the same batch id
    assert spark.read.parquet(f"{root}/_instants/batch_id=0").count() == 1
    assert ssilver.read_output(spark, root, "clean").count() == 1
    assert ssilver.read_output(spark, root, "duplicates").count() == 0


def test_watermark_dedup_stream(spark, scratch):
    from chalkline.plans import silver
    from chalkline.streaming import dedup as sdedup
    raw_path, out, ckpt = scratch("raw"), scratch("out"), scratch("ckpt")
    land(spark, raw_path, [raw_row(event_id="x", id_=1), raw_row(event_id="x", id_=2),
                           raw_row(event_id="y", id_=3)])
    flat = silver.flatten(bronze.raw_stream(spark, raw_path), normalize=False)
    with sdedup.DroppedRows(spark) as dropped:
        q = (sdedup.dedup_within_watermark(flat).writeStream.format("parquet")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
        q.awaitTermination()
    assert sorted(r["_event_id"] for r in spark.read.parquet(out).collect()) == ["x", "y"]
    assert dropped.total(q) == 0


def test_raw_ingest_stream_lands_by_event_time(spark, scratch):
    import json
    from chalkline.sources import feed
    src, out, ckpt = scratch("lines"), scratch("raw"), scratch("ckpt")
    lines = [json.dumps({"id": i, "type": "edit", "title": "t", "wiki": "enwiki",
                         "meta": {"dt": f"2025-03-14T{10 + i % 2:02d}:00:00Z"}}) for i in range(6)]
    spark.createDataFrame([(l,) for l in lines + ["garbage"]], "value string").write.text(src)
    events = feed.parse_events(feed.replay_stream(spark, src))
    raw.start_raw_ingest(events, out, ckpt).awaitTermination()
    got = spark.read.parquet(out).groupBy("dt", "hour").count().collect()
    assert sorted((str(r["dt"]), r["hour"], r["count"]) for r in got) == [
        ("2025-03-14", 10, 3), ("2025-03-14", 11, 3)]


def test_sql_over_a_registered_stream(spark, scratch):
    from chalkline.streaming import sql as ssql
    raw_path, out, ckpt = scratch("raw"), scratch("out"), scratch("ckpt")
    land(spark, raw_path, [raw_row(event_id=str(i), id_=i, type_="new" if i else "edit")
                           for i in range(4)])
    ssql.register_stream(bronze.raw_stream(spark, raw_path), "raw_events_stream")
    counts = ssql.stream_sql(spark, "SELECT type, _event_id FROM raw_events_stream WHERE type = 'new'")
    q = (counts.writeStream.format("parquet").option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_ingestion_smoke_published_equals_persisted(spark, scratch):
    """20 events encoded as messages, decoded, landed and mirrored: 20 rows."""
    import json
    from chalkline.sources import feed
    lines = [json.dumps({"id": i, "type": "edit", "title": f"p{i}", "wiki": "enwiki",
                         "meta": {"dt": "2025-03-14T10:00:00Z"}}) for i in range(20)]
    parsed = feed.parse_events(spark.createDataFrame([(l,) for l in lines], "value string"))
    messages = feed.encode_messages(parsed)
    decoded = feed.decode_messages(messages)
    raw_path, bronze_path = scratch("raw"), scratch("bronze")
    raw.write_raw(decoded, raw_path)
    bronze.run_bronze(spark, raw_path, bronze_path, scratch("ckpt"))
    assert messages.count() == 20
    assert spark.read.parquet(bronze_path).count() == 20
