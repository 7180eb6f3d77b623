"""Change tables with positions, enrichment by version, stateful uniqueness, footers, splicing."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.operators import cdc, contracts
from chalkline.sources import files, footers
from chalkline.streaming import changes, enrich, stateful

ROWS = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("n", T.IntegerType())])


def batch(spark, *rows):
    return spark.createDataFrame(rows, "k long, v string, n int, _op string, at int")


# ---- change tables ----

@pytest.fixture()
def stock(spark, scratch):
    t = changes.ChangeTable(spark, scratch("stock"), ROWS, ["k"], buckets=4)
    t.commit(batch(spark, (1, "a", 1, "upsert", 0), (2, "b", None, "upsert", 0), (3, None, 3, "upsert", 0)))
    t.commit(batch(spark, (2, "b", None, "upsert", 0), (3, "c", 3, "upsert", 0), (4, "d", 4, "upsert", 0), (9, None, None, "delete", 0)))
    return t


def test_commits_record_what_they_changed(spark, stock):
    assert stock.version() == 2
    first = {(r["k"], r["_change_type"]) for r in stock.changes(1, 1).collect()}
    assert first == {(1, "insert"), (2, "insert"), (3, "insert")}
    second = {(r["k"], r["v"], r["_change_type"]) for r in stock.changes(2).collect()}       # an equal row is no change
    assert second == {(3, None, "update_preimage"), (3, "c", "update_postimage"), (4, "d", "insert")}
    stock.commit(batch(spark, *[(k, None, None, "delete", 0) for k in (1, 2, 3, 4)]))
    assert stock.current().count() == 0 and {r["_change_type"] for r in stock.changes(3).collect()} == {"delete"}
    assert sorted(tuple(r) for r in stock.current(2).collect()) == [(1, "a", 1), (2, "b", None), (3, "c", 3), (4, "d", 4)]


def test_the_last_change_of_a_key_counts(spark, stock):
    stock.commit(batch(spark, (1, "x", 1, "upsert", 2), (1, "y", 2, "upsert", 3), (2, "z", 0, "upsert", 1), (2, None, None, "delete", 5)),
                 sequence=["at"])
    assert {tuple(r) for r in stock.current().where("k < 3").collect()} == {(1, "y", 2)}


def test_a_retried_commit_replaces_its_own_folders(spark, stock, monkeypatch):
    """The commit fails before it is published; the next attempt takes the same version."""
    publish = changes._publish
    monkeypatch.setattr(changes, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        stock.commit(batch(spark, (1, "half", 0, "upsert", 0), (7, "half", 0, "upsert", 0)))
    assert stock.version() == 2 and stock.current().where("k in (1, 7)").collect()[0]["v"] == "a"
    monkeypatch.setattr(changes, "_publish", publish)
    assert stock.commit(batch(spark, (1, "whole", 0, "upsert", 0))) == 3
    assert {(r["k"], r["v"]) for r in stock.current().where("k in (1, 7)").collect()} == {(1, "whole")}


def test_a_consumer_goes_on_where_it_stopped(spark, stock, scratch):
    ckpt, got = scratch("consumer"), []

    def run(start=1):
        return changes.consume(spark, stock.root, ckpt, lambda df, _: got.extend((r["_commit_version"], r["k"]) for r in df.collect()),
                               stock.change_schema(), starting_version=start)

    assert run(start=2) == [2] and {v for v, _ in got} == {2}
    assert run(start=2) == [] and len(got) == 3
    stock.commit(batch(spark, (5, "e", 5, "upsert", 0)))
    stock.commit(batch(spark, (5, "f", 5, "upsert", 0)))
    assert run(start=2) == [3, 4] and [v for v, _ in sorted(got)] == [2, 2, 2, 3, 4, 4]


def test_old_bucket_versions_go_and_the_table_stays(spark, stock):
    before = sorted(tuple(r) for r in stock.current().collect())
    assert stock.vacuum(keep_from=2) > 0
    assert sorted(tuple(r) for r in stock.current().collect()) == before


# ---- enrichment ----

def test_a_batch_keeps_its_reference_version(spark, scratch):
    ref, root = scratch("reference"), scratch("enriched")
    at = dt.datetime(2024, 1, 1)

    def version(name):
        files.write_version(spark.createDataFrame([("aawiki", name, "wikipedia", at)],
                                                  "wiki_code string, language_name string, project_type string, _snapshot_fetched_at timestamp"), ref)

    rows = spark.createDataFrame([("aawiki", 1, "2024-01-01"), ("zzwiki", 2, "2024-01-01"), (None, 3, "2024-01-01")], "wiki string, id int, dt string")
    version("old")
    enrich.enrich_batch(spark, rows, 0, ref, root)
    version("new")
    enrich.enrich_batch(spark, rows, 0, ref, root)                 # a replay
    enrich.enrich_batch(spark, rows, 1, ref, root)
    out = enrich.read_enriched(spark, root, rows.schema)
    assert {(r["batch_id"], r["id"], r["language_name"]) for r in out.collect()} == {
        (0, 1, "old"), (0, 2, None), (0, 3, None), (1, 1, "new"), (1, 2, None), (1, 3, None)}
    assert out.count() == 6


# ---- keyed state ----

EVENTS = "id long, _event_id string, meta_dt timestamp, _ingested_at string, _producer_instance string, note string, n long"


def event(i, key, minute, arrived=None, producer="p"):
    t = dt.datetime(2024, 5, 1) + dt.timedelta(minutes=minute)
    return (i, key, None if minute is None else t, f"{arrived if arrived is not None else i:06d}", producer, f"ä {i}", 2 ** 60 + i)


class Feed:
    """A folder stream that is drained run by run with one checkpoint."""

    def __init__(self, spark, scratch, judge):
        self.spark, self.src, self.out, self.ckpt, self.judge = spark, scratch("src"), scratch("out"), scratch("ckpt"), judge

    def run(self, rows):
        self.spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(self.src)
        judged = self.judge(self.spark.readStream.schema(EVENTS).parquet(self.src))
        (judged.writeStream.format("parquet").option("checkpointLocation", self.ckpt).trigger(availableNow=True)
         .start(self.out).awaitTermination())
        return [tuple(r) for r in self.spark.read.parquet(self.out).select("id", "verdict", "note", "n").collect()]


def test_redelivered_ids_are_told_apart(spark, scratch):
    """1,000 ids, the last 50 again after a restart, and one that has been pushed out."""
    feed = Feed(spark, scratch, lambda s: stateful.suppress_redelivery(s, max_ids=990))
    got = feed.run([event(i, str(i), 0) for i in range(1000)] + [event(5000, None, 0)])
    assert len(got) == 1001 and {v for _, v, _, _ in got} == {"new"} and (7, "new", "ä 7", 2 ** 60 + 7) in got
    again = [event(2000 + i, str(i), 0) for i in range(950, 1000)] + [event(6000, "3", 0), event(6001, None, 0), event(6002, "960", 0, producer="q")]
    later = {i: v for i, v, _, _ in feed.run(again) if i >= 2000 and i != 5000}
    assert [i for i, v in later.items() if v == "new"] and {i for i, v in later.items() if v == "new"} == {6000, 6001, 6002}
    assert sum(v == "redelivered" for v in later.values()) == 50


def test_the_first_arrival_survives_whatever_the_batches(spark, scratch):
    rng, hour = random.Random(3), 60
    rows = [event(i, f"k{rng.randrange(12)}", rng.randrange(0, 90), arrived=rng.randrange(10_000)) for i in range(60)]
    rows += [event(900, None, 5), (901, "t", None, "x", "p", "no time", 1)]
    first = {}
    for r in rows:
        if r[1] is not None and r[2] is not None and (r[1] not in first or (r[3], r[0]) < first[r[1]]):
            first[r[1]] = (r[3], r[0])
    want = {r[0]: "first" if r[1] is None or r[2] is None or first[r[1]] == (r[3], r[0]) else "duplicate" for r in rows}
    seal = [event(999, "seal", 24 * hour)]
    for cuts in ([rows], [rows[:20], rows[20:41], rows[41:]]):
        feed = Feed(spark, scratch, lambda s: stateful.first_arrivals(s, delay="3 hours", horizon_ms=2 * hour * 60_000))
        for part in (*cuts, seal):
            got = feed.run(part)
        assert {i: v for i, v, _, _ in got if i != 999} == want and len(got) == len(rows)


def test_rows_behind_the_watermark_come_out(spark, scratch):
    feed = Feed(spark, scratch, lambda s: stateful.first_arrivals(s, delay="1 hour", horizon_ms=60_000))
    feed.run([event(1, "a", 600), event(2, "b", 700)])
    got = {i: v for i, v, _, _ in feed.run([event(3, "c", 10), event(4, "a", 20), event(5, "d", 5000)])}
    assert got == {1: "first", 2: "first", 3: "late", 4: "late"}


# ---- footers ----

def test_wrong_files_are_named(spark, scratch):
    path = scratch("landed")
    contract = {"contract_version": "1", "partition_columns": ["d"], "fields": [
        {"name": "a", "type": "long"}, {"name": "s", "type": "string"}, {"name": "at", "type": "timestamp"}, {"name": "d", "type": "string"}]}
    good = spark.createDataFrame([(1, "x", dt.datetime(2024, 1, 1), 0)], "a long, s string, at timestamp, more int")
    good.write.parquet(f"{path}/d=1")
    footers.assert_files_conform(spark, path, contract)
    good.withColumn("a", F.col("a").cast("string")).drop("s").coalesce(1).write.parquet(f"{path}/d=2")
    import pandas as pd
    pd.DataFrame({"a": [1.5], "s": ["y"], "at": [dt.datetime(2024, 1, 1)]}).to_parquet(f"{path}/d=2/own.parquet")
    bad = {(r["path"].rsplit("/", 2)[1], r["column_name"], r["actual"]) for r in footers.file_violations(spark, path, contract).collect()}
    assert bad == {("d=2", "a", "string"), ("d=2", "s", None), ("d=2", "a", "double"), ("d=2", "at", "timestamp_ntz")}
    with pytest.raises(contracts.ContractViolation, match="d=2"):
        footers.assert_files_conform(spark, path, contract)


# ---- splicing ----

def test_spliced_versions_equal_rebuilt_ones(spark):
    rng = random.Random(8)
    rows = [(f"k{rng.randrange(6)}", rng.randrange(300), i, rng.choice("ab")) for i in range(240)]
    schema = "k string, at int, event_id int, v string"
    df = spark.createDataFrame(rows, schema)
    seq = ["at", "event_id"]
    for cut in (rows[:120], [r for r in rows if r[1] < 150], [r for r in rows if r[1] >= 150], [r for r in rows if r[0] != "k1"]):
        old = spark.createDataFrame(cut, schema)
        new = df.exceptAll(old)
        base = cdc.scd2(old, ["k"], seq, ["v"], last_seen=True)
        got = cdc.splice_scd2(base, old, new, ["k"], seq, ["v"])
        want = cdc.scd2(df, ["k"], seq, ["v"], last_seen=True)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))
        assert all(r["__LAST_AT"] >= r["__START_AT"] for r in got.collect())
