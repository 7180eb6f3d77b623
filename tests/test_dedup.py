"""Uniqueness operators, including a hot key and NULL keys."""

import random

import pandas as pd
from pyspark.sql import functions as F

from chalkline.operators import dedup


def test_redelivery_all_recognised(spark):
    ids = list(range(1000)) + list(range(950, 1000))
    df = spark.createDataFrame([(str(i), n) for n, i in enumerate(ids)], "_event_id string, seq int")
    survivors, dups = dedup.split_duplicates(df, ["_event_id"], ["seq"])
    assert survivors.count() == 1000 and dups.count() == 50
    assert dups.agg(F.min("seq")).first()[0] == 1000          # later copies are the duplicates
    assert dedup.duplicate_report(df, ["_event_id"]).count() == 50


def test_keep_first_and_latest_match_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 30), rnd.randint(0, 5), rnd.random()) for _ in range(2000)]
    rows += [(999, rnd.randint(0, 1000), rnd.random()) for _ in range(3000)]   # hot key
    df = spark.createDataFrame(rows, "k int, s int, v double")
    pdf = pd.DataFrame(rows, columns=["k", "s", "v"])
    first = pdf.sort_values(["k", "s", "v"]).groupby("k").head(1)
    last = pdf.sort_values(["k", "s", "v"], ascending=False).groupby("k").head(1)
    got_first = sorted(tuple(r) for r in dedup.keep_first(df, ["k"], ["s"]).collect())
    got_last = sorted(tuple(r) for r in dedup.keep_latest(df, ["k"], ["s"]).collect())
    assert got_first == sorted(map(tuple, first.itertuples(index=False)))
    assert got_last == sorted(map(tuple, last.itertuples(index=False)))


def test_plan_pre_aggregates_before_shuffle(spark, capsys):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("s"))
    dedup.keep_first(df, ["k"], ["s"]).explain()
    assert "partial_min" in capsys.readouterr().out


def test_null_keys_never_collapse(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "_event_id string, s int")
    survivors, dups = dedup.split_duplicates(df, ["_event_id"], ["s"])
    assert survivors.count() == 3 and dups.count() == 1


def test_exact_copies_counted_once(spark):
    df = spark.createDataFrame([("a", 1)] * 3 + [("b", 1)], "_event_id string, s int")
    survivors, dups = dedup.split_duplicates(df, ["_event_id"], ["s"])
    assert survivors.count() == 2 and dups.count() == 2


def test_drop_seen_keeps_batch_columns(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, _event_id string")
    hist = spark.createDataFrame([("a",)], "_event_id string")
    out = dedup.drop_seen(batch, hist, ["_event_id"])
    assert out.columns == batch.columns
    assert sorted(r["n"] for r in out.collect()) == [2, 3]


def test_run_marker_prefix_isolates_rows(spark):
    from chalkline.operators import setops
    df = spark.createDataFrame([("run7-1",), ("run7-2",), ("run8-1",), (None,)], "_event_id string")
    assert sorted(r[0] for r in setops.with_prefix(df, "_event_id", "run7-").collect()) == ["run7-1", "run7-2"]


def test_hot_group_of_exact_copies_is_split(spark):
    """5,000 identical copies + normal rows: duplicates are exact and the
    surplus copies come out of several tasks (chunked replication)."""
    rows = [("hot", 1)] * 5000 + [(str(i), i) for i in range(100)] + [("x", 1), ("x", 2)]
    df = spark.createDataFrame(rows, "_event_id string, s int")
    survivors, dups = dedup.split_duplicates(df, ["_event_id"], ["s"], chunk=500)
    assert survivors.count() == 102
    assert dups.count() == 5000
    assert dups.where("_event_id = 'hot'").count() == 4999
    per_task = (dups.where("_event_id = 'hot'").select(F.spark_partition_id().alias("p"))
                    .groupBy("p").count().collect())
    assert len(per_task) > 1 and max(r["count"] for r in per_task) <= 4999 // 2 + 500


def test_union_all_by_name_fills_missing_columns(spark):
    from chalkline.operators import setops
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(2, True)], "id int, flag boolean")
    out = setops.union_all_by_name(a, b).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, "x", None), (2, None, True)]
