"""Change feed, SCD1, SCD2 (across ranges) and out-of-order application."""

import datetime as dt
import random

import pandas as pd

from chalkline.operators import cdc


def test_snapshot_diff_kinds(spark):
    v1 = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "k int, v string")
    v2 = spark.createDataFrame([(1, "a"), (2, "B"), (4, None), (5, "e")], "k int, v string")
    out = {(r["k"], r["_change_type"]): r["v"] for r in cdc.snapshot_diff(v1, v2, ["k"], 7).collect()}
    assert out == {(2, "update_preimage"): "b", (2, "update_postimage"): "B",
                   (3, "delete"): "c", (5, "insert"): "e"}


def test_scd1_upsert_no_duplicate_members(spark):
    cur = spark.createDataFrame([(1, 10, "x"), (2, 10, "y")], "k int, seq int, v string")
    batch = spark.createDataFrame([(1, 20, "x2"), (1, 5, "late"), (3, 1, "z")], "k int, seq int, v string")
    got = sorted(tuple(r) for r in cdc.apply_scd1(cur, batch, ["k"], ["seq"]).collect())
    assert got == [(1, 20, "x2"), (2, 10, "y"), (3, 1, "z")]


def _brute_scd2(rows):
    pdf = pd.DataFrame(rows, columns=["k", "d", "s", "v"]).sort_values(["k", "d", "s"])
    out = []
    for k, g in pdf.groupby("k"):
        prev = object()
        starts = []
        for r in g.itertuples():
            if r.v != prev:
                starts.append((r.d, r.s, r.v))
            prev = r.v
        for i, (d, s, v) in enumerate(starts):
            end = starts[i + 1][:2] if i + 1 < len(starts) else (None, None)
            out.append((k, v, d, s, end[0], end[1]))
    return sorted(out, key=repr)


def _scd2_rows(df):
    return sorted(((r["k"], r["v"], r["__START_AT"]["d"], r["__START_AT"]["s"],
                    r["__END_AT"]["d"] if r["__END_AT"] else None,
                    r["__END_AT"]["s"] if r["__END_AT"] else None) for r in df.collect()), key=repr)


def test_scd2_matches_brute_force_across_ranges(spark):
    rnd = random.Random(3)
    base = dt.date(2024, 1, 1)
    rows = []
    for n in range(1500):
        k = 0 if n % 3 == 0 else rnd.randint(1, 20)      # key 0 is hot
        rows.append((k, base + dt.timedelta(days=rnd.randint(0, 400)), n, rnd.choice("ABC")))
    df = spark.createDataFrame(rows, "k int, d date, s int, v string")
    got = cdc.scd2(df, ["k"], ["d", "s"], ["v"])
    assert _scd2_rows(got) == _brute_scd2(rows)


def test_scd2_collapses_equal_neighbours_and_out_of_order(spark):
    d = dt.date(2024, 1, 1)
    rows = [(1, d, 1, "A"), (1, d, 2, "A"), (1, d, 4, "B"), (1, d + dt.timedelta(days=40), 5, "A")]
    df = spark.createDataFrame(rows, "k int, d date, s int, v string")
    versions = cdc.scd2(df, ["k"], ["d", "s"], ["v"])
    assert sorted((r[3], r[1]) for r in _scd2_rows(versions)) == [(1, "A"), (4, "B"), (5, "A")]
    late = spark.createDataFrame([(1, d, 3, "C")], "k int, d date, s int, v string")
    applied = cdc.apply_scd2(versions, df, late, ["k"], ["d", "s"], ["v"])
    assert _scd2_rows(applied) == _brute_scd2(rows + [(1, d, 3, "C")])


def test_scd_type_is_one_parameter(spark):
    """Type 1 and type 2 take the same (keys, sequence) inputs."""
    rows = [(1, 1, "A"), (1, 2, "B")]
    df = spark.createDataFrame(rows, "k int, s int, v string")
    assert cdc.scd1(df, ["k"], ["s"]).count() == 1
    assert cdc.scd2(df, ["k"], ["s"], ["v"]).count() == 2


def test_snapshot_diff_never_pairs_duplicate_keys(spark):
    v1 = spark.createDataFrame([(1, "a"), (1, "b")] + [(2, "x")] * 50, "k int, v string")
    v2 = spark.createDataFrame([(1, "a"), (1, "c")] + [(2, "x")] * 49, "k int, v string")
    out = sorted((r["k"], r["v"], r["_change_type"]) for r in cdc.snapshot_diff(v1, v2, ["k"], 2).collect())
    assert out == [(1, "b", "update_preimage"), (1, "c", "update_postimage"),
                   (2, "x", "update_preimage")]
