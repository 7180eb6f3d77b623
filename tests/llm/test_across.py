"""Lists that span several components are joined across them only."""

import random

import pyarrow as pa
import pytest

from chalkline.llm import setjoin
from tests.llm.test_brute_force import brute_components, near_family


def _join_of(spark):
    return setjoin.Join(spark.createDataFrame(list(near_family(2).items()), "doc_id long, text string"), 3, 80)


def test_pairs_across_components_are_all_found(spark):
    j = _join_of(spark)
    every = {tuple(r) for r in j._across(None).collect()}
    cids = sorted(r["cid"] for r in j.classes.collect())
    for k in (1, 2, 7):                                     # nodes without a label are components of their own
        root = {c: min(x for x in cids if x % k == c % k) for c in cids if c % 5}
        labels = spark.createDataFrame(list(root.items()), "node long, root long")
        got = [tuple(r) for r in j._across(labels).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(a, b) for a, b in every if root.get(a, a) != root.get(b, b)}


@pytest.mark.parametrize("long", [2, 1000])
def test_pairs_of_lists_lose_nothing(spark, monkeypatch, long):
    """Long lists joined two by two find the links that single lists find."""
    monkeypatch.setattr(setjoin, "LONG", long)
    case = near_family(3)
    df = spark.createDataFrame(list(case.items()), "doc_id long, text string")
    for n, pct in ((3, 90), (5, 80)):
        j = setjoin.Join(df, n, pct)
        alone = spark.createDataFrame([], "node long, root long")
        got = {tuple(r) for r in j._checked(j._across(alone)).collect()}
        assert got == {tuple(r) for r in j.links().collect()} and len(got) == len(brute_components(case, n, pct)[1])


def test_no_pair_inside_the_main_component_is_formed(spark):
    """Between a family and one outsider, one side of every pair is the outsider."""
    j = _join_of(spark)
    cids = sorted(r["cid"] for r in j.classes.collect())
    rows = [(7, c, cids[0] if c != cids[-1] else c) for c in cids]
    sides = j._sides(spark.createDataFrame(rows, "sig long, cid long, comp long"))
    assert [r["cid"] for r in sides.where("NOT main").collect()] == [cids[-1]] and sides.count() == len(cids)
    one = j._sides(spark.createDataFrame([(7, c, cids[0]) for c in cids], "sig long, cid long, comp long"))
    assert one.count() == 0


def test_runs_of_keys_are_kept_across_batches():
    """Sorted keys, cut into batches at every place: every key with two sets stays, with
    pivots from its own sets; single ones go, but for the ends of the range."""
    rnd = random.Random(4)
    for _ in range(200):
        rows = sorted((rnd.randrange(12), rnd.randrange(5)) for _ in range(rnd.randrange(0, 40)))
        cuts = sorted({0, len(rows), *[rnd.randrange(len(rows) + 1) for _ in range(rnd.randrange(0, 6))]})
        batches = [pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows[a:b]], pa.int64()), pa.array([d for _, d in rows[a:b]], pa.int64())],
                                              names=["sig", "d1"]) for a, b in zip(cuts, cuts[1:])]
        got = [(r["sig"], r["d1"], r["pivots"]) for b in setjoin._shared(batches) for r in b.to_pylist()]
        sets = {}
        for s, d in rows:
            sets.setdefault(s, set()).add(d)
        need = {(s, d) for s, ds in sets.items() if len(ds) > 1 for d in ds}
        ends = {(s, d) for s, ds in sets.items() if len(ds) == 1 and s in (rows[0][0], rows[-1][0]) for d in ds}
        assert len(got) == len({g[:2] for g in got}) and {g[:2] for g in got} == need | ends
        assert all(set(p) <= sets[s] and (p or len(sets[s]) == 1) for s, _, p in got)
        for s, ds in sets.items():          # every member but a pivot itself is compared with some pivot
            if len(ds) > 1:
                assert all(d in p or p for t, d, p in got if t == s)
