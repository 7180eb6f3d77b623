"""Large sets are judged by a sketch for each window of their slices."""

import random

import numpy as np
import pytest

from chalkline.llm import setjoin
from tests.llm.test_brute_force import brute_components


def _words(rnd, count):
    return [f"w{rnd.getrandbits(40):x}" for _ in range(count)]


def _case():
    """Sixty long texts that share a passage, two of them with a near copy just above the limit."""
    rnd = random.Random(8)
    passage = _words(rnd, 80)
    texts = {i: _words(rnd, 1500 + 3 * i) + passage for i in range(60)}
    for i, of in ((60, 7), (61, 50)):
        copy = list(texts[of])
        for at in rnd.sample(range(20, len(copy) - 20), len(copy) // 50):
            copy[at] = f"x{at}"
        texts[i] = copy
    return {i: " ".join(w) for i, w in texts.items()}


def test_a_shared_passage_makes_no_candidates_of_long_texts(spark, monkeypatch):
    case, near, land = _case(), [], setjoin.land

    def landed(df, name):
        out = land(df, name)
        if name == "jaccard-near":
            near.append(out.count())
        return out

    monkeypatch.setattr(setjoin, "land", landed)
    df = spark.createDataFrame(list(case.items()), "doc_id long, text string")
    got = {r["doc"]: r["component"] for r in setjoin.near_classes(df, 5, 80).collect()}
    assert got == {i: root for i, (_, root) in brute_components(case, 5, 80)[0].items()}
    assert got[60] == 7 and got[61] == 50
    assert sum(near) <= 4


def test_windows_lose_no_link(spark):
    case = _case()
    j = setjoin.Join(spark.createDataFrame(list(case.items()), "doc_id long, text string"), 5, 80)
    doc = {r["cid"]: r["doc"] for r in j.classes.collect()}
    links = {tuple(sorted((doc[r["a"]], doc[r["b"]]))) for r in j.links().collect()}
    assert links == {(7, 60), (50, 61)} and len(brute_components(case, 5, 80)[1]) == 2


@pytest.mark.parametrize("pct", [60, 80, 90])
def test_linked_sets_meet_twice_in_windows_that_accept_them(pct):
    rnd = np.random.default_rng(pct)
    table = setjoin.bands(pct)
    lows = [b[0] for b in table]
    windowed = 0
    for size in (1, 30, 500, 1500, 4000, 12_000, 60_000):
        for _ in range(6):
            a = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
            t = int(rnd.integers(-(-pct * len(a) // 100), len(a) + 1))       # the partner's size
            most = (100 - pct) * (len(a) + t) // (100 + pct)
            new = max(0, (most - (len(a) - t)) // 2)
            kept = rnd.permutation(a)[:t - new]
            b = np.unique(np.concatenate((kept, rnd.integers(0, 1 << 63, new, dtype=np.uint64) * np.uint64(2) + np.uint64(1))))
            both = [{int(k): None for k in setjoin.slice_keys(s, pct, table, lows)} for s in (a, b)]
            drawn = []
            for s in (a, b):
                names, limits, bits = setjoin.sketches(s, pct, table, lows)
                drawn.append({int(w): (int(m), x) for w, m, x in zip(names, limits, bits.reshape(len(names), -1))})
            met = 0
            for key in both[0].keys() & both[1].keys():
                name = key >> 1 & ((1 << setjoin.WINDOW_BITS) - 1)
                (limit, x), (same, y) = drawn[0][name], drawn[1][name]
                assert limit == same
                met += int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= limit
                windowed += name > 0
            assert met >= 2, (size, t)
    assert windowed > 100
