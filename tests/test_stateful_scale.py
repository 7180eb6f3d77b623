"""Keyed state at size: bounded memory of a producer, one value per bucket of ids."""

import random
import tracemalloc
from collections import OrderedDict

import pandas as pd
import pyarrow as pa
import pytest

from chalkline.streaming import stateful
from test_incremental import Feed, event


class ListState:
    def __init__(self):
        self.kept = []

    def get(self):
        return iter(self.kept)

    def put(self, values):
        self.kept = list(values)


def processor(max_ids):
    p = stateful.LastIds(max_ids, None)
    p.ids = ListState()
    return p


def plain(known, ids, max_ids):
    """One id after the other."""
    out = []
    for i in ids:
        out.append(i not in known)
        if out[-1]:
            known[i] = None
            if len(known) > max_ids:
                known.popitem(last=False)
    return out


@pytest.mark.parametrize("max_ids, names, run", [(1, 3, 50), (5, 8, 3), (20, 30, 7), (40, 60, 1000), (1000, 50, 9)])
def test_shares_judge_like_one_id_after_the_other(monkeypatch, max_ids, names, run):
    monkeypatch.setattr(stateful, "RUN", run)
    monkeypatch.setattr(stateful, "PACK", 7)
    rng, p, known, number = random.Random(max_ids), processor(max_ids), OrderedDict(), 0
    for _ in range(6):                                  # micro-batches
        ids = [f"ü{rng.randrange(names)}" for _ in range(rng.randrange(1, 120))]
        rows = [(f"{number + i:09d}", x, f"{number + i}") for i, x in enumerate(ids)]
        number += len(ids)
        shuffled = rng.sample(rows, len(rows))
        frames = [pd.DataFrame(shuffled[i:i + 11], columns=["arrival", "row_id", "payload"]) for i in range(0, len(rows), 11)]
        got = pd.concat(p.handleInputRows(("p",), iter(frames), None))
        want = plain(known, ids, max_ids)
        assert [(r[2], "new" if n else "redelivered") for r, n in zip(rows, want)] == list(got.itertuples(index=False, name=None))
    assert p.judged(pa.array(list(known), pa.large_string()), pa.array(["new one"], pa.large_string()))[0].tolist() == [True]


def test_a_producer_is_worked_through_in_bounded_memory(monkeypatch):
    """20 MB of rows, half of them twice; what is held at a time does not grow with them."""
    monkeypatch.setattr(stateful, "RUN", 500)
    monkeypatch.setattr(stateful, "BATCH", 500)
    text, rng = "x" * 980, random.Random(1)
    order = rng.sample(range(20_000), 20_000)

    def frames():
        for i in range(0, len(order), 250):
            some = order[i:i + 250]
            yield pd.DataFrame({"arrival": [f"{k:09d}" for k in some], "row_id": [str(k % 10_000) for k in some],
                                "payload": [f"{k:09d}{text}" for k in some]})

    tracemalloc.start()
    try:
        seen = new = 0
        for frame in processor(15_000).handleInputRows(("p",), frames(), None):
            assert [int(p[:9]) for p in frame["payload"]] == list(range(seen, seen + len(frame)))
            seen, new = seen + len(frame), new + (frame["verdict"] == "new").sum()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (seen, new) == (20_000, 10_000) and peak < 12_000_000


class Held:
    """The state of one key; every call to it is counted."""
    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def get(self):
        self.calls += 1
        return self.value

    def exists(self):
        self.calls += 1
        return self.value is not None

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, due):
        self.calls += 1
        self.timers.add(due)

    def deleteTimer(self, due):
        self.calls += 1
        self.timers.remove(due)


class Clock:
    def __init__(self, watermark):
        self.getCurrentWatermarkInMs = lambda: watermark
        self.getExpiryTimeInMs = lambda: watermark


def test_ids_of_a_bucket_share_one_trip_to_the_state():
    p, state = stateful.FirstArrival(100), Held()
    p.handle = p.held = state
    frame = pd.DataFrame([(str(i), f"id{i % 900}", i + 50, f"row {i}") for i in range(1000)],
                         columns=["arrival", "row_id", "at", "payload"])
    out = pd.concat(p.handleInputRows((1,), iter([frame]), Clock(50)))
    assert len(out) == 100 and set(out["verdict"]) == {"duplicate"}
    assert state.calls <= 4 and state.timers == {150}
    state.timers.remove(150)
    some = pd.concat(p.handleExpiredTimer((1,), Clock(160), type("", (), {"getExpiryTimeInMs": lambda s: 150})()))
    assert list(some["payload"]) == [f"row {i}" for i in (*range(10),)] and state.timers == {160}
    assert state.calls <= 7


@pytest.mark.parametrize("buckets", [1, 3])
def test_buckets_hold_and_release_each_id_by_its_own_time(spark, scratch, buckets):
    """Watermark at 540 minutes: ids due before it are out, the one due right then is held."""
    feed = Feed(spark, scratch, lambda s: stateful.first_arrivals(s, delay="1 hour", horizon_ms=60 * 60_000, buckets=buckets))
    rows = [event(i, f"k{i}", 400 + 20 * i) for i in range(7)] + [event(20, "k2", 441, arrived=9_999)]
    feed.run(rows)
    got = {i: v for i, v, _, _ in feed.run([event(99, "z", 600)])}
    assert got == {20: "duplicate", 0: "first", 1: "first", 2: "first", 3: "first"}
    last = {i: v for i, v, _, _ in feed.run([event(999, "seal", 24 * 60)])}
    assert {i for i, v in last.items() if v == "first"} >= set(range(7)) and len(last) >= 8
