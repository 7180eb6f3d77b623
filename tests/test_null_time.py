"""The NULL-time cross-batch check sees every event."""

from chalkline.plans import catalog

SF = "/root/testdata/sf0.001"


def test_all_events_reach_the_null_time_check(spark):
    got = {r["verdict"]: r for r in catalog.queries()["stream_null_time_duplicates_all"](spark, SF).collect()}
    ids = catalog.feed(spark, SF).where("_event_id IS NOT NULL").select("_event_id")
    n, d = ids.count(), ids.distinct().count()
    assert {v: (r["row_count"], r["distinct_ids"]) for v, r in got.items()} == {"rejected": (d, d), "duplicates": (2 * n - d, d)}
