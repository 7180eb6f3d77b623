"""Data-quality dimensions, one row per case, including NULL logic."""

import datetime as dt

import pytest

from chalkline.operators import dq
from chalkline.plans import silver
from tests.helpers import BASE_DT, raw_df, raw_row

AS_OF = "2025-03-15T00:00:00Z"
CFG = dq.DQConfig(as_of=AS_OF)


def reasons(spark, cfg=CFG, **kw):
    row = raw_row(**kw)
    out = silver.stage(raw_df(spark, [row]), cfg, load_stamp=False).collect()[0]
    return list(out[dq.REASONS_COLUMN]), out


def test_valid_row_passes(spark):
    assert reasons(spark)[0] == []


@pytest.mark.parametrize("field", ["event_id", "title", "wiki", "meta_dt"])
def test_required_field_null_is_completeness(spark, field):
    kw = {field: None}
    if field == "meta_dt":
        kw.update(timestamp=int(BASE_DT.timestamp()), ingested_at=BASE_DT.isoformat(),
                  dt_part="2025-03-14", hour=21)
    assert reasons(spark, **kw)[0] == ["completeness"]


def test_malformed_event_time_is_null_not_a_crash(spark):
    assert reasons(spark, meta_dt="not-a-time", timestamp=int(BASE_DT.timestamp()),
                   ingested_at=BASE_DT.isoformat())[0] == ["completeness"]


def test_unknown_type_is_validity(spark):
    assert reasons(spark, type_="unknown")[0] == ["validity"]


@pytest.mark.parametrize("bad", ["Bad\x01title", "nul\x00", "esc\x1b", "vt\x0b"])
def test_control_char_is_validity(spark, bad):
    assert reasons(spark, title=bad)[0] == ["validity"]


@pytest.mark.parametrize("ok", ["tab\there", "line\nfeed", "cr\rhere"])
def test_tab_newline_cr_allowed(spark, ok):
    assert reasons(spark, title=ok)[0] == []


def test_multilingual_never_rejected(spark):
    assert reasons(spark, title="مرحبا 北京市 🚀 Café")[0] == []


@pytest.mark.parametrize("old,expected", [(50, ["accuracy"]), (None, []), (0, [])])
def test_new_page_with_old_length(spark, old, expected):
    assert reasons(spark, type_="new", length_old=old)[0] == expected


def test_future_timestamp_is_accuracy(spark):
    r, _ = reasons(spark, timestamp=int(dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc).timestamp()))
    assert r == ["accuracy", "consistency"]


def test_clock_skew_tolerance(spark):
    as_of = int(dt.datetime(2025, 3, 15, tzinfo=dt.timezone.utc).timestamp())
    # 2025-03-15 00:04:00 is inside 300 s of "now"; dt is set to match.
    r, _ = reasons(spark, timestamp=as_of + 240, dt_part="2025-03-15")
    assert r == []
    r, _ = reasons(spark, timestamp=as_of + 400, dt_part="2025-03-15")
    assert r == ["accuracy"]


def test_wrong_partition_date_is_consistency(spark):
    assert reasons(spark, dt_part="2020-01-01")[0] == ["consistency"]


def test_two_failures_in_tag_order(spark):
    assert reasons(spark, title=None, type_="bogus")[0] == ["completeness", "validity"]


def test_null_type_and_null_timestamp_are_not_tagged(spark):
    assert reasons(spark, type_=None)[0] == []
    assert reasons(spark, type_=None, title="x\x01")[0] == ["validity"]
    assert reasons(spark, timestamp=None, meta_dt=BASE_DT)[0] == []


def test_strict_mode_closes_gaps(spark):
    strict = dq.DQConfig(as_of=AS_OF, strict=True)
    assert reasons(spark, strict, type_=None)[0] == ["completeness", "validity", "accuracy"]
    assert reasons(spark, strict, user="bad\x02user")[0] == ["validity"]


def test_late_arrival_flagged_never_rejected(spark):
    r, row = reasons(spark, ingested_at=(BASE_DT + dt.timedelta(minutes=20)).isoformat())
    assert r == []
    assert row["_is_late_arrival"] is True
    assert row["_ingestion_latency_seconds"] == 1200


def test_on_time_not_late(spark):
    _, row = reasons(spark)
    assert row["_is_late_arrival"] is False and row["_ingestion_latency_seconds"] == 42


def test_thresholds_from_session_conf(spark):
    spark.conf.set("spark.chalkline.dq.lateThresholdSeconds", "1")
    try:
        cfg = dq.DQConfig.from_conf(spark, as_of=AS_OF)
        assert cfg.late_threshold_seconds == 1
        _, row = reasons(spark, cfg)
        assert row["_is_late_arrival"] is True
    finally:
        spark.conf.unset("spark.chalkline.dq.lateThresholdSeconds")
