"""Reference snapshots and the gold star schema."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from chalkline.operators import dq, gold
from chalkline.plans import silver
from chalkline.schemas import DIM_WIKI_REFERENCE_SCHEMA
from chalkline.sources import files, sitematrix
from tests.helpers import raw_df, raw_row

DOC = {"count": 2,
       "0": {"localname": "Afar", "site": [{"dbname": "aawiki", "code": "wiki", "closed": ""},
                                           {"dbname": "aawiktionary", "code": "wiktionary"}]},
       "1": {"localname": "Portuguese", "site": [{"dbname": "ptwiki", "code": "wiki"}]},
       "specials": [{"dbname": "commonswiki", "code": "commons"}]}


def test_sitematrix_parse(spark):
    docs = spark.createDataFrame([(json.dumps(DOC), "2025-03-14T00:00:00Z")], "doc string, fetched_at string")
    got = {r["wiki_code"]: (r["language_name"], r["project_type"], r["is_closed"])
           for r in sitematrix.parse_documents(docs).collect()}
    assert got == {"aawiki": ("Afar", "wikipedia", True),
                   "aawiktionary": ("Afar", "wiktionary", False),
                   "ptwiki": ("Portuguese", "wikipedia", False)}


def _snap(spark, codes, fetched):
    rows = [(c, "Lang", "wikipedia", False, fetched) for c in codes]
    return spark.createDataFrame(rows, DIM_WIKI_REFERENCE_SCHEMA)


def test_snapshot_accumulation_and_latest(spark, scratch):
    root = scratch("ref")
    t1 = dt.datetime(2026, 8, 1, tzinfo=dt.timezone.utc)
    t2 = dt.datetime(2026, 8, 2, tzinfo=dt.timezone.utc)
    counts = []
    files.write_snapshot(_snap(spark, ["a", "b", "c"], t1), root, t1)
    counts.append(files.read_ndjson(spark, f"{root}/*", DIM_WIKI_REFERENCE_SCHEMA).count())
    files.write_snapshot(_snap(spark, ["a", "b", "c"], t1), root, t1)     # rerun
    counts.append(files.read_ndjson(spark, f"{root}/*", DIM_WIKI_REFERENCE_SCHEMA).count())
    files.write_snapshot(_snap(spark, ["d"], t2), root, t2)
    counts.append(files.read_ndjson(spark, f"{root}/*", DIM_WIKI_REFERENCE_SCHEMA).count())
    assert counts == [3, 3, 4]
    files.write_snapshot(_snap(spark, ["a", "b", "c", "d"], t2), root, t2)   # second full fetch
    ref = files.read_ndjson(spark, f"{root}/*", DIM_WIKI_REFERENCE_SCHEMA)
    assert sitematrix.latest_snapshot(ref).count() == 4


def test_versioned_table_reads_current_only(spark, scratch):
    path = scratch("mv")
    files.write_version(spark.range(3), path)
    files.write_version(spark.range(5), path)
    assert files.read_current(spark, path).count() == 5


def test_format_dispatch_rejects_unknown(spark, scratch):
    with pytest.raises(ValueError):
        files.read(spark, scratch("x"), "csv")


def _silver(spark, rows):
    st = silver.stage(raw_df(spark, rows), dq.DQConfig(as_of="2025-03-15T00:00:00Z"))
    return silver.split(st)["clean"]


def _star(spark, s):
    ref = spark.createDataFrame([], DIM_WIKI_REFERENCE_SCHEMA)
    return {"dim_editor": gold.dim_editor(s), "dim_page": gold.dim_page(s),
            "dim_wiki": gold.dim_wiki(s, ref),
            "dim_date": gold.calendar(s.select(F.to_date("meta_dt").alias("full_date"))),
            "dim_change_type": gold.dim_change_type(spark)}


def test_fact_without_loss_and_keys_resolve(spark):
    s = _silver(spark, [raw_row(event_id=str(i), id_=i, user=f"u{i % 2}") for i in range(4)]
                + [raw_row(event_id="ip", id_=9, user="192.168.0.1")])
    dims = _star(spark, s)
    fact = gold.fact_edit_event(s)
    report = gold.integrity_report(s, fact, dims)
    gold.assert_integrity(report)
    assert fact.count() == 5 and dims["dim_change_type"].count() == 8
    reg = {r["user_name"]: r["is_registered"] for r in dims["dim_editor"].collect()}
    assert reg == {"u0": True, "u1": True, "192.168.0.1": False}


def test_null_user_fails_the_load(spark):
    s = _silver(spark, [raw_row(event_id="1", id_=1, user=None)])
    report = gold.integrity_report(s, gold.fact_edit_event(s), _star(spark, s))
    with pytest.raises(gold.IntegrityError, match="null_editor_key"):
        gold.assert_integrity(report)


def test_streaming_gold_upserts_dims_before_facts(spark, scratch):
    """Two batches: the later change of an editor wins, first_seen keeps the
    earliest date, a late (older) batch changes nothing, facts accumulate."""
    from chalkline.streaming import gold as sgold
    root = scratch("gold")
    day2 = dt.datetime(2026, 8, 1, 12, tzinfo=dt.timezone.utc)
    day0 = dt.datetime(2026, 7, 30, 10, tzinfo=dt.timezone.utc)
    b0 = _silver(spark, [raw_row(event_id="1", id_=1, user="ann", bot=False)])
    b1 = _silver(spark, [raw_row(event_id="2", id_=2, user="ann", bot=True, meta_dt=day2)])
    late = _silver(spark, [raw_row(event_id="3", id_=3, user="ann", bot=False, meta_dt=day0)])
    for bid, b in enumerate([b0, b1, late]):
        sgold.gold_batch(spark, b, bid, root)
    sgold.gold_batch(spark, b1, 1, root)                      # replay of batch 1
    before = sgold.read_dimension(spark, root, "dim_editor").collect()
    assert sgold.compact(spark, root, "dim_editor", upto=1) == 1
    assert sgold.compact(spark, root, "dim_editor", upto=1) == 0      # nothing new to merge
    assert sgold.read_dimension(spark, root, "dim_editor").collect() == before
    ed = sgold.read_dimension(spark, root, "dim_editor").collect()
    assert len(ed) == 1 and ed[0]["is_bot"] is True
    assert str(ed[0]["first_seen_date"]) == "2026-07-30"
    assert sgold.read_fact(spark, root).count() == 3
    assert sgold.read_dimension(spark, root, "dim_date").count() == 3      # 07-30 .. 08-01


def test_streaming_gold_rejects_null_foreign_key(spark, scratch):
    from chalkline.streaming import gold as sgold
    bad = _silver(spark, [raw_row(event_id="1", id_=1, user=None)])
    with pytest.raises(gold.IntegrityError):
        sgold.gold_batch(spark, bad, 0, scratch("gold"))
