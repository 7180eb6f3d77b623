"""JSON-line parsing, quarantine, message codec."""

import json

from chalkline.sources import feed

VALID = {"id": 8801, "type": "new", "title": "Harbour light", "user": "keeper", "bot": False,
         "wiki": "cywiki", "timestamp": 1785000000, "server_url": "https://cy.example.org",
         "meta": {"dt": "2026-07-25T17:20:00Z"}, "length": {"old": 0, "new": 412}}


def lines_df(spark, lines):
    return spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "line_no int, value string")


def test_valid_line_parsed(spark):
    rows = feed.parse_events(lines_df(spark, [json.dumps(VALID)])).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["_event_id"] == "8801" and r["id"] == 8801 and r["bot"] is False
    assert r["meta"]["dt"] == "2026-07-25T17:20:00Z" and r["length"]["new"] == 412
    assert json.loads(r["_extra_fields"]) == {} and r["_schema_version"] == "1.0.0"


BROKEN = ['{"title": "cut off', "<html>502</html>", '{"id": 1,, "bot": true}']


def test_broken_lines_go_to_quarantine_and_the_others_on(spark):
    good = {3 * i + 1: 9000 + i for i in range(4)}
    lines = [json.dumps({**VALID, "id": good[i]}) if i in good else BROKEN[i % 3] for i in range(12)]
    df = lines_df(spark, lines)
    assert {r["line_no"]: r["id"] for r in feed.parse_events(df).collect()} == good
    held = feed.quarantine(df).collect()
    assert {r["line_no"] for r in held} == set(range(12)) - set(good)
    assert all((r["reason"], r["value"]) == ("malformed", lines[r["line_no"]]) for r in held)


def test_edge_lines(spark):
    lines = ["[1, 2]", "", "   ", '"text"', json.dumps({"type": "edit"}),
             json.dumps({"id": None, "title": "x"})]
    df = lines_df(spark, lines)
    parsed = {r["line_no"]: r["_event_id"] for r in feed.parse_events(df).collect()}
    assert parsed == {4: "", 5: "None"}          # reference parity: missing -> "", null -> "None"
    strict = {r["line_no"]: r["_event_id"] for r in feed.parse_events(df, strict=True).collect()}
    assert strict == {4: None, 5: None}
    q = {r["line_no"]: r["reason"] for r in feed.quarantine(df).collect()}
    assert q == {0: "not_object", 1: "blank", 2: "blank", 3: "not_object"}


def test_json_that_a_python_reader_accepts_is_accepted(spark):
    """Leading white space, a repeated key (the last value counts), boolean and fractional ids."""
    lines = ["\t" + json.dumps(VALID), '{"wiki": "first", "id": 1, "wiki": "last"}', '{"id": true}', '{"id": 5.0}',
             '{"id": 2.5}', '{"id": "text"}', "\t\r"]
    df = lines_df(spark, lines)
    got = {r["line_no"]: (r["_event_id"], r["wiki"]) for r in feed.parse_events(df).collect()}
    assert got == {0: ("8801", "cywiki"), 1: ("1", "last"), 2: ("True", None), 3: ("5.0", None),
                   4: ("2.5", None), 5: ("text", None)}
    assert [(r["line_no"], r["reason"]) for r in feed.quarantine(df).collect()] == [(6, "blank")]


def test_undecodable_payloads_are_kept_apart(spark):
    good = json.dumps({"uri": "u", "offset": 3})
    df = spark.createDataFrame([(good.encode(),), (b"garbage",), (b"",)], "value binary")
    schema = "uri string, offset long"
    from pyspark.sql import types as T
    struct = T.StructType.fromDDL(schema)
    assert [tuple(r) for r in feed.decode_messages(df, struct).collect()] == [("u", 3)]
    assert sorted(bytes(r[0]) for r in feed.undecodable_messages(df, struct).collect()) == [b"", b"garbage"]


def test_unknown_fields_kept_as_json(spark):
    line = json.dumps({**VALID, "new_field": {"a": [1, 2]}, "k": 7})
    r = feed.parse_events(lines_df(spark, [line])).collect()[0]
    assert json.loads(r["_extra_fields"]) == {"new_field": {"a": [1, 2]}, "k": 7}


def test_message_roundtrip(spark):
    df = feed.parse_events(lines_df(spark, [json.dumps(VALID)])).drop("line_no")
    back = feed.decode_messages(feed.encode_messages(df)).collect()[0]
    assert back["_event_id"] == "8801" and back["meta"]["dt"] == "2026-07-25T17:20:00Z"
    assert back["length"]["old"] == 0


def test_recorded_feed_replay(spark, scratch):
    """A recorded NDJSON feed: 50 events, one duplicated id -> 49 distinct."""
    from chalkline.operators import dedup
    path = scratch("recorded")
    events = [{**VALID, "id": i, "type": "log" if i == 3 else "edit", "bot": i % 7 == 0}
              for i in range(49)]
    events.append({**VALID, "id": 10})
    spark.createDataFrame([(json.dumps(e),) for e in events], "value string") \
         .coalesce(1).write.text(path)
    out, ckpt = scratch("replay-out"), scratch("replay-ckpt")
    q = (feed.replay_stream(spark, path).writeStream.format("parquet")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
    q.awaitTermination()
    parsed = feed.parse_events(spark.read.parquet(out))
    assert parsed.count() == 50
    assert parsed.where("bot").count() >= 1 and parsed.where("type = 'log'").count() >= 1
    rep = dedup.duplicate_report(parsed, ["_event_id"]).collect()
    assert [(r["_event_id"], r["n_duplicates"]) for r in rep] == [("10", 1)]
    assert parsed.select("_event_id").distinct().count() == 49
