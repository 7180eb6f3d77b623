"""Maps the driver's generic tables onto the change-event domain.

``events`` plays the change feed and ``nation`` x ``region`` the wiki site
matrix.  The test tables are clean, so defects are injected by modulus on the
event id.  Conditions are tested in the order written; the first match wins.
The same mapping is written in DuckDB SQL in ``chalkline.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.schemas import RAW_SCHEMA, SCHEMA_VERSION

# Fixed values of the adapter (shared with the DuckDB oracle).
EVENT_TYPE_TO_CHANGE_TYPE = {
    "click": "edit",
    "purchase": "edit",
    "view": "categorize",
    "signup": "new",
    "error": "log",
}
BAD_TITLE = "Broken\x02heading"
NFD_TITLE = "Cafe\u0301 Mu\u0308ller"  # NFD form of "Café Müller"
MULTILINGUAL_TITLE = "北京市 مرحبا 🚀"          # CJK + Arabic + emoji
FUTURE_EPOCH = 1893456000                       # 2030-01-01T00:00:00Z
TWO_DAYS = 172800
BOT_SWITCH = "2024-01-16"
AS_OF = "2024-02-01T00:00:00Z"                  # fixed "now" for the accuracy rule
ROWS_PER_TASK = 50_000                          # events that one task turns into feed rows


def _m(c: Column, mod: int, rem: int) -> Column:
    return (c % mod) == rem


def feed_rows(events: DataFrame) -> DataFrame:
    """``events`` -> raw change events (``RAW_SCHEMA``: bronze columns + dt, hour).

    The narrow source rows are dealt out first, ``ROWS_PER_TASK`` to a task: a file's splits
    follow its bytes, but its rows come in row groups, so many splits may be empty and a
    few hold everything."""
    cores = events.sparkSession.sparkContext.defaultParallelism
    events = events.repartition(max(cores, -(-events.count() // ROWS_PER_TASK)))
    i = F.col("event_id")
    ts = F.col("ts")
    epoch = F.unix_seconds(ts.cast("timestamp"))

    change_type = F.lit(None).cast("string")
    for src, dst in EVENT_TYPE_TO_CHANGE_TYPE.items():
        change_type = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(change_type)
    change_type = F.when(_m(i, 101, 7), F.lit("unknown")).otherwise(change_type)

    title = (F.when(_m(i, 103, 9), F.lit(None).cast("string"))
             .when(_m(i, 107, 11), F.lit(BAD_TITLE))
             .when(_m(i, 109, 13), F.lit(NFD_TITLE))
             .when(_m(i, 113, 15), F.lit(MULTILINGUAL_TITLE))
             .otherwise(F.concat(F.lit("Page "), (i % 500).cast("string"))))

    event_id = (F.when(_m(i, 211, 5), F.lit(None).cast("string"))
                .when(_m(i, 97, 3), (i - 1).cast("string"))
                .otherwise(i.cast("string")))

    timestamp = (F.when(_m(i, 127, 17), epoch - TWO_DAYS)
                 .when(_m(i, 137, 21), F.lit(FUTURE_EPOCH).cast("long"))
                 .otherwise(epoch))

    # 25 nations play wikis; codes 25 to 27 are in no reference
    wiki = F.concat(F.lit("w"), (F.col("user_id") % 28).cast("string"), F.lit("wiki"))
    floor_value = F.floor(F.col("value")).cast("long")
    length_old = F.when(change_type == "new",
                        F.when(_m(i, 131, 19), F.lit(50)).otherwise(F.lit(0)).cast("long")
                        ).otherwise(floor_value)
    length_new = floor_value + (i % 40)

    meta_dt = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ingested = F.concat(
        F.date_format(ts + F.make_dt_interval(secs=(i % 900).cast("decimal(18,6)")),
                      "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit("+00:00"))

    rows = events.select(
        i.alias("id"),
        change_type.alias("type"),
        title.alias("title"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user"),
        # some accounts turn into bots half-way through the month
        (((F.col("user_id") % 10) == 0) | (((F.col("user_id") % 7) == 3) & (ts >= F.lit(BOT_SWITCH).cast("timestamp_ntz"))))
        .alias("bot"),
        wiki.alias("wiki"),
        timestamp.alias("timestamp"),
        F.concat(F.lit("https://"), wiki, F.lit(".example.org")).alias("server_url"),
        F.struct(
            F.concat(F.lit("https://"), wiki, F.lit(".example.org/wiki/"), i.cast("string")).alias("uri"),
            F.concat(F.lit("req-"), i.cast("string")).alias("request_id"),
            F.concat(F.lit("meta-"), i.cast("string")).alias("id"),
            meta_dt.alias("dt"),
            F.concat(wiki, F.lit(".example.org")).alias("domain"),
            F.lit("recentchange").alias("stream"),
            F.lit("recentchange").alias("topic"),
            (i % 4).alias("partition"),
            i.alias("offset"),
        ).alias("meta"),
        F.struct(length_old.alias("old"), length_new.alias("new")).alias("length"),
        event_id.alias("_event_id"),
        ingested.alias("_ingested_at"),
        F.concat(F.lit("producer-"), (i % 3).cast("string")).alias("_producer_instance"),
        F.col("props").alias("_extra_fields"),
        F.lit(SCHEMA_VERSION).alias("_schema_version"),
        F.substring_index(meta_dt, "T", 1).alias("dt"),
        F.substring(F.substring_index(meta_dt, "T", -1), 1, 2).cast("int").alias("hour"),
    )
    return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


def feed_lines(events: DataFrame) -> DataFrame:
    """``events`` -> one raw JSON line per event (column ``value``), the shape
    a change stream delivers.  Unknown fields from ``props`` are merged into the
    object.  Injected defects on ``id % 89``: 1 malformed text, 2 blank line, 3 a JSON
    array, 4 no ``id`` key, 5 ``"id": null``, 6 a leading tab, 7 a repeated key, 8 only
    white space, 9 a boolean id, 10 an id with a fraction.
    """
    rows = feed_rows(events)
    payload = F.to_json(F.struct("id", "type", "title", "user", "bot", "wiki", "timestamp",
                                 "server_url", "meta", "length"))
    extras = F.regexp_replace(F.col("_extra_fields"), r"^\s*\{", "")
    merged = F.concat(F.regexp_replace(payload, r"\}$", ""), F.lit(", "), extras)
    i = F.col("id")
    no_id = F.regexp_replace(merged, r"^\{\"id\":-?[0-9]+,", "")
    line = (F.when(_m(i, 89, 1), F.lit('{"type": "edit",'))
            .when(_m(i, 89, 2), F.lit(""))
            .when(_m(i, 89, 3), F.lit("[1, 2, 3]"))
            .when(_m(i, 89, 4), F.concat(F.lit("{"), no_id))
            .when(_m(i, 89, 5), F.concat(F.lit('{"id":null,'), no_id))
            .when(_m(i, 89, 6), F.concat(F.lit("\t"), merged))
            .when(_m(i, 89, 7), F.concat(F.lit('{"wiki":"shadowed",'), F.substring(merged, 2, 1_000_000)))
            .when(_m(i, 89, 8), F.lit("\t\r"))
            .when(_m(i, 89, 9), F.concat(F.lit('{"id":true,'), no_id))
            .when(_m(i, 89, 10), F.concat(F.lit('{"id":'), i.cast("string"), F.lit(".0,"), no_id))
            .otherwise(merged))
    return rows.select(i.alias("line_no"), line.alias("value"),
                       F.col("_ingested_at"), F.col("_producer_instance"))


# Reference snapshots --------------------------------------------------------

# Fixed adapter values: two site-matrix fetches.  The second one closes other wikis and
# renames the languages, so "latest snapshot per code" matters.
SNAPSHOTS = (
    # (fetched_at, closed when n % closed_mod == 0, suffix of the language name)
    ("2024-01-01T00:00:00Z", 7, ""),
    ("2024-01-15T00:00:00Z", 5, " 2"),
)


def sitematrix_documents(nation: DataFrame, region: DataFrame) -> DataFrame:
    """nation x region -> one site-matrix JSON document per snapshot
    (``fetched_at``, ``doc``): ``{"count": n, "<k>": {"localname": .., "site":
    [{"dbname": .., "code": .., "closed": ""}]}, .., "specials": [..]}``.

    The document is bounded by the number of wikis, not by event volume.
    """
    n = F.col("n_nationkey")
    located = nation.join(region, nation.n_regionkey == region.r_regionkey)
    per_snapshot = []
    for fetched_at, closed_mod, suffix in SNAPSHOTS:
        per_snapshot.append(located.select(
            F.lit(fetched_at).alias("fetched_at"), "r_regionkey",
            F.concat("r_name", F.lit(suffix)).alias("r_name"),
            F.struct(
                F.concat(F.lit("w"), n.cast("string"), F.lit("wiki")).alias("dbname"),
                F.when((n % 4) == 3, F.lit("wiktionary")).otherwise(F.lit("wiki")).alias("code"),
                # the key alone says closed, whatever its value
                F.when((n % closed_mod) == 0, F.lit("")).alias("closed"),
            ).alias("site")))
    sites = per_snapshot[0]
    for more in per_snapshot[1:]:
        sites = sites.unionByName(more)
    langs = (sites.groupBy("fetched_at", "r_regionkey", "r_name")
             .agg(F.sort_array(F.collect_list("site")).alias("site"))
             .select("fetched_at", F.struct(
                 F.col("r_regionkey").cast("string").alias("key"),
                 F.struct(F.col("r_name").alias("localname"), F.col("site")).alias("value")).alias("e")))
    docs = langs.groupBy("fetched_at").agg(
        F.count("*").alias("n"), F.map_from_entries(F.collect_list("e")).alias("langs"))
    body = F.regexp_replace(F.regexp_replace(F.to_json("langs"), r"^\{", ""), r"\}$", "")
    doc = F.concat(F.lit('{"count": '), F.col("n").cast("string"), F.lit(", "), body,
                   F.lit(', "specials": [{"dbname": "metawiki", "code": "meta"}]}'))
    return docs.select("fetched_at", doc.alias("doc"))


# Two versions of ``orders`` (change feed fixture) --------------------------------

INSERTED_KEY_OFFSET = 10_000_000


def orders_versions(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(v1, v2): v2 drops keys % 50 = 0, flips the status of keys % 7 = 1,
    raises the price of keys % 11 = 2 by 1, and inserts copies of keys
    % 97 = 5 under key + 10,000,000."""
    k = F.col("o_orderkey")
    flipped = (F.when(F.col("o_orderstatus") == "O", F.lit("F"))
                .when(F.col("o_orderstatus") == "F", F.lit("O"))
                .otherwise(F.lit("F")))
    kept = orders.where((k % 50) != 0).select(
        k, "o_custkey",
        F.when((k % 7) == 1, flipped).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when((k % 11) == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
         .alias("o_totalprice"),
        "o_orderdate", "o_orderpriority")
    inserted = orders.where((k % 97) == 5).withColumn("o_orderkey", k + INSERTED_KEY_OFFSET)
    return orders, kept.unionByName(inserted.select(*kept.columns))
