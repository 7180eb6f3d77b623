"""Gold star schema: dimensions, the edit fact and integrity checks.

Surrogate keys are SHA-256 hashes of natural keys, so the fact computes its
foreign keys from its own row - no lookup join on the load path.  Dimension
attributes are SCD1 (latest by event time, then event id) and
``first_seen_date`` is the earliest event date; both come out of a single
aggregation per dimension (partial aggregation, skew-safe).  Integrity is
checked afterwards with anti joins (every foreign key must resolve).
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline.functions.keys import surrogate_key
from chalkline.functions.time import date_key
from chalkline.operators import contracts, joins

# Heuristic for anonymous editors: the user name is an IPv4 or IPv6 literal.
IP_LITERAL = r"^(\d{1,3}(\.\d{1,3}){3}|[0-9A-Fa-f:]*:[0-9A-Fa-f:.]+)$"


def editor_key(user: Column) -> Column:
    return surrogate_key(user)


def page_key(wiki: Column, title: Column) -> Column:
    return surrogate_key(wiki, title)


def wiki_key(wiki: Column) -> Column:
    return surrogate_key(wiki)


def change_type_key(type_: Column, is_bot: Column) -> Column:
    return surrogate_key(type_, is_bot)


def _change_types() -> list[str]:
    return contracts.enum_fields(contracts.load("silver_recentchange"))["type"]


SEQUENCE = "_seq"


def _latest_and_first(silver: DataFrame, key: Column, attrs: dict[str, Column]) -> DataFrame:
    seq = F.struct(F.col("meta_dt").alias("at"), F.col("_event_id").alias("event_id"))
    latest = F.max(F.struct(seq.alias(SEQUENCE), *[c.alias(n) for n, c in attrs.items()])).alias("_l")
    first = F.min(F.to_date(F.col("meta_dt"))).alias("first_seen_date")
    grouped = silver.withColumn("_k", key).where(F.col("_k").isNotNull()).groupBy("_k")
    return grouped.agg(latest, first).select(
        F.col("_k"), *[F.col(f"_l.{n}").alias(n) for n in attrs], "first_seen_date",
        F.col(f"_l.{SEQUENCE}").alias(SEQUENCE))


def _seq(with_sequence: bool) -> list[str]:
    return [SEQUENCE] if with_sequence else []


def dim_editor(silver: DataFrame, with_sequence: bool = False) -> DataFrame:
    d = _latest_and_first(silver, editor_key(F.col("user")),
                          {"user_name": F.col("user"), "is_bot": F.col("bot")})
    return d.select(F.col("_k").alias("editor_key"), "user_name",
                    (~F.col("user_name").rlike(IP_LITERAL)).alias("is_registered"),
                    "is_bot", "first_seen_date", *_seq(with_sequence))


def dim_page(silver: DataFrame, with_sequence: bool = False) -> DataFrame:
    d = _latest_and_first(silver, page_key(F.col("wiki"), F.col("title")),
                          {"title": F.col("title"), "wiki_code": F.col("wiki")})
    return d.select(F.col("_k").alias("page_key"), "title", "wiki_code", "first_seen_date",
                    *_seq(with_sequence))


def dim_wiki(silver: DataFrame, reference_latest: DataFrame | None = None,
             with_sequence: bool = False) -> DataFrame:
    """Wiki codes seen in the stream; with a reference they are enriched (``enrich_wiki``)."""
    d = _latest_and_first(silver, wiki_key(F.col("wiki")), {"wiki_code": F.col("wiki")})
    d = d.select(F.col("_k").alias("wiki_key"), "wiki_code", "first_seen_date", *_seq(with_sequence))
    return d if reference_latest is None else enrich_wiki(d, reference_latest)


def enrich_wiki(wikis: DataFrame, reference_latest: DataFrame) -> DataFrame:
    """Language and project of the latest reference snapshot; codes missing from the
    reference keep NULL attributes.  Done when the dimension is read, so a new snapshot
    shows at once, also for wikis without new events."""
    ref = reference_latest.select("wiki_code", "language_name", "project_type")
    rest = [c for c in wikis.columns if c not in ("wiki_key", "wiki_code")]
    return joins.enrich_left(wikis, ref, "wiki_code").select("wiki_key", "wiki_code", "language_name", "project_type", *rest)


# Tables that follow the stream: surrogate key, natural attributes as columns of silver.
TRACKED = {
    "dim_editor": ("editor_key", {"user_name": "user", "is_bot": "bot"}),
    "dim_page": ("page_key", {"title": "title", "wiki_code": "wiki"}),
    "dim_wiki": ("wiki_key", {"wiki_code": "wiki"}),
}
_KEY_OF = {"dim_editor": lambda: editor_key(F.col("user")),
           "dim_page": lambda: page_key(F.col("wiki"), F.col("title")),
           "dim_wiki": lambda: wiki_key(F.col("wiki"))}
SCD2_SEQUENCE = ("at", "event_id")


def dimension_changes(silver: DataFrame, name: str) -> DataFrame:
    """Every observation of a dimension member: key, attributes, sequence (at, event_id)."""
    key, attrs = TRACKED[name]
    return (silver.select(_KEY_OF[name]().alias(key), *[F.col(c).alias(n) for n, c in attrs.items()],
                          F.col("meta_dt").alias("at"), F.col("_event_id").alias("event_id"))
            .where(F.col(key).isNotNull()))


def latest_members(rows: DataFrame, key: str) -> DataFrame:
    """SCD1 merge of dimension rows built ``with_sequence``: per key the attributes of the
    latest sequence win, ``first_seen_date`` is the earliest.  Idempotent (a row merged
    twice changes nothing) and order-insensitive, so late batches are handled."""
    attrs = [c for c in rows.columns if c not in (key, SEQUENCE, "first_seen_date")]
    merged = rows.groupBy(key).agg(
        F.max(F.struct(F.col(SEQUENCE), *[F.col(a) for a in attrs])).alias("_l"),
        F.min("first_seen_date").alias("first_seen_date"))
    return merged.select(key, *[F.col(f"_l.{a}").alias(a) for a in attrs], "first_seen_date",
                         F.col(f"_l.{SEQUENCE}").alias(SEQUENCE)).select(*rows.columns)


def _calendar_columns(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    return days.select(date_key(d).alias("date_key"), d,
                       F.year(d).alias("year"), F.month(d).alias("month"),
                       F.dayofmonth(d).alias("day"),
                       F.date_format(d, "EEEE").alias("day_of_week"),
                       F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar rows for every day in [start, end] (ISO dates)."""
    one = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("full_date"))
    return _calendar_columns(one)


def calendar(days: DataFrame) -> DataFrame:
    """Calendar rows from the first to the last of ``full_date``.  Months are counted
    out first, so the days of a long range come from many tasks."""
    bounds = days.agg(F.min("full_date").alias("s"), F.max("full_date").alias("e"))
    months = bounds.select("s", "e", F.explode(F.sequence(
        F.trunc("s", "month"), F.trunc("e", "month"), F.expr("INTERVAL 1 MONTH"))).alias("m")).repartition("m")
    return _calendar_columns(months.select(F.explode(F.sequence(
        F.greatest("s", "m"), F.least("e", F.last_day("m")))).alias("full_date")))


def dim_change_type(spark: SparkSession) -> DataFrame:
    """Junk dimension: every change type x bot flag (8 literal rows)."""
    rows = list(itertools.product(_change_types(), (False, True)))
    df = spark.createDataFrame(rows, "type string, is_bot boolean")
    return df.select(change_type_key(F.col("type"), F.col("is_bot")).alias("change_type_key"),
                     "type", "is_bot")


def fact_edit_event(silver: DataFrame) -> DataFrame:
    """One fact row per clean silver row; foreign keys hashed from the row."""
    old, new = F.col("length_old"), F.col("length_new")
    return silver.select(
        F.col("_event_id").alias("event_id"),
        date_key(F.to_date(F.col("meta_dt"))).alias("date_key"),
        F.hour(F.col("meta_dt")).alias("hour_of_day"),
        editor_key(F.col("user")).alias("editor_key"),
        page_key(F.col("wiki"), F.col("title")).alias("page_key"),
        wiki_key(F.col("wiki")).alias("wiki_key"),
        change_type_key(F.col("type"), F.col("bot")).alias("change_type_key"),
        old.alias("length_old"), new.alias("length_new"), (new - old).alias("length_delta"),
        F.col("_silver_loaded_at").alias("silver_loaded_at") if "_silver_loaded_at" in silver.columns
        else F.lit(None).cast("timestamp").alias("silver_loaded_at"),
        F.current_timestamp().alias("gold_loaded_at"),
    )


FOREIGN_KEYS = (
    ("editor_key", "dim_editor"), ("page_key", "dim_page"), ("wiki_key", "dim_wiki"),
    ("date_key", "dim_date"), ("change_type_key", "dim_change_type"),
)


def integrity_report(silver: DataFrame, fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(check_name, violations): fact loss, NULL foreign keys and unresolved foreign
    keys.  Every count must be 0.  Per key the fact is counted before the join."""
    rows = fact.agg((-F.count(F.lit(1))).alias("violations"))
    parts = [rows.unionByName(silver.agg(F.count(F.lit(1)).alias("violations")))
             .agg(F.sum("violations").alias("violations")).select(F.lit("fact_rows_lost").alias("check_name"), "violations")]
    for key, dim_name in FOREIGN_KEYS:
        entries = F.array(F.struct(F.lit(f"null_{key}").alias("check_name"), F.col("null_rows").alias("violations")),
                          F.struct(F.lit(f"unresolved_{key}").alias("check_name"), F.col("unresolved_rows").alias("violations")))
        parts.append(joins.key_report(fact, dims[dim_name], key).select(F.inline(entries)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class IntegrityError(RuntimeError):
    pass


def assert_integrity(report: DataFrame) -> None:
    """Fail the load when any check has violations."""
    bad = report.where(F.col("violations") != 0).collect()   # at most a dozen rows
    if bad:
        raise IntegrityError(f"gold integrity violated: {[tuple(r) for r in bad]}")
