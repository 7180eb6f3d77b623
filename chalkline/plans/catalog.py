"""The query catalogue: every operator, runnable on the driver's tables.

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole tables.  Column
names match the DuckDB oracles in ``chalkline.plans.oracle``.  Timestamps are
returned as TIMESTAMP_NTZ (UTC wall clock) and arrays of reasons as
comma-joined text so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import datetime as _dt

from chalkline.functions import text
from chalkline.functions.text import has_control_chars, nfc
from chalkline.operators import cdc, contracts, dedup, dq, gold, reports, setops
from chalkline.plans import silver
from chalkline.schemas import DIM_WIKI_REFERENCE_SCHEMA, EVENT_SCHEMA, RAW_SCHEMA
from chalkline.streaming import bronze, changes, enrich, raw, stateful
from chalkline.streaming import dedup as sdedup
from chalkline.streaming import gold as sgold
from chalkline.streaming import silver as ssilver
from chalkline.streaming import sql as ssql
from chalkline.session import pin_utc, scratch_path
from chalkline.sources import adapter, files, footers, sitematrix
from chalkline.sources import feed as feedsrc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CFG = dq.DQConfig(as_of=adapter.AS_OF)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.feed_rows(table(spark, sf_dir, "events"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stage(feed(spark, sf_dir), CFG, load_stamp=False)


def outputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return silver.split(staged(spark, sf_dir))


def ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP -> TIMESTAMP_NTZ (the session is UTC, so wall clock = UTC)."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.typeName() == "timestamp" else F.col(f.name)
                       for f in df.schema.fields])


def reasons_text(col: str = dq.REASONS_COLUMN) -> F.Column:
    return F.concat_ws(",", F.col(col)).alias("dq_failure_reasons")


# Data quality -----------------------------------------------------------------

@query
def dq_tag_reasons(spark, sf_dir):
    """DQ-1..4, DQ-7: failed dimensions per row (before dedup)."""
    return staged(spark, sf_dir).select(
        "id", "_event_id", reasons_text(),
        F.size(dq.REASONS_COLUMN).cast("int").alias("n_failures"))


STRICT = dq.DQConfig(as_of=adapter.AS_OF, strict=True)


@query
def dq_strict_reasons(spark, sf_dir):
    """D1, D2, D14: the strict rule set - ``type`` required, ``user`` checked for
    control characters, a NULL check counts as a failure, lateness never NULL."""
    st = silver.stage(feed(spark, sf_dir), STRICT, load_stamp=False)
    return st.select("id", "_event_id", reasons_text(), "_is_late_arrival")


@query
def dq_breakdown(spark, sf_dir):
    """DQ-9: rejected rows per dimension, most frequent first."""
    return reports.rejection_breakdown(outputs(spark, sf_dir)["rejected"])


@query
def dq_rejected_sample(spark, sf_dir):
    """DQ-10: five rejected rows (top-n by raw id)."""
    sample = reports.rejected_sample(outputs(spark, sf_dir)["rejected"], 5)
    return sample.select("id", "_event_id", "type", reasons_text())


@query
def dq_timeliness(spark, sf_dir):
    """DQ-6: latency and late arrivals per event date (lateness never rejects)."""
    return (staged(spark, sf_dir).groupBy("dt").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("_is_late_arrival"), 1)).alias("n_late"),
        F.max("_ingestion_latency_seconds").alias("max_latency_seconds"),
        F.sum("_ingestion_latency_seconds").alias("sum_latency_seconds")))


@query
def dq_reconcile(spark, sf_dir):
    """DQ-11 / P4: input = clean + rejected + duplicates, counted in one pass."""
    counts = silver.verdict_counts(staged(spark, sf_dir))
    return reports.balance(counts, feed(spark, sf_dir), ssilver.OUTPUTS)


@query
def silver_clean(spark, sf_dir):
    """FLT-1, PRJ-1..3: contract-ordered clean silver rows."""
    clean = silver.silver_projection(outputs(spark, sf_dir)["clean"])
    return ntz(clean)


@query
def silver_rejected(spark, sf_dir):
    """FLT-2, PRJ-6: rejected rows with their reasons."""
    rej = outputs(spark, sf_dir)["rejected"].withColumn("dq_failure_reasons", reasons_text())
    return ntz(silver.silver_projection(rej, extra=("dq_failure_reasons",)))


# Contracts ----------------------------------------------------------------------

@query
def contract_null_audit(spark, sf_dir):
    """CT-5: NULLs in columns the silver contract declares NOT NULL (audit only)."""
    return contracts.null_audit(staged(spark, sf_dir), contracts.load("silver_recentchange"))


@query
def contract_enum_violations(spark, sf_dir):
    """CT-4: values outside the declared ``type`` enum, counted not rejected."""
    return contracts.enum_violations(feed(spark, sf_dir), contracts.load("bronze_recentchange"))


@query
def schema_version_counts(spark, sf_dir):
    """CT-7: parsed rows per stamped schema version."""
    return contracts.schema_version_counts(parsed_lines(spark, sf_dir))


@query
def drift_fields(spark, sf_dir):
    """CT-6: unknown payload fields kept in ``_extra_fields`` and their frequency."""
    return contracts.drift_report(parsed_lines(spark, sf_dir))


# Parsing / ingestion ---------------------------------------------------------------

def lines(spark, sf_dir):
    return adapter.feed_lines(table(spark, sf_dir, "events"))


def parsed_lines(spark, sf_dir):
    return feedsrc.parse_events(lines(spark, sf_dir))


def _event_columns(df: DataFrame) -> list:
    return ["_event_id", "type", "title", "user", "bot", "wiki", "timestamp",
            F.col("meta.dt").alias("meta_dt_text"),
            F.col("length.old").alias("length_old"), F.col("length.new").alias("length_new")]


@query
def parse_event_lines(spark, sf_dir):
    """SRC-8, FLT-3: JSON lines -> typed events; unknown fields kept as JSON."""
    p = parsed_lines(spark, sf_dir)
    return p.select("line_no", *_event_columns(p),
                    F.get_json_object("_extra_fields", "$.k").cast("int").alias("k"))


@query
def quarantine_lines(spark, sf_dir):
    """FLT-3 / D8: blank, malformed and non-object lines with their raw text."""
    return feedsrc.quarantine(lines(spark, sf_dir)).select("line_no", "value", "reason")


@query
def event_envelope_roundtrip(spark, sf_dir):
    """SNK-6 + SRC-11: rows -> JSON message bytes -> typed rows again."""
    decoded = feedsrc.decode_messages(feedsrc.encode_messages(feed(spark, sf_dir)))
    return decoded.select(F.col("id"), *_event_columns(decoded), "_ingested_at")


# Reference dimension (site matrix) -----------------------------------------------------

def reference_rows(spark, sf_dir):
    docs = adapter.sitematrix_documents(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))
    return sitematrix.parse_documents(docs)


@query
def sitematrix_explode(spark, sf_dir):
    """SRC-9, FLT-4: site-matrix documents -> one row per wiki per snapshot."""
    return ntz(reference_rows(spark, sf_dir))


@query
def reference_latest_snapshot(spark, sf_dir):
    """D9 / GD-3 input: latest snapshot per wiki code."""
    return ntz(sitematrix.latest_snapshot(reference_rows(spark, sf_dir)))


def _written_snapshots(spark, sf_dir) -> str:
    """SNK-7: each fetch written as its own NDJSON snapshot folder."""
    root = scratch_path(spark, "dim_wiki_reference")
    ref = reference_rows(spark, sf_dir)
    for fetched_at, *_ in adapter.SNAPSHOTS:
        when = _dt.datetime.fromisoformat(fetched_at.replace("Z", "+00:00"))
        snap = ref.where(F.col("_snapshot_fetched_at") == F.lit(fetched_at).cast("timestamp"))
        files.write_snapshot(snap, root, when)
    return root


@query
def ndjson_batch_scan(spark, sf_dir):
    """SNK-7 + SRC-3: write snapshot files, read the folder back with an explicit schema."""
    root = _written_snapshots(spark, sf_dir)
    return ntz(files.read_ndjson(spark, f"{root}/*", DIM_WIKI_REFERENCE_SCHEMA))


@query
def sql_file_scan(spark, sf_dir):
    """SRC-4: SQL over the snapshot files with explicit casts."""
    root = _written_snapshots(spark, sf_dir)
    casts = {"wiki_code": "STRING", "language_name": "STRING", "project_type": "STRING",
             "is_closed": "BOOLEAN", "_snapshot_fetched_at": "TIMESTAMP"}
    return ntz(files.sql_over_files(spark, f"{root}/*", casts, "json"))


# Uniqueness (batch) ----------------------------------------------------------------

LINEITEM_KEY = ("l_orderkey", "l_linenumber")


@query
def dedup_keep_first(spark, sf_dir):
    """UQ-2: one row per (order, line): earliest ship date wins."""
    return dedup.keep_first(table(spark, sf_dir, "lineitem"), LINEITEM_KEY, ("l_shipdate",))


@query
def dedup_keep_latest(spark, sf_dir):
    """UQ-4: latest arrival per event id (``row_number() ... DESC = 1``)."""
    rows = feed(spark, sf_dir).select("_event_id", "id", "_ingested_at", "type", "dt")
    return dedup.keep_latest(rows, silver.DEDUP_KEY, silver.ARRIVAL_ORDER)


@query
def duplicate_report(spark, sf_dir):
    """UQ-6: natural keys seen more than once."""
    return dedup.duplicate_report(table(spark, sf_dir, "lineitem"), LINEITEM_KEY)


@query
def dedup_anti_join(spark, sf_dir):
    """UQ-5: a new batch (even ids) minus the event ids that history (odd ids) holds."""
    rows = feed(spark, sf_dir).select("id", "_event_id", "dt")
    batch, history = rows.where("id % 2 = 0"), rows.where("id % 2 = 1")
    return dedup.drop_seen(batch, history, silver.DEDUP_KEY)


@query
def run_marker_rows(spark, sf_dir):
    """FLT-5: rows of one run, told by the prefix of their id."""
    return setops.with_prefix(feed(spark, sf_dir).select("id", "_event_id", "dt"), "_event_id", "7")


# Text normalization -------------------------------------------------------------------

@query
def nfc_titles(spark, sf_dir):
    """UDF-1: NFC over whole documents (Arrow-batched pandas UDF)."""
    docs = table(spark, sf_dir, "documents")
    normalized = nfc(F.col("text"))
    return docs.select("doc_id", "lang",
                       F.length(normalized).alias("nfc_chars"),
                       (normalized != F.col("text")).alias("changed"),
                       F.sha2(normalized, 256).alias("nfc_sha256"))


@query
def nfc_sql(spark, sf_dir):
    """UDF-1 from SQL: the registered function over titles as they arrive."""
    text.register(spark)
    feed(spark, sf_dir).createOrReplaceTempView("chalkline_feed")
    return spark.sql("SELECT id, nfc(title) AS title, nfc(title) <> title AS changed FROM chalkline_feed")


@query
def multilingual_validity(spark, sf_dir):
    """S3: multilingual text is never a validity failure; only control characters are."""
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count(F.when(has_control_chars(F.col("text")), 1)).alias("n_control_chars"),
        F.count(F.when(~F.col("text").rlike("^[\\x00-\\x7F]*$"), 1)).alias("n_non_ascii"))


# Streaming ------------------------------------------------------------------------

def _landed_raw(spark, sf_dir, where=None) -> str:
    """SNK-1: feed rows landed in raw/dt=/hour= folders."""
    path = scratch_path(spark, "raw")
    rows = feed(spark, sf_dir)
    if where is not None:
        rows = rows.where(where)
    raw.write_raw(rows, path)
    return path


@query
def raw_partition_counts(spark, sf_dir):
    """SNK-1, STR-5: rows per event-time partition after landing."""
    path = _landed_raw(spark, sf_dir)
    landed = spark.read.schema(RAW_SCHEMA).parquet(path)
    return landed.groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("row_count"))


@query
def stream_bronze_counts(spark, sf_dir):
    """SRC-1, SNK-3, STR-4: raw -> bronze with an availableNow file stream."""
    raw_path = _landed_raw(spark, sf_dir)
    bronze_path, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt-bronze")
    bronze.run_bronze(spark, raw_path, bronze_path, ckpt)
    out = spark.read.parquet(bronze_path)
    return out.groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"),
                                 F.count_distinct("_event_id").alias("distinct_ids"))


RERUN_SPLIT = "2024-01-20"


@query
def stream_rerun_idempotent(spark, sf_dir):
    """SRC-2 / B2: rerun without new files adds nothing; new files add only themselves."""
    raw_path = scratch_path(spark, "raw")
    rows = feed(spark, sf_dir)
    raw.write_raw(rows.where(F.col("dt") < RERUN_SPLIT), raw_path)
    bronze_path, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt-bronze")
    added = [bronze.run_bronze(spark, raw_path, bronze_path, ckpt)]
    counts = [spark.read.parquet(bronze_path).count()]
    added.append(bronze.run_bronze(spark, raw_path, bronze_path, ckpt))
    counts.append(spark.read.parquet(bronze_path).count())
    raw.write_raw(rows.where(F.col("dt") >= RERUN_SPLIT), raw_path)
    added.append(bronze.run_bronze(spark, raw_path, bronze_path, ckpt))
    counts.append(spark.read.parquet(bronze_path).count())
    data = [(i + 1, int(a), int(c)) for i, (a, c) in enumerate(zip(added, counts))]
    return spark.createDataFrame(data, "run_no int, rows_added long, bronze_rows long")


@query
def stream_row_counts_many_batches(spark, sf_dir):
    """SRC-2: rows reported by a run of one file per micro-batch (more batches than Spark
    keeps progress reports of), against the rows in the table."""
    path = scratch_path(spark, "raw")
    feed(spark, sf_dir).repartitionByRange(120, "id").write.parquet(path)
    bronze_path = scratch_path(spark, "bronze")
    added = bronze.run_bronze(spark, path, bronze_path, scratch_path(spark, "ckpt"), max_files_per_trigger=1)
    landed = spark.read.parquet(bronze_path)
    return landed.agg(F.lit(added).cast("long").alias("rows_reported"), F.count(F.lit(1)).alias("rows_in_table"),
                      (F.count_distinct("batch_id") > 100).alias("over_100_batches"))


DEDUP_PARTS = ("2024-01-11", "2024-01-21")


@query
def stream_dedup_ids(spark, sf_dir):
    """UQ-1, STR-1/2: watermark dedup over three landings drained one after the other
    (ids only; which copy survives is arrival-dependent).  Rows without an id all stay."""
    raw_path, out_path, ckpt = scratch_path(spark, "raw"), scratch_path(spark, "dedup"), scratch_path(spark, "ckpt-dedup")
    rows, dt = feed(spark, sf_dir), F.col("dt")
    parts = [dt < DEDUP_PARTS[0], (dt >= DEDUP_PARTS[0]) & (dt < DEDUP_PARTS[1]), dt >= DEDUP_PARTS[1]]
    for part in parts:
        raw.write_raw(rows.where(part), raw_path)
        flat = silver.flatten(bronze.raw_stream(spark, raw_path), normalize=False)
        (sdedup.dedup_within_watermark(flat, horizon="60 days").select("_event_id")
         .writeStream.format("parquet").option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(out_path).awaitTermination())
    return spark.read.schema("_event_id string").parquet(out_path)


def _silver_run(spark, sf_dir, max_files_per_trigger=None, where=None) -> tuple[str, str]:
    """(bronze path, silver root) after raw -> bronze -> silver."""
    raw_path = _landed_raw(spark, sf_dir, where)
    bronze_path, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    bronze.run_bronze(spark, raw_path, bronze_path, scratch_path(spark, "ckpt-bronze"))
    ssilver.run_silver(spark, bronze_path, root, scratch_path(spark, "ckpt-silver"), CFG, max_files_per_trigger)
    return bronze_path, root


@query
def stream_silver_fanout(spark, sf_dir):
    """SNK-4, UQ-7, STR-8: bronze -> silver in several micro-batches; every
    row lands in exactly one of clean / rejected / duplicates."""
    bronze_path, root = _silver_run(spark, sf_dir, max_files_per_trigger=400)
    tagged = spark.read.parquet(bronze_path).select(F.lit("input").alias("_src"), "_event_id")
    for name in ssilver.OUTPUTS:
        tagged = tagged.unionByName(
            ssilver.read_output(spark, root, name).select(F.lit(name).alias("_src"), "_event_id"))
    src = F.col("_src")
    kept = src.isin("clean", "rejected")
    return tagged.agg(
        F.count(F.when(src == "input", 1)).alias("input_rows"),
        F.count(F.when(kept, 1)).alias("survivor_rows"),
        F.count(F.when(src == "duplicates", 1)).alias("duplicates_rows"),
        F.count_distinct(F.when(kept, F.col("_event_id"))).alias("distinct_ids"),
        F.count(F.when(kept & F.col("_event_id").isNull(), 1)).alias("null_id_rows"),
    ).withColumn("balanced", F.col("input_rows") == F.col("survivor_rows") + F.col("duplicates_rows"))


def _null_time_verdicts(spark, events):
    """The same events, without an event time, in two batches: rows and ids by verdict."""
    timeless = (events.where("_event_id IS NOT NULL")
                .withColumn("meta", F.col("meta").withField("dt", F.lit(None).cast("string")))
                .withColumns({"dt": F.lit(None).cast("string"), "hour": F.lit(None).cast("int")})
                .withColumn("_bronze_loaded_at", F.lit(adapter.AS_OF).cast("timestamp")))
    root = scratch_path(spark, "silver")
    for batch_id in (0, 1):
        ssilver.fan_out(spark, timeless.withColumn("id", F.col("id") + batch_id * 1_000_000_000), batch_id, root, CFG)
    parts = [ssilver.read_output(spark, root, n).select(F.lit(n).alias("verdict"), "_event_id") for n in ssilver.OUTPUTS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("verdict").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("_event_id").alias("distinct_ids"))


@query
def stream_null_time_duplicates_all(spark, sf_dir):
    """UQ-7: the same events, without an event time, in two batches; the second arrival
    of every id is a duplicate."""
    return _null_time_verdicts(spark, feed(spark, sf_dir))


@query
def stream_sql_staging(spark, sf_dir):
    """SRC-6, D16: the rules as SQL text over a registered stream (``FROM STREAM``);
    clean rows per date, before dedup."""
    raw_path = _landed_raw(spark, sf_dir)
    ssql.register_stream(silver.flatten(bronze.raw_stream(spark, raw_path)), "chalkline_raw_stream")
    staged_stream = ssql.stream_sql(spark, dq.select_sql("chalkline_raw_stream", CFG))
    out_path, ckpt = scratch_path(spark, "sql-stream"), scratch_path(spark, "ckpt-sql")
    q = (staged_stream.where(dq.passed()).select("_event_id", "dt")
         .writeStream.format("parquet").option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(out_path))
    q.awaitTermination()
    return (spark.read.schema("_event_id string, dt string").parquet(out_path)
                 .groupBy("dt").agg(F.count(F.lit(1)).alias("clean_rows")))


@query
def stream_recorded_feed(spark, sf_dir):
    """SRC-10, SNK-2: recorded lines replayed as a stream, parsed, landed by event time
    with a trigger; rows per day."""
    src, out = scratch_path(spark, "recorded"), scratch_path(spark, "raw")
    lines(spark, sf_dir).select("value").write.text(src)
    events = feedsrc.parse_events(feedsrc.replay_stream(spark, src))
    raw.start_raw_ingest(events, out, scratch_path(spark, "ckpt")).awaitTermination()
    landed = spark.read.schema(RAW_SCHEMA).parquet(out)
    return landed.groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"))


@query
def layer_row_counts(spark, sf_dir):
    """AG-1, AG-9: rows per layer output (bronze in = clean + rejected + duplicates)."""
    counts = silver.verdict_counts(staged(spark, sf_dir)).withColumnRenamed("verdict", "table_name")
    bronze_rows = feed(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.unionByName(bronze_rows.select(F.lit("bronze").alias("table_name"), "row_count"))


# Change data --------------------------------------------------------------------------

ORDER_SEQUENCE = ("o_orderdate", "o_orderkey")
SCD1_SPLIT = "1998-01-01"


@query
def change_feed_diff(spark, sf_dir):
    """CDC-1: change feed between two versions of orders (multiset differences + key existence)."""
    v1, v2 = adapter.orders_versions(table(spark, sf_dir, "orders"))
    return cdc.snapshot_diff(v1, v2, ["o_orderkey"], commit_version=2)


@query
def change_feed_upserts(spark, sf_dir):
    """D13: what the next layer reads from the change feed (inserts and
    post-images, no change metadata)."""
    v1, v2 = adapter.orders_versions(table(spark, sf_dir, "orders"))
    return cdc.as_upserts(cdc.snapshot_diff(v1, v2, ["o_orderkey"], commit_version=2))


def _customer_changes(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_custkey", *ORDER_SEQUENCE, "o_orderstatus", "o_orderpriority")


@query
def scd1_customer(spark, sf_dir):
    """CDC-2: SCD type 1 per customer, built then upserted with a later batch."""
    changes = _customer_changes(spark, sf_dir)
    before = changes.where(F.col("o_orderdate") < SCD1_SPLIT)
    after = changes.where(F.col("o_orderdate") >= SCD1_SPLIT)
    current = cdc.scd1(before, ["o_custkey"], ORDER_SEQUENCE)
    return cdc.apply_scd1(current, after, ["o_custkey"], ORDER_SEQUENCE)


def _scd2_out(versions: DataFrame) -> DataFrame:
    return versions.select(
        "o_custkey", "o_orderstatus",
        F.col("__START_AT.o_orderdate").alias("__START_AT"),
        F.col("__START_AT.o_orderkey").alias("__START_ORDERKEY"),
        F.col("__END_AT.o_orderdate").alias("__END_AT"),
        F.col("__END_AT.o_orderkey").alias("__END_ORDERKEY"))


@query
def scd2_customer(spark, sf_dir):
    """CDC-3, WN-2: SCD type 2 on order status per customer (neighbours across ranges)."""
    return _scd2_out(cdc.scd2(_customer_changes(spark, sf_dir), ["o_custkey"], ORDER_SEQUENCE, ["o_orderstatus"]))


@query
def scd_out_of_order(spark, sf_dir):
    """CDC-4: late changes rebuild only the customers they touch."""
    changes = _customer_changes(spark, sf_dir)
    late, on_time = changes.where("o_orderkey % 5 = 0"), changes.where("o_orderkey % 5 <> 0")
    keys, tracked = ["o_custkey"], ["o_orderstatus"]
    current = cdc.scd2(on_time, keys, ORDER_SEQUENCE, tracked)
    return _scd2_out(cdc.apply_scd2(current, on_time, late, keys, ORDER_SEQUENCE, tracked))


RENAMED = "Renamed page"


@query
def silver_from_change_feed(spark, sf_dir):
    """SRC-7, SNK-9: silver reads what changed between two states of bronze: new rows and
    the post-images of changed ones, judged like any other row."""
    v2 = feed(spark, sf_dir).withColumn("title", F.when(F.col("id") % 53 == 1, RENAMED).otherwise(F.col("title")))
    v1 = feed(spark, sf_dir).where(F.col("dt") < RERUN_SPLIT)
    upserts = cdc.as_upserts(cdc.snapshot_diff(v1, v2, ["id"], commit_version=2))
    return silver.stage(upserts, CFG, load_stamp=False).select("id", "_event_id", "title", reasons_text())


# Streams with a position, a reference, or state of their own ---------------------------------

@query
def stream_wiki_enrichment(spark, sf_dir):
    """JN-1: clean silver rows as a stream, joined with the reference version of their
    batch; the second fetch is written between two runs and shows from the second on.
    Codes without a reference row stay."""
    raw_path, rows = scratch_path(spark, "raw"), feed(spark, sf_dir)
    bronze_path, root, out = (scratch_path(spark, n) for n in ("bronze", "silver", "enriched"))
    table_path, ref = scratch_path(spark, "reference"), reference_rows(spark, sf_dir)
    ckpt = {n: scratch_path(spark, f"ckpt-{n}") for n in ("bronze", "silver", "enriched")}
    schema = ssilver.output_schema(spark)
    first_fetch = F.lit(adapter.SNAPSHOTS[0][0]).cast("timestamp")
    for known, part in ((ref.where(F.col("_snapshot_fetched_at") == first_fetch), F.col("dt") < RERUN_SPLIT),
                        (ref, F.col("dt") >= RERUN_SPLIT)):
        files.write_version(known, table_path)
        raw.write_raw(rows.where(part), raw_path)
        bronze.run_bronze(spark, raw_path, bronze_path, ckpt["bronze"])
        ssilver.run_silver(spark, bronze_path, root, ckpt["silver"], CFG)
        clean = spark.readStream.schema(schema).parquet(f"{root}/verdict=clean")
        enrich.run_enriched(spark, clean, table_path, out, ckpt["enriched"])
    return enrich.read_enriched(spark, out, schema).select("_event_id", "wiki", "dt", *enrich.ATTRIBUTES)


def _orders_commits(spark, sf_dir):
    """Three batches for a change table of orders: all of them, updates and new rows (with
    unchanged ones among them), and deletes."""
    v1, v2 = adapter.orders_versions(table(spark, sf_dir, "orders"))
    k = F.col("o_orderkey")
    touched = ((k % 7) == 1) | ((k % 11) == 2) | (k >= adapter.INSERTED_KEY_OFFSET) | ((k % 13) == 4)
    upsert, delete = F.lit("upsert").alias(changes.OP), F.lit("delete").alias(changes.OP)
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    v1, v2 = v1.select(*cols), v2.select(*cols)
    return v1.schema, [v1.select("*", upsert), v2.where(touched).select("*", upsert), v1.where((k % 50) == 0).select("*", delete)]


def _consumed(spark, out):
    """A handler that appends what it is handed, one folder per run and batch."""
    def handler(run_no):
        return lambda rows, batch_id: (rows.withColumn("run_no", F.lit(run_no)).write.mode("overwrite")
                                       .parquet(f"{out}/run={run_no}-{batch_id}"))
    return handler


@query
def change_feed_incremental(spark, sf_dir):
    """SRC-7, SNK-9: three commits of a change table; a consumer that starts after the first
    sees the second and the third once, a rerun nothing."""
    schema, batches = _orders_commits(spark, sf_dir)
    t = changes.ChangeTable(spark, scratch_path(spark, "orders"), schema, ["o_orderkey"])
    ckpt, out = scratch_path(spark, "ckpt-consumer"), scratch_path(spark, "consumed")
    handler = _consumed(spark, out)

    def consume(run_no):
        changes.consume(spark, t.root, ckpt, handler(run_no), t.change_schema(), starting_version=2)

    t.commit(batches[0])
    t.commit(batches[1])
    consume(1)
    t.commit(batches[2])
    consume(2)
    consume(3)
    return spark.read.parquet(f"{out}/*").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", cdc.CHANGE_TYPE, cdc.COMMIT_VERSION, "run_no")


@query
def change_table_current(spark, sf_dir):
    """SNK-9: the state that the three commits leave, without a diff of whole states."""
    schema, batches = _orders_commits(spark, sf_dir)
    t = changes.ChangeTable(spark, scratch_path(spark, "orders"), schema, ["o_orderkey"])
    for batch in batches:
        t.commit(batch)
    return t.current()


LANDINGS = ("2024-01-11", "2024-01-21")


def _landings():
    dt = F.col("dt")
    return [dt < LANDINGS[0], (dt >= LANDINGS[0]) & (dt < LANDINGS[1]), dt >= LANDINGS[1]]


@query
def stream_layer_change_feed(spark, sf_dir):
    """SRC-7, SNK-9: bronze publishes each of its batches as a commit; silver consumes from
    the second on, each commit once, judged like any other row."""
    raw_path, bronze_path, commits, out = (scratch_path(spark, n) for n in ("raw", "bronze", "bronze-commits", "consumed"))
    ckpt, reader, rows = scratch_path(spark, "ckpt-bronze"), scratch_path(spark, "ckpt-reader"), feed(spark, sf_dir)
    handler = _consumed(spark, out)
    for run_no, part in enumerate(_landings()):
        raw.write_raw(rows.where(part), raw_path)
        bronze.run_bronze(spark, raw_path, bronze_path, ckpt, commits=commits)
        if run_no:
            layer = spark.read.schema(bronze.bronze_schema()).parquet(bronze_path)
            changes.consume(spark, commits, reader, handler(run_no), RAW_SCHEMA, starting_version=2, layer=layer)
    read = spark.read.parquet(f"{out}/*")
    upserts = silver.stage(read.where(F.col(cdc.CHANGE_TYPE) == "insert"), CFG, load_stamp=False)
    keys = read.select("id", cdc.COMMIT_VERSION, "run_no")
    return upserts.select("id", "_event_id", reasons_text()).join(keys, "id")


def _verdict_batches(spark, judged, out, ckpt, run_no=None):
    """Drain a judged stream, (id, _event_id, verdict) of every batch in a folder of its own."""
    def keep(batch, batch_id):
        (batch.select("id", "_event_id", stateful.VERDICT, F.lit(run_no).cast("int").alias("run_no"))
         .write.mode("overwrite").parquet(f"{out}/batch={run_no or 0}-{batch_id}"))
    (judged.writeStream.foreachBatch(keep).option("checkpointLocation", ckpt)
     .trigger(availableNow=True).start().awaitTermination())


RESENT = ("2024-01-05", "2024-01-26")


@query
def stream_redelivery(spark, sf_dir):
    """UQ-3: every event once, then, after a restart, the first and the last days again.
    Each producer's state holds half its ids: the last days are redelivered, the first have
    been pushed out and pass."""
    raw_path, out, ckpt = (scratch_path(spark, n) for n in ("raw", "redelivery", "ckpt-redelivery"))
    rows = feed(spark, sf_dir)
    max_ids = max(1, rows.count() // 6)
    dt = F.col("dt")
    for run_no, part in ((1, F.lit(True)), (2, (dt <= RESENT[0]) | (dt >= RESENT[1]))):
        raw.write_raw(rows.where(part), raw_path)
        flat = silver.flatten(bronze.raw_stream(spark, raw_path), normalize=False)
        _verdict_batches(spark, stateful.suppress_redelivery(flat, max_ids=max_ids), out, ckpt, run_no)
    return spark.read.parquet(f"{out}/*")


@query
def stream_first_arrivals(spark, sf_dir):
    """UQ-1, DQ-5, STR-1, D7: three landings, the earliest days last, then an event that moves
    the watermark past all horizons.  Every row comes out once: the copy that arrived first,
    its duplicates, and what came behind the watermark."""
    raw_path, out, ckpt = (scratch_path(spark, n) for n in ("raw", "arrivals", "ckpt-arrivals"))
    rows, parts = feed(spark, sf_dir), _landings()
    seal = rows.orderBy("id").limit(1).withColumns({
        "id": F.lit(-1).cast("long"), "_event_id": F.lit("seal"), "dt": F.lit("2030-01-01"), "hour": F.lit(0),
        "meta": F.col("meta").withField("dt", F.lit("2030-01-01T00:00:00Z"))})
    for landed in (rows.where(parts[1]), rows.where(parts[2]), rows.where(parts[0]), seal):
        raw.write_raw(landed, raw_path)
        flat = silver.flatten(bronze.raw_stream(spark, raw_path), normalize=False)
        judged = stateful.first_arrivals(flat, horizon_ms=60 * 86_400_000)
        _verdict_batches(spark, judged, out, ckpt)
    return spark.read.parquet(f"{out}/*").where("id >= 0").select("id", "_event_id", stateful.VERDICT)


# Gold star schema ------------------------------------------------------------------------

def clean_silver(spark, sf_dir):
    return outputs(spark, sf_dir)["clean"]


def reference_latest(spark, sf_dir):
    return sitematrix.latest_snapshot(reference_rows(spark, sf_dir))


#: What the tables of the star read of clean silver.
STAR_INPUT = ("_event_id", "id", "type", "title", "user", "bot", "wiki", "meta_dt", "length_old", "length_new", "dt")


class Star(dict):
    """Star-schema builders over clean silver, each built on first use.  A query of one table
    reads the plan itself; where several tables share it, ``landed`` writes the columns that
    they read once."""

    def __init__(self, spark, sf_dir, landed: bool = False):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir
        self.silver = clean_silver(spark, sf_dir).select(*STAR_INPUT)
        if landed:
            path = scratch_path(spark, "clean-silver")
            self.silver.write.parquet(path)
            self.silver = spark.read.schema(self.silver.schema).parquet(path)

    def __missing__(self, name):
        s, spark = self.silver, self.spark
        build = {
            "dim_editor": lambda: gold.dim_editor(s),
            "dim_page": lambda: gold.dim_page(s),
            "dim_wiki": lambda: gold.dim_wiki(s, reference_latest(spark, self.sf_dir)),
            "dim_date": lambda: gold.calendar(s.select(F.to_date("meta_dt").alias("full_date"))),
            "dim_change_type": lambda: gold.dim_change_type(spark),
            "fact": lambda: gold.fact_edit_event(s),
        }[name]
        self[name] = build()
        return self[name]


def star(spark, sf_dir, landed: bool = False) -> Star:
    return Star(spark, sf_dir, landed)


@query
def dim_editor(spark, sf_dir):
    """GD-1: editors (SCD1 attributes, first seen date, registered flag)."""
    return star(spark, sf_dir)["dim_editor"]


@query
def dim_page(spark, sf_dir):
    """GD-2: pages keyed by sha2(wiki, title)."""
    return star(spark, sf_dir)["dim_page"]


@query
def dim_wiki(spark, sf_dir):
    """GD-3, JN-1: wikis enriched from the latest reference snapshot (left join)."""
    return star(spark, sf_dir)["dim_wiki"]


@query
def dim_date(spark, sf_dir):
    """GD-4: calendar over the data's date range."""
    return star(spark, sf_dir)["dim_date"]


@query
def dim_change_type(spark, sf_dir):
    """GD-5, JN-3: junk dimension type x bot (static seed) with the number of
    facts resolving to each member (facts aggregated first, then joined)."""
    st = star(spark, sf_dir)
    per_key = st["fact"].groupBy("change_type_key").agg(F.count(F.lit(1)).alias("fact_rows"))
    return (st["dim_change_type"].join(per_key, "change_type_key", "left")
              .select("change_type_key", "type", "is_bot",
                      F.coalesce(F.col("fact_rows"), F.lit(0)).alias("fact_rows")))


FACT_COLUMNS = ("event_id", "date_key", "hour_of_day", "editor_key", "page_key", "wiki_key",
                "change_type_key", "length_old", "length_new", "length_delta")


@query
def fact_edit_event(spark, sf_dir):
    """GD-6, GD-7: one fact row per clean silver row, hashed foreign keys."""
    return star(spark, sf_dir)["fact"].select(*FACT_COLUMNS)


FK_SPLIT = "2024-01-25"


@query
def fact_null_fk(spark, sf_dir):
    """GD-8, JN-2..4: fact loss, NULL and unresolved foreign keys.  The dimensions stop at
    a date that the facts pass, and some facts have no user, so every check has work."""
    st = star(spark, sf_dir, landed=True)
    rows = st.silver.withColumn("user", F.when(F.col("id") % 139 != 23, F.col("user")))
    early = st.silver.where(F.col("dt") < FK_SPLIT)
    dims = {"dim_editor": gold.dim_editor(early), "dim_page": gold.dim_page(early), "dim_wiki": gold.dim_wiki(early),
            "dim_date": gold.calendar(early.select(F.to_date("meta_dt").alias("full_date"))),
            "dim_change_type": gold.dim_change_type(spark).where("type <> 'log'")}
    return gold.integrity_report(st.silver, gold.fact_edit_event(rows.where("id % 1000 <> 999")), dims)


def _gold_run(spark, sf_dir, scd_type: int = 1, max_files_per_trigger: int = 500) -> str:
    """raw -> bronze -> silver -> gold; every query streams a star of its own."""
    _, silver_root = _silver_run(spark, sf_dir)
    root = scratch_path(spark, "gold")
    sgold.run_gold(spark, silver_root, root, scratch_path(spark, "ckpt-gold"), max_files_per_trigger, scd_type)
    return root


@query
def stream_gold_editors(spark, sf_dir):
    """STR-7, CDC-2 per batch: raw -> bronze -> silver -> gold as chained availableNow
    runs; merged deltas, one bucket set compacted, must equal the batch-built dimension."""
    root = _gold_run(spark, sf_dir)
    sgold.compact(spark, root, "dim_editor", upto=0)
    return sgold.read_dimension(spark, root, "dim_editor")


@query
def stream_fact(spark, sf_dir):
    """STR-6: the streamed fact, batch by batch, equals the batch-built one."""
    return sgold.read_fact(spark, _gold_run(spark, sf_dir)).select(*FACT_COLUMNS)


@query
def stream_dim_wiki_refresh(spark, sf_dir):
    """GD-3, JN-1: wikis were streamed before the second snapshot; a read after it shows
    the new names, without new events."""
    root = _gold_run(spark, sf_dir)
    return sgold.read_dimension(spark, root, "dim_wiki", reference_latest(spark, sf_dir))


@query
def stream_dim_editor_scd2(spark, sf_dir):
    """CDC-3, STR-7: the same run with scd_type=2 keeps every version of an editor."""
    root = _gold_run(spark, sf_dir, scd_type=2)
    v = sgold.read_dimension(spark, root, "dim_editor", scd_type=2)
    return ntz(v.select("editor_key", "user_name", "is_bot", F.col("__START_AT.at").alias("start_at"),
                        F.col("__START_AT.event_id").alias("start_event"), F.col("__END_AT.at").alias("end_at"),
                        F.col("__END_AT.event_id").alias("end_event")))


def _scd2_rows(versions, phase):
    return ntz(versions.select("editor_key", "user_name", "is_bot", F.col("__START_AT.at").alias("start_at"),
                               F.col("__START_AT.event_id").alias("start_event"), F.col("__END_AT.at").alias("end_at"),
                               F.col("__END_AT.event_id").alias("end_event"), F.lit(phase).alias("phase")))


@query
def stream_scd2_spliced(spark, sf_dir):
    """CDC-3, CDC-4, STR-7: the middle days are streamed and compacted, then the last days and,
    late, the first ones arrive.  Read as base and spliced deltas, and compacted once more."""
    clean, path, root = clean_silver(spark, sf_dir), scratch_path(spark, "clean-silver"), scratch_path(spark, "gold")
    # judged and deduplicated once; every part reads its days
    clean.withColumn("_silver_loaded_at", F.lit(adapter.AS_OF).cast("timestamp")).write.parquet(path)
    clean = spark.read.parquet(path)
    first, middle, last = _landings()
    for batch_id, part in enumerate((middle, last, first)):
        sgold.gold_batch(spark, clean.where(part), batch_id, root, scd_type=2)
        if batch_id == 0:
            sgold.compact(spark, root, "dim_editor", upto=0, scd_type=2)
    spliced = _scd2_rows(sgold.read_dimension(spark, root, "dim_editor", scd_type=2), "spliced")
    landed = scratch_path(spark, "spliced")
    spliced.write.parquet(landed)
    sgold.compact(spark, root, "dim_editor", upto=2, scd_type=2)
    again = _scd2_rows(sgold.read_dimension(spark, root, "dim_editor", scd_type=2), "compacted")
    return spark.read.schema(spliced.schema).parquet(landed).unionByName(again)


PLANTED_DAY = "2024-01-25"


@query
def contract_file_types(spark, sf_dir):
    """CT-1..3: footers of all landed files against the contract.  A day is landed twice more,
    once with a column under another type and once without a column; those files are named."""
    path, rows = _landed_raw(spark, sf_dir), feed(spark, sf_dir)
    day = rows.where(F.col("dt") == PLANTED_DAY).drop("dt", "hour")
    day.withColumn("timestamp", F.col("timestamp").cast("string")).write.parquet(f"{path}/dt={PLANTED_DAY}/hour=24")
    day.drop("title").write.parquet(f"{path}/dt={PLANTED_DAY}/hour=25")
    contract = contracts.load("bronze_recentchange")
    landed = {**contract, "fields": [f for f in contract["fields"] if f["name"] in RAW_SCHEMA.fieldNames()]}
    bad = footers.file_violations(spark, path, landed)
    folder = F.regexp_extract("path", "dt=([^/]+)/hour=([0-9]+)", 0)
    return bad.groupBy(folder.alias("folder"), "column_name", "declared", "actual").agg(F.sum("n_rows").alias("n_rows"))


# Dashboard ------------------------------------------------------------------------------

@query
def volume_by_wiki(spark, sf_dir):
    """AG-3: edits per wiki."""
    st = star(spark, sf_dir, landed=True)
    return reports.volume_by_wiki(st["fact"], st["dim_wiki"])


@query
def bot_share(spark, sf_dir):
    """AG-4: bot vs human share of edits."""
    st = star(spark, sf_dir)
    return reports.bot_share(st["fact"], st["dim_change_type"])


@query
def hour_distribution(spark, sf_dir):
    """AG-5: edits per hour of day."""
    return reports.hour_distribution(star(spark, sf_dir)["fact"])


@query
def top_pages(spark, sf_dir):
    """AG-6, ST-1/2: top 10 pages by summed length delta."""
    st = star(spark, sf_dir, landed=True)
    return reports.top_pages(st["fact"], st["dim_page"], n=10)


TOP_EDITORS_SINCE = 20240115


@query
def top_editors(spark, sf_dir):
    """AG-7: top 10 editors since a date."""
    st = star(spark, sf_dir, landed=True)
    return reports.top_editors(st["fact"], st["dim_editor"], TOP_EDITORS_SINCE, n=10)


# Set utilities -------------------------------------------------------------------------

@query
def union_by_name(spark, sf_dir):
    """SO-1: clean and rejected rows concatenated by name (missing columns NULL)."""
    out = outputs(spark, sf_dir)
    both = setops.union_common(out["clean"].drop(dq.REASONS_COLUMN), out["rejected"])
    return both.groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"))


@query
def table_equality(spark, sf_dir):
    """SO-2: multiset difference of two versions of orders, both ways."""
    v1, v2 = adapter.orders_versions(table(spark, sf_dir, "orders"))
    return setops.equality_report(v2, v1)


@query
def id_set_equality(spark, sf_dir):
    """SO-3: ids of clean rows against ids of rows that arrived in time."""
    st = staged(spark, sf_dir)
    return setops.id_set_report(st.where(dq.passed()).select("id"), st.where("NOT _is_late_arrival").select("id"), "id")


@query
def clean_rejected_disjoint(spark, sf_dir):
    """SO-4: no event id is both clean and rejected."""
    out = outputs(spark, sf_dir)
    return setops.disjoint_report(out["clean"], out["rejected"], "_event_id")


# Storage and configuration -----------------------------------------------------------

@query
def format_roundtrip(spark, sf_dir):
    """SRC-12, SNK-8: written and read back in every allowed format."""
    suppliers = table(spark, sf_dir, "supplier")
    parts = []
    for fmt in sorted(files.FORMATS):
        path = scratch_path(spark, f"format-{fmt}")
        files.write(suppliers, path, fmt)
        parts.append(files.read(spark, path, fmt, suppliers.schema).select(F.lit(fmt).alias("format"), "s_suppkey", "s_name"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def snapshot_accumulation(spark, sf_dir):
    """GD-9: rows in the snapshot folder after a fetch, its rerun, and a second fetch."""
    root, ref, counts = scratch_path(spark, "snapshots"), reference_rows(spark, sf_dir), []
    for fetched_at in (adapter.SNAPSHOTS[0][0], adapter.SNAPSHOTS[0][0], adapter.SNAPSHOTS[1][0]):
        snap = ref.where(F.col("_snapshot_fetched_at") == F.lit(fetched_at).cast("timestamp"))
        files.write_snapshot(snap, root, _dt.datetime.fromisoformat(fetched_at.replace("Z", "+00:00")))
        counts.append((len(counts) + 1, files.read_ndjson(spark, f"{root}/*", DIM_WIKI_REFERENCE_SCHEMA).count()))
    return spark.createDataFrame(counts, "step int, row_count long")


@query
def versioned_table(spark, sf_dir):
    """SNK-5, SRC-13: a table replaced twice; readers see the last content only."""
    path, regions = scratch_path(spark, "versions"), table(spark, sf_dir, "region")
    for rows in (regions, regions.limit(0), regions.where("r_regionkey > 1")):
        files.write_version(rows, path)
    files.expire_versions(spark, path, keep=1)
    return files.read_current(spark, path)


@query
def dq_configured_thresholds(spark, sf_dir):
    """DQ-8: thresholds from the session's settings."""
    name = dq.SETTINGS + "lateThresholdSeconds"
    spark.conf.set(name, "60")
    try:
        cfg = dq.DQConfig.from_conf(spark, as_of=adapter.AS_OF)
    finally:
        spark.conf.unset(name)
    late = silver.stage(feed(spark, sf_dir), cfg, normalize=False, load_stamp=False)
    return late.groupBy("dt").agg(F.count(F.when(F.col("_is_late_arrival"), 1)).alias("n_late"))


@query
def load_stamps(spark, sf_dir):
    """PRJ-4, PRJ-5: generated stamps: set on every row, one instant per run, not before
    the run began."""
    began = F.lit(_dt.datetime.now(_dt.timezone.utc) - _dt.timedelta(seconds=1)).cast("timestamp")
    stamped = silver.stage(feed(spark, sf_dir), CFG, normalize=False)
    arrived = feedsrc.parse_events(lines(spark, sf_dir).drop("_ingested_at"))
    a = stamped.agg(F.lit("silver").alias("layer"), F.count("_silver_loaded_at").alias("n_stamped"),
                    F.count_distinct("_silver_loaded_at").alias("n_instants"),
                    (F.min("_silver_loaded_at") >= began).alias("after_start"))
    at = F.try_to_timestamp("_ingested_at")
    b = arrived.agg(F.lit("arrival").alias("layer"), F.count(at).alias("n_stamped"),
                    F.count_distinct(at).alias("n_instants"), (F.min(at) >= began).alias("after_start"))
    return a.unionByName(b)


@query
def undecodable_payloads(spark, sf_dir):
    """SRC-11: message payloads that are no event, kept as they came."""
    messages = lines(spark, sf_dir).select("line_no", F.col("value").cast("binary").alias("value"))
    lost = feedsrc.undecodable_messages(messages, EVENT_SCHEMA["meta"].dataType)
    return lost.select("line_no", F.col("value").cast("string").alias("value"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
