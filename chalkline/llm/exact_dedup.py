"""Exact duplicates by progressive refinement, in DataFrame operations only.

Texts are first grouped by their length in bytes.  Only lengths that occur twice
are grouped by (length, hash of the first characters), only pairs that occur
twice have their whole text read and hashed with SHA-256.  Each step is a count
with partial aggregation, so a group that holds a third of all rows shrinks to
one row per input partition before it is shuffled; the joins that narrow the rows
are plain equi-joins whose hot keys adaptive execution splits.

Defined results: a null text is the empty text; a null id is smaller than any
other; a very long text is hashed whole; an empty table gives an empty table; columns beyond text and id pass
through, and helper columns take names that the input does not use.  Rows that
repeat both text and id are the same document: all of them carry the same
verdict, and ``drop_copies`` returns one of them (the smallest by the SHA-256 of
its JSON form, so reruns agree).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, land, positional

PREFIX_CHARS = 64


def _with_keys(docs: DataFrame, text: str, full: bool):
    names = [free_name(docs, n) for n in ("_len", "_head", "_full")]
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keys = {names[0]: F.octet_length(body), names[1]: F.xxhash64(F.substring(body, 1, PREFIX_CHARS))}
    if full:
        keys[names[2]] = F.sha2(body, 256)
    return docs.withColumns(keys), names


def copy_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Groups of two and more equal texts: (n_bytes, head_hash, text_sha256, keep_id,
    group_size, n_keep); n_keep counts the rows whose id is keep_id."""
    keyed, (length, head, _) = _with_keys(docs, text, full=False)
    narrow = keyed.select(length, head)
    same_length = narrow.groupBy(length).count().where("count > 1").select(length)
    same_head = (narrow.join(same_length, length, "left_semi")
                 .groupBy(length, head).count().where("count > 1").select(length, head))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    survivors = (keyed.select(length, head, F.col(key).alias("_id"), body.alias("_body"))
                 .join(same_head, [length, head], "left_semi")
                 .select(length, head, F.sha2("_body", 256).alias("_sha"), "_id"))
    # two levels: rows per id, then per text; no row set of a group meets in one task
    per_id = survivors.groupBy(length, head, "_sha", "_id").agg(F.count(F.lit(1)).alias("_n"))
    return (per_id.groupBy(length, head, "_sha")
            .agg(F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size"),
                 F.max(F.struct(F.col("_id").isNotNull(), "_id", "_n"))["_n"].alias("n_keep"))
            .where("group_size > 1")
            .select(F.col(length).alias("n_bytes"), F.col(head).alias("head_hash"),
                    F.col("_sha").alias("text_sha256"), "keep_id", "group_size", "n_keep"))


def mark_copies(docs: DataFrame, text: str = "text", key: str = "doc_id",
                groups: DataFrame | None = None) -> DataFrame:
    """Every row with ``_verdict``: struct(text_sha256, keep_id, group_size, kept, n_keep)."""
    groups = copy_groups(docs, text, key) if groups is None else groups
    rows, (text_x, key_x) = positional(docs, text, key)
    keyed, (length, head, full) = _with_keys(rows, text_x, full=True)
    g = groups.select(F.col("n_bytes").alias(length), F.col("head_hash").alias(head),
                      F.col("text_sha256").alias(full), F.col("keep_id").alias("_g_keep"),
                      F.col("group_size").alias("_g_size"), F.col("n_keep").alias("_g_n"))
    joined = keyed.join(g, [length, head, full], "left")
    single = F.col("_g_size").isNull()
    verdict = F.struct(
        F.col(full).alias("text_sha256"),
        F.when(single, F.col(key_x)).otherwise(F.col("_g_keep")).alias("keep_id"),
        F.coalesce("_g_size", F.lit(1)).cast("long").alias("group_size"),
        (single | F.col(key_x).eqNullSafe(F.col("_g_keep"))).alias("kept"),
        F.coalesce("_g_n", F.lit(1)).cast("long").alias("n_keep"))
    return joined.select(*[F.col(x).alias(c) for x, c in zip(rows.columns, docs.columns)],
                         verdict.alias(free_name(docs, "_verdict")))


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without copies; of equal texts the largest id stays.  Only rows
    whose (length, head hash) is that of some group have their whole text hashed."""
    groups = land(copy_groups(docs, text, key), "copy-groups")
    mark = free_name(docs, "_verdict")
    rows, (text_x,) = positional(docs, text)
    keyed, (length, head, _) = _with_keys(rows, text_x, full=False)
    heads = groups.select(F.col("n_bytes").alias(length), F.col("head_hash").alias(head)).distinct()
    flagged = keyed.join(heads.withColumn("_copied", F.lit(True)), [length, head], "left")
    alone, alike = (flagged.where(c).select(*rows.columns).toDF(*docs.columns) for c in ("_copied IS NULL", "_copied"))
    kept = mark_copies(alike, text, key, groups).where(F.col(mark)["kept"])
    repeated = groups.where("n_keep > 1")
    if repeated.isEmpty():
        return alone.unionByName(kept.select(*docs.columns))
    rows = kept.where(F.col(mark)["n_keep"] > 1)
    row = F.struct(*docs.columns)
    once = (rows.groupBy(F.col(mark)["text_sha256"].alias("_sha"))
            .agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("_row")).select("_row.*"))
    return alone.unionByName(kept.where(F.col(mark)["n_keep"] == 1).select(*docs.columns)).unionByName(once)


def op9_exact_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return mark_copies(docs).select(
        "doc_id", F.col("_verdict.keep_id").alias("keep_id"),
        F.col("_verdict.group_size").alias("group_size"), F.col("_verdict.kept").alias("kept"),
        F.col("_verdict.text_sha256").alias("text_sha256"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
