"""Inspection and dashboard reports.

Every report aggregates first (partial aggregation before the shuffle) and
joins dimension attributes onto the small aggregated result afterwards.
Top-n reports sort by (measure desc, key asc) so ties are deterministic and
run as TakeOrdered (per-partition top-n, then a merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chalkline.operators.dq import REASONS_COLUMN


def rejection_breakdown(rejected: DataFrame, reasons: str = REASONS_COLUMN) -> DataFrame:
    """(reason, row_count) ordered by count desc: one row per failed dimension."""
    return (rejected.select(F.explode(F.col(reasons)).alias("reason"))
                    .groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))
                    .orderBy(F.col("row_count").desc(), F.col("reason")))


def rejected_sample(rejected: DataFrame, n: int = 5, reasons: str = REASONS_COLUMN) -> DataFrame:
    """A small sample of rejected rows (lowest ids first, so it is repeatable)."""
    return rejected.select("id", "_event_id", "type", F.col(reasons)).orderBy("id").limit(n)


def reconcile(inputs: DataFrame, outputs: dict[str, DataFrame]) -> DataFrame:
    """One row: input count, every output count and ``balanced`` = in == sum(out).

    All counts come from one aggregation over the tagged union of the inputs."""
    tagged = inputs.select(F.lit("input").alias("_src"))
    for name, df in outputs.items():
        tagged = tagged.unionByName(df.select(F.lit(name).alias("_src")))
    names = ["input"] + list(outputs)
    row = tagged.agg(*[F.count(F.when(F.col("_src") == n, 1)).alias(f"{n}_rows") for n in names])
    total = sum((F.col(f"{n}_rows") for n in outputs), F.lit(0))
    return row.withColumn("balanced", F.col("input_rows") == total)


def balance(counts: DataFrame, inputs: DataFrame, outputs: tuple[str, ...]) -> DataFrame:
    """``reconcile`` from (verdict, row_count) rows and the input itself."""
    rows = counts.unionByName(inputs.agg(F.count(F.lit(1)).alias("row_count"))
                              .select(F.lit("input").alias("verdict"), "row_count"))
    row = rows.agg(*[F.coalesce(F.sum(F.when(F.col("verdict") == n, F.col("row_count"))), F.lit(0)).alias(f"{n}_rows")
                     for n in ("input", *outputs)])
    return row.withColumn("balanced", F.col("input_rows") == sum((F.col(f"{n}_rows") for n in outputs), F.lit(0)))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each named DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Dashboard panels over the star schema ---------------------------------------

def volume_by_wiki(fact: DataFrame, dim_wiki: DataFrame) -> DataFrame:
    per_key = fact.groupBy("wiki_key").agg(F.count(F.lit(1)).alias("edit_count"))
    return (per_key.join(dim_wiki.select("wiki_key", "wiki_code", "language_name"), "wiki_key")
                   .select("wiki_code", "language_name", "edit_count"))


def bot_share(fact: DataFrame, dim_change_type: DataFrame, digits: int = 6) -> DataFrame:
    per_type = fact.groupBy("change_type_key").agg(F.count(F.lit(1)).alias("n"))
    per_bot = (per_type.join(dim_change_type.select("change_type_key", "is_bot"), "change_type_key")
                       .groupBy("is_bot").agg(F.sum("n").alias("edit_count")))
    total = F.sum("edit_count").over(Window.partitionBy())   # over two aggregated rows
    return per_bot.select("is_bot", "edit_count",
                          F.round(F.col("edit_count") / total, digits).alias("share"))


def hour_distribution(fact: DataFrame) -> DataFrame:
    return fact.groupBy("hour_of_day").agg(F.count(F.lit(1)).alias("edit_count"))


def top_pages(fact: DataFrame, dim_page: DataFrame, n: int = 10) -> DataFrame:
    per_page = (fact.groupBy("page_key").agg(F.sum("length_delta").alias("total_length_delta"))
                    .orderBy(F.col("total_length_delta").desc(), F.col("page_key")).limit(n))
    return (per_page.join(dim_page.select("page_key", "title", "wiki_code"), "page_key")
                    .select("page_key", "title", "wiki_code", "total_length_delta"))


def top_editors(fact: DataFrame, dim_editor: DataFrame, since_date_key: int, n: int = 10
                ) -> DataFrame:
    per_editor = (fact.where(F.col("date_key") >= since_date_key)
                      .groupBy("editor_key").agg(F.count(F.lit(1)).alias("edit_count"))
                      .orderBy(F.col("edit_count").desc(), F.col("editor_key")).limit(n))
    return (per_editor.join(dim_editor.select("editor_key", "user_name"), "editor_key")
                      .select("editor_key", "user_name", "edit_count"))
