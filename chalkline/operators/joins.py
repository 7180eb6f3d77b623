"""Join helpers.  No broadcast is forced: adaptive execution measures the sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_left(rows: DataFrame, reference: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Left join: rows without a reference match keep NULL attributes (never lost)."""
    return rows.join(reference, on=on, how="left")


def key_report(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """(null_rows, unresolved_rows) of a foreign key.  Facts are counted per key first,
    so a busy member is one row when the dimension is joined."""
    per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = dim.select(key).distinct().withColumn("_known", F.lit(True))
    joined = per_key.join(known, key, "left")
    return joined.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("null_rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull() & F.col("_known").isNull(), F.col("_n"))), F.lit(0))
        .alias("unresolved_rows"))


def unresolved(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (NULL keys included)."""
    d = dim.select(F.col(dim_key).alias(fact_key)).distinct()
    return facts.join(d, on=fact_key, how="left_anti")
