"""Site-matrix documents -> wiki reference rows, and the reference dimension.

A site-matrix document maps language keys to ``{"localname", "site": [...]}``
plus two non-language keys.  Parsing explodes the map and the site arrays with
built-in generators; the latest snapshot per wiki is chosen by an aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference): keys that are not languages, and
# project-code renames (other codes are already project types).
NON_LANGUAGE_KEYS = ("count", "specials")
PROJECT_CODE_TO_TYPE = {"wiki": "wikipedia"}

# A site stays a map, so that a key can be told from its value.
_LANGUAGE = T.StructType([
    T.StructField("localname", T.StringType()),
    T.StructField("site", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])


def parse_documents(docs: DataFrame, doc_col: str = "doc", fetched_col: str = "fetched_at"
                    ) -> DataFrame:
    """(doc, fetched_at) -> (wiki_code, language_name, project_type, is_closed,
    _snapshot_fetched_at): one row per site, non-language keys skipped."""
    entries = docs.select(
        F.col(fetched_col).alias("_fetched"),
        F.explode(F.from_json(F.col(doc_col), T.MapType(T.StringType(), T.StringType())))
         .alias("key", "entry"))
    langs = (entries.where(~F.col("key").isin(*NON_LANGUAGE_KEYS))
                    .select("_fetched", F.from_json("entry", _LANGUAGE).alias("lang")))
    sites = langs.select("_fetched", F.col("lang.localname").alias("language_name"),
                         F.explode_outer("lang.site").alias("site")).where(F.col("site").isNotNull())
    code = F.col("site")["code"]
    project = code
    for src, dst in PROJECT_CODE_TO_TYPE.items():
        project = F.when(code == src, F.lit(dst)).otherwise(project)
    return sites.select(
        F.col("site")["dbname"].alias("wiki_code"),
        F.col("language_name"),
        project.alias("project_type"),
        F.map_contains_key("site", F.lit("closed")).alias("is_closed"),
        F.try_to_timestamp(F.col("_fetched")).alias("_snapshot_fetched_at"))


def latest_snapshot(reference: DataFrame) -> DataFrame:
    """One row per ``wiki_code``: the most recently fetched snapshot.

    Without this, two full fetches give two rows per code and every join on
    the code fans out."""
    cols = [c for c in reference.columns if c not in ("wiki_code", "_snapshot_fetched_at")]
    latest = F.max(F.struct("_snapshot_fetched_at", *cols)).alias("_l")
    return (reference.where(F.col("wiki_code").isNotNull())
                     .groupBy("wiki_code").agg(latest)
                     .select("wiki_code", *[F.col(f"_l.{c}").alias(c) for c in cols],
                             F.col("_l._snapshot_fetched_at").alias("_snapshot_fetched_at")))
