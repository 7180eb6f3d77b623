"""The feed adapter reproduces the counts recorded in SURVEY §7.3 (sf0.001)."""

from pyspark.sql import functions as F

from chalkline.operators import dq
from chalkline.plans import catalog


def test_adapter_counts_match_survey(spark):
    st = catalog.staged(spark, "/root/testdata/sf0.001")
    r = st.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.when(F.array_contains(dq.REASONS_COLUMN, d), 1)).alias(d) for d in dq.DIMENSIONS],
        F.count(F.when(dq.passed(), 1)).alias("clean"),
        F.count(F.when(~dq.passed(), 1)).alias("rejected"),
        F.count_distinct("_event_id").alias("distinct_ids"),
        F.count(F.when(F.col("_is_late_arrival"), 1)).alias("late"),
    ).first().asDict()
    assert r == {"rows": 1000, "completeness": 15, "validity": 20, "accuracy": 9,
                 "consistency": 16, "clean": 948, "rejected": 52, "distinct_ids": 984,
                 "late": 299}
