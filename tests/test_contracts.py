import pytest
from pyspark.sql import functions as F

from chalkline.operators import contracts
from chalkline.schemas import BRONZE_SCHEMA
from tests.helpers import raw_df, raw_row


def test_bundled_contract_matches_schema():
    c = contracts.load("bronze_recentchange")
    assert [f.name for f in contracts.struct_type(c).fields] == BRONZE_SCHEMA.fieldNames()


def test_missing_contracted_field_fails_loud(spark):
    df = raw_df(spark, [raw_row()]).drop("wiki")
    with pytest.raises(contracts.ContractViolation, match="wiki"):
        contracts.assert_fields_present(df, contracts.load("bronze_recentchange"))


def test_new_field_tolerated(spark):
    df = raw_df(spark, [raw_row()]).withColumn("brand_new", F.lit(1))
    contracts.assert_fields_present(df, contracts.load("bronze_recentchange"))
    contracts.assert_types_conform(df, contracts.load("bronze_recentchange"))


def test_type_mismatch_detected(spark):
    df = raw_df(spark, [raw_row()]).withColumn("timestamp", F.col("timestamp").cast("string"))
    with pytest.raises(contracts.ContractViolation, match="timestamp"):
        contracts.assert_types_conform(df, contracts.load("bronze_recentchange"))


def test_null_audit_and_enum(spark):
    df = raw_df(spark, [raw_row(), raw_row(event_id=None, type_="weird")])
    from chalkline.plans import silver
    from chalkline.operators import dq
    staged = silver.stage(df, dq.DQConfig(as_of="2025-03-15T00:00:00Z"), load_stamp=False)
    audit = {r["column_name"]: r["null_count"]
             for r in contracts.null_audit(staged, contracts.load("silver_recentchange")).collect()}
    assert audit["_event_id"] == 1 and audit["title"] == 0
    enum = contracts.enum_violations(df, contracts.load("bronze_recentchange")).collect()
    assert [(r["column_name"], r["value"], r["row_count"]) for r in enum] == [("type", "weird", 1)]


def test_contract_without_enum_or_required_field(spark):
    c = {"fields": [{"name": "a", "type": "string", "nullable": True}]}
    df = spark.createDataFrame([("x",)], "a string")
    assert contracts.enum_violations(df, c).count() == 0 and contracts.null_audit(df, c).count() == 0
    assert contracts.enum_violations(df, contracts.load("dim_wiki_reference")).count() == 0


def test_conformance_lists_every_column():
    c = contracts.load("dim_wiki_reference")
    rows = contracts.conformance(contracts.struct_type(c), c)
    assert len(rows) == 5 and all(r[3] for r in rows)
    missing = contracts.conformance(contracts.struct_type({"fields": c["fields"][1:]}), c)
    assert missing[0] == ("wiki_code", "string", None, False)


def test_bronze_run_with_a_missing_field_raises(spark, scratch, monkeypatch):
    from chalkline.streaming import bronze
    raw_df(spark, [raw_row()]).write.parquet(path := scratch("raw"))
    monkeypatch.setattr(bronze, "bronze_rows", lambda df: df.drop("wiki"))
    with pytest.raises(contracts.ContractViolation, match="wiki"):
        bronze.run_bronze(spark, path, scratch("bronze"), scratch("ckpt"))


def test_drift_report(spark):
    df = raw_df(spark, [raw_row(extra='{"a": 1, "b": 2}'), raw_row(extra='{"a": 3}')])
    got = {r["field_name"]: r["row_count"] for r in contracts.drift_report(df).collect()}
    assert got == {"a": 2, "b": 1}
