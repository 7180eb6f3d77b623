"""Versioned data contracts (YAML) and the checks built from them.

* ``load`` / ``struct_type``: contract -> Spark ``StructType`` (CT-1).
* ``assert_fields_present``: fail before running when a contracted top-level
  field is missing (CT-2); new, uncontracted fields are tolerated.
* ``assert_types_conform``: reader schema vs contract types (CT-3).
* ``enum_violations`` / ``null_audit``: declared enums and non-null fields,
  audited without rejecting (CT-4, CT-5).
* ``drift_report``: unknown payload fields kept in ``_extra_fields`` (CT-6).
* ``schema_version_counts``: rows per stamped schema version (CT-7).
"""

from __future__ import annotations

from importlib import resources
from pathlib import Path

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SCALARS = {
    "string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(),
    "double": T.DoubleType(),
}


class ContractViolation(RuntimeError):
    """A dataset does not satisfy its contract's structure."""


def load(name_or_path: str | Path) -> dict:
    """A contract by bundled name (``bronze_recentchange``) or by file path."""
    p = Path(name_or_path)
    if p.suffix in (".yaml", ".yml") and p.exists():
        text = p.read_text()
    else:
        text = (resources.files("chalkline.contracts") / f"{name_or_path}.yaml").read_text()
    return yaml.safe_load(text)


def _dtype(field: dict) -> T.DataType:
    if field["type"] == "struct":
        return T.StructType([_field(f) for f in field["fields"]])
    if field["type"].startswith("array<"):
        return T.ArrayType(_SCALARS[field["type"][6:-1]])
    return _SCALARS[field["type"]]


def _field(field: dict) -> T.StructField:
    return T.StructField(field["name"], _dtype(field), bool(field.get("nullable", True)))


def struct_type(contract: dict) -> T.StructType:
    return T.StructType([_field(f) for f in contract["fields"]])


def assert_fields_present(df_or_schema, contract: dict) -> None:
    """Raise unless every contracted top-level field is there; more fields are fine."""
    have = set(df_or_schema.columns if isinstance(df_or_schema, DataFrame) else df_or_schema.fieldNames())
    missing = [f["name"] for f in contract["fields"] if f["name"] not in have]
    if missing:
        raise ContractViolation(
            f"{contract.get('table', 'dataset')} contract {contract.get('contract_version')} "
            f"declares field(s) missing from the data: {sorted(missing)}")


def _strip_nullability(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _strip_nullability(f.dataType)) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_strip_nullability(dt.elementType))
    return dt


def conformance(schema: T.StructType, contract: dict) -> list[tuple[str, str, str | None, bool]]:
    """(column, declared, actual, ok) per contracted column; nullability is audited
    apart (``null_audit``), a missing column has no actual type."""
    actual = {f.name: f.dataType for f in schema.fields}
    out = []
    for f in struct_type(contract).fields:
        found = actual.get(f.name)
        out.append((f.name, f.dataType.simpleString(), found.simpleString() if found else None,
                    found is not None and _strip_nullability(found) == _strip_nullability(f.dataType)))
    return out


def assert_types_conform(df_or_schema, contract: dict) -> None:
    """Every contracted column present with the contracted type."""
    assert_fields_present(df_or_schema, contract)
    schema = df_or_schema.schema if isinstance(df_or_schema, DataFrame) else df_or_schema
    bad = [row[:3] for row in conformance(schema, contract) if not row[3]]
    if bad:
        raise ContractViolation(f"type mismatch (column, contracted, actual): {bad}")


def table_contract(contract: dict, table: str) -> dict:
    """The part of a contract with several tables that concerns one of them."""
    return {"contract_version": contract["contract_version"], "table": table, **contract["tables"][table]}


def enum_fields(contract: dict) -> dict[str, list]:
    return {f["name"]: list(f["enum"]) for f in contract["fields"] if "enum" in f}


def null_audit(df: DataFrame, contract: dict) -> DataFrame:
    """(column_name, null_count) for every field declared ``nullable: false``.

    One aggregation pass, whatever the number of audited columns."""
    names = [f["name"] for f in contract["fields"]
             if not f.get("nullable", True) and f["name"] in df.columns]
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, null_count long")
    counts = df.agg(*[F.count(F.when(F.col(n).isNull(), 1)).alias(n) for n in names])
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return counts.selectExpr(f"stack({len(names)}, {stack}) AS (column_name, null_count)")


def enum_violations(df: DataFrame, contract: dict) -> DataFrame:
    """(column_name, value, row_count) for non-NULL values outside a declared enum, in
    one pass; empty for a contract without enums."""
    bad = [F.when(~F.col(name).isin(*allowed),
                  F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value")))
           for name, allowed in enum_fields(contract).items() if name in df.columns]
    if not bad:
        return df.sparkSession.createDataFrame([], "column_name string, value string, row_count long")
    return (df.select(F.explode(F.array_compact(F.array(*bad))).alias("v"))
            .groupBy("v.column_name", "v.value").agg(F.count(F.lit(1)).alias("row_count")))


def drift_report(df: DataFrame, extra_col: str = "_extra_fields") -> DataFrame:
    """(field_name, row_count): unknown payload fields and how many rows carry them."""
    keys = F.map_keys(F.from_json(F.col(extra_col), T.MapType(T.StringType(), T.StringType())))
    return (df.select(F.explode(keys).alias("field_name"))
              .groupBy("field_name").agg(F.count(F.lit(1)).alias("row_count")))


def schema_version_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("_schema_version").agg(F.count(F.lit(1)).alias("row_count"))
