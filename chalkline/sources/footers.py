"""What landed files really hold: schemas read from Parquet footers, file by file.

Spark lists the files; tasks open their footers, one small read each, and nothing of the
rows.  A file whose columns differ from its contract is named by its path, before a reader
with the contract's schema stumbles over it.
"""

from __future__ import annotations

import json
import sys

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.operators import contracts

_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
_FILES = "path string, n_rows long, columns map<string,string>"


def _columns(footer) -> dict[str, str]:
    """Column -> Spark type: as the writing Spark noted it, else from the file's own types."""
    noted = (footer.metadata or {}).get(_SPARK_SCHEMA)
    if noted:
        fields = T.StructType.fromJson(json.loads(noted)).fields
        return {f.name: f.dataType.simpleString() for f in fields}
    from pyspark.sql.pandas.types import from_arrow_schema
    found = {f.name: f.dataType.simpleString() for f in from_arrow_schema(footer.schema.to_arrow_schema(), prefer_timestamp_ntz=True).fields}
    old = {footer.schema.column(i).path for i in range(len(footer.schema)) if footer.schema.column(i).physical_type == "INT96"}
    return {name: "timestamp" if name in old else kind for name, kind in found.items()}


def _open(path: str):
    uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
    fs, at = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(at)


def _read_footers(batches):
    for b in batches:
        rows = []
        for path in b.column(0).to_pylist():
            with _open(path) as f:
                footer = pq.read_metadata(f)
                rows.append({"path": path, "n_rows": footer.num_rows, "columns": list(_columns(footer).items())})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("path", pa.string()), ("n_rows", pa.int64()), ("columns", pa.map_(pa.string(), pa.string()))]))


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """(path, n_rows, columns: map of column to type) of every Parquet file under ``path``."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load(path).select("path"))
    return listed.mapInArrow(_read_footers, _FILES)


def file_violations(spark: SparkSession, path: str, contract: dict) -> DataFrame:
    """(path, n_rows, column_name, declared, actual) of contracted columns that a file holds
    under another type, or not at all (``actual`` NULL).  Partition columns, which the path
    holds, and columns beyond the contract are no violation."""
    kept = set(contract.get("partition_columns", []))
    wanted = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("declared"))
              for f in contracts.struct_type(contract).fields if f.name not in kept]
    per = file_schemas(spark, path).select("path", "n_rows", "columns", F.explode(F.array(*wanted)).alias("w"))
    actual = F.try_element_at("columns", F.col("w.column_name"))
    return (per.select("path", "n_rows", "w.column_name", "w.declared", actual.alias("actual"))
            .where(~F.col("actual").eqNullSafe(F.col("declared"))))


def assert_files_conform(spark: SparkSession, path: str, contract: dict, shown: int = 20) -> None:
    """Raise, naming up to ``shown`` files, unless all files hold the contracted columns."""
    bad = file_violations(spark, path, contract).orderBy("path", "column_name").limit(shown).collect()
    if bad:
        raise contracts.ContractViolation(f"files that break the contract (path, rows, column, contracted, actual): "
                                          f"{[tuple(r) for r in bad]}")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
