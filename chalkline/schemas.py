"""Explicit schemas per layer, built from the contracts (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

from chalkline.operators import contracts

# Fixed value: version of the known-field list stamped on every parsed row.
SCHEMA_VERSION = "1.0.0"

BRONZE_SCHEMA = contracts.struct_type(contracts.load("bronze_recentchange"))

# Fields that an event itself carries; the others (with an underscore) are added on
# arrival, and unknown fields of an event go to _extra_fields.
KNOWN_TOP_LEVEL_FIELDS = tuple(n for n in BRONZE_SCHEMA.fieldNames() if not n.startswith("_"))
EVENT_SCHEMA = T.StructType([f for f in BRONZE_SCHEMA.fields if f.name in KNOWN_TOP_LEVEL_FIELDS])

# Raw files carry the event-time partition columns in their paths.
PARTITION_FIELDS = T.StructType([
    T.StructField("dt", T.StringType()),
    T.StructField("hour", T.IntegerType()),
])
RAW_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + PARTITION_FIELDS.fields)

DIM_WIKI_REFERENCE_SCHEMA = contracts.struct_type(contracts.load("dim_wiki_reference"))

# Silver column order as contracted (dt, hour are partition columns).
SILVER_COLUMNS = tuple(f["name"] for f in contracts.load("silver_recentchange")["fields"])
