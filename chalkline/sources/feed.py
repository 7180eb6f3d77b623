"""The event feed: JSON lines and message payloads -> typed event rows.

Every line is parsed once, JVM-side, into a VARIANT; typed fields, the event id and the
unknown fields are all taken from it.  Of a repeated key the last value counts.  Lines
that are blank, not JSON, or not a JSON object go to a quarantine output with their raw
text instead of being lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.schemas import (
    BRONZE_SCHEMA,
    EVENT_SCHEMA,
    KNOWN_TOP_LEVEL_FIELDS,
    SCHEMA_VERSION,
)
from chalkline.session import pin_last_key_counts

PARSED = "_parsed"
JSON_SPACE = " \t\r\n"


def _is_object(parsed: Column) -> Column:
    return F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))


def _float_text(x: Column) -> Column:
    """Shortest decimal text with a fraction, plain up to 10^16."""
    whole = (F.abs(x) >= 1e7) & (F.abs(x) < 1e16) & (x == F.floor(x))
    return F.when(whole, F.concat(x.cast("long").cast("string"), F.lit(".0"))).otherwise(x.cast("string"))


def _event_id(strict: bool) -> Column:
    """The id as text: numbers and strings as they stand, fractions with their point,
    ``True`` / ``False`` for booleans.  A missing id is "" and a JSON null "None"; the
    strict reading maps both to NULL.  Objects and arrays give their JSON text."""
    raw = F.try_variant_get(PARSED, "$.id", "variant")
    kind = F.schema_of_variant(raw)
    text = (F.when(kind == "BOOLEAN", F.initcap(F.try_variant_get(PARSED, "$.id", "string")))
            .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), _float_text(F.try_variant_get(PARSED, "$.id", "double")))
            .when(kind.rlike("^(OBJECT|ARRAY)"), F.to_json(raw))
            .otherwise(F.try_variant_get(PARSED, "$.id", "string")))
    absent, null = raw.isNull(), F.is_variant_null(raw)
    if strict:
        return F.when(~absent & ~null, text)
    return F.when(absent, F.lit("")).when(null, F.lit("None")).otherwise(text)


def parse_events(lines: DataFrame, value_col: str = "value", strict: bool = False,
                 ingested_at: Column | None = None, producer_instance: Column | None = None
                 ) -> DataFrame:
    """JSON lines -> bronze-shaped rows (known fields typed, the rest in
    ``_extra_fields`` as JSON, ``_event_id`` and ``_schema_version`` derived).

    Lines that are no object are dropped here; ``quarantine`` returns them.  Columns of
    ``lines`` other than ``value_col`` are carried along (e.g. a line number),
    and ``_ingested_at`` / ``_producer_instance`` are taken from same-named
    input columns when present, else from the given expressions."""
    pin_last_key_counts(lines.sparkSession)
    now_iso = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    arrival = {"_ingested_at": now_iso if ingested_at is None else ingested_at,
               "_producer_instance": F.lit(None).cast("string") if producer_instance is None else producer_instance}
    arrival = {n: F.col(n) if n in lines.columns else c for n, c in arrival.items()}
    carried = [c for c in lines.columns
               if c != value_col and c not in arrival and c not in BRONZE_SCHEMA.fieldNames()]
    # one cast types all known fields; a value that does not fit becomes NULL
    known = F.try_variant_get(PARSED, "$", EVENT_SCHEMA.simpleString())
    boolean_id = F.schema_of_variant(F.try_variant_get(PARSED, "$.id", "variant")) == "BOOLEAN"
    typed = {f.name: F.col(f"_known.{f.name}") for f in EVENT_SCHEMA.fields}
    typed["id"] = F.when(F.coalesce(boolean_id, F.lit(False)), None).otherwise(typed["id"])
    fields = F.try_variant_get(PARSED, "$", "map<string,variant>")
    unknown = F.to_json(F.map_filter(fields, lambda k, _: ~k.isin(*KNOWN_TOP_LEVEL_FIELDS)))
    event = F.struct(
        *[c.alias(n) for n, c in typed.items()],
        _event_id(strict).alias("_event_id"),
        *[c.alias(n) for n, c in arrival.items()],
        unknown.alias("_extra_fields"),
        F.lit(SCHEMA_VERSION).alias("_schema_version"))
    # a generator yields one row per object and none otherwise; unlike a filter it is not
    # moved below the projection, where the line would be parsed a second time
    parsed = lines.withColumn(PARSED, F.try_parse_json(value_col)).withColumn("_known", known)
    return parsed.select(*carried, F.inline(F.array_compact(F.array(F.when(_is_object(F.col(PARSED)), event)))))


def quarantine(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines that are not a JSON object, with ``reason`` blank / malformed /
    not_object and the raw text kept."""
    pin_last_key_counts(lines.sparkSession)
    text, parsed = F.col(value_col), F.col(PARSED)
    reason = (F.when(text.isNull() | (F.btrim(text, F.lit(JSON_SPACE)) == ""), F.lit("blank"))
               .when(parsed.isNull(), F.lit("malformed"))
               .when(~_is_object(parsed), F.lit("not_object")))
    row = F.struct(*lines.columns, reason.alias("reason"))
    judged = lines.withColumn(PARSED, F.try_parse_json(value_col))
    return judged.select(F.inline(F.array_compact(F.array(F.when(reason.isNotNull(), row)))))


def encode_messages(df: DataFrame, key_col: str | None = "_event_id") -> DataFrame:
    """Rows -> message ``(key, value)`` with a JSON payload as bytes."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns])).cast("binary")
    key = F.col(key_col).cast("binary") if key_col else F.lit(None).cast("binary")
    return df.select(key.alias("key"), value.alias("value"))


def _decoded(messages: DataFrame, schema: T.StructType, value_col: str) -> DataFrame:
    checked = T.StructType([*schema.fields, T.StructField("_undecodable", T.StringType())])
    text = F.col(value_col).cast("string")
    return messages.withColumn("_m", F.from_json(text, checked, {"columnNameOfCorruptRecord": "_undecodable"}))


def _failed(value_col: str) -> Column:
    blank = F.btrim(F.col(value_col).cast("string"), F.lit(JSON_SPACE)) == ""
    return F.col("_m").isNull() | F.col("_m._undecodable").isNotNull() | blank


def decode_messages(messages: DataFrame, schema: T.StructType = BRONZE_SCHEMA, value_col: str = "value"
                    ) -> DataFrame:
    """Message bytes -> typed rows (explicit schema).  Payloads that cannot be decoded
    are left out; ``undecodable_messages`` returns them."""
    good = _decoded(messages, schema, value_col).where(~_failed(value_col))
    return good.select(*[F.col(f"_m.{f.name}").alias(f.name) for f in schema.fields])


def undecodable_messages(messages: DataFrame, schema: T.StructType = BRONZE_SCHEMA, value_col: str = "value"
                         ) -> DataFrame:
    """Messages whose payload is no JSON object of the schema, as they came."""
    return _decoded(messages, schema, value_col).where(_failed(value_col)).select(*messages.columns)


def replay_stream(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A recorded NDJSON feed folder as a finite text stream (column ``value``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
