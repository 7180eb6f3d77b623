"""SQL over streams: a streaming DataFrame registered as a temporary view can
be queried with ``spark.sql``; the result is itself a stream (the SQL form of
``FROM STREAM t``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_stream(stream: DataFrame, name: str) -> None:
    if not stream.isStreaming:
        raise ValueError(f"{name}: expected a streaming DataFrame")
    stream.createOrReplaceTempView(name)


def stream_sql(spark: SparkSession, sql: str) -> DataFrame:
    out = spark.sql(sql)
    if not out.isStreaming:
        raise ValueError("query does not read a registered stream")
    return out
