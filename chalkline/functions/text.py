"""Text helpers.

NFC normalization has no built-in Spark expression; it runs as an Arrow UDF that skips
batches and values already in normal form.  ``register`` makes it callable from SQL.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference's rule): C0 control characters except
# tab (0x09), line feed (0x0A) and carriage return (0x0D).
CONTROL_CHAR_PATTERN = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def has_control_chars(c: Column) -> Column:
    """TRUE / FALSE / NULL (for NULL input).

    The pattern is handed to ``rlike`` as a Python string, never spliced into
    SQL text, where the SQL literal parser would eat the backslashes.
    """
    return c.rlike(CONTROL_CHAR_PATTERN)


def _make_nfc():
    """The kernel is defined locally, so it is shipped to the executors by value:
    workers need pyarrow, not this package.  ASCII text is in normal form already and is
    passed on untouched.  (pyarrow's own utf8_normalize is not used: in this version it
    decomposes under every form.)"""
    def normalize(values: pa.Array) -> pa.Array:
        from unicodedata import is_normalized, normalize as to_form
        if pc.all(pc.or_kleene(pc.string_is_ascii(values), pc.is_null(values)), skip_nulls=False).as_py():
            return values
        out = [v if v is None or v.isascii() or is_normalized("NFC", v) else to_form("NFC", v)
               for v in values.to_pylist()]
        return pa.array(out, pa.string())
    return F.arrow_udf(normalize, T.StringType())


nfc = _make_nfc()


def register(spark: SparkSession, name: str = "nfc") -> None:
    """Make NFC available to SQL text under ``name``."""
    spark.udf.register(name, nfc)
