"""Time helpers.  Epoch arithmetic is done without the session time zone
where possible, so results do not depend on cluster defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_to_timestamp(c: Column) -> Column:
    """ISO-8601 text to TIMESTAMP; malformed text becomes NULL instead of
    failing the batch (ANSI mode would raise on ``cast``)."""
    return F.try_to_timestamp(c)


def epoch_seconds(c: Column) -> Column:
    """Seconds since the epoch of a TIMESTAMP (UTC instant)."""
    return F.unix_seconds(c)


def utc_date_of_epoch(epoch: Column) -> Column:
    """UTC calendar date of an epoch-seconds value, as DATE.

    Pure integer arithmetic, independent of the session time zone."""
    return F.date_from_unix_date(F.floor(epoch / F.lit(86400)).cast("int"))


def date_key(d: Column) -> Column:
    """yyyymmdd integer key of a DATE."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
