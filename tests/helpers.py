"""Builders for small bronze-shaped rows."""

from __future__ import annotations

import datetime as dt

from chalkline.schemas import RAW_SCHEMA

#: The instant most rows happen at; tests shift it.
BASE_DT = dt.datetime(2025, 3, 14, 21, 5, 0, tzinfo=dt.timezone.utc)
ARRIVAL_LAG = dt.timedelta(seconds=42)

DEFAULTS = {
    "id": 1, "type": "edit", "title": "Canal lock", "user": "ferry", "bot": False, "wiki": "kawiki",
    "server_url": "https://ka.example.net", "_event_id": "1", "_producer_instance": "unit", "_extra_fields": "{}",
    "_schema_version": "1.0.0",
}


def iso(t: dt.datetime) -> str:
    return t.strftime("%Y-%m-%dT%H:%M:%SZ")


def raw_row(event_id="1", id_=1, type_="edit", title=DEFAULTS["title"], user=DEFAULTS["user"], bot=False,
            wiki=DEFAULTS["wiki"], meta_dt=BASE_DT, timestamp=None, length_old=75, length_new=119,
            ingested_at=None, dt_part=None, hour=None, extra="{}"):
    """One raw row in the order of ``RAW_SCHEMA``, by default a clean edit.  ``meta_dt`` is an
    instant, or text as it came; what depends on it follows it unless given."""
    at = meta_dt if isinstance(meta_dt, dt.datetime) else None
    values = {
        **DEFAULTS, "id": id_, "type": type_, "title": title, "user": user, "bot": bot, "wiki": wiki, "_event_id": event_id,
        "_extra_fields": extra, "length": (length_old, length_new),
        "meta": tuple((iso(at) if at else meta_dt) if f.name == "dt" else None for f in RAW_SCHEMA["meta"].dataType.fields),
        "timestamp": int(at.timestamp()) if timestamp is None and at else timestamp,
        "_ingested_at": (at + ARRIVAL_LAG).isoformat() if ingested_at is None and at else ingested_at,
        "dt": dt_part or (at or BASE_DT).strftime("%Y-%m-%d"),
        "hour": (at or BASE_DT).hour if hour is None else hour,
    }
    return tuple(values[f.name] for f in RAW_SCHEMA.fields)


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)
