"""Column-level helpers: text, time and key functions (all JVM-side except NFC)."""

from chalkline.functions.keys import surrogate_key
from chalkline.functions.text import CONTROL_CHAR_PATTERN, has_control_chars, nfc
from chalkline.functions.time import (
    date_key,
    epoch_seconds,
    iso_to_timestamp,
    utc_date_of_epoch,
)

__all__ = [
    "CONTROL_CHAR_PATTERN", "has_control_chars", "nfc", "surrogate_key",
    "date_key", "epoch_seconds", "iso_to_timestamp", "utc_date_of_epoch",
]
