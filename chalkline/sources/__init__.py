"""Sources: the event feed (JSON lines, message payloads, typed raw rows),
reference snapshots and format-dispatched file readers."""
