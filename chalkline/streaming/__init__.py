"""Structured Streaming edges: raw landing, bronze mirror, silver fan-out and
watermark dedup.  Every run is incremental (checkpointed) and can be stopped
and restarted; ``availableNow`` runs drain what is there and stop."""
