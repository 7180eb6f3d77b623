"""chalkline: a PySpark-native medallion / change-data / data-quality library.

Raw change events are parsed (unknown fields kept), landed in event-time
partitions, mirrored into typed bronze tables incrementally, checked against
versioned contracts, tagged on the data-quality dimensions, split into clean,
rejected and duplicate outputs that always reconcile, turned into change feeds
and slowly changing dimensions, and assembled into a star schema with reports.

Every operator is a plain ``DataFrame -> DataFrame`` function; Structured
Streaming only appears at the edges (``chalkline.streaming``).
"""

__version__ = "0.1.0"
