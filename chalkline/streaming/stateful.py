"""Uniqueness with keyed state of our own: every row comes out again, with a verdict.

Spark's ``dropDuplicatesWithinWatermark`` keeps the first copy it happens to see and loses
the others, and it drops rows behind the watermark.  Two operators do without the losses:

``suppress_redelivery`` remembers the last ``max_ids`` ids of each producer.  An id among
them is ``redelivered``; another is ``new``, is remembered, and pushes out the oldest.  State
is bounded by count, whatever the event times are; an idle producer's state is dropped by a
timer.  A producer's rows of one micro-batch are worked through in order of arrival, a share
at a time: sorted runs wait on the worker's disk, and the ids known are one packed array.

``first_arrivals`` holds one row per id until the watermark has passed its event time by the
horizon, then emits it as ``first``.  Until then the copy that arrived first replaces the one
held; every loser comes out at once as ``duplicate``.  Which copy survives depends on arrival
order alone, not on how rows were cut into batches.  Rows behind the watermark come out as
``late``.  first + duplicate + late + held = input; rows without an id or an event time are
never duplicates and pass beside the state as ``first``.

A row crosses the state as its id, its order and its JSON.  Rows are dealt out by producer,
or by a bucket of ids: a bucket's held rows are one value with one timer, read and written
once a micro-batch, so that no id costs a trip to the state of its own.  The number of
buckets belongs to the checkpoint.
"""

from __future__ import annotations

import heapq
import itertools
import pickle
import sys
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Ids remembered per producer.
MAX_IDS = 10_000
NEW, REDELIVERED = "new", "redelivered"
FIRST, DUPLICATE, LATE = "first", "duplicate", "late"
VERDICT = "verdict"
#: Rows put out at a time.
BATCH = 10_000
#: Rows of a producer that are sorted and judged at a time, and read back at a time from a run.
RUN, SLICE = 50_000, 100
#: Ids in one entry of the state.
PACK = 65_536
#: Buckets of ids.
BUCKETS = 4_096
# microseconds survive the trip through JSON
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def pin_state_store(spark: SparkSession) -> None:
    """Custom state needs the RocksDB store, which the query reads when it starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def arrival_order(*columns: str) -> Column:
    """Columns as one text that sorts alike; numbers must not be negative."""
    return F.concat_ws("\u0001", *[F.lpad(F.coalesce(F.col(c).cast("string"), F.lit("")), 40, "0")
                                   if c == "id" else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def _frames(rows: list[tuple]) -> Iterator[pd.DataFrame]:
    for i in range(0, len(rows), BATCH):
        yield pd.DataFrame(rows[i:i + BATCH], columns=["payload", VERDICT])


def _sorted(rows: Iterator[pd.DataFrame], *columns: str) -> list[tuple]:
    """The micro-batch's rows of one key, in order of arrival."""
    found = [t for frame in rows for t in zip(*[frame[c] for c in ("arrival", *columns)])]
    found.sort(key=lambda t: t[0])
    return found


def _runs(rows: Iterator[pd.DataFrame], *columns: str) -> Iterator[list[tuple]]:
    """The rows in sorted shares."""
    found: list[tuple] = []
    for frame in rows:
        found.extend(zip(*[frame[c] for c in ("arrival", *columns)]))
        if len(found) >= RUN:
            yield sorted(found, key=lambda t: t[0])
            found = []
    if found:
        yield sorted(found, key=lambda t: t[0])


def _spooled(run: list[tuple]) -> Iterator[tuple]:
    """A run of text rows, written to a temporary file at once and read back in slices."""
    file = tempfile.TemporaryFile()
    table = pa.table([pa.array(c, pa.string()) for c in zip(*run)], names=[str(i) for i in range(len(run[0]))])
    with pa.ipc.new_stream(file, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(table, max_chunksize=SLICE)
    file.seek(0)

    def back():
        with file:
            for part in pa.ipc.open_stream(file):
                yield from zip(*[c.to_pylist() for c in part.columns])
    return back()


def _in_order(rows: Iterator[pd.DataFrame], *columns: str) -> Iterator[tuple]:
    """The micro-batch's rows of one key, in order of arrival; more than a run of them are
    sorted run by run and merged."""
    runs = _runs(rows, *columns)
    head = list(itertools.islice(runs, 2))
    if len(head) < 2:
        return iter(head[0] if head else ())
    waiting = [_spooled(run) for run in head]
    head.clear()
    waiting += map(_spooled, runs)
    return heapq.merge(*waiting, key=lambda t: t[0])


class LastIds(StatefulProcessor):
    """The ids of a producer, oldest first."""

    def __init__(self, max_ids: int, idle_ms: int | None):
        self.max_ids, self.idle_ms = max_ids, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.ids = handle, handle.getListState("ids", "pack binary")

    def judged(self, known: pa.Array, ids: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Which of ``ids`` (no more than ``max_ids``, or one) are new, and the ids known after them."""
        n, k = len(known), len(ids)
        coded = ids.dictionary_encode()
        code, place = coded.indices.to_numpy(), np.full(len(coded.dictionary), -1)
        found = pc.index_in(known, value_set=coded.dictionary)
        at = pc.indices_nonzero(found.is_valid())
        place[found.take(at).to_numpy()] = at.to_numpy()
        # ids that are not known are new once; a copy finds them, as no share pushes out its own
        new = np.zeros(k, bool)
        new[np.unique(code, return_index=True)[1][place < 0]] = True
        # a known one is pushed out when as many are new as stand before it; only ids that this
        # share can reach are looked at one by one
        before, again = np.cumsum(new), set()
        for i in np.flatnonzero((place[code] >= 0) & (place[code] < n + k - self.max_ids)).tolist():
            if code[i] not in again and place[code[i]] < n + before[i] + len(again) - self.max_ids:
                again.add(code[i])
                new[i] = True
        known = pa.concat_arrays([known, ids.filter(pa.array(new))])
        return new, known.slice(max(0, len(known) - self.max_ids))

    def handleInputRows(self, key, rows, timerValues):
        text = pa.large_string()
        known = pa.concat_arrays([pa.array([], text), *[pa.array(pickle.loads(r[0]), text) for r in self.ids.get()]])
        ordered, changed = _in_order(rows, "row_id", "payload"), False
        while share := list(itertools.islice(ordered, max(1, min(RUN, self.max_ids)))):
            _, ids, payloads = zip(*share)
            new, known = self.judged(known, pa.array(ids, text))
            changed |= bool(new.any())
            yield from _frames([(p, NEW if n else REDELIVERED) for p, n in zip(payloads, new.tolist())])
        if changed:
            self.ids.put([(pickle.dumps(known.slice(i, PACK).to_pylist()),) for i in range(0, len(known), PACK)])
        if self.idle_ms is not None:
            for due in list(self.handle.listTimers()):
                self.handle.deleteTimer(due)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.ids.clear()
        yield from ()

    def close(self) -> None:
        pass


class FirstArrival(StatefulProcessor):
    """The rows of a bucket's ids that arrived first, until their horizon has passed."""

    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows binary")

    def _load(self) -> dict[str, tuple[str, str, int]]:
        """(arrival, payload, due) by id."""
        kept = self.held.get()
        return pickle.loads(kept[0]) if kept else {}

    def _keep(self, held: dict, before: int | None) -> None:
        """Store the rows; the one timer is due with the first of them."""
        due = min((d for _, _, d in held.values()), default=None)
        if held:
            self.held.update((pickle.dumps(held),))
        else:
            self.held.clear()
        if due != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if due is not None:
                self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues):
        watermark, held, out, changed = timerValues.getCurrentWatermarkInMs(), self._load(), [], False
        before = min((d for _, _, d in held.values()), default=None)
        for arrival, row_id, at, payload in _sorted(rows, "row_id", "at", "payload"):
            if at < watermark:
                out.append((payload, LATE))
                continue
            best, due = held.get(row_id), int(at) + self.horizon_ms
            if best is None:
                held[row_id] = (arrival, payload, due)
            else:
                due = min(best[2], due)
                lost, held[row_id] = (best[1], (arrival, payload, due)) if arrival < best[0] else (payload, (*best[:2], due))
                out.append((lost, DUPLICATE))
            changed = True
        if changed:
            self._keep(held, before)
        yield from _frames(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        fired, held, watermark = expiredTimerInfo.getExpiryTimeInMs(), self._load(), timerValues.getCurrentWatermarkInMs()
        past = {i: row for i, row in held.items() if row[2] == fired or row[2] < watermark}
        self._keep({i: row for i, row in held.items() if i not in past}, None)
        yield from _frames([(payload, FIRST) for _, payload, _ in past.values()])

    def close(self) -> None:
        pass


def _packed(stream: DataFrame, **columns: Column) -> DataFrame:
    return stream.select(*[c.alias(n) for n, c in columns.items()],
                         F.to_json(F.struct(*stream.columns), _JSON).alias("payload"))


def _unpacked(judged: DataFrame, schema: T.StructType) -> DataFrame:
    row = F.from_json("payload", schema, _JSON)
    return judged.select(row.alias("_r"), VERDICT).select(*[F.col(f"_r.{n}").alias(n) for n in schema.fieldNames()], VERDICT)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def suppress_redelivery(stream: DataFrame, key: str = "_event_id", producer: str = "_producer_instance",
                        arrival: Column | None = None, max_ids: int = MAX_IDS, idle_ms: int | None = None) -> DataFrame:
    """All rows of ``stream`` with ``verdict`` new or redelivered.  Rows without an id are new."""
    pin_state_store(stream.sparkSession)
    arrival = arrival_order("_ingested_at", "id") if arrival is None else arrival
    known = stream.where(F.col(key).isNotNull())
    packed = _packed(known, producer=F.coalesce(F.col(producer).cast("string"), F.lit("")), arrival=arrival,
                     row_id=F.col(key).cast("string"))
    judged = packed.groupBy("producer").transformWithStateInPandas(
        LastIds(max_ids, idle_ms), f"payload string, {VERDICT} string", "Append",
        "ProcessingTime" if idle_ms is not None else "None")
    beside = stream.where(F.col(key).isNull()).withColumn(VERDICT, F.lit(NEW))
    return _unpacked(judged, _nullable(stream.schema)).unionByName(beside)


def first_arrivals(stream: DataFrame, key: str = "_event_id", event_time: str = "meta_dt", delay: str = "2 hours",
                   horizon_ms: int = 2 * 3_600_000, arrival: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """All rows of ``stream`` with ``verdict`` first, duplicate or late; a row is held back
    until the watermark (greatest event time less ``delay``) has passed it by the horizon.
    The state's values are as large as the rows held in a bucket."""
    pin_state_store(stream.sparkSession)
    arrival = arrival_order("_ingested_at", "id") if arrival is None else arrival
    df = stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
    usable = F.col(key).isNotNull() & F.col(event_time).isNotNull()
    # the copy of the event time carries no watermark of its own, so that late rows get here
    row_id = F.col(key).cast("string")
    packed = _packed(df.where(usable), bucket=F.pmod(F.xxhash64(row_id), F.lit(buckets)).cast("int"), row_id=row_id,
                     arrival=arrival, at=F.unix_millis(F.col(event_time)))
    judged = packed.groupBy("bucket").transformWithStateInPandas(
        FirstArrival(horizon_ms), f"payload string, {VERDICT} string", "Append", "EventTime")
    beside = df.where(~usable).withColumn(VERDICT, F.lit(FIRST))
    return _unpacked(judged, _nullable(df.schema)).unionByName(beside)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
