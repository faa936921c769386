"""Sliding windows that are closed: by the watermark of the event time, or by the clock.

``start_windows`` keeps the count and sum of each open window as state (``transformWithState``, RocksDB).  The windows that start in one
``SPAN`` of time share a state, which holds the open ones alone, and a timer at the first of their ends: a batch talks to the state store once for
each span it touches, however many windows its rows are in.

* ``clock="event_time"``: the timer is the watermark, the greatest event time of earlier micro-batches less ``delay``.  A
  row whose window had ended by then is late *for that window*: it goes to ``late_path`` with its ``ingest_key`` instead of being lost.
  An event may be late for the first of its windows and in time for the last.
* ``clock="processing_time"``: the timer is the clock.  A window is written after its end by the next trigger, whether or
  not an event arrives.  Rows of a backlog, whose windows ended long ago, are written with the batch that reads them; no row is late.

Rows cross to Python and back packed: a task puts the memberships it has for a key side by side in one value of bytes, and state and output are such
values too, so the cost for each row is numpy's and not that of a Row.

Each row counts in ``length / slide`` windows, as in the batch computation, and each of these memberships ends up in exactly one place: a closed
window, the late table, or (until its end is reached) the state, which ``open_windows`` reads from the checkpoint.  So
closed + late + open is what ``operators.windows`` computes from all rows at once: ``all_windows``.

A span is split over ``SHARDS`` keys by the arrival key, so a window with a third of all rows isn't one task's work; a state holds two
numbers for each open window however many rows it has seen, and no more windows than start in the span.  All shards of a window close in the same micro-batch and are merged before it is written, so in event time
a window is one row of the closed table.  In processing time a window whose rows arrive after its end (a backlog read in several
batches) has one row for each such batch; readers merge them.

Defined results: a row without a time is in no window; an absent total counts as an event and adds 0; an empty topic leaves both tables
empty; a restarted job continues with its state; a replayed micro-batch writes nothing again.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from salespark.functions import time as TS
from salespark.operators import windows as W
from salespark.schemas import AGG_SALES_WINDOWED
from salespark.streaming import sinks as S

#: keys a span is split over, and its length; fixed for the life of a checkpoint
SHARDS = 16
SPAN = 16 * 86_400_000_000  # microseconds: a key costs some milliseconds in a batch, its windows little (40 bytes each, the open ones alone)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OPEN = "windows binary"
OUT = "late boolean, packed binary"
UNPACKED = "start_us long, end_us long, late boolean, a long, high long, low long"
LATE_COLUMNS = "window_start timestamp_ntz, window_end timestamp_ntz, ingest_key long, total_value decimal(22,2)"
#: columns of packed rows: start, end, ingest key (of a member or a late row) or count (of a window), high and low part of the money
WIDTH = 5
LOW = 10_000_000  # money is high * LOW + low / 100: sums of both are exact in 64 bits as far as the sum is a decimal(22,2)
HELD_ROWS = 1_000_000  # memberships a task holds before it passes them on, packed
PACK_ROWS = 4_096  # rows of one packed value at most
NO_KEY = -(1 << 63)  # in the place of an absent ingest key; arrival keys are never negative


def _ends_ms(end_us):
    """Timers count milliseconds; a window that ends within one is closed after it."""
    return -(-end_us // 1000)


def _rows(packed: bytes | None) -> np.ndarray:
    return np.frombuffer(packed or b"", np.int64).reshape(-1, WIDTH)


def _totals(rows: np.ndarray) -> np.ndarray:
    """One row for each window, with the sums of the others' counts and money."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]))
    values = rows[:, 2:]
    if int(np.abs(values).max()) * len(rows) >= 1 << 62:
        values = values.astype(object)  # a sum that fits no 64 bits is an error below, not a wrong number
    return np.concatenate([rows[first, :2], np.add.reduceat(values, first, axis=0).astype(np.int64)], axis=1)


def _packed(rows: np.ndarray) -> Iterator[bytes]:
    for at in range(0, len(rows), PACK_ROWS):
        yield rows[at:at + PACK_ROWS].tobytes()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(span, shard, ``WIDTH`` columns) -> (span, shard, packed)."""
    def flush() -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        ends = np.append(np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1, len(rows)).tolist()
        keys, values, at = [], [], 0
        for end in ends:
            for value in _packed(rows[at:end, 2:]):
                keys.append(at)
                values.append(value)
            at = end
        yield pa.RecordBatch.from_arrays([pa.array(rows[keys, 0]), pa.array(rows[keys, 1].astype(np.int32)), pa.array(values, pa.binary())],
                                         ["span", "shard", "packed"])

    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns], axis=1))
            n += b.num_rows
        if n >= HELD_ROWS:
            yield from flush()
            held, n = [], 0
    if n:
        yield from flush()


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(late, packed) -> ``UNPACKED``"""
    def flush() -> pa.RecordBatch:
        columns = [pa.array(c) for c in np.concatenate(held).T.copy()]
        flags = pa.array(np.repeat(np.array(late, bool), [len(x) for x in held]))
        return pa.RecordBatch.from_arrays([*columns[:2], flags, *columns[2:]], ["start_us", "end_us", "late", "a", "high", "low"])

    held, late, n = [], [], 0
    for b in batches:
        for flag, packed in zip(b.column("late").to_pylist(), b.column("packed")):
            held.append(_rows(packed.as_py()))
            late.append(flag)
            n += len(held[-1])
            if n >= 16 * PACK_ROWS:
                yield flush()
                held, late, n = [], [], 0
    if held:
        yield flush()


def _unpacked(packed: DataFrame) -> DataFrame:
    """(start_us, end_us, late, a, money) of (late, packed) rows; a: ingest key of a late row, else the window's count."""
    money = F.col("high").cast("decimal(19,0)") * F.lit(Decimal(LOW)) + F.col("low").cast("decimal(19,0)") * F.lit(Decimal("0.01"))
    return packed.mapInArrow(_unpack, UNPACKED).select("start_us", "end_us", "late", F.nullif("a", F.lit(NO_KEY)).alias("a"), money.cast("decimal(22,2)").alias("money"))


class OpenWindows(StatefulProcessor):
    """Count and sum of the open windows of one (span, shard), with a timer at the first of their ends."""

    def __init__(self, event_time: bool):
        self.event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        held, late, n, n_late = [], [], 0, 0
        for row in rows:
            members = _rows(row.packed)
            if self.event_time and (over := _ends_ms(members[:, 1]) <= now).any():
                late.append(members[over])
                n_late += len(late[-1])
                members = members[~over]
                if n_late >= PACK_ROWS:
                    yield from self._out(True, np.concatenate(late))
                    late, n_late = [], 0
            if len(members):
                members = members.copy()
                members[:, 2] = 1
                held.append(members)
                n += len(members)
                if n >= HELD_ROWS:
                    held = [_totals(np.concatenate(held))]
                    n = len(held[0])
        if late:
            yield from self._out(True, np.concatenate(late))
        if not held:
            return
        new = _totals(np.concatenate(held))
        over = _ends_ms(new[:, 1]) <= now  # the clock's backlog: nothing to wait for
        yield from self._out(False, new[over])
        new = new[~over]
        if len(new):
            before = _rows(self._stored())
            first = int(new[:, 1].min())
            if not len(before) or first < int(before[:, 1].min()):
                self.handle.registerTimer(_ends_ms(first))
            self.open.update((_totals(np.concatenate([before, new])).tobytes(),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        now = max(now, timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs())
        stored = _rows(self._stored())
        over = _ends_ms(stored[:, 1]) <= now
        yield from self._out(False, stored[over])
        left = stored[~over]
        if len(left) == len(stored):  # closed by an earlier timer of the same batch
            return
        if len(left):
            self.handle.registerTimer(_ends_ms(int(left[:, 1].min())))
            self.open.update((left.tobytes(),))
        else:
            self.open.clear()

    def _out(self, late: bool, rows: np.ndarray) -> Iterator[Row]:
        for packed in _packed(rows):
            yield Row(late=late, packed=packed)

    def _stored(self) -> bytes | None:
        held = self.open.get()
        return None if held is None else bytes(held[0])

    def close(self) -> None:
        pass


def _micros(ts) -> F.Column:
    return F.unix_micros(TS.ntz_to_instant(ts))


def _ntz(us: str) -> F.Column:
    return TS.instant_to_ntz(F.timestamp_micros(us))


def start_windows(events: DataFrame, closed_path: str, late_path: str, checkpoint: str, clock: str = "event_time",
                  delay: str = "5 seconds", time_col: str | None = None, trigger: dict | None = None,
                  length: str = W.WINDOW_LENGTH, slide: str = W.WINDOW_SLIDE) -> StreamingQuery:
    """Streaming rows (``ingest_key``, ``total_value`` and a TIMESTAMP_NTZ column) -> closed windows and late rows.  ``time_col``: by default
    ``event_ts``, or ``ingest_ts`` when closed by the clock.  ``trigger``: by default what is there is read (event time), or a batch a
    second is run until the job is stopped (processing time; see ``run_to_idle``)."""
    if clock not in ("event_time", "processing_time"):
        raise ValueError(f"clock: {clock}")
    by_event = clock == "event_time"
    time_col = time_col or ("event_ts" if by_event else "ingest_ts")
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = events.filter(F.col(time_col).isNotNull())
    if by_event:
        rows = rows.withColumn("_at", TS.ntz_to_instant(time_col)).withWatermark("_at", delay)
    # ``_at`` ends here: the state operator would otherwise drop late rows before the processor sees them
    members = rows.select(F.window(time_col, length, slide).alias("w"), "ingest_key",
                          F.coalesce("total_value", F.lit(0).cast("decimal(22,2)")).alias("total_value"))
    high = F.expr(f"total_value div {LOW}BD")
    low = ((F.col("total_value") - F.col("high").cast("decimal(20,0)") * F.lit(Decimal(LOW))) * 100).cast("long")
    keyed = members.select(F.floor(_micros("w.start") / SPAN).alias("span"), F.pmod(F.xxhash64("ingest_key"), F.lit(SHARDS)).alias("shard"),
                           _micros("w.start").alias("start_us"), _micros("w.end").alias("end_us"),
                           F.coalesce("ingest_key", F.lit(NO_KEY)), high.alias("high"), "total_value") \
        .withColumn("low", low).drop("total_value")
    packed = keyed.mapInArrow(_pack, "span long, shard int, packed binary")
    out = packed.groupBy("span", "shard").transformWithState(
        OpenWindows(by_event), outputStructType=OUT, outputMode="Append", timeMode="EventTime" if by_event else "ProcessingTime")

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = _unpacked(batch).select(_ntz("start_us").alias("window_start"), _ntz("end_us").alias("window_end"), "late", "a", "money").persist()
        try:
            # most triggers of the clock close nothing; batch 0 is written even if empty, so both tables exist
            if batch_id > 0 and batch.isEmpty():
                return
            closed = batch.filter("not late").select("window_start", "window_end", F.col("a").alias("sale_count"), F.col("money").alias("total_revenue"))
            S.write_part(W.merged(closed), closed_path, batch_id, rebalance=False)
            S.write_part(batch.filter("late").select("window_start", "window_end", F.col("a").alias("ingest_key"),
                                                     F.col("money").alias("total_value")), late_path, batch_id)
        finally:
            batch.unpersist()
    return (out.writeStream.queryName(f"windows_{clock}").option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or ({"availableNow": True} if by_event else {"processingTime": "1 second"}))).foreachBatch(run).start())


def run_to_idle(q: StreamingQuery, seconds: float = 3600.0) -> None:
    """Run a ``processing_time`` job (with a ``processingTime`` trigger) until a micro-batch finds nothing to read, then stop it.  The clock
    never ends, so such a job doesn't end by itself under ``availableNow``."""
    end = time.monotonic() + seconds
    try:
        while time.monotonic() < end:
            if q.awaitTermination(1):
                raise RuntimeError(str(q.exception()))
            done = q.lastProgress
            if done is not None and done["numInputRows"] == 0 and not q.status["isDataAvailable"]:
                return
        raise TimeoutError(f"{q.name}: data left after {seconds} s")
    finally:
        q.stop()


def closed_windows(spark: SparkSession, closed_path: str) -> DataFrame:
    return W.merged(spark.read.schema(AGG_SALES_WINDOWED).parquet(closed_path))


def late_rows(spark: SparkSession, late_path: str) -> DataFrame:
    """One row for each window an event came too late for."""
    return spark.read.schema(LATE_COLUMNS).parquet(late_path)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Partial rows of the windows that were open at the last committed batch, read from the job's state."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "open").load()
    held = _unpacked(state.select(F.lit(False).alias("late"), F.col("value.windows").alias("packed")))
    return held.select(_ntz("start_us").alias("window_start"), _ntz("end_us").alias("window_end"),
                       F.col("a").alias("sale_count"), F.col("money").alias("total_revenue"))


def all_windows(spark: SparkSession, closed_path: str, late_path: str, checkpoint: str) -> DataFrame:
    """Every window with all its rows: closed, late and open together."""
    columns = ["window_start", "window_end", "sale_count", "total_revenue"]
    late = late_rows(spark, late_path).select("window_start", "window_end", F.lit(1).cast("long").alias("sale_count"),
                                              F.col("total_value").alias("total_revenue"))
    closed = spark.read.schema(AGG_SALES_WINDOWED).parquet(closed_path).select(*columns)
    return W.merged(closed.unionByName(late).unionByName(open_windows(spark, checkpoint).select(*columns)))
