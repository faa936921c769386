"""Windows closed by the watermark and by the clock: every membership in one place, state across a restart."""

import time

from pyspark.sql import functions as F

from salespark.operators import windows as W
from salespark.plans import stream_queries as SQ
from salespark.streaming import stateful as ST


START = "2026-07-09 10:00:00"
ROWS = "ingest_key long, event_ts timestamp_ntz, ingest_ts timestamp_ntz, total_value decimal(22,2)"


class Job:
    """A window job over a folder of rows: each ``add`` is one micro-batch."""

    def __init__(self, spark, name, clock="event_time"):
        self.spark, self.root, self.clock = spark, SQ.Run(spark, name).root, clock
        self.paths = (f"{self.root}/closed", f"{self.root}/late", f"{self.root}/checkpoint")
        self.at = 0
        spark.createDataFrame([], ROWS).write.parquet(f"{self.root}/rows")

    def start(self, trigger=None):
        rows = self.spark.readStream.schema(ROWS).parquet(f"{self.root}/rows")
        return ST.start_windows(rows, *self.paths, clock=self.clock, trigger=trigger)

    def add(self, *seconds, total="1.25"):
        """One event at each second after START."""
        from datetime import datetime, timedelta
        from decimal import Decimal
        at = [None if s is None else datetime.fromisoformat(START) + timedelta(seconds=s) for s in seconds]
        rows = [(self.at + i, t, t, None if total is None else Decimal(total)) for i, t in enumerate(at)]
        self.at += len(rows)
        self.spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{self.root}/rows")

    def drain(self):
        q = self.start()
        if self.clock == "processing_time":
            return ST.run_to_idle(q, 60)
        assert q.awaitTermination(120) and q.exception() is None

    def check_whole(self, time_col="event_ts"):
        rows = self.spark.read.schema(ROWS).parquet(f"{self.root}/rows").filter(F.col(time_col).isNotNull())
        want = W.window_stats(rows, time_col)
        got = ST.all_windows(self.spark, *self.paths).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

    def closed(self):
        return {(r.window_start.second + 60 * r.window_start.minute, r.sale_count)
                for r in ST.closed_windows(self.spark, self.paths[0]).collect()}

    def late(self):
        return sorted((r.ingest_key, r.window_start.second) for r in ST.late_rows(self.spark, self.paths[1]).collect())


def test_late_rows_have_a_table_of_their_own(spark):
    job = Job(spark, "test_late")
    job.add(20, 21, 21)
    job.drain()
    job.add(100)        # the watermark goes to 95 s with the batch after this one
    job.drain()
    job.add(69, 22)     # 22 s: its windows start at 0, 10, 20 s; 69 s: at 40, 50, 60 s, of which all are over
    job.drain()
    job.add(88, None)   # windows 60..90 (over), 70..100 and 80..110 (open)
    job.drain()
    assert {(0, 3), (10, 3), (20, 3)} <= job.closed()
    assert job.late() == [(4, 0), (4, 40), (4, 50), (5, 0), (5, 10), (5, 20), (6, 0)]  # second 0 of 4 and 6: window 60..90
    job.check_whole()
    stored = spark.read.parquet(job.paths[0])
    assert stored.count() == stored.select("window_start").distinct().count()  # closed once


def test_a_hot_window_is_split_and_written_once(spark):
    job = Job(spark, "test_hot")
    job.add(*[25] * 400, total=None)
    job.drain()
    assert ST.open_windows(spark, job.paths[2]).count() == 3 * ST.SHARDS  # two numbers each
    job.add(300)
    job.drain()
    job.add(301)
    job.drain()
    rows = [r for r in spark.read.parquet(job.paths[0]).collect() if r.sale_count == 400]
    assert len(rows) == 3 and all(r.total_revenue == 0 and r.avg_order_value == 0 for r in rows)
    job.check_whole()


def test_an_empty_topic(spark):
    job = Job(spark, "test_no_rows")
    job.add(None)
    job.drain()
    job.check_whole()
    assert job.closed() == set() and job.late() == []


def test_the_clock_closes_a_window_without_a_further_event(spark):
    """State from before a restart is closed by the clock afterwards, once, with no new event."""
    from datetime import datetime, timezone
    job = Job(spark, "test_clock_close", "processing_time")
    now = (datetime.now(timezone.utc).replace(tzinfo=None) - datetime.fromisoformat(START)).total_seconds()
    job.add(now + 25, now + 25)
    job.drain()
    assert sum(n for _, n in job.closed()) == 0
    q = job.start({"processingTime": "1 second"})
    try:
        until = time.time() + 100
        while time.time() < until and len(job.closed()) < 3:
            time.sleep(1)
    finally:
        q.stop()
    assert [n for _, n in sorted(job.closed())] == [2, 2, 2]
    assert spark.read.parquet(job.paths[0]).count() == 3
    job.check_whole("ingest_ts")


def test_a_backlog_is_closed_as_it_is_read(spark):
    job = Job(spark, "test_backlog", "processing_time")
    for seconds in ((1, 2, 3), (2, 700), (1,)):
        job.add(*seconds)
        job.drain()
    job.check_whole("ingest_ts")


def test_windows_of_one_day_share_a_state(spark):
    """The state store is asked once for each span a batch touches, not once for each window: the timers follow."""
    job = Job(spark, "test_span")
    job.add(*range(0, 3600, 7))
    job.drain()
    state = spark.read.format("statestore").option("path", job.paths[2]).option("stateVarName", "open").load()
    assert state.count() <= ST.SHARDS
    job.add(1805)
    job.drain()
    job.add(3700, 3590)  # the watermark is 3590 s here: all windows before it are over
    job.drain()
    job.add(3701)
    job.drain()
    job.check_whole()
    assert len(job.closed()) > 300
    left = {(r.window_start.second + 60 * r.window_start.minute) for r in ST.open_windows(spark, job.paths[2]).collect()}
    assert left and min(left) >= 40


def test_days_share_a_state_and_money_is_exact(spark):
    job = Job(spark, "test_days")
    job.add(*range(0, 10 * 86_400, 7_200), total="-99999999999999999.99")
    job.drain()
    state = spark.read.format("statestore").option("path", job.paths[2]).option("stateVarName", "open").load()
    assert state.count() <= 2 * ST.SHARDS
    job.add(20, 21, 10 * 86_400, total="12345678901234567890.12")
    job.drain()
    job.check_whole()


def test_memberships_are_packed_by_key():
    import numpy as np
    import pyarrow as pa
    n = 3 * ST.PACK_ROWS
    columns = [np.arange(n) % 2, np.zeros(n), np.arange(n), np.arange(n) + 30, np.arange(n), np.full(n, 7), np.full(n, -3)]
    batch = pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], list("abcdefg"))
    (got,) = ST._pack(iter([batch]))
    assert got.column("span").to_pylist() == [0, 0, 1, 1] and set(got.column("shard").to_pylist()) == {0}
    packed = pa.RecordBatch.from_arrays([pa.array([False] * 4), got.column("packed")], ["late", "packed"])
    rows = [r for b in ST._unpack(iter([packed])) for r in b.to_pylist()]
    assert len(rows) == n and {r["start_us"] for r in rows} == set(range(n)) and all((r["high"], r["low"]) == (7, -3) for r in rows)


def test_a_late_row_without_a_key(spark):
    job = Job(spark, "test_no_key")
    job.add(20)
    job.drain()
    job.add(100)
    job.drain()
    spark.sql("SELECT CAST(NULL AS BIGINT) AS ingest_key, TIMESTAMP_NTZ '2026-07-09 10:00:21' AS event_ts, TIMESTAMP_NTZ '2026-07-09 10:00:21' AS ingest_ts, "
              "CAST(1 AS DECIMAL(22,2)) AS total_value").coalesce(1).write.mode("append").parquet(f"{job.root}/rows")
    job.drain()
    assert [r.ingest_key for r in ST.late_rows(spark, job.paths[1]).collect()] == [None] * 3
    job.check_whole()


def test_a_table_is_made_once_for_a_schema_in_ddl(spark):
    from salespark.session import work_dir
    from salespark.streaming.sinks import create_table_if_not_exists
    path = work_dir(spark, "made_once")
    assert [create_table_if_not_exists(spark, path, "upto long") for _ in range(2)] == [True, False]
    assert spark.read.parquet(path).columns == ["upto"]
