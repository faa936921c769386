"""Structured Streaming jobs: end-to-end against the batch oracle, restart
from checkpoint without duplicates, first-arrival-wins across micro-batches,
and the same transform on a static frame and a stream."""

import argparse
import time
from functools import partial

import pytest
from pyspark.sql import functions as F

from salespark.plans import stream_queries as SQ
from salespark.plans.queries import QUERIES
from salespark.schemas import FACT_SALES
from salespark.streaming import jobs as JB
from salespark.streaming import sinks as S
from salespark.streaming import topics as T
from tests.helpers import messages, sale
from tools.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", ["sink_fact_upsert", "window_sliding", "sink_error_skip", "sink_fact_contract", "sink_agg_consumer"])
def test_stream_query_matches_oracle(spark, con, sf_small, name):
    q = SQ.STREAM_QUERIES[name]
    assert compare(spark, con, name, q.run, q.sql, sf_small, verbose=False)


def _events(spark, start, payloads):
    df = messages(spark, payloads)
    return df.withColumn("ingest_key", F.col("ingest_key") + start).withColumn(
        "ingest_ts", F.lit("2026-07-09 10:00:00").cast("timestamp_ntz"))


def _batches(path):
    import os
    from salespark.session import local_path
    return sorted(n for n in os.listdir(local_path(path)) if n.startswith("batch_id="))


def test_restart_and_replay_keep_one_row_per_sale(spark):
    run = SQ.Run(spark, "test_restart")
    T.write_batch(_events(spark, 0, [sale(i) for i in range(20)]), run.raw)
    run.etl()
    # later arrivals: other versions of sales already stored, and new sales
    T.write_batch(_events(spark, 100, [sale(i, total_amount=999) for i in range(10)] + [sale(i) for i in range(20, 25)]), run.raw)
    run.etl()            # resumes from the checkpoint: only the new files
    run.etl()            # nothing new: no batch, no change
    facts = S.read_facts(spark, run.facts)
    assert facts.count() == 25 == facts.select("sale_id").distinct().count()
    assert facts.filter("total_amount = 999").count() == 0  # the first arrival, not the later copy


def test_a_dimension_row_added_between_two_batches_is_seen(spark):
    run = SQ.Run(spark, "test_dims")
    run.store_dims()

    def etl(start, *events):
        T.write_batch(_events(spark, start, events), run.raw)
        run.etl(dims=True)
        return ({r.sale_id for r in S.read_facts(spark, run.facts).collect()},
                [(r.sale_id, r.violations) for r in spark.read.parquet(JB.rejects_of(run.facts)).orderBy("ingest_key").collect()])

    def known(n, **changes):
        return sale(n, **{"user_id": "U-0001", "product_id": 101, "event_timestamp": f"{SQ.FK_DATE_START}T10:00:00", **changes})

    first = [known(1), known(2, user_id="U-NEW"), known(3, product_id=999), known(4, total_amount=0),
             known(5, event_timestamp="1899-01-01T00:00:00", user_id="U-NEW")]
    facts, rejects = etl(0, *first)
    bad = [["user_id_in_dim_user"], ["product_id_in_dim_product"], ["total_amount_positive"], ["user_id_in_dim_user", "date_id_in_dim_date"]]
    assert len(facts) == 1 and [v for _, v in rejects] == bad
    S.store_dims({"dim_user": spark.createDataFrame([("U-NEW", "new")], "user_id string, segment string")}, run.dims, "append")
    facts, rejects = etl(100, known(6, user_id="U-NEW"), known(7, product_id=999))
    assert len(facts) == 2 and [v for _, v in rejects[4:]] == [["product_id_in_dim_product"]]
    assert len(facts) + len(rejects) == 7  # and no duplicates


def test_the_stored_table_is_not_shuffled(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2)], "sale_id string, x int")
    stored = spark.createDataFrame([("b",), ("c",), ("b",)], "sale_id string")
    assert [r.sale_id for r in S.not_stored(new, stored).collect()] == ["a"]
    assert [r.sale_id for r in S.not_stored(new, stored, broadcast_keys=1).collect()] == ["a"]
    path = f"{SQ.Run(spark, 'test_plan').root}/stored"
    stored.write.parquet(path)
    keys = spark.read.parquet(path).join(F.broadcast(new.select("sale_id")), "sale_id", "left_semi")
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def _forget_last_commit(checkpoint):
    """The state after a crash between a batch's output and its commit: the next start runs the batch again."""
    import os
    from salespark.session import local_path
    commits = f"{local_path(checkpoint)}/commits"
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.remove(f"{commits}/{name}")


def test_a_replayed_batch_changes_nothing_downstream(spark):
    """Each job's last batch runs again after every downstream job has read its output: nothing moves, then or later."""
    run = SQ.Run(spark, "test_replay")
    T.write_batch(_events(spark, 0, [sale(i) for i in range(7)] + [sale(quantity=0), sale(8, quantity=1.5)]).coalesce(1), run.raw)

    def downstream():
        run.anomaly(with_topic=True)
        run.aggregation("event_ts", with_topic=True)
        run.fact_consumer()
        run.alert_consumer()
        run.agg_consumer()
        tables = [S.read_facts(spark, run.facts), S.read_facts(spark, run.consumer_facts), T.read_batch(spark, run.valid),
                  T.read_batch(spark, run.invalid), spark.read.parquet(run.alerts), spark.read.parquet(run.consumer_alerts),
                  spark.read.parquet(JB.rejects_of(run.facts)), JB.log_windows(spark, run.agg), JB.windows(spark, run.consumer_agg)]
        return [sorted(map(str, t.collect())) for t in tables]

    run.etl()
    first, batches = downstream(), _batches(run.facts)
    assert [len(t) for t in first] == [7, 7, 8, 1, 1, 1, 1, 3, 3]
    outputs = ["etl/topics", "etl/facts", "anomaly/table", "anomaly/topic", "aggregation/log", "aggregation/topic", "fact_consumer",
               "alert_consumer/rows", "alert_consumer/rejects", "agg_consumer/rows", "agg_consumer/rejects"]
    for output in outputs:
        _forget_last_commit(run.ckpt(output))
    run.etl()
    assert downstream() == first and _batches(run.facts) == batches
    T.write_batch(_events(spark, 50, [sale(70)]), run.raw)
    run.etl()
    assert [len(t) for t in downstream()][:3] == [8, 8, 9]


def test_a_batch_that_failed_half_way_is_completed(spark):
    """The topics were written, the facts only in part: the next start adds what is missing, and only that."""
    run = SQ.Run(spark, "test_half")
    T.write_batch(_events(spark, 0, [sale(i) for i in range(5)]), run.raw)
    run.etl()
    stored = S.read_facts(spark, run.facts)
    before = sorted(map(str, stored.collect()))
    last = int(_batches(run.facts)[-1].split("=")[1])
    nothing = spark.createDataFrame([], FACT_SALES).withColumn("sale_month", F.col("date_id"))
    S.write_part(nothing, run.facts, last, "sale_month")
    assert S.read_facts(spark, run.facts).count() < 5
    _forget_last_commit(run.ckpt("etl/facts"))
    run.etl()
    assert T.read_batch(spark, run.valid).count() == 5 and sorted(map(str, S.read_facts(spark, run.facts).collect())) == before


def test_files_of_a_batch_that_was_not_committed_are_not_read(spark):
    run = SQ.Run(spark, "test_uncommitted")
    T.write_batch(_events(spark, 0, [sale(i) for i in range(5)]), run.raw)
    run.etl()
    T.write_batch(_events(spark, 90, [sale(9)]), run.valid)  # what a task of a failed batch leaves in the folder
    assert T.read_batch(spark, run.valid).count() == 5
    run.fact_consumer()
    assert S.read_facts(spark, run.consumer_facts).count() == 5


def test_a_failing_output_ends_its_job(spark):
    run = SQ.Run(spark, "test_failing")
    T.write_batch(_events(spark, 0, [sale(1)]), run.raw)
    out = JB.EtlOutputs(run.valid, run.invalid, run.facts, f"{run.root}/no/dims")
    job = JB.start_etl(spark, run.raw, out, run.ckpt("etl"), trigger={"processingTime": "1 second"})
    with pytest.raises(RuntimeError, match="no/dims"):
        JB.run_to_end(job)
    assert not job.isActive
    run.etl()  # restarted with what it needs
    assert S.read_facts(spark, run.facts).count() == 1 == T.read_batch(spark, run.valid).count()


def test_windows_are_the_same_before_during_and_after_compaction(spark):
    run = SQ.Run(spark, "test_compact")

    def add(start):
        T.write_batch(_events(spark, start, [sale(start + i, event_timestamp=f"2024-02-29 23:59:{i:02d}") for i in range(0, 40, 8)]).coalesce(1), run.raw)
        run.etl()
        run.aggregation("event_ts")
        return sorted(map(str, JB.log_windows(spark, run.agg).collect()))

    def rows_read():
        return JB._log_rows(spark, run.agg).count()
    add(0)
    assert JB.compact_windows(spark, run.agg) is None  # the only batch may still be running
    add(100)
    want = add(200)
    before = rows_read()
    # a crash between the merged rows and the generation's row leaves files that no reader sees
    spark.range(3).selectExpr("timestamp_ntz'2024-02-29 23:59:00' AS window_start").write.parquet(f"{JB.compacted_of(run.agg)}/upto=1")
    assert sorted(map(str, JB.log_windows(spark, run.agg).collect())) == want and rows_read() == before
    assert JB.compact_windows(spark, run.agg) == 1  # in place of what was left there
    assert sorted(map(str, JB.log_windows(spark, run.agg).collect())) == want and rows_read() < before
    assert JB.compact_windows(spark, run.agg) is None
    later = add(300)
    assert later != want and JB.compact_windows(spark, run.agg) == 2
    assert sorted(map(str, JB.log_windows(spark, run.agg).collect())) == later


def test_jobs_run_together_and_a_failed_one_is_restarted(spark, monkeypatch):
    """All jobs with a processing-time trigger; the fact sink fails once in the middle of a batch."""
    from salespark import __main__ as cli
    run = SQ.Run(spark, "test_together")
    T.write_batch(_events(spark, 0, [sale(i) for i in range(6)] + [sale(quantity=0)]).coalesce(1), run.raw)
    write, failures = S.write_part, []

    def fails_once(df, path, batch_id, partition_by=None):
        if partition_by and not failures:
            failures.append(path)
            raise OSError("lost while writing")
        write(df, path, batch_id, partition_by)
    monkeypatch.setattr(S, "write_part", fails_once)
    facts, alerts, consumed = (f"{run.root}/tables/{t}" for t in ("fact_sales", "anomaly_alerts_consumer", "fact_sales_consumer"))

    def complete():
        try:
            return [S.read_facts(spark, facts).count(), spark.read.parquet(alerts).count(), S.read_facts(spark, consumed).count()] == [6, 1, 6]
        except Exception:  # a table is not there yet
            return False
    args = argparse.Namespace(bootstrap=None, once=False, every="1 second", max_per_trigger=None, time="event_ts")
    jobs = ("etl", "anomaly", "fact-consumer", "alert-consumer")
    deadline = time.monotonic() + 120
    done = JB.supervise({j: partial(cli.start, spark, j, args, run.root) for j in jobs}, lambda: complete() or time.monotonic() > deadline)
    assert complete() and sum(done.values()) == len(failures) == 1
    assert not spark.streams.active


def test_a_job_that_keeps_failing_stops_all(spark):
    run = SQ.Run(spark, "test_keeps_failing")
    T.write_batch(_events(spark, 0, [sale(1)]).coalesce(1), run.raw)
    out = JB.EtlOutputs(run.valid, run.invalid, run.facts, f"{run.root}/no/dims")
    with pytest.raises(RuntimeError, match="etl: .*"):
        JB.supervise({"etl": lambda: JB.start_etl(spark, run.raw, out, run.ckpt("etl"), {"processingTime": "1 second"})}, restarts=1)
    assert not spark.streams.active


def test_partial_rows_of_tasks_merge_to_the_windows(spark, monkeypatch):
    from salespark.operators import windows as W
    monkeypatch.setattr(W, "HELD_WINDOWS", 2)
    rows = spark.range(400, numPartitions=3).selectExpr(
        "timestamp_ntz'2026-07-09 10:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 50) AS event_ts",
        "if(id % 7 = 0, NULL, CAST(id AS decimal(22,2))) AS total_value")
    want = W.window_stats(rows, "event_ts")
    part = W.partial_rows(rows, "event_ts")
    assert part.columns == want.columns and part.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, W.merged(part).collect())) == sorted(map(str, want.collect()))
    assert W.partial_rows(rows.limit(0), "event_ts").count() == 0


def test_inserted_at_is_the_clock_of_the_batch(spark):
    run = SQ.Run(spark, "test_clock")
    T.write_batch(_events(spark, 0, [sale(1)]), run.raw)
    run.etl()
    run.aggregation(with_topic=True)
    run.agg_consumer()
    rows = spark.read.parquet(run.consumer_agg).collect()
    assert len(rows) == 3 and len({r.inserted_at for r in rows}) == 1 and rows[0].inserted_at is not None


def test_many_batches_give_the_batch_results(spark, sf_small):
    """Three micro-batches and more, in arrival order unlike event order."""
    run = SQ.run_pipeline(spark, sf_small, "test_multibatch")
    run.aggregation("event_ts")
    assert len(_batches(run.facts)) >= 3 and len(_batches(run.agg)) >= 3
    for got, name in ((S.read_facts(spark, run.facts), "pk_first_wins"), (JB.log_windows(spark, run.agg), "agg_window_stats")):
        want = QUERIES[name].run(spark, sf_small)
        got = got.select(*want.columns)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_same_transform_batch_and_stream(spark):
    """batch_mode: tag_events gives the same rows on a static frame and a stream."""
    from salespark.operators.validate import tag_events
    run = SQ.Run(spark, "test_batch_stream")
    payloads = [sale(i, quantity=i % 3) for i in range(12)]
    T.write_batch(_events(spark, 0, payloads), run.raw)
    batch = tag_events(T.read_batch(spark, run.raw)).drop("_v")
    out = f"{run.root}/tables/tagged"
    q = (tag_events(T.read_stream(spark, run.raw)).drop("_v").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", run.ckpt("tagged"))
         .trigger(availableNow=True).start())
    JB.run_to_end(q)
    stream = spark.read.parquet(out)
    assert stream.exceptAll(batch.select(*stream.columns)).count() == 0
    assert stream.count() == batch.count() == 12


def test_processing_time_trigger(spark):
    """A continuous ETL job (processingTime trigger) picks up new files."""
    run = SQ.Run(spark, "test_continuous")
    T.write_batch(_events(spark, 0, [sale(i) for i in range(5)]), run.raw)
    out = JB.EtlOutputs(run.valid, run.invalid, run.facts)
    q = JB.start_etl(spark, run.raw, out, run.ckpt("etl"), trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        T.write_batch(_events(spark, 10, [sale(9), sale(quantity=0)]), run.raw)
        q.processAllAvailable()
    finally:
        q.stop()
    assert S.read_facts(spark, run.facts).count() == 6
    assert T.read_batch(spark, run.invalid).count() == 1


def test_sequence_passthrough(spark):
    """INSERT INTO sink SELECT * FROM source, with the bounded id sequence."""
    from salespark.session import work_dir
    from salespark.sources.dims import sequence_source
    path = work_dir(spark, "passthrough")
    sequence_source(spark).write.parquet(path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]


def test_fact_consumer_over_two_runs(spark):
    run = SQ.Run(spark, "test_fact_consumer")
    for start, events in ((0, [sale(i) for i in range(8)]), (100, [sale(i, total_amount=500) for i in range(4)] + [sale(9)])):
        T.write_batch(_events(spark, start, events), run.raw)
        run.etl()
        run.fact_consumer()
    got = S.read_facts(spark, run.consumer_facts)
    assert got.count() == 9 == got.select("sale_id").distinct().count() and got.filter("total_amount = 500").count() == 0


def test_console_sink(spark):
    from salespark.streaming.sinks import console
    run = SQ.Run(spark, "test_console")
    T.write_batch(_events(spark, 0, [sale()]), run.raw)
    JB.run_to_end(console(T.read_stream(spark, run.raw).select("ingest_key"), run.ckpt("console"),
                          trigger={"availableNow": True}))


def test_kafka_reader_needs_the_connector(spark):
    """The Kafka topic builds a kafka readStream; this image has no connector."""
    topic = T.kafka_topic(T.RAW_TOPIC, "broker:9092", starting_offsets="latest", group_id="etl-group")
    assert topic.options == {"kafka.group.id": "etl-group"}
    with pytest.raises(Exception, match="(?i)kafka"):
        T.read_stream(spark, topic)


def test_kafka_columns(spark):
    rows = [(b"x", t, p, o) for t, p, o in (("2026-07-09 10:00:00.002", 0, 5), ("2026-07-09 10:00:00.001", 3, 9), ("2026-07-09 10:00:00.001", 3, 8))]
    df = spark.createDataFrame(rows, "value binary, timestamp string, partition int, offset long").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp"))
    got = T.kafka_columns(df).orderBy("ingest_key").collect()
    assert [(r.partition, str(r.ingest_ts)[-3:]) for r in got] == [(3, "000"), (3, "000"), (0, "000")]
    assert len({r.ingest_key for r in got}) == 3 and got[0].value == "x"


def test_cli_runs_the_jobs_once(spark):
    """python -m salespark <job> --once: the ETL then the anomaly job on file topics."""
    from salespark.__main__ import main
    run = SQ.Run(spark, "test_cli")
    T.write_batch(_events(spark, 0, [sale(1), sale(quantity=0)]), run.raw)
    main(["etl", "--root", run.root, "--once"])
    for job in ("anomaly", "aggregation", "fact-consumer", "alert-consumer", "agg-consumer"):
        main([job, "--root", run.root, "--once"])
    assert S.read_facts(spark, f"{run.root}/tables/fact_sales").count() == 1
    assert S.read_facts(spark, f"{run.root}/tables/fact_sales_consumer").count() == 1
    assert JB.windows(spark, f"{run.root}/tables/agg_sales_windowed_consumer").count() == 3
    assert spark.read.parquet(f"{run.root}/tables/anomaly_alerts").first().anomaly_code == 3


def test_raw_topic_is_stored_once(spark, sf_small):
    """No second copy of the messages is left or made: the run's folder holds the topic alone."""
    import os

    from salespark.plans import stream_queries as SQ
    from salespark.session import local_path
    from salespark.streaming import topics as T
    r = SQ.Run(spark, "test_stored_once")
    r.produce(sf_small)
    assert os.listdir(local_path(r.root)) == ["topics"]
    files = T.read_batch(spark, r.raw).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert T.read_batch(spark, r.raw).count() == spark.read.parquet(f"{sf_small}/lineitem.parquet").count()
