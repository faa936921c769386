"""The three streaming jobs and the consumers, as Structured Streaming queries.

Each job is ``readStream -> DataFrame transforms -> sinks``: one streaming query for each output, with a checkpoint of its own
under the job's checkpoint folder, so a job restarted after a failure resumes each output from its last committed micro-batch.

* ``start_etl``         raw topic -> tag -> valid and invalid topic (one query, routed by row); fact_sales and its
                        rejects (a second one)
* ``start_anomaly``     invalid topic -> coded alerts -> anomaly_alerts, and the alert topic if given
* ``start_aggregation`` valid topic -> 30 s / 10 s sliding windows -> partial statistics per batch, to a
                        log and to the aggregate topic; ``log_windows`` merges them, ``compact_windows`` keeps the log short
* ``start_fact_consumer``, ``start_alert_consumer``, ``start_agg_consumer`` the three topic -> table consumers

Topics and appended tables are written by Spark's file sink, whose log makes them exactly once; what needs the stored table
or an aggregate of the micro-batch is a partition of its own per batch (``sinks.write_part``), which a replay overwrites with the same rows.

``trigger`` is ``{"availableNow": True}`` to drain what is there and stop, or
``{"processingTime": "60 seconds"}`` for a continuous job (the SQL job's
checkpoint interval).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from salespark.functions import json as J
from salespark.functions import time as TS
from salespark.operators import facts as FA
from salespark.operators import quality as Q
from salespark.operators import validate as V
from salespark.operators import windows as W
from salespark.schemas import AGG_SALES_WINDOWED, ALERT_COLUMNS, FACT_SALES
from salespark.session import let_go
from salespark.streaming import sinks as S
from salespark.streaming import topics as T

# Bounded out-of-orderness declared by the SQL job.
EVENT_WATERMARK = "5 seconds"

DRAIN = {"availableNow": True}


@dataclass(frozen=True)
class Job:
    """The streaming queries of one job, one for each output, under the names of a StreamingQuery."""

    queries: tuple[StreamingQuery, ...]

    @property
    def isActive(self) -> bool:
        return any(q.isActive for q in self.queries)

    def processAllAvailable(self) -> None:
        for q in self.queries:
            q.processAllAvailable()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    def exception(self) -> Exception | None:
        return next((q.exception() for q in self.queries if q.exception() is not None), None)


def run_to_end(job: Job | StreamingQuery) -> None:
    """Wait until all queries of a job have ended (with an ``availableNow`` trigger they end by themselves).  If one fails, the
    others are stopped and its failure is raised."""
    job = job if isinstance(job, Job) else Job((job,))
    while job.isActive and job.exception() is None:
        time.sleep(0.05)
    failed = job.exception()
    if failed is not None:
        job.stop()
        raise RuntimeError(str(failed))


def supervise(starts: dict[str, Callable[[], Job]], until: Callable[[], bool] | None = None, restarts: int = 3,
              every: float = 1.0) -> dict[str, int]:
    """Run jobs together, in the order of ``starts`` (name -> function that starts it, writers of a topic before its readers).

    A job of which an output fails is stopped as a whole and started again from its checkpoints, at most ``restarts`` times;
    after that all jobs are stopped and the failure is raised.  Returns the restarts of each job when all have ended
    (``availableNow``), or once ``until()`` is true (jobs with a processing-time trigger), and leaves none running."""
    done = dict.fromkeys(starts, 0)
    jobs: dict[str, Job] = {}
    try:
        for name, start in starts.items():
            jobs[name] = start()
        while any(job.isActive for job in jobs.values()) or any(job.exception() for job in jobs.values()):
            for name, job in jobs.items():
                failed = job.exception()
                if failed is None:
                    continue
                job.stop()
                if done[name] >= restarts:
                    raise RuntimeError(f"{name}: {failed}")
                done[name] += 1
                jobs[name] = starts[name]()
            if until is not None and until():
                break
            time.sleep(every)
        return done
    finally:
        for job in jobs.values():
            job.stop()


def rejects_of(table_path: str) -> str:
    """Where the rows go that break a table's contract."""
    return f"{table_path}_rejects"


@dataclass(frozen=True)
class EtlOutputs:
    valid: T.Topic
    invalid: T.Topic
    facts_path: str
    dims_path: str | None = None  # stored dimensions: facts must then meet the CHECK and FOREIGN KEY rules


def routed(tagged: DataFrame, valid: T.Topic, invalid: T.Topic) -> DataFrame:
    """Tagged events with the name of the topic each belongs to (split)."""
    return tagged.withColumn("topic", F.when(F.col("error_reason").isNull(), valid.name).otherwise(invalid.name))


def start_etl(spark: SparkSession, raw: T.Topic, out: EtlOutputs, checkpoint: str,
              trigger: dict | None = None, max_per_trigger: int | None = None) -> Job:
    """The valid and the invalid topic share their place (one folder, or the same Kafka servers): one query writes both."""
    trigger = trigger or DRAIN
    tagged = V.tag_events(T.read_stream(spark, raw, max_per_trigger)).drop(V.V)  # the VARIANT is not needed past the split
    split = T.start_writer(routed(tagged, out.valid, out.invalid), out.valid, f"{checkpoint}/topics", "etl_topics", trigger, key="sale_id")
    return Job((split, _start_facts(tagged, out.facts_path, f"{checkpoint}/facts", "etl_facts", trigger, out.dims_path)))


def _start_facts(tagged: DataFrame, facts_path: str, checkpoint: str, name: str, trigger: dict, dims_path: str | None) -> StreamingQuery:
    spark = tagged.sparkSession
    S.create_table_if_not_exists(spark, facts_path, FACT_SALES)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            S.upsert_first_wins(batch, facts_path, rejects_of(facts_path), batch_id, dims_path)
        finally:
            batch.unpersist()
    return _start_foreach(FA.fact_rows(V.valid_events(tagged)), run, checkpoint, name, trigger)


def _start_foreach(rows: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, name: str, trigger: dict) -> StreamingQuery:
    def then_let_go(batch: DataFrame, batch_id: int) -> None:
        run(batch, batch_id)
        let_go(batch.sparkSession)  # the shuffle files of the batches before
    return rows.writeStream.queryName(name).option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(then_let_go).start()


def alerts_from_invalid(messages: DataFrame) -> DataFrame:
    """Invalid-topic JSON -> coded alerts (the record is parsed again, as a
    separate job reading a topic must)."""
    v = J.parse("value")
    parsed = messages.select("ingest_key", "ingest_ts", v.alias(V.V))
    vv = F.col(V.V)
    typed = parsed.select(
        "ingest_key", "ingest_ts", V.V,
        J.field(vv, "error_reason", "string").alias("error_reason"),
        J.field(vv, "sale_id", "string").alias("sale_id"),
        J.field(vv, "event_timestamp", "string").alias("event_timestamp"))
    return V.coded_alerts(typed)


def start_anomaly(spark: SparkSession, invalid: T.Topic, alerts_path: str, checkpoint: str,
                  trigger: dict | None = None, alerts_topic: T.Topic | None = None,
                  max_per_trigger: int | None = None) -> Job:
    trigger = trigger or DRAIN
    alerts = alerts_from_invalid(T.read_stream(spark, invalid, max_per_trigger))
    queries = [S.append_stream(alerts, alerts_path, f"{checkpoint}/table", "anomaly_alerts", trigger)]
    if alerts_topic is not None:
        msg = alerts.select(
            "sale_id", J.write(F.struct("sale_id", "anomaly_type", "anomaly_code", "event_timestamp")).alias("value"),
            F.col("detected_at").alias("ingest_ts"), F.col("id").alias("ingest_key"), F.lit(alerts_topic.name).alias("topic"))
        queries.append(T.start_writer(msg, alerts_topic, f"{checkpoint}/topic", "anomaly_topic", trigger, key="sale_id"))
    return Job(tuple(queries))


def valid_from_topic(messages: DataFrame) -> DataFrame:
    """Valid-topic JSON -> (event_ts, ingest_ts, ingest_key, total_value)."""
    v = J.parse("value")
    parsed = messages.select("ingest_ts", "ingest_key", v.alias("_v")).select(
        "ingest_ts", "ingest_key", J.field("_v", "event_timestamp", "string").alias("_ts_text"),
        J.field("_v", "total_amount", "decimal(22,2)").alias("total_value"))
    return parsed.select("ingest_ts", "ingest_key", TS.ts_iso("_ts_text").alias("event_ts"), "total_value")


def start_aggregation(spark: SparkSession, valid: T.Topic, log_path: str, checkpoint: str,
                      time_col: str = "ingest_ts", trigger: dict | None = None,
                      agg_topic: T.Topic | None = None, max_per_trigger: int | None = None) -> Job:
    """Sliding-window statistics on the arrival clock (``ingest_ts``) or the event time (``event_ts``).

    Each micro-batch is reduced to one partial row per window it touches, (count, sum), which is what the
    original's accumulator holds and merges.  The partial rows are a partition of the log per batch; a window's
    statistics are the sum of its partial rows (``log_windows``).  No state is kept and no watermark drops a
    late event: it becomes a partial row of its window like any other.  The topic, which other streams read, takes partial rows
    that each task has combined (``W.partial_rows``): an append needs no shuffle, and the file sink makes it exactly once."""
    trigger = trigger or DRAIN
    S.create_table_if_not_exists(spark, generations_of(log_path), GENERATION)
    S.create_table_if_not_exists(spark, compacted_of(log_path), StructType([*AGG_SALES_WINDOWED.fields, StructField("upto", LongType())]), ["upto"])
    events = valid_from_topic(T.read_stream(spark, valid, max_per_trigger))
    queries = [_start_foreach(events, lambda batch, batch_id: S.write_part(W.window_stats(batch, time_col), log_path, batch_id, rebalance=False),
                              f"{checkpoint}/log", "agg_sales_windowed", trigger)]
    if agg_topic is not None:
        bounds = F.struct(*[F.col(c).cast("string").alias(c) for c in ("window_start", "window_end")],
                          "sale_count", "total_revenue", "avg_order_value")
        msg = W.partial_rows(events, time_col).select(
            J.write(bounds).alias("value"), F.col("window_end").alias("ingest_ts"),
            F.unix_micros(TS.ntz_to_instant("window_start")).alias("ingest_key"), F.lit(agg_topic.name).alias("topic"))
        queries.append(T.start_writer(msg, agg_topic, f"{checkpoint}/topic", "agg_topic", trigger))
    return Job(tuple(queries))


def windows(spark: SparkSession, table_path: str) -> DataFrame:
    """agg_sales_windowed as a consumer stored it: one row per window, the sum of its partial rows."""
    return W.merged(spark.read.schema(AGG_SALES_WINDOWED).parquet(table_path))


GENERATION = "upto long"


def compacted_of(log_path: str) -> str:
    """Where the merged rows of all batches up to ``upto`` are."""
    return f"{log_path}_compacted"


def generations_of(log_path: str) -> str:
    """The table of complete generations: one row each, appended when the generation has been written."""
    return f"{log_path}_generations"


def _generation(spark: SparkSession, log_path: str) -> int:
    """The batch that the latest complete generation goes up to; -1 if there is none."""
    upto = spark.read.schema(GENERATION).parquet(generations_of(log_path)).agg(F.max("upto")).first()[0]
    return -1 if upto is None else upto


def _parts(spark: SparkSession, path: str, column: str) -> DataFrame:
    return spark.read.schema(StructType([*AGG_SALES_WINDOWED.fields, StructField(column, LongType())])).parquet(path)


def _log_rows(spark: SparkSession, log_path: str) -> DataFrame:
    """The latest complete generation and the log's batches after it (folders before it are pruned, not read)."""
    upto = _generation(spark, log_path)
    merged = _parts(spark, compacted_of(log_path), "upto").filter(F.col("upto") == upto).drop("upto")
    later = _parts(spark, log_path, "batch_id").filter(F.col("batch_id") > upto)
    return merged.withColumn("batch_id", F.lit(upto)).unionByName(later)


def log_windows(spark: SparkSession, log_path: str) -> DataFrame:
    """agg_sales_windowed from the aggregation job's log: one row per window, the sum of its partial rows."""
    return W.merged(_log_rows(spark, log_path))


def compact_windows(spark: SparkSession, log_path: str) -> int | None:
    """Maintenance beside the running job: merge the log's partial rows, up to the batch before the last, into a new generation, and
    return that batch's number (None: there is nothing to merge).  Readers see the old generation and all batches after it until the
    new one's row is appended, and the same windows before and after; a run that fails half way leaves files that nobody
    reads and the next run overwrites.  The last batch stays out because it may still be running.  The merged
    folders of the log can be dropped once no reader that started earlier is left."""
    rows = _log_rows(spark, log_path)
    last = _parts(spark, log_path, "batch_id").agg(F.max("batch_id")).first()[0]
    upto = -1 if last is None else last - 1
    if upto <= _generation(spark, log_path):
        return None
    merged = W.merged(rows.filter(F.col("batch_id") <= upto))
    merged.hint("rebalance").write.mode("overwrite").parquet(f"{compacted_of(log_path)}/upto={upto}")
    spark.createDataFrame([(upto,)], GENERATION).coalesce(1).write.mode("append").parquet(generations_of(log_path))
    return upto


def start_fact_consumer(spark: SparkSession, valid: T.Topic, facts_path: str, checkpoint: str,
                        trigger: dict | None = None, max_per_trigger: int | None = None,
                        dims_path: str | None = None) -> Job:
    """The fact consumer: valid topic -> fact_sales with ``ON CONFLICT
    (sale_id) DO NOTHING``, through the same sink as the ETL job (``dims_path`` as there)."""
    tagged = V.tag_events(T.read_stream(spark, valid, max_per_trigger)).drop(V.V)
    return Job((_start_facts(tagged, facts_path, checkpoint, "fact_consumer", trigger or DRAIN, dims_path),))


def start_sql_etl(spark: SparkSession, raw: T.Topic, facts_path: str, invalid: T.Topic,
                  checkpoint: str, trigger: dict | None = None,
                  watermark: str | None = EVENT_WATERMARK, max_per_trigger: int | None = None,
                  jdbc: tuple[str, str, dict] | None = None) -> Job:
    """The SQL ETL job as a stream: fixed-schema JSON source with the computed
    ``ts`` column (and its declared watermark, which no operator consumes),
    fact branch appended to the fact table (the JDBC table declares no key, so
    no dedup), invalid branch with the SQL reason order to a topic.  ``jdbc``: (url, table, properties) of a
    database table that takes the facts instead of ``facts_path`` (at-least-once, as the original).  Two
    queries, as the original's two INSERT jobs."""
    trigger = trigger or DRAIN
    typed = V.parse_typed(T.read_stream(spark, raw, max_per_trigger))
    if watermark is not None:
        typed = typed.withColumn("_wm", TS.ntz_to_instant("ts")).withWatermark("_wm", watermark)
    facts = V.sql_facts(typed)
    if jdbc is None:
        stored = S.append_stream(facts, facts_path, f"{checkpoint}/facts", "sql_facts", trigger)
    else:
        stored = _start_foreach(facts, lambda batch, _: S.jdbc_append(batch, *jdbc), f"{checkpoint}/facts", "sql_facts", trigger)
    out = typed.filter(~V.sql_ok()).select(
        J.write(F.struct("sale_id", "user_id", "product_id", "quantity", "unit_price",
                         "total_amount", "event_timestamp",
                         V.sql_reason().alias("error_reason"))).alias("value"),
        "ingest_ts", "ingest_key", "sale_id", F.lit(invalid.name).alias("topic"))
    return Job((stored, T.start_writer(out, invalid, f"{checkpoint}/invalid", "sql_invalid", trigger, key="sale_id")))


def start_alert_consumer(spark: SparkSession, alerts_topic: T.Topic, table_path: str,
                         checkpoint: str, trigger: dict | None = None,
                         max_per_trigger: int | None = None) -> Job:
    """The alert consumer: stores (sale_id, anomaly_type, event_timestamp)
    from the alert topic; the code column stays NULL; detected_at is the
    arrival clock.  Rows without a sale id or type go to the rejects."""
    v = J.parse("value")
    msgs = T.read_stream(spark, alerts_topic, max_per_trigger).select("ingest_key", "ingest_ts", v.alias("_v"))
    rows = msgs.select(
        F.col("ingest_key").alias("id"),
        J.field("_v", "sale_id", "string").alias("sale_id"),
        J.field("_v", "anomaly_type", "string").alias("anomaly_type"),
        F.lit(None).cast("int").alias("anomaly_code"),
        J.field("_v", "event_timestamp", "string").alias("event_timestamp"),
        F.col("ingest_ts").alias("detected_at"))
    return _consume(rows, "alert_consumer", Q.not_null_rules(ALERT_COLUMNS), table_path, checkpoint, trigger)


def start_agg_consumer(spark: SparkSession, agg_topic: T.Topic, table_path: str,
                       checkpoint: str, trigger: dict | None = None,
                       max_per_trigger: int | None = None) -> Job:
    """The aggregate consumer: the rows of the aggregate topic stored with ``inserted_at`` =
    the micro-batch clock (``current_timestamp()`` is fixed per batch); ``windows`` gives one row per window."""
    v = J.parse("value")
    msgs = T.read_stream(spark, agg_topic, max_per_trigger).select(v.alias("_v"))
    rows = msgs.select(*[J.field("_v", f.name, f.dataType.simpleString()).alias(f.name) if "window" not in f.name
                         else J.field("_v", f.name, "string").try_cast("timestamp_ntz").alias(f.name)
                         for f in AGG_SALES_WINDOWED.fields]) \
        .withColumn("inserted_at", F.current_timestamp().cast("timestamp_ntz"))
    return _consume(rows, "agg_consumer", Q.not_null_rules([f.name for f in AGG_SALES_WINDOWED.fields]), table_path,
                    checkpoint, trigger)


def _consume(rows: DataFrame, name: str, rules: dict, table_path: str, checkpoint: str, trigger: dict | None) -> Job:
    return Job(tuple(S.append_checked(rows, rules, table_path, rejects_of(table_path), checkpoint, name, trigger or DRAIN)))
