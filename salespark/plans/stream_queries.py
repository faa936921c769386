"""Registered streaming queries.

Each one writes the derived raw topic (all of ``lineitem`` as JSON messages)
into a fresh folder under the shared checkpoint root, runs the streaming jobs
with an ``availableNow`` trigger, and returns the table they produced.  The raw topic is written as ``BATCHES``
sets of files and every job reads it in at least as many micro-batches, in arrival order, which is unlike the order
of event times.  The oracle of each is the batch SQL of the same operator: a stream drained to the
end must hold what the batch computation holds.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespark.operators import reports as R
from salespark.plans import oracle as O
from salespark.plans.queries import FACT_OUT, FACT_OUT_SQL, FK_DATE_END, FK_DATE_START, Query
from salespark.session import let_go, work_dir
from salespark.sources import dims as D
from salespark.sources import fixture as FX
from salespark.streaming import jobs as JB
from salespark.streaming import sinks as S
from salespark.streaming import stateful as ST
from salespark.streaming import topics as T

STREAM_QUERIES: dict[str, Query] = {}


def _register(name: str, sql: str | None, doc: str = ""):
    def wrap(fn):
        STREAM_QUERIES[name] = Query(name, fn, sql, doc)
        return fn
    return wrap


#: Sets of files on the raw topic; each becomes one micro-batch or more of every job.
BATCHES = 3


class Run:
    """Folders of one end-to-end run (topics, tables, checkpoints).  A job reads its topic in ``BATCHES`` micro-batches or
    one more, or in one for each file if there are fewer."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = work_dir(spark, name)
        self.raw = T.file_topic(T.RAW_TOPIC, self.root)
        self.valid = T.file_topic(T.VALID_TOPIC, self.root)
        self.invalid = T.file_topic(T.INVALID_TOPIC, self.root)
        self.alerts_topic = T.file_topic(T.ALERTS_TOPIC, self.root)
        self.agg_topic = T.file_topic(T.AGG_TOPIC, self.root)
        self.facts = f"{self.root}/tables/fact_sales"
        self.alerts = f"{self.root}/tables/anomaly_alerts"
        self.agg = f"{self.root}/tables/agg_sales_windowed"
        self.dims = f"{self.root}/tables/dims"
        self.consumer_facts = f"{self.root}/tables/fact_sales_consumer"
        self.consumer_alerts = f"{self.root}/tables/anomaly_alerts_consumer"
        self.consumer_agg = f"{self.root}/tables/agg_sales_windowed_consumer"

    def ckpt(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"

    def produce(self, sf: str, batches: int = BATCHES) -> None:
        """All events on the raw topic, in ``batches`` sets of files that follow each other in arrival order."""
        messages = FX.raw_messages(self.spark, sf)
        part = F.least(F.floor(F.col("ingest_key") / ((1 << 60) / batches)), F.lit(batches - 1))
        for k in range(batches):  # lineitem is scanned for each; the texts of a batch are made once and stored once
            T.write_batch(messages.filter(part == k), self.raw)

    def _run(self, start, topic: T.Topic, *args, ckpt: str, **more) -> None:
        files = len(T.read_batch(self.spark, topic).inputFiles())
        JB.run_to_end(start(self.spark, topic, *args, self.ckpt(ckpt), max_per_trigger=max(1, files // BATCHES), **more))
        let_go(self.spark)

    def etl(self, dims: bool = False) -> None:
        out = JB.EtlOutputs(self.valid, self.invalid, self.facts, self.dims if dims else None)
        self._run(JB.start_etl, self.raw, out, ckpt="etl")

    def store_dims(self) -> None:
        S.store_dims({"dim_user": D.dim_user(self.spark), "dim_product": D.dim_product(self.spark),
                      "dim_date": D.dim_date(self.spark, FK_DATE_START, FK_DATE_END)}, self.dims)

    def anomaly(self, with_topic: bool = False) -> None:
        self._run(JB.start_anomaly, self.invalid, self.alerts, ckpt="anomaly",
                  alerts_topic=self.alerts_topic if with_topic else None)

    def aggregation(self, time_col: str = "ingest_ts", with_topic: bool = False) -> None:
        self._run(JB.start_aggregation, self.valid, self.agg, ckpt="aggregation", time_col=time_col,
                  agg_topic=self.agg_topic if with_topic else None)

    def stateful_windows(self, clock: str) -> DataFrame:
        """Windows closed by ``clock`` over the valid topic: closed, late and open together."""
        files = len(T.read_batch(self.spark, self.valid).inputFiles())
        events = JB.valid_from_topic(T.read_stream(self.spark, self.valid, max(1, files // BATCHES)))
        paths = (self.agg, f"{self.agg}_late", self.ckpt(f"windows_{clock}"))
        q = ST.start_windows(events, *paths, clock=clock)
        (JB.run_to_end if clock == "event_time" else ST.run_to_idle)(q)
        return ST.all_windows(self.spark, *paths)

    def fact_consumer(self) -> None:
        self._run(JB.start_fact_consumer, self.valid, self.consumer_facts, ckpt="fact_consumer")

    def alert_consumer(self) -> None:
        self._run(JB.start_alert_consumer, self.alerts_topic, self.consumer_alerts, ckpt="alert_consumer")

    def agg_consumer(self) -> None:
        self._run(JB.start_agg_consumer, self.agg_topic, self.consumer_agg, ckpt="agg_consumer")

    def sql_etl(self) -> None:
        self._run(JB.start_sql_etl, self.raw, f"{self.root}/tables/fact_sale_sink", self.invalid, ckpt="sql_etl")


def run_pipeline(spark: SparkSession, sf: str, name: str) -> Run:
    r = Run(spark, name)
    r.produce(sf)
    r.etl()
    return r


@_register("sink_fact_upsert", O.facts_sql(f"SELECT {FACT_OUT_SQL} FROM fact_sales"),
           "streaming ETL: fact_sales written with ON CONFLICT DO NOTHING semantics")
def q_sink_fact_upsert(spark, sf):
    r = run_pipeline(spark, sf, "sink_fact_upsert")
    return S.read_facts(spark, r.facts).select(*FACT_OUT)


@_register("src_consumer_topics", O.facts_sql(f"SELECT {FACT_OUT_SQL} FROM fact_sales"),
           "fact consumer: valid topic -> fact_sales")
def q_src_consumer_topics(spark, sf):
    r = run_pipeline(spark, sf, "src_consumer_topics")
    r.fact_consumer()
    return S.read_facts(spark, r.consumer_facts).select(*FACT_OUT)


@_register("sink_error_skip", O.with_ctes(O.SALES_EVENTS, O.TAGGED, O.FACTS, O.ALERTS, select="""
SELECT 'fact_sales' AS table_name, count(*) AS rejected FROM fact_input WHERE ingest_key NOT IN (SELECT ingest_key FROM fact_rows)
UNION ALL SELECT 'anomaly_alerts', count(*) FROM anomaly_alerts WHERE sale_id IS NULL"""),
           "rows the jobs put aside because they break a table's contract")
def q_sink_error_skip(spark, sf):
    r = run_pipeline(spark, sf, "sink_error_skip")
    r.anomaly(with_topic=True)
    r.alert_consumer()
    paths = {"fact_sales": r.facts, "anomaly_alerts": r.consumer_alerts}
    parts = [spark.read.parquet(JB.rejects_of(p)).agg(F.count(F.lit(1)).alias("rejected"))
             .select(F.lit(t).alias("table_name"), "rejected") for t, p in paths.items()]
    return parts[0].union(parts[1])


# the whole contract of fact_sales by the name of each rule, in the order of the table's columns, its CHECKs and its keys
_CONTRACT_SQL = {**{f"{c}_not_null": f"{c} IS NOT NULL" for c in O.FACT_COLUMNS},
                 "quantity_positive": "quantity > 0", "unit_price_positive": "unit_price > 0", "total_amount_positive": "total_amount > 0",
                 "value_band_known": "value_band IN ('low', 'medium', 'high')", "sale_hour_range": "sale_hour BETWEEN 0 AND 23",
                 "sale_minute_range": "sale_minute BETWEEN 0 AND 59",
                 "user_id_in_dim_user": "user_id IN (SELECT 'U-' || lpad(CAST(i AS VARCHAR), 4, '0') FROM range(1, 101) t(i))",
                 "product_id_in_dim_product": "product_id IN (SELECT i FROM (FROM range(101, 107) UNION ALL FROM range(201, 208) "
                                              "UNION ALL FROM range(301, 306) UNION ALL FROM range(401, 407)) t(i))",
                 "date_id_in_dim_date": f"date_id BETWEEN DATE '{FK_DATE_START}' AND DATE '{FK_DATE_END}'"}


@_register("sink_fact_contract", O.facts_sql(f"""
SELECT ingest_key, sale_id, CASE WHEN violations = '' THEN 'stored' ELSE 'rejected' END AS outcome, violations
FROM (SELECT *, row_number() OVER (PARTITION BY sale_id, violations = '' ORDER BY ingest_key) AS rn FROM (
  SELECT *, array_to_string(list_filter([{', '.join(f"CASE WHEN NOT ({r}) THEN '{n}' END" for n, r in _CONTRACT_SQL.items())}],
                                        lambda x: x IS NOT NULL), ',') AS violations FROM fact_input))
WHERE violations <> '' OR rn = 1"""),
           "streaming ETL whose fact table has its whole contract (NOT NULL, CHECK, FOREIGN KEY): facts and rejects")
def q_sink_fact_contract(spark, sf):
    r = Run(spark, "sink_fact_contract")
    r.produce(sf)
    r.store_dims()
    r.etl(dims=True)
    rejects = spark.read.parquet(JB.rejects_of(r.facts))
    return S.read_facts(spark, r.facts).select("ingest_key", "sale_id", F.lit("stored").alias("outcome"), F.lit("").alias("violations")) \
        .union(rejects.select("ingest_key", "sale_id", F.lit("rejected"), F.array_join("violations", ",")))


@_register("split_multi_sink", O.tagged_sql("""
SELECT CASE WHEN error_reason IS NULL THEN 'valid-sales' ELSE 'invalid-sales-events' END AS topic,
       ingest_key, error_reason, value_band FROM tagged"""),
           "one tagged stream, its rows routed to the valid and the invalid topic by one query")
def q_split_multi_sink(spark, sf):
    r = run_pipeline(spark, sf, "split_multi_sink")

    def read(topic: T.Topic) -> DataFrame:
        return (T.read_batch(spark, topic)
                .select(F.lit(topic.name).alias("topic"), "ingest_key",
                        F.get_json_object("value", "$.error_reason").alias("error_reason"),
                        F.get_json_object("value", "$.value_band").alias("value_band")))
    return read(r.valid).unionByName(read(r.invalid))


@_register("sink_anomaly_coded", O.alerts_sql(
    "SELECT id, sale_id, anomaly_type, anomaly_code, event_timestamp, detected_at FROM anomaly_alerts"),
    "streaming anomaly job over the invalid topic")
def q_sink_anomaly_coded(spark, sf):
    r = run_pipeline(spark, sf, "sink_anomaly_coded")
    r.anomaly()
    return spark.read.parquet(r.alerts).select(
        "id", "sale_id", "anomaly_type", "anomaly_code", "event_timestamp", "detected_at")


@_register("sink_anomaly_consumer", O.alerts_sql("""
SELECT id, sale_id, anomaly_type, CAST(NULL AS INTEGER) AS anomaly_code, event_timestamp, detected_at
FROM anomaly_alerts WHERE sale_id IS NOT NULL"""), "alert consumer: alert topic -> table without the code")
def q_sink_anomaly_consumer(spark, sf):
    r = run_pipeline(spark, sf, "sink_anomaly_consumer")
    r.anomaly(with_topic=True)
    r.alert_consumer()
    return spark.read.parquet(r.consumer_alerts).select(
        "id", "sale_id", "anomaly_type", "anomaly_code", "event_timestamp", "detected_at")


WINDOW_OUT = ["window_start", "window_end", "sale_count", "total_revenue", "avg_order_value"]
_WINDOWS_SELECT = f"SELECT {', '.join(WINDOW_OUT)} FROM agg_sales_windowed"


@_register("window_sliding", O.windows_sql(_WINDOWS_SELECT),
           "streaming 30 s / 10 s windows on event time, merged from the partial rows of many batches")
def q_window_sliding(spark, sf):
    r = run_pipeline(spark, sf, "window_sliding")
    r.aggregation("event_ts")
    return JB.log_windows(spark, r.agg)


@_register("sink_agg_job", O.windows_sql(_WINDOWS_SELECT, "ingest_ts"),
           "the aggregation job as the original runs it: arrival clock, no watermark")
def q_sink_agg_job(spark, sf):
    r = run_pipeline(spark, sf, "sink_agg_job")
    r.aggregation()
    return JB.log_windows(spark, r.agg)


@_register("watermark", O.windows_sql(_WINDOWS_SELECT),
           "windows closed by the watermark: those closed, the late rows' table and those still open hold every event")
def q_watermark(spark, sf):
    return run_pipeline(spark, sf, "watermark").stateful_windows("event_time")


@_register("processing_time_close", O.windows_sql(_WINDOWS_SELECT, "ingest_ts"),
           "windows closed by the clock: a backlog is closed as it is read, what has not ended stays open")
def q_processing_time_close(spark, sf):
    return run_pipeline(spark, sf, "processing_time_close").stateful_windows("processing_time")


@_register("chained_jobs", O.facts_sql("""
SELECT value_band, CAST(sum(total_amount) AS DECIMAL(22,2)) AS revenue, count(*) AS cnt
FROM fact_sales GROUP BY value_band"""), "job -> topic -> job chain, then the band report over the stored table")
def q_chained_jobs(spark, sf):
    r = run_pipeline(spark, sf, "chained_jobs")
    r.fact_consumer()
    return R.revenue_by_band(S.read_facts(spark, r.consumer_facts))


@_register("src_table_scan", O.with_ctes(O.SALES_EVENTS, O.TAGGED, O.FACTS, O.ALERTS, O.window_cte("ingest_ts"), select="""
SELECT 'revenue' AS panel, date_trunc('minute', event_timestamp) AS time, CAST(sum(total_amount) AS DECIMAL(22,2)) AS amount
FROM fact_sales GROUP BY 2
UNION ALL SELECT 'anomalies', date_trunc('minute', detected_at), CAST(count(*) AS DECIMAL(22,2)) FROM anomaly_alerts GROUP BY 2
UNION ALL SELECT 'latest_window', max(window_end), arg_max(total_revenue, window_end) FROM agg_sales_windowed"""),
           "dashboard panels over the three stored tables")
def q_src_table_scan(spark, sf):
    r = run_pipeline(spark, sf, "src_table_scan")
    r.anomaly()
    r.aggregation()
    money = "decimal(22,2)"
    facts = R.revenue_by_minute(S.read_facts(spark, r.facts)).select(F.lit("revenue").alias("panel"), "time", F.col("revenue").cast(money).alias("amount"))
    alerts = R.anomalies_by_minute(spark.read.parquet(r.alerts)).select(F.lit("anomalies"), "time", F.col("anomalies").cast(money))
    window = R.latest_window(JB.log_windows(spark, r.agg)).select(F.lit("latest_window"), "window_end", "total_revenue")
    return facts.union(alerts).union(window)


@_register("sink_agg_consumer", O.windows_sql(_WINDOWS_SELECT, "ingest_ts"),
           "aggregate topic -> consumer table, one row per window (inserted_at, a wall clock, is left out)")
def q_sink_agg_consumer(spark, sf):
    r = run_pipeline(spark, sf, "sink_agg_consumer")
    r.aggregation(with_topic=True)
    r.agg_consumer()
    return JB.windows(spark, r.consumer_agg)


def _sql_run(spark, sf, name):
    r = Run(spark, name)
    r.produce(sf)
    r.sql_etl()
    return r


@_register("sink_jdbc_fact", O.sql_dialect(f"""
SELECT sale_id, user_id, product_id, CAST(ts AS DATE) AS date_id, quantity, unit_price, total_amount,
  CASE WHEN total_amount < 50 THEN 'low' WHEN total_amount < 200 THEN 'medium' ELSE 'high' END AS value_band,
  CAST(hour(ts) AS INTEGER) AS sale_hour, CAST(minute(ts) AS INTEGER) AS sale_minute,
  dayname(ts) AS day_of_week, ts AS event_timestamp
FROM sql_src WHERE {O.SQL_OK}"""), "streaming SQL job: fact branch into the fact table (append)")
def q_sink_jdbc_fact(spark, sf):
    r = _sql_run(spark, sf, "sink_jdbc_fact")
    return spark.read.parquet(f"{r.root}/tables/fact_sale_sink")


@_register("sink_kafka_typed", O.sql_dialect(f"""
SELECT ingest_key, sale_id, {O.SQL_REASON} AS error_reason
FROM sql_src WHERE NOT {O.SQL_OK}"""), "streaming SQL job: invalid branch as JSON on a topic")
def q_sink_kafka_typed(spark, sf):
    r = _sql_run(spark, sf, "sink_kafka_typed")
    return T.read_batch(spark, r.invalid).select(
        "ingest_key", F.get_json_object("value", "$.sale_id").alias("sale_id"),
        F.get_json_object("value", "$.error_reason").alias("error_reason"))


def query_map() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.run for k, q in STREAM_QUERIES.items()}


def oracle_map() -> dict[str, str]:
    return {k: q.sql for k, q in STREAM_QUERIES.items() if q.sql is not None}
