"""Run one streaming job, or all (what ``spark-submit`` would launch on a cluster).

    python -m salespark etl         --root <shared folder> [--bootstrap host:port]
    python -m salespark anomaly     --root ...
    python -m salespark aggregation --root ... [--time event_ts]
    python -m salespark sql-etl     --root ...
    python -m salespark fact-consumer / alert-consumer / agg-consumer --root ...
    python -m salespark all         --root ...      the pipeline: every job but sql-etl, together; a failed one is restarted

Topics are Kafka when ``--bootstrap`` is given, else parquet message folders
under ``--root``.  Tables and checkpoints live under ``--root`` (default: the
session's ``spark.checkpoint.dir``).  ``--once`` drains what is there
(availableNow) and exits; otherwise the job runs with a processing-time
trigger (``--every``, default 60 seconds) until stopped.
"""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import SparkSession

from salespark.session import build_session, checkpoint_root
from salespark.streaming import jobs as JB
from salespark.streaming import topics as T

# writers of a topic before its readers
PIPELINE = ("etl", "anomaly", "aggregation", "fact-consumer", "alert-consumer", "agg-consumer")
JOBS = (*PIPELINE, "sql-etl", "all")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="salespark")
    ap.add_argument("job", choices=JOBS)
    ap.add_argument("--root", help="shared folder for tables, topics and checkpoints")
    ap.add_argument("--bootstrap", help="Kafka bootstrap servers (else file topics)")
    ap.add_argument("--starting-offsets", help="of a new job on Kafka (default: latest for sql-etl, else earliest)")
    ap.add_argument("--time", default="ingest_ts", choices=("event_ts", "ingest_ts"),
                    help="aggregation clock: event time or arrival time")
    ap.add_argument("--jdbc-url", help="sql-etl: database that takes the facts (else a table under --root)")
    ap.add_argument("--jdbc-table", default="fact_sales")
    ap.add_argument("--once", action="store_true", help="drain available data and stop")
    ap.add_argument("--every", default="60 seconds", help="processing-time trigger interval")
    ap.add_argument("--max-per-trigger", type=int, default=None)
    a = ap.parse_args(argv)

    spark = build_session()
    root = (a.root or checkpoint_root(spark)).rstrip("/")

    if a.job != "all":
        return JB.run_to_end(start(spark, a.job, a, root))
    if a.once:  # a reader's turn comes when its topic is complete
        for job in PIPELINE:
            JB.run_to_end(start(spark, job, a, root))
    else:
        JB.supervise({job: partial(start, spark, job, a, root) for job in PIPELINE})


def start(spark: SparkSession, job: str, a: argparse.Namespace, root: str) -> JB.Job:
    def topic(name: str) -> T.Topic:
        if a.bootstrap:
            first = a.starting_offsets or ("latest" if job == "sql-etl" else "earliest")
            return T.kafka_topic(name, a.bootstrap, first, group_id=f"salespark-{job}")
        return T.file_topic(name, root, "sql-etl" if job == "sql-etl" and name == T.INVALID_TOPIC else None)

    tables, ckpt = f"{root}/tables", f"{root}/checkpoints/{job}"
    more = {"trigger": {"availableNow": True} if a.once else {"processingTime": a.every}, "max_per_trigger": a.max_per_trigger}
    if job == "etl":
        out = JB.EtlOutputs(topic(T.VALID_TOPIC), topic(T.INVALID_TOPIC), f"{tables}/fact_sales")
        return JB.start_etl(spark, topic(T.RAW_TOPIC), out, ckpt, **more)
    if job == "anomaly":
        return JB.start_anomaly(spark, topic(T.INVALID_TOPIC), f"{tables}/anomaly_alerts", ckpt,
                                alerts_topic=topic(T.ALERTS_TOPIC), **more)
    if job == "aggregation":
        return JB.start_aggregation(spark, topic(T.VALID_TOPIC), f"{tables}/agg_sales_windowed", ckpt,
                                    time_col=a.time, agg_topic=topic(T.AGG_TOPIC), **more)
    if job == "sql-etl":
        return JB.start_sql_etl(spark, topic(T.RAW_TOPIC), f"{tables}/fact_sale_sink",
                                topic(T.INVALID_TOPIC), ckpt, **more,
                                jdbc=(a.jdbc_url, a.jdbc_table, {}) if a.jdbc_url else None)
    if job == "fact-consumer":
        return JB.start_fact_consumer(spark, topic(T.VALID_TOPIC), f"{tables}/fact_sales_consumer", ckpt, **more)
    if job == "alert-consumer":
        return JB.start_alert_consumer(spark, topic(T.ALERTS_TOPIC), f"{tables}/anomaly_alerts_consumer", ckpt, **more)
    return JB.start_agg_consumer(spark, topic(T.AGG_TOPIC), f"{tables}/agg_sales_windowed_consumer", ckpt, **more)


if __name__ == "__main__":
    main()
