"""Topics: where jobs read and write JSON messages.

A topic is either Kafka (production; needs the spark-sql-kafka package on the
classpath) or a folder of parquet message files (local runs and tests; the
Kafka connector is not installed here).  Both give the same message columns:

* ``value``      JSON text
* ``ingest_ts``  arrival clock (Kafka record timestamp), TIMESTAMP_NTZ
* ``ingest_key`` arrival order used for first-arrival-wins decisions.  For Kafka it is the record's
                 time in milliseconds, then the partition, then the offset, in one number; it is
                 unique while a partition takes fewer than 65,536 records in a millisecond.  Records are
                 written with the sale id as their key, so all copies of a sale share a partition.  Partitions count
                 modulo 64: beyond 64 of them two records of one millisecond may share a key, and first-wins falls to
                 the columns that follow it.

The file topics of one job are one folder, split by ``topic=<name>``, that one streaming query writes through Spark's file
sink: its log in the folder lists the files of committed micro-batches, and readers of the folder, batch or stream, see
those files only.  A replayed micro-batch is skipped by that log.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST
from pyspark.sql.streaming import StreamingQuery

from salespark.schemas import TOPIC_MESSAGE
from salespark.session import compiled, open_files

# Topic names of the pipeline.
RAW_TOPIC = "sales-events"
VALID_TOPIC = "valid-sales"
INVALID_TOPIC = "invalid-sales-events"
ALERTS_TOPIC = "anomaly-alerts"
AGG_TOPIC = "agg-sales-windowed"

#: The job that writes each topic: its file topics share a folder.
WRITERS = {RAW_TOPIC: "producer", VALID_TOPIC: "etl", INVALID_TOPIC: "etl", ALERTS_TOPIC: "anomaly", AGG_TOPIC: "aggregation"}
#: JSON messages repeat their keys and much of their values; a stronger code than Parquet's usual one stores them in less space.
COMPRESSION = "zstd"
FILE_MESSAGE = ST.StructType([*TOPIC_MESSAGE.fields, ST.StructField("topic", ST.StringType())])


@dataclass(frozen=True)
class Topic:
    name: str
    kind: str = "files"                 # "files" or "kafka"
    path: str | None = None             # the writing job's folder of message files (kind="files")
    bootstrap: str | None = None        # kafka bootstrap servers (kind="kafka")
    starting_offsets: str = "earliest"  # jobs: earliest; the SQL job: latest
    options: dict = field(default_factory=dict)


def read_stream(spark: SparkSession, topic: Topic, max_per_trigger: int | None = None) -> DataFrame:
    """Streaming messages of a topic."""
    compiled(spark)
    if topic.kind == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", topic.bootstrap)
             .option("subscribe", topic.name)
             .option("startingOffsets", topic.starting_offsets))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        for k, v in topic.options.items():
            r = r.option(k, v)
        return kafka_columns(r.load())
    create(spark, topic)
    r = spark.readStream.schema(FILE_MESSAGE)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    return _messages_of(r.parquet(topic.path), topic)


def read_batch(spark: SparkSession, topic: Topic) -> DataFrame:
    """All messages currently in a topic (a bounded read)."""
    if topic.kind == "kafka":
        df = (spark.read.format("kafka").option("kafka.bootstrap.servers", topic.bootstrap)
              .option("subscribe", topic.name).option("startingOffsets", "earliest").load())
        return kafka_columns(df)
    return _messages_of(spark.read.schema(FILE_MESSAGE).parquet(topic.path), topic)


def create(spark: SparkSession, topic: Topic) -> None:
    """The folder of a file topic, empty, if it is not there: a reader may start before the writer."""
    if topic.kind == "files":
        spark.createDataFrame([], FILE_MESSAGE).write.mode("ignore").partitionBy("topic").parquet(topic.path)


def _messages_of(files: DataFrame, topic: Topic) -> DataFrame:
    return files.filter(F.col("topic") == topic.name).drop("topic")


def kafka_columns(df: DataFrame) -> DataFrame:
    """The message columns, and ``partition`` for the spread check."""
    millis = F.shiftleft(F.unix_millis(F.col("timestamp")), 22)
    part = F.shiftleft(F.pmod(F.col("partition").cast("bigint"), F.lit(64)), 16)
    return df.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").cast("timestamp_ntz").alias("ingest_ts"),
        millis.bitwiseOR(part).bitwiseOR(F.pmod(F.col("offset"), F.lit(65_536))).alias("ingest_key"),
        "partition")


def write_batch(messages: DataFrame, topic: Topic, key: str | None = None) -> None:
    """Append a static frame of messages (``value``, ``ingest_ts``, ``ingest_key``) to a topic, as a producer does.  ``key``: the
    column that becomes the Kafka record's key."""
    if topic.kind == "kafka":
        (_kafka_records(messages.withColumn("topic", F.lit(topic.name)), key).write.format("kafka")
            .option("kafka.bootstrap.servers", topic.bootstrap).save())
        return
    open_files(messages.sparkSession)
    (messages.select("value", "ingest_ts", "ingest_key", F.lit(topic.name).alias("topic"))
        .write.mode("append").option("compression", COMPRESSION).partitionBy("topic").parquet(topic.path))


def start_writer(messages: DataFrame, topic: Topic, checkpoint: str, query_name: str, trigger: dict, key: str | None = None) -> StreamingQuery:
    """Write streaming messages (``value``, ``ingest_ts``, ``ingest_key`` and the name of each row's ``topic``) where ``topic`` lives:
    its Kafka servers, or its folder of message files, which belongs to this query alone.

    Files: exactly once, by the file sink's own log.  Kafka is at-least-once (as the original sinks): a replayed batch is sent
    again, and readers that must count it once have to drop repeated keys."""
    if topic.kind == "kafka":
        w = (_kafka_records(messages, key).writeStream.format("kafka").option("kafka.bootstrap.servers", topic.bootstrap))
    else:
        open_files(messages.sparkSession)
        w = (messages.select("value", "ingest_ts", "ingest_key", "topic").writeStream.format("parquet")
             .option("compression", COMPRESSION).partitionBy("topic").option("path", topic.path))
    return w.queryName(query_name).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _kafka_records(messages: DataFrame, key: str | None) -> DataFrame:
    columns = ["value", "topic"]
    return messages.select(*columns if key is None else [F.col(key).cast("string").alias("key"), *columns])


def file_topic(name: str, root: str, writer: str | None = None) -> Topic:
    """``writer``: the job that writes it, if not the usual one."""
    return Topic(name=name, kind="files", path=f"{root.rstrip('/')}/topics/{writer or WRITERS[name]}")


def kafka_topic(name: str, bootstrap: str, starting_offsets: str = "earliest",
                group_id: str | None = None) -> Topic:
    opts = {"kafka.group.id": group_id} if group_id else {}
    return Topic(name=name, kind="kafka", bootstrap=bootstrap,
                 starting_offsets=starting_offsets, options=opts)
