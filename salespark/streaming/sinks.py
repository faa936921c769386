"""Table sinks.

* ``append_stream`` -- a stream as it is, through Spark's file sink: the log it keeps in the folder makes the table exactly once.
* ``append_checked`` -- the same for the rows that break no rule; the others go to a side table with the names of the rules.
* ``upsert_first_wins`` -- ``INSERT ... ON CONFLICT (sale_id) DO NOTHING``, inside ``foreachBatch``: rows that break the table's
  contract go to a side table; of the others the first arrival of each sale id that is not stored yet is added.
* ``write_part`` -- what ``foreachBatch`` computes from a micro-batch, as the partition ``batch_id=N``.
* ``jdbc_append`` -- the PostgreSQL form (``df.write.jdbc``), one JDBC batch per
  task instead of a connection and commit per row.

``write_part`` overwrites its partition, and what is written there is a function of the micro-batch and of the partitions
before it.  So a replay puts the same rows in the same place, and a batch that failed half way is completed.  Tables
written so are read by batch jobs only; what other streams read goes through the file sink.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salespark.operators import facts as FA
from salespark.operators import quality as Q
from salespark.schemas import FACT_SALES

# Keys of one micro-batch up to this many (counted) are broadcast to the stored table's scan.
BROADCAST_KEYS = 2_000_000


def create_table_if_not_exists(spark: SparkSession, path: str, schema, partition_by: list[str] | None = None) -> bool:
    """``CREATE TABLE IF NOT EXISTS`` for a path-based parquet table: an empty table with the schema where nothing is there.
    Returns whether it was made."""
    try:
        spark.read.schema(schema).parquet(path)
        return False
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    w = spark.createDataFrame([], schema).write.mode("ignore")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return True


def read_facts(spark: SparkSession, path: str, before_batch: int | None = None) -> DataFrame:
    """The stored fact table, or what batches before ``before_batch`` stored (``sale_month`` and ``batch_id`` are its partition columns)."""
    if before_batch is None:
        return spark.read.schema(FACT_SALES).parquet(path)
    parts = T.StructType([*FACT_SALES.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(parts).parquet(path).filter(F.col("batch_id") < before_batch)


def write_part(df: DataFrame, path: str, batch_id: int, partition_by: str | None = None, rebalance: bool = True) -> None:
    """Store ``df`` as the partition ``batch_id`` of the table, in place of what a failed run of the batch left there.

    REBALANCE lets adaptive execution size the files: about one for each touched value of
    ``partition_by``, more for a value with a large share of the batch.  It is a shuffle; rows that come from an aggregate's
    (``rebalance=False``) have their files sized by that one."""
    if rebalance:
        df = df.hint("rebalance", partition_by) if partition_by else df.hint("rebalance")
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(f"{path}/batch_id={batch_id}")


def not_stored(new: DataFrame, stored: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """The rows of ``new`` whose sale id is not in ``stored``.

    The batch's keys are broadcast to the scan of the stored key column, so the stored table is neither shuffled
    nor sorted; what comes back are the ids in both, at most one per row of the batch.  A batch with more
    than ``broadcast_keys`` keys (a backfill) is joined by a shuffle instead."""
    keys = stored.select("sale_id")
    if new.count() > broadcast_keys:
        return new.join(keys, "sale_id", "left_anti")
    both = keys.join(F.broadcast(new.select("sale_id")), "sale_id", "left_semi").distinct()
    return new.join(both, "sale_id", "left_anti")


def store_dims(dims: dict[str, DataFrame], path: str, mode: str = "errorifexists") -> None:
    """Store dimensions as ``path/<name>``; ``mode="append"`` adds rows to those that are there."""
    for name, rows in dims.items():
        rows.write.mode(mode).parquet(f"{path}/{name}")


def read_dims(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The stored dimensions as they are now: called in each micro-batch, it sees rows that were added since the last."""
    return {name: spark.read.parquet(f"{path}/{name}") for name in Q.FOREIGN_KEYS.values()}


def upsert_first_wins(rows: DataFrame, path: str, rejects_path: str, batch_id: int, dims_path: str | None = None) -> None:
    """Store the new sales of a batch of typed fact rows (``facts.fact_rows``), and the rejected ones.  With ``dims_path`` rows must
    meet the CHECK rules and have their dimensions' rows too, not the NOT NULL columns alone.  The table exists
    (``create_table_if_not_exists``)."""
    spark = rows.sparkSession
    ok, bad = FA.by_contract(rows) if dims_path is None else FA.by_table_contract(rows, read_dims(spark, dims_path))
    write_part(bad, rejects_path, batch_id)
    new = FA.first_wins(ok).select(*[f.name for f in FACT_SALES.fields]).persist()
    try:
        # Partitioned by month: date filters prune months and then row groups by
        # the date_id min/max statistics; a day per partition would leave one small
        # file per day and batch.
        add = not_stored(new, read_facts(spark, path, batch_id))
        write_part(add.withColumn("sale_month", F.trunc("date_id", "month")), path, batch_id, "sale_month")
    finally:
        new.unpersist()


def append_stream(df: DataFrame, path: str, checkpoint: str, query_name: str, trigger: dict) -> StreamingQuery:
    """The table at ``path`` belongs to this query alone; rows appear in it with the commit of their micro-batch."""
    return (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .queryName(query_name).trigger(**trigger).start())


def append_checked(df: DataFrame, rules: dict, path: str, rejects_path: str, checkpoint: str, query_name: str,
                   trigger: dict) -> list[StreamingQuery]:
    """The rows that break none of the rules, and in the side table the others with the rules' names: one query each."""
    ok, bad = Q.split_by_rules(df, rules)
    return [append_stream(ok, path, f"{checkpoint}/rows", query_name, trigger),
            append_stream(bad, rejects_path, f"{checkpoint}/rejects", f"{query_name}_rejects", trigger)]


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict) -> None:
    df.write.jdbc(url=url, table=table, mode="append", properties=properties)


def console(df: DataFrame, checkpoint: str, trigger: dict | None = None):
    """Print sink (``'connector' = 'print'``)."""
    w = (df.writeStream.format("console").option("truncate", False)
           .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
