"""Table scans (parquet).  Callers select columns right after the read, so
Catalyst prunes the scan's ReadSchema and pushes filters into it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


#: Session setting: the number of partitions that row-heavy work (JSON, regex) is dealt over after a scan.  Off (unset)
#: on a cluster, where a large table has many splits; ``bench.py`` and local runs set it, because a table stored
#: as one parquet row group is otherwise read, parsed and validated by one task.
INPUT_PARTITIONS = "spark.salespark.input.partitions"


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over ``INPUT_PARTITIONS`` partitions if the session sets that, else as it was scanned."""
    n = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n)) if n else df
