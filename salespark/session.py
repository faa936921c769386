"""Session construction and the shared work folder.

Jobs write intermediate tables and streaming checkpoints under the folder the
cluster names in ``spark.checkpoint.dir`` (a shared file system on a real
cluster).  Only when the session has none -- local tests -- do we create one.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; every one can be overridden by the caller.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a micro-batch or stage should not fail because one executor died
    "spark.task.maxFailures": "4",
    # see ``compiled``
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # see ``open_files``
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # JSON objects with a repeated key parse with the last value (as json.loads)
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Settings for a large cluster run (pass as ``extra`` to build_session).

    * shuffles start at 4 partitions per core and AQE coalesces them to about
      128 MB each (and splits skewed join partitions), so no stage holds more
      than a partition's worth of rows per task in memory;
    * window state lives in RocksDB on the executors' local disks, with
      changelog checkpoints to the shared checkpoint folder, so state size is
      not bounded by executor heap and a lost executor's state is restored;
    * scans split files into 256 MB input partitions."""
    return {
        "spark.sql.shuffle.partitions": str(4 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def build_session(master: str | None = None, app: str = "salespark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local["):
        # local runs read small tables: see sources.tables.INPUT_PARTITIONS
        conf["spark.salespark.input.partitions"] = str(shuffle_partitions or 8)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compiled(spark: SparkSession) -> None:
    """Let wide row-by-row stages run as machine code, whatever session runs them.

    The JVM never compiles a method of more than 8,000 bytes, and Spark by default generates such: one of them for a whole stage that
    parses and tags events, which is then interpreted for every row.  With this limit a stage whose code is larger runs as
    split projections, which are compiled.  Streaming queries take the setting with them when they start."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", DEFAULT_CONF["spark.sql.codegen.hugeMethodLimit"])


def open_files(spark: SparkSession) -> None:
    """Let a task that deals rows over a few folders (topics, parts, months) keep a file open in each, not sort the rows by folder
    first; beyond this many folders it sorts.  Streaming queries take the setting with them when they start."""
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    spark.conf.set(conf, DEFAULT_CONF[conf])


def let_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage, between steps of many jobs each.

    Spark deletes the shuffle files, broadcast blocks and checkpoints of tables that nothing refers to any more when the driver's JVM
    has collected them, not before; and the JVM grows its heap up to the limit with plans and events of jobs that are over,
    rather than collect what little is still in use."""
    gc.collect()  # Python's references keep objects of the JVM
    spark.sparkContext._jvm.System.gc()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from the session (``SparkContext.getCheckpointDir`` or the
    ``spark.checkpoint.dir`` setting).  If unset and the session is local (as
    in tests) a fresh folder is created and registered; on a cluster an unset
    folder is an error, because a machine-local folder would not survive the
    loss of an executor.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="salespark-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one run of one job."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/salespark/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme (for tests that look at files directly)."""
    if uri.startswith("file:"):
        uri = uri[len("file:"):]
        while uri.startswith("//"):
            uri = uri[1:]
    return os.path.abspath(uri)
