"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salespark.session import checkpoint_root, let_go, work_dir  # noqa: F401 (let_go: for the operators)

#: the ASCII letters that every text contract lower-cases (and no others)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Rows for each file of a small table.
FILE_ROWS = 100_000


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cut the lineage: an eager, reliable checkpoint in the folder that the
    session names in ``spark.checkpoint.dir`` (survives a lost executor).

    ``rows``: a bound on the number of rows where one is known; the table then has a file for each ``FILE_ROWS`` of them
    and not one for each shuffle partition."""
    checkpoint_root(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    return df.checkpoint(eager=True)


def unsized(df: DataFrame) -> DataFrame:
    """A checkpointed table without the size that Spark has worked out for it, for tables made of themselves again and again.

    Spark takes a join to be as large as the product of its sides, and a checkpoint keeps that number: each join of a loop doubles its
    digits, until after some twenty the number alone fills the driver's memory."""
    spark, plan = df.sparkSession, df._jdf.queryExecution()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(plan.toRdd(), df._jdf.schema(), False), spark)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows (counted here), else as it is, to be joined by a
    shuffle.  ``df`` should be a checkpointed table of a few narrow columns."""
    return F.broadcast(df) if df.count() <= rows else df


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once for each row.  A lambda that
    names a computed column directly may have the computation inlined by the optimizer, and
    then repeats it for every element."""
    return F.transform(F.array(value), use)[0]


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage through a Parquet table in the session's shared folder: smaller than a checkpoint where
    the rows are many, and read column by column."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(text, UPPER, UPPER.lower())


def crc_mod(col: Column, m: int) -> Column:
    """crc32 of the value's decimal text, modulo m (the hold-out rule)."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(m)


def on_workers(spark: SparkSession) -> None:
    """Let the Python workers find this package where the driver found it, whatever folder the session was started in.
    (Where executors have other folders, install the package there or pass it with --py-files.)"""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*paths, root])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
