"""Reading the input tables and cutting lineage through the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows that go to Python together hold about this many bytes, however long texts are (a longer row goes alone).
HANDED_BYTES = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark so that any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A temporary folder is set only where a local session names none; on a cluster executors wouldn't see it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="surveyloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside sends rows to Python by bytes, not only by number: long texts would else fill the memory beside the heap."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(HANDED_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    The result has no lineage: a lost executor costs a reread of files, not a
    recomputation of what came before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with bounded_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if it only reads files, else written: a task that is run again then finds the same rows in the same order.

    Row numbers given by tasks rely on that.
    """
    return written(df, name) if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


def quoted(names: list[str]) -> list[str]:
    """Column names as expressions, whatever characters they hold."""
    return ["`" + n.replace("`", "``") + "`" for n in names]
