"""Where intermediate tables, sinks under test and stream checkpoints go.

This is the shared folder that the cluster names in ``spark.checkpoint.dir``.
Where that is unset, as in a bare local session, it is a folder of the
warehouse; on a cluster it must be set, as the warehouse may then lie on the
driver's own disk.

Tables of one application lie below one folder, so :func:`clear` removes them
together; :func:`discard` removes one that later steps no longer read.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this application."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/legweave-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of a result that several later steps read, so a lost
    executor re-reads files instead of recomputing the whole plan.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    settled = df.sparkSession.read.schema(df.schema).parquet(path)
    settled._settled_path = path
    return settled


def discard(*tables: DataFrame) -> None:
    """Remove tables of :func:`settle` that no DataFrame still in use reads."""
    for df in tables:
        _remove(df.sparkSession, df._settled_path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files that no DataFrame refers to any more.

    Spark does so when the driver collects its garbage, which a long job of
    large shuffles and few driver objects may not do for a while.
    """
    gc.collect()
    spark._jvm.System.gc()


def clear(spark: SparkSession) -> None:
    """Remove everything this application has left in the shared folder."""
    _remove(spark, shared_root(spark))


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
