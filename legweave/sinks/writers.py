"""Writing results: partitioned datasets, tables, logs and retention."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legweave.scratch import settle
from legweave.sources.tables import check_format, delete, exists, manifest

SECONDS_PER_DAY = 86_400
RETENTION_DAYS = 7


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = ()) -> None:
    """Parquet partitioned by ``by``, replacing only the partitions present in ``df``.

    Rows are rebalanced by partition value: each value gets few files, and one
    that holds a large share of the rows is split over several tasks by its
    measured size.  Rows are sorted inside a task so row-group statistics skip.
    """
    by = list(by)
    (
        df.hint("rebalance", *[F.col(b) for b in by])
        .sortWithinPartitions(*by, *sort)
        .write.partitionBy(*by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def write_format(df: DataFrame, path: str, fmt: str, mode: str = "overwrite") -> None:
    writer = df.write.format(check_format(fmt)).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Adds rows to a CSV dataset, creating it when absent; nothing is rewritten."""
    write_format(df, path, "csv", "append")


def write_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> None:
    """Replaces (overwrite) or extends (append) a catalog table."""
    writer = df.write.mode(mode).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def refresh_table(frames: Sequence[DataFrame], name: str, path: str | None = None) -> None:
    """Replaces a table by the union of the frames in one write.

    Readers never see the first frame alone.
    """
    if not frames:
        return
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    write_table(union, name, "overwrite", path)


def stamp_version(df: DataFrame, epoch_seconds: int) -> DataFrame:
    return df.withColumn("lastUpdated", F.lit(epoch_seconds).cast("long"))


def retained(df: DataFrame, now: int, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows not older than ``days`` before the epoch second ``now``."""
    return df.filter(F.col("lastUpdated") >= now - days * SECONDS_PER_DAY)


def retention_counts(df: DataFrame, now: int, days: int = RETENTION_DAYS) -> DataFrame:
    """One row: rows before, deleted and left."""
    old = F.col("lastUpdated") < now - days * SECONDS_PER_DAY
    return df.agg(
        F.count("*").alias("initial_rows"),
        F.count_if(old).alias("deleted_rows"),
        (F.count("*") - F.count_if(old)).alias("remaining_rows"),
    )


def delete_old_versions(spark: SparkSession, path: str, now: int, days: int = RETENTION_DAYS) -> DataFrame:
    """Deletes the version partitions older than ``days`` and returns :func:`retention_counts` as of before.

    The table is partitioned by ``lastUpdated``, so nothing is rewritten.
    """
    counts = settle(retention_counts(spark.read.parquet(path), now, days), "retention")
    for version in manifest(spark, path, ["lastUpdated"]).collect():  # one row per version
        if int(version["lastUpdated"]) < now - days * SECONDS_PER_DAY:
            delete(spark, f"{path}/lastUpdated={version['lastUpdated']}")
    return counts


def append_run(rows: DataFrame, path: str, run: int) -> None:
    """Writes one run's rows as its own partition; repeating a run replaces it, so a retry adds nothing twice."""
    (
        rows.withColumn("run", F.lit(run).cast("long"))
        .write.partitionBy("run")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def append_ledger(failed: DataFrame, path: str, run: int, key: str = "filepath") -> None:
    """Adds the keys of one run's failed work to the ledger."""
    append_run(failed.select(key).distinct(), path, run)


def reset_ledger(spark: SparkSession, path: str) -> None:
    """Empties the ledger, as a run that has come to its end does."""
    delete(spark, path)


def read_ledger(spark: SparkSession, path: str, key: str = "filepath") -> DataFrame:
    """The distinct keys of the ledger; none where nothing has failed yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{key} string")
    return spark.read.schema(f"{key} string, run long").parquet(path).select(key).distinct()


def compact_ledger(spark: SparkSession, path: str, run: int, key: str = "filepath") -> None:
    """Gathers the keys of all runs up to ``run`` in the partition of ``run``, then removes the earlier ones.

    A crash between the two leaves keys twice, which readers and a later
    compaction do not mind; it never leaves one out.
    """
    if not exists(spark, path):
        return
    kept = settle(spark.read.schema(f"{key} string, run long").parquet(path).filter(F.col("run") <= run), "ledger")
    append_run(kept.select(key).distinct(), path, run)
    for earlier in kept.filter(F.col("run") < run).select("run").distinct().collect():  # one row per run
        delete(spark, f"{path}/run={earlier['run']}")


def append_alerts(alerts: DataFrame, path: str, run: int) -> None:
    """Writes one run's alerts as its own partition of the log."""
    append_run(alerts, path, run)


def replace_view(df: DataFrame, name: str, root: str) -> str:
    """Writes a new version below ``root``, then points the view ``name`` at it; returns the version's path.

    The view is switched in one catalog operation once the files are complete,
    so readers see the old version until then, and keep it if the write fails.
    """
    path = f"{root}/version={uuid.uuid4().hex}"
    df.write.parquet(path)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT * FROM parquet.`{path}`")
    return path


def replace_by_union(frames: Sequence[DataFrame], name: str, root: str) -> str | None:
    """:func:`replace_view` by the union of the frames, absent columns null."""
    if not frames:
        return None
    return replace_view(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), name, root)
