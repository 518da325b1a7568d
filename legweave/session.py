"""Session settings the operators rely on.

Everything here is a runtime SQL setting, so :func:`tune` also works on a
session that a cluster's launcher already created.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Calendar arithmetic and epoch conversions are defined in UTC; New York
    # time is always converted by zone name.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Re-running a plan must replace only the partitions it produced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

ESTIMATED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
OWN_LIMIT = "spark.legweave.ownBroadcastLimit"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that results or plan quality depend on."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    own = spark.conf.get(OWN_LIMIT, None)
    if own:  # what broadcast_by_measure has changed
        spark.conf.set(ESTIMATED, own)
        if spark.conf.get(MEASURED, None) == own:
            spark.conf.unset(MEASURED)
        spark.conf.unset(OWN_LIMIT)
    return spark


def broadcast_by_measure(spark: SparkSession) -> SparkSession:
    """From now on a join broadcasts a side by its size at run time only; the session's limit stays, :func:`tune` goes back.

    Estimates come from the sizes of files.  A settled table of few distinct
    values is a hundred times larger in memory, and exploded rows are not
    counted at all, so a side of gigabytes would pass for a small one and end
    the driver.
    """
    limit = spark.conf.get(ESTIMATED)
    if limit != "-1":
        spark.conf.set(OWN_LIMIT, limit)
        if spark.conf.get(MEASURED, None) is None:
            spark.conf.set(MEASURED, limit)
        spark.conf.set(ESTIMATED, "-1")
    return spark


def local_session(app: str = "legweave", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench, with a shared folder of its own."""
    shared = os.path.join(tempfile.gettempdir(), f"legweave-shared-{os.getpid()}")
    return tune(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .getOrCreate()
    )
