"""The tail of the equity snapshot: contract, scores, versions and retention."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from legweave.operators.gates import Watch, key_of, nulls_in
from legweave.plans.features import MODEL_FEATURES, SCORE_KEYS, require_features, scores_back
from legweave.sinks.writers import delete_old_versions, stamp_version, write_partitioned

# Fixed value: days that versions of the snapshot are kept.
KEPT_DAYS = 30
ROW_KEYS = [*SCORE_KEYS, "trade_date"]


def contract_watch(wanted: Sequence[str] = MODEL_FEATURES) -> Watch:
    """Counts the nulls of every model input."""
    return Watch(nulls_in(wanted, key_of(*ROW_KEYS)))


def scored_snapshot(
    snapshot: DataFrame,
    frame: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    version: int,
    watch: Watch | None = None,
    wanted: Sequence[str] = MODEL_FEATURES,
) -> DataFrame:
    """Every row of ``snapshot`` with its scores and label, stamped with the run's version.

    ``frame`` must have all inputs of the model, or it is an error; ``watch`` (a
    :func:`contract_watch`) counts their nulls while the frame is scored.
    ``score`` adds ``prediction_score_0``, ``prediction_score_1`` and
    ``prediction_label``.  Rows that the frame lacks keep null scores.
    """
    checked = require_features(frame, wanted)
    if watch is not None:
        checked = watch.on(checked)
    return stamp_version(scores_back(snapshot, score(checked), ROW_KEYS), version)


def store_versions(spark: SparkSession, rows: DataFrame, path: str, now: int, days: int = KEPT_DAYS) -> DataFrame:
    """Adds a version to the table at ``path``, or replaces it, and deletes old ones; returns the retention's counts."""
    write_partitioned(rows, path, ["lastUpdated"], sort=["symbol", "weeks", "strike_milli"])
    return delete_old_versions(spark, path, now, days)
