"""Quality gates, counted by the job that reads the rows and not by a scan of their own."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = "gate string, n_rows bigint, n_broken bigint, first_key string, last_key string"


@dataclass(frozen=True)
class Gate:
    """A rule that no row may break; ``key`` names a row in the report."""

    name: str
    broken: Column
    key: Column


class GateBroken(ValueError):
    """Rows of a job break one of its gates."""


class Watch:
    """How many rows of a job break each gate, with the first and the last of their keys.

    :meth:`on` adds the counts to a frame as observed metrics.  They are there
    when the first job that reads the frame has run, so :meth:`report`,
    :meth:`table` and :meth:`require` belong after that, and wait for it.  A row
    for which a rule is unknown counts as breaking it.
    """

    def __init__(self, gates: Sequence[Gate]):
        self.gates = list(gates)
        self._observation: Observation | None = None

    def on(self, df: DataFrame) -> DataFrame:
        if self._observation is not None:
            raise ValueError("a watch counts one frame")
        self._observation = Observation(f"gates-{uuid.uuid4().hex}")
        metrics = [F.count(F.lit(1)).alias("n_rows")]
        for i, gate in enumerate(self.gates):
            broken = F.coalesce(gate.broken, F.lit(True))
            key = F.when(broken, gate.key.cast("string"))
            metrics += [F.count_if(broken).alias(f"n{i}"), F.min(key).alias(f"low{i}"), F.max(key).alias(f"high{i}")]
        return df.observe(self._observation, *metrics)

    def report(self) -> list[tuple[str, int, int, str | None, str | None]]:
        """Per gate: its name, rows seen, rows that break it, and their smallest and largest key."""
        if self._observation is None:
            raise ValueError("the watch is on no frame")
        seen = self._observation.get
        return [
            (g.name, seen["n_rows"], seen[f"n{i}"], seen[f"low{i}"], seen[f"high{i}"]) for i, g in enumerate(self.gates)
        ]

    def table(self, spark: SparkSession) -> DataFrame:
        """The report as a table, one row per gate."""
        return spark.createDataFrame(self.report(), REPORT)

    def require(self, tolerated: Sequence[str] = ()) -> None:
        """Raises :class:`GateBroken` when rows break a gate that isn't tolerated."""
        bad = [r for r in self.report() if r[2] and r[0] not in tolerated]
        if bad:
            raise GateBroken("; ".join(f"{name}: {n} of {rows} rows, {low} to {high}" for name, rows, n, low, high in bad))


def key_of(*columns: str) -> Column:
    """The named columns joined by a slash, as a gate's key."""
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns])


def nulls_in(columns: Sequence[str], key: Column) -> list[Gate]:
    """A gate per column that no null may pass."""
    return [Gate(f"null_{c}", F.col(c).isNull(), key) for c in columns]
