"""Running a streaming query over landed files until it has caught up."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from legweave.scratch import fresh_path

# Settings a stream with processing-time state needs while it starts.  Its
# operator always asks for one more empty batch, so a run that should stop when
# the files are used up must not start batches without data.
TIMED_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}
TTL_STATE_SETTINGS = {**TIMED_STATE_SETTINGS, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def ttl_state(spark: SparkSession):
    """Keeps streaming state in RocksDB and runs data batches only."""
    return _settings(spark, TTL_STATE_SETTINGS)


def timed_state(spark: SparkSession):
    """Keeps streaming state in RocksDB; event-time timers also fire in a last batch without data."""
    return _settings(spark, TIMED_STATE_SETTINGS)


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A file stream over the Parquet files of a folder."""
    reader = spark.readStream.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def catch_up(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    partition_by: tuple[str, ...] = (),
) -> None:
    """Appends everything available to a Parquet dataset, then stops."""
    writer = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def catch_up_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update"
) -> StreamingQuery:
    """Hands every micro-batch to ``write(batch, batch_id)``, then stops; the ended query has its progress."""
    run = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return run


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream to a new dataset in the shared folder and reads that."""
    spark = stream.sparkSession
    out = fresh_path(spark, name)
    catch_up(stream, out, fresh_path(spark, f"{name}-state"), mode)
    return spark.read.schema(stream.schema).parquet(out)
