"""Market tables at rest: a partition per trade date, buckets that keep the legs of a strike together."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legweave.functions.dates import to_day, to_yyyymmdd
from legweave.scratch import settle

# What quotes, greeks and open interest of a contract share, and a front leg with its back legs too.
BUCKET_KEYS = ["symbol", "strike_milli"]

# A bucket is one task's share of every join on this layout: its rows are bounded, the number of buckets is not.
LEAST_BUCKETS, ROWS_PER_BUCKET = 8, 500_000


def buckets_for(n_rows: int) -> int:
    """How many buckets tables of about ``n_rows`` rows take; those that meet must have equally many."""
    return max(LEAST_BUCKETS, -(-n_rows // ROWS_PER_BUCKET))


def land_bucketed(rows: DataFrame, name: str, path: str, buckets: int, mode: str = "overwrite") -> DataFrame:
    """Writes the catalog table ``name``: partitioned by trade date, bucketed by symbol and strike.

    Tables of equally many buckets meet on keys that include both without a
    shuffle: quotes with greeks and open interest, and the front leg with a back
    leg of another expiration (see :func:`buckets_kept`).  Rows are dealt by
    bucket first, so a day has one file per bucket.  ``append`` adds days to an
    existing table.
    """
    dealt = rows.repartition(buckets, *BUCKET_KEYS).sortWithinPartitions("trade_date", *BUCKET_KEYS)
    (
        dealt.write.partitionBy("trade_date")
        .bucketBy(buckets, *BUCKET_KEYS)
        .sortBy(*BUCKET_KEYS)
        .format("parquet")
        .option("path", path)
        .mode(mode)
        .saveAsTable(name)
    )
    return read_bucketed(rows.sparkSession, name, rows.columns)


def read_bucketed(spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
    """The catalog table; a path alone would not tell Spark of the buckets."""
    return spark.table(name).select(*columns)


@contextmanager
def buckets_kept(spark: SparkSession) -> Iterator[None]:
    """While plans are made in here, joins keep a layout by some of their keys instead of dealing rows anew.

    Spark's default asks for a layout by all join keys.  That guards against
    layouts by one coarse key, so it is lifted only where bucketed tables meet:
    run the action in here.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def covered_days(rows: DataFrame, first: str, last: str) -> DataFrame:
    """The distinct calendar days (``trade_date``) between the columns ``first`` and ``last`` of any row."""
    spans = rows.select(first, last).distinct().filter(F.col(first) <= F.col(last))
    day = F.explode(F.sequence(to_day(first), to_day(last)))
    return spans.select(day.alias("day")).distinct().select(to_yyyymmdd("day").alias("trade_date"))


def on_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the trade dates in ``days``; of a partitioned table only their partitions are read.

    ``days`` has one row per date, some hundred a year, so it is broadcast and
    the scan waits for it: the dates prune the partitions at run time.
    """
    # Written, so that the pruning and the join read the same few rows; the filter makes Spark consider them.
    wanted = settle(days.select("trade_date").distinct(), "days").filter(F.col("trade_date") > 0)
    return rows.join(F.broadcast(wanted), "trade_date", "left_semi").select(*rows.columns)
