"""Landed bulk CSV slices: every value is text until it is cast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legweave.schemas import QUOTE_EXTRAS, VENDOR_NAMES, all_strings


def read_bulk_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All CSV files below ``path`` as text columns; the header is checked.

    Blank rows are dropped, and pages need no order.
    """
    return (
        spark.read.schema(all_strings(list(columns)))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


REJECTED = "rejected"


def read_bulk_csv_or_reject(
    spark: SparkSession, path: str, schema: T.StructType, needed: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Typed rows of all CSV files below ``path``, and the text and file of the rows that are none.

    A row is rejected when it has too few or too many values, when a value
    doesn't fit its type, or when one of ``needed`` is empty.
    """
    wide = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    rows = (
        spark.read.schema(wide)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(path)
        .withColumn("file", F.input_file_name())
    )
    names = [f.name for f in schema.fields]
    lacking = F.lit(False)
    for name in needed:
        lacking = lacking | F.col(name).isNull()
    # True of every row.  It reads all columns, or a value that no later step asks for would not be checked.
    read = F.xxhash64(*names) >= F.lit(-(2**63))
    good = rows.filter(read & F.col(REJECTED).isNull() & ~lacking).select(*names)
    text = F.coalesce(REJECTED, F.to_csv(F.struct(*names)))
    return good, rows.filter(F.col(REJECTED).isNotNull() | lacking).select("file", text.alias(REJECTED))


def with_our_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in VENDOR_NAMES.items() if k in df.columns})


def cast_slice(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The schema's columns at their types, plus ``keep`` as they are."""
    return df.select(*keep, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def drop_null_keys(df: DataFrame, keys: Sequence[str] = ("ms_of_day",)) -> DataFrame:
    return df.dropna(subset=list(keys))


def snapshot_quotes(df: DataFrame) -> DataFrame:
    return df.drop("ms_of_day", *QUOTE_EXTRAS)


def snapshot_greeks(df: DataFrame) -> DataFrame:
    return df.drop("ms_of_day2", "bid", "ask")
