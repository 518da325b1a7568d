"""Landed pages of the tick service: JSON with positional values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legweave.schemas import PAGE_SCHEMA, VENDOR_NAMES

CONTRACT_TYPE = "root string, expiration string, strike string, right string"
ITEM_TYPE = f"contract struct<{CONTRACT_TYPE}>, ticks array<array<string>>"
CONTRACT_FIELDS = {"root": "string", "expiration": "int", "strike": "bigint", "right": "string"}


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """All page files below ``path`` in one scan; each keeps its own header."""
    return spark.read.schema(PAGE_SCHEMA).json(path)


REJECTED = "rejected"


def read_pages_or_reject(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Good pages, and the text and file of those that are no page: not JSON, or without header or response."""
    schema = T.StructType([*PAGE_SCHEMA.fields, T.StructField(REJECTED, T.StringType())])
    lines = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED).json(path)
    # Spark does not let the rejected text be read alone, so each side keeps the page's columns.
    lines = lines.withColumn("file", F.input_file_name())
    whole = F.col("header.format").isNotNull() & F.col("response").isNotNull()
    good = lines.filter(F.col(REJECTED).isNull() & whole).select("header", "response")
    text = F.coalesce(REJECTED, F.to_json(F.struct("header", "response")))
    return good, lines.filter(F.col(REJECTED).isNotNull() | ~whole).select("file", text.alias(REJECTED))


def flatten_pages(pages: DataFrame, fields: dict[str, str], contract: bool = True) -> DataFrame:
    """One row per response item, with the requested header fields cast.

    An item is either a list of values or an object with ``contract`` and
    ``ticks``; of the ticks only the first is used.  Values are matched to the
    page's header by position, and extra names or values on either side are
    ignored.  Vendor names become ours (``root`` -> ``symbol`` and so on).
    """
    items = pages.select(F.col("header.format").alias("names"), F.explode("response").alias("item"))
    is_object = F.ltrim(F.col("item")).startswith("{")
    parsed = items.select(
        "names",
        F.when(is_object, F.from_json("item", ITEM_TYPE)).alias("obj"),
        F.when(~is_object, F.from_json("item", "array<string>")).alias("values"),
    ).select(
        "names",
        F.col("obj.contract").alias("contract"),
        F.coalesce(F.get("obj.ticks", F.lit(0)), F.col("values")).alias("values"),
    )
    n = F.least(F.size("names"), F.size("values"))
    rows = parsed.select(
        "contract",
        F.map_from_arrays(F.slice("names", F.lit(1), n), F.slice("values", F.lit(1), n)).alias("tick"),
    )
    contract_cols = [F.col(f"contract.{f}").cast(t).alias(f) for f, t in CONTRACT_FIELDS.items()] if contract else []
    ticks = [F.try_element_at("tick", F.lit(f)).cast(t).alias(f) for f, t in fields.items()]
    flat = rows.select(*contract_cols, *ticks)
    return flat.withColumnsRenamed({k: v for k, v in VENDOR_NAMES.items() if k in flat.columns})
