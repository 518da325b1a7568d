"""Tables by format, by name or by SQL text, and manifests of written datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FORMATS = ("csv", "parquet", "json")


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    return fmt


def read_format(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None) -> DataFrame:
    """A dataset in one of the three formats.  Pass a schema for csv and json."""
    reader = spark.read.format(check_format(fmt))
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def read_table(
    spark: SparkSession,
    table: str | None = None,
    query: str | None = None,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """A catalog or JDBC table, or the result of a SQL text.  Errors are raised.

    Exactly one of ``table`` and ``query`` is given.  For JDBC pass ``url`` and,
    to read in parallel, ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    if jdbc is not None:
        source = {"dbtable": table} if table is not None else {"query": query}
        return spark.read.format("jdbc").options(**jdbc, **source).load()
    return spark.table(table) if table is not None else spark.sql(query)


def manifest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The distinct partition values of a written dataset.

    ``keys`` are partition columns, so tasks read the row counts in the files'
    footers and no column; Spark lists many folders by a job of its own.
    """
    return spark.read.parquet(path).select(*keys).distinct()


def delete(spark: SparkSession, path: str) -> None:
    """Removes whatever is stored at ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path``, on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
