"""Splits by id, bounded labelled samples, and per-row scoring that keeps all columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legweave.llm.batches import blocks, give_back, utf8
from legweave.scratch import settle


def id_remainder(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def bounded_sample(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """Up to ``per_label`` rows of each label, the first in the order of a hash of ``key``, as a written table.

    Labels are counted first, and rows whose hash is too large for a label of
    that size are left out at once, so that no task gathers more than about
    twice the sample whatever the table's size.
    """
    sizes = rows.groupBy(F.col(label).alias("__label")).agg(F.count(F.lit(1)).alias("__size"))
    draw = F.shiftrightunsigned(F.xxhash64(F.col(key)), 11) / F.lit(float(1 << 53))
    likely = rows.withColumn("__draw", draw).join(settle(sizes, "sizes"), F.col(label) == F.col("__label"))
    likely = likely.filter(F.col("__draw") * F.col("__size") <= F.lit(2.0 * per_label + 20))
    w = Window.partitionBy(label).orderBy("__draw", key)
    first = likely.withColumn("__nth", F.row_number().over(w)).filter(F.col("__nth") <= per_label)
    return settle(first.select(*rows.columns), "sample")


Scorer = Callable[[np.ndarray, np.ndarray], dict[str, pa.Array]]


def with_scores(df: DataFrame, text_col: str, scorer: Scorer, fields: list[T.StructField]) -> DataFrame:
    """``df`` and the columns that ``scorer(bytes, starts)`` gives for blocks of whole texts.

    The row travels as one struct, so no name of its own can clash, and the text
    in it is sent once.
    """
    packed = df.select(F.struct("*").alias("row"))
    name = df.select(text_col).columns[0]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(pc.struct_field(batch.column("row"), name))
            for lo, hi in blocks(starts):
                made = scorer(data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo])
                rows = batch.column("row").slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([rows, *[made[n] for n in names]], ["row", *names])
        give_back()

    return packed.mapInArrow(run, T.StructType([packed.schema["row"], *fields])).select("row.*", *names)
