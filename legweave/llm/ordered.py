"""Running totals over a global order, without one task that sees every row."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legweave.scratch import settle

PART = "__part"


def running_totals(df: DataFrame, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``df`` with ``before_<v>``: the total of ``v`` over all rows before this one.

    Rows are dealt to ranges of ``order`` (nulls first), each range adds up its
    own rows, and the totals of the ranges, one row per partition, are added by
    a broadcast join.  A hot leading key is cut by the columns after it.  Rows
    that tie in every order column follow each other in an arbitrary order.
    ``values`` must be whole numbers or doubles without nulls.
    """
    fields = [T.StructField(PART, T.IntegerType())] + [
        T.StructField(f"before_{v}", df.schema[v].dataType) for v in values
    ]
    schema = T.StructType(df.schema.fields + fields)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = settle(ranged.mapInArrow(_add_up(tuple(values)), schema), "ranges")
    totals = local.groupBy(PART).agg(*[F.max(F.col(f"before_{v}") + F.col(v)).alias(v) for v in values])
    so_far = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(
        totals.select(PART, *[F.coalesce(F.sum(v).over(so_far), F.lit(0)).alias(f"__{v}") for v in values]), "offsets"
    )
    joined = local.join(F.broadcast(offsets), PART)
    added: list[Column] = [
        (F.col(f"before_{v}") + F.col(f"__{v}")).cast(df.schema[v].dataType).alias(f"before_{v}") for v in values
    ]
    return joined.select(*df.columns, *added)


def _add_up(values: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        so_far = dict.fromkeys(values, 0)
        for batch in batches:
            columns, names = list(batch.columns), list(batch.schema.names)
            columns.append(pa.array(np.full(batch.num_rows, part, np.int32)))
            for v in values:
                x = batch.column(v).to_numpy(zero_copy_only=False)
                before = np.cumsum(x) - x + so_far[v]
                so_far[v] += x.sum()
                columns.append(pa.array(before))
            yield pa.RecordBatch.from_arrays(columns, names + [PART] + [f"before_{v}" for v in values])

    return run
