"""Running sums per key over sorted rows, with no key in one task.

Rows are range-sorted, so that a key with many rows spans many partitions; a task sums within
its partition, and what a partition's first key already has from earlier partitions is carried
by a table of one row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.llm.common import prepare
from clickpath.storage import stored

_PART, _AT = "_part", "_at"


def _local(sums: list[tuple[str, str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        last: dict[str, int] = {}
        held = {out: 0 for _, _, out in sums}
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            here = np.arange(n)
            first, goes_on = {}, {}
            for key in {key for key, _, _ in sums}:
                k = batch.column(key).to_numpy()
                opens = np.ones(n, bool)
                opens[1:] = k[1:] != k[:-1]
                goes_on[key] = key in last and last[key] == k[0]
                first[key] = np.maximum.accumulate(np.where(opens, here, 0))
                last[key] = int(k[-1])
            columns = []
            for key, value, out in sums:
                total = np.cumsum(batch.column(value).to_numpy())
                since = first[key]
                upto = total - np.where(since > 0, total[since - 1], 0)
                if goes_on[key]:
                    upto[since == 0] += held[out]
                held[out] = int(upto[-1])
                columns.append(pa.array(upto, pa.int64()))
            place = [pa.array(np.full(n, part, np.int32)), pa.array(at + here)]
            at += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, *place],
                                             [*batch.schema.names, *(out for _, _, out in sums), _PART, _AT])

    return run


def running_sums(df: DataFrame, order: list[Column], sums: list[tuple[str, str, str]], parts: int | None = None) -> DataFrame:
    """``df`` with a column ``out`` for each (key, value, out) of ``sums``: the sum of ``value``
    over the rows of the same ``key`` up to the row, in ``order``.

    Keys and values are longs without nulls, and every key's rows must lie together in
    ``order``.  Rows that tie in ``order`` are never split, so it should be unique.  ``parts``
    fixes the number of partitions (results do not depend on it).
    """
    prepare(df.sparkSession)
    cut = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    schema = T.StructType([*df.schema.fields, *(T.StructField(out, T.LongType()) for _, _, out in sums),
                           T.StructField(_PART, T.IntegerType()), T.StructField(_AT, T.LongType())])
    rows = stored(cut.sortWithinPartitions(*order).mapInArrow(_local(sums), schema), "running")
    keys = list(dict.fromkeys(key for key, _, _ in sums))
    ends = rows.groupBy(_PART).agg(*(F.min_by(key, _AT).alias(f"_first_{key}") for key in keys), *(F.max_by(key, _AT).alias(f"_last_{key}") for key in keys),
                                   *(F.max_by(out, _AT).alias(f"_end_{out}") for _, _, out in sums))
    for key in keys:
        outs = [out for k, _, out in sums if k == key]
        asks = ends.select(F.col(f"_first_{key}").alias("_key"), _PART, F.lit(0).alias("_kind"), *(F.lit(0).cast("long").alias(out) for out in outs))
        gives = ends.select(F.col(f"_last_{key}").alias("_key"), _PART, F.lit(1).alias("_kind"), *(F.col(f"_end_{out}").alias(out) for out in outs))
        earlier = Window.partitionBy("_key").orderBy(_PART, "_kind").rowsBetween(Window.unboundedPreceding, -1)
        carried = asks.unionAll(gives).select("*", *(F.coalesce(F.sum(out).over(earlier), F.lit(0)).alias(f"_from_{out}") for out in outs))
        carried = carried.filter("_kind = 0").select(_PART, F.col("_key").alias("_first"), *(f"_from_{out}" for out in outs))
        # One row for each partition of the sort.
        rows = rows.join(F.broadcast(carried), _PART)
        rows = rows.withColumns({out: F.col(out) + F.when(F.col(key) == F.col("_first"), F.col(f"_from_{out}")).otherwise(0) for out in outs}).drop("_first", *(f"_from_{out}" for out in outs))
    return rows.select(*df.columns, *(out for _, _, out in sums))
