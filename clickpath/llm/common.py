"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.shipping import ship_package

#: Text handed to one numpy pass inside a task; bounds a worker's memory whatever the batch.
SLICE_BYTES = 4 << 20
#: Text that one Arrow batch carries between the JVM and Python, on either side.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """What the operators' Python tasks need: the package on the workers, and small batches.

    The default batch is bounded by 10,000 rows and 64 MB; with two tasks and both sides'
    copies that alone can fill a small executor."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hashed_sample(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hash of ``by`` (all, if there are fewer).

    A sort with a limit sends that many rows of every partition to one place; rows whose
    hash is far above the wanted share of all rows are left out before it."""
    key, total = F.xxhash64(*by), df.count()
    if total > 2 * rows:
        df = df.filter(key <= -(2**63) + int(2**64 * 1.5 * rows / total))
    return df.orderBy(key, *by).limit(rows)


def byte_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column, each of about ``limit`` bytes and one row at least."""
    sizes = np.asarray(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, to
        at = to


def doc_text(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch: its column ``text``, or that field of its struct ``doc``."""
    found = batch.column("text") if "text" in batch.schema.names else pc.struct_field(batch.column("doc"), "text")
    return found.cast(pa.string())


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one UTF-8 buffer and its row offsets (a null row is empty)."""
    column = pa.concat_arrays([column.cast(pa.string()).fill_null("")])
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of true bytes; a run ends with its row."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = offsets[:-1][np.diff(offsets) > 0]
    first[rows] = inside[rows]
    starts = np.flatnonzero(first)
    ended = np.concatenate([~inside, [True]])
    ended[offsets] = True
    stops = np.flatnonzero(ended)
    return starts, stops[np.searchsorted(stops, starts, side="right")]


def byte_table(keep: str) -> np.ndarray:
    """256 booleans: which bytes match the pattern of one (Latin-1) character."""
    import re

    return np.array([bool(re.fullmatch(keep, chr(b), re.DOTALL)) for b in range(256)])


#: A-Z to a-z, every other byte as it is.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
