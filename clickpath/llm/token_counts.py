"""Operator 6, token counts: a separator scan over flat token files.

A flat token file is nothing but ids, little-endian and of a fixed width, each document
closed by the end-of-document id; no index says where documents begin.  It is held as a
table of numbered blocks that cut documents anywhere.  A scan searches each block for the
separator in one vector comparison.  What crosses block borders is stitched by a prefix scan
over one small summary row per block: ids before the block, documents closed before it, and
where the last separator stood.  The scan is in two levels (chunks of blocks, blocks of a
chunk), so one huge file is not one task.

``count_documents`` writes such files from a table of texts, one per task, and a list of the
doc_ids in the order written, and counts tokens by scanning the files.

Defined results: null and empty texts are a separator alone, 1 token; null doc_ids keep
their row; repeated rows are counted each; ids after the last separator of a file are an
open document; a text that spells the separator does not make one; no rows, no files; extra
columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickpath.llm.common import byte_slices, prepare
from clickpath.llm.tokens import encoder
from clickpath.storage import run_folder, stored

BLOCK_IDS = 1 << 16
CHUNK_BLOCKS = 1 << 10
WIDTHS = {2: "<u2", 4: "<u4"}


def write_flat(docs: DataFrame, tokenizer: str, end_id: int, path: str, block_ids: int = BLOCK_IDS, width: int = 2) -> None:
    """Write the ids of ``docs(doc_id, text)`` as flat blocks, one file per task.

    ``path/blocks`` has rows (file, block, data), ``path/order`` has (file, first, doc_ids):
    which documents were written, in order.  Special tokens in a text are ordinary text.
    """
    prepare(docs.sparkSession)
    kind = WIDTHS[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, plain_specials=True)
        file, block, written = TaskContext.get().partitionId(), 0, 0
        rest = np.zeros(0, kind)

        def rows(first: int, blocks: list[bytes], doc_ids: pa.Array | None) -> pa.RecordBatch:
            n = len(blocks) + (doc_ids is not None)
            data = blocks + [None] * (n - len(blocks))
            ids = [None] * len(blocks) + ([doc_ids.to_pylist()] if doc_ids is not None else [])
            place = [*range(first, first + len(blocks)), *([written] if doc_ids is not None else [])]
            return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.int32()), pa.array(place, pa.int64()), pa.array(data, pa.binary()), pa.array(ids, pa.list_(pa.int64()))],
                                              ["file", "block", "data", "doc_ids"])

        for batch in batches:
            for lo, hi in byte_slices(batch.column("text")):
                ids, _ = enc.encode(batch.column("text").slice(lo, hi - lo), end_id)
                if width == 2 and len(ids) and ids.max() > 0xFFFF:
                    raise ValueError("ids over 65535 need a width of 4 bytes")
                rest = np.concatenate([rest, ids.astype(kind)])
                full = len(rest) // block_ids
                blocks = [rest[k * block_ids:(k + 1) * block_ids].tobytes() for k in range(full)]
                yield rows(block, blocks, batch.column("doc_id").slice(lo, hi - lo))
                block, written, rest = block + full, written + hi - lo, rest[full * block_ids:]
        if len(rest):
            yield rows(block, [rest.tobytes()], None)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = given.mapInArrow(run, "file int, block long, data binary, doc_ids array<long>")
    both.withColumn("part", F.when(F.col("data").isNull(), "order").otherwise("blocks")).write.option("compression", "zstd").partitionBy("part").parquet(path)


def read_binary(spark: SparkSession, path: str, block_ids: int = BLOCK_IDS, width: int = 2, run_blocks: int = 256) -> DataFrame:
    """Blocks (file, block, data) of plain binary files of ids, of any size.

    Spark lists the files; a task opens its files through pyarrow's file systems and reads runs of
    ``run_blocks`` blocks by their offsets, so one long file is read by many tasks.  A file cut
    off within an id: what is left of that id is no id and is left out.  An empty file has no blocks."""
    prepare(spark)
    size, parts = block_ids * width, spark.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first, length in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "length")), strict=True):
                system, name = pa.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", file))
                last = min(first + run_blocks, -(-length // size))
                with system.open_input_file(name) as data:
                    for k in range(first, last):
                        block = data.read_at(min(size, length - k * size), k * size)
                        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([k], pa.int64()), pa.array([block], pa.binary())], ["file", "block", "data"])

    files = spark.read.format("binaryFile").load(path).select("path", (F.col("length") - F.col("length") % width).alias("length")).filter("length > 0")
    runs = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size).cast("long"), F.lit(run_blocks).cast("long"))).alias("first"))
    return runs.repartition(4 * parts).mapInArrow(run, "file string, block long, data binary")


def scan_blocks(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """(file, block, n_ids, ends): ids of each block and the places after its separators."""
    prepare(blocks.sparkSession)
    kind = WIDTHS[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x.as_buffer(), kind) for x in batch.column("data")]
            ends = [np.flatnonzero(x == end_id) + 1 for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array([len(x) for x in ids], pa.int64()),
                                              pa.array(ends, pa.list_(pa.int64()))], ["file", "block", "n_ids", "ends"])

    return blocks.select("file", "block", "data").mapInArrow(run, f"file {blocks.schema['file'].dataType.simpleString()}, block long, n_ids long, ends array<long>")


def stitch(scanned: DataFrame, chunk_blocks: int = CHUNK_BLOCKS) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of every document of the scanned files.

    ``start`` counts the file's ids before the document; an open document is the file's last.
    """
    rows = scanned.withColumn("chunk", F.floor(F.col("block") / chunk_blocks)).withColumn("n_ends", F.size("ends").cast("long"))
    inside = Window.partitionBy("file", "chunk").orderBy("block")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)

    def earlier(column, window):
        return F.coalesce(F.sum(column).over(window), F.lit(0).cast("long"))

    # Within a chunk: ids and documents before the block, and the last separator (in ids of the chunk).
    local = rows.withColumn("ids_before", earlier("n_ids", before)).withColumn("docs_before", earlier("n_ends", before))
    local = local.withColumn("last_end", F.when(F.col("n_ends") > 0, F.col("ids_before") + F.element_at("ends", -1)))
    local = local.withColumn("open_from", F.max("last_end").over(before))
    chunks = local.groupBy("file", "chunk").agg(F.sum("n_ids").alias("ids"), F.sum("n_ends").alias("docs"), F.max("last_end").alias("last"))
    over = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("chunk_ids", earlier("ids", over)).withColumn("chunk_docs", earlier("docs", over))
    chunks = chunks.withColumn("chunk_open", F.coalesce(F.max(F.col("chunk_ids") + F.col("last")).over(over), F.lit(0).cast("long")))
    placed = local.join(chunks.select("file", "chunk", "chunk_ids", "chunk_docs", "chunk_open"), ["file", "chunk"])
    at = F.col("chunk_ids") + F.col("ids_before")
    placed = placed.select("file", at.alias("at"), (F.col("chunk_docs") + F.col("docs_before")).alias("ordinal"), "n_ids", "ends",
                           F.coalesce(F.col("chunk_ids") + F.col("open_from"), F.col("chunk_open")).alias("open_from"))
    closed = (placed.select("file", "at", "ordinal", "open_from", F.posexplode(F.arrays_zip(F.expr("concat(array(cast(null as bigint)), slice(ends, 1, greatest(size(ends) - 1, 0)))").alias("since"), F.col("ends").alias("till"))).alias("k", "d"))
              .filter(F.col("d.till").isNotNull())
              .select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), F.coalesce(F.col("at") + F.col("d.since"), F.col("open_from")).alias("start"), (F.col("at") + F.col("d.till")).alias("end"), F.lit(True).alias("closed")))
    last = placed.groupBy("file").agg(F.max(F.col("at") + F.col("n_ids")).alias("end"), F.max(F.col("ordinal") + F.size("ends")).alias("ordinal"),
                                      F.max(F.coalesce(F.col("at") + F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1), F.lit(0).cast("long"))).alias("start"))
    opened = last.filter("end > start").select("file", "ordinal", "start", "end", F.lit(False).alias("closed"))
    return closed.unionByName(opened).select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "closed")


def count_documents(docs: DataFrame, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS, width: int = 2) -> DataFrame:
    """(doc_id, file, start, n_tokens): tokens of every document with its separator, from flat files."""
    spark = docs.sparkSession
    path = f"{run_folder(spark)}/clickpath-flat-{uuid.uuid4().hex}"
    write_flat(docs, tokenizer, end_id, path, block_ids, width)
    schema = "file int, block long, data binary, doc_ids array<long>, part string"
    files = spark.read.schema(schema).option("basePath", path).parquet(path)
    counted = stitch(stored(scan_blocks(files.filter("part = 'blocks'"), end_id, width), "flat-scan"))
    order = (files.filter("part = 'order'").select("file", "block", F.posexplode("doc_ids").alias("k", "doc_id"))
             .select("file", (F.col("block") + F.col("k")).alias("ordinal"), "doc_id"))
    return order.join(counted, ["file", "ordinal"]).select("doc_id", "file", "start", "n_tokens")
