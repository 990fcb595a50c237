"""Operator 2, token-id output: files of context-mixed, range-coded blocks.

Documents are sorted by doc_id, then by a hash of their text, over range partitions, encoded, closed by an end id, and each
partition's ids are cut into blocks of 4096 that :mod:`mixing_coder` codes independently of
each other, with their own checksums.  A file is the Parquet output of one task, one row per
block: the coded payload and which documents it holds (their place in the file, doc_id, ids of
the file before the document, and ids of the document before, in and after the block).  Spark's commit protocol decides what a file holds when a
task is repeated, and reading needs no block but its own.

Reading decodes blocks wherever they lie.  A document's CRC-32 over all blocks is the XOR of
its pieces' CRCs, each carried past the bytes that follow it, so even a document of many
blocks is summed up by partial aggregates.

Defined results: null and empty texts are the end id alone; null doc_ids sort first; documents of one
doc_id (or of none) stand in order of their texts' hashes, so they may span files and ``start`` is
the same in every run; repeated rows are documents of their own; an empty table gives no files' rows and no result; ids of
65536 and more are refused; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickpath.llm.common import byte_slices, prepare
from clickpath.llm.mixing_coder import BLOCK_IDS, LANES, decode_blocks, encode_blocks
from clickpath.llm.tokens import END_ID, encoder
from clickpath.storage import run_folder

_LISTS = ("ordinals", "doc_ids", "begins", "starts", "counts", "after")
SCHEMA = "file int, block long, payload binary, " + ", ".join(f"{c} array<long>" for c in _LISTS)
_POLYNOMIAL = 0xEDB88320                         # CRC-32, lowest power in the highest bit


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials over GF(2) modulo the CRC's."""
    a, b, out = a.copy(), b.copy(), np.zeros_like(a)
    for bit in range(31, -1, -1):
        out ^= np.where(a >> bit & 1, b, 0)
        b = (b >> 1) ^ np.where(b & 1, _POLYNOMIAL, 0)
    return out


def crc_carried(crc: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Each CRC as it counts in the CRC of a longer text, ``after`` bytes before its end."""
    out, power, rest = crc.astype(np.int64), np.full(len(crc), 1 << 23, np.int64), after.astype(np.int64)    # x ** 8
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        out[odd] = _times(out[odd], power[odd])
        rest >>= 1
        power = _times(power, power)
    return out


def _block_rows(file: int, first: int, ids: np.ndarray, at: int, docs: np.ndarray, block_ids: int) -> pa.RecordBatch:
    """Rows of the blocks of ``ids``, which begin at place ``at`` of the file.

    ``docs`` has rows (ordinal, doc_id, has a doc_id, start, ids) of all documents in them, and
    may have more that begin behind them.
    """
    docs = docs[docs[:, 3] < at + len(ids)]
    blocks = [ids[k:k + block_ids] for k in range(0, len(ids), block_ids)]
    edges = at + np.arange(len(blocks)) * block_ids
    cuts = np.unique(np.concatenate([np.maximum(docs[:, 3], at), edges]))
    ends = np.append(cuts[1:], at + len(ids))
    doc = docs[np.searchsorted(docs[:, 3], cuts, side="right") - 1]
    bounds = pa.array(np.searchsorted(cuts, np.append(edges, at + len(ids))).astype(np.int32))
    columns = (doc[:, 0], pa.array(doc[:, 1], mask=doc[:, 2] == 0), doc[:, 3], cuts - doc[:, 3], ends - cuts, doc[:, 3] + doc[:, 4] - ends)
    lists = [pa.ListArray.from_arrays(bounds, pa.array(x) if isinstance(x, np.ndarray) else x) for x in columns]
    head = [pa.array([file] * len(blocks), pa.int32()), pa.array(np.arange(first, first + len(blocks))), pa.array(encode_blocks(blocks), pa.binary())]
    return pa.RecordBatch.from_arrays([*head, *lists], ["file", "block", "payload", *_LISTS])


def write_files(docs: DataFrame, tokenizer: str, path: str, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of ``docs(doc_id, text)`` to files under ``path``, in order of doc_id."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, file = encoder(tokenizer), TaskContext.get().partitionId()
        block = at = ordinal = 0                             # at: ids of the file that are coded
        held, known = np.zeros(0, np.uint32), np.zeros((0, 5), np.int64)
        for batch in batches:
            for lo, hi in byte_slices(batch.column("text")):
                ids, off = enc.encode(batch.column("text").slice(lo, hi - lo), END_ID)
                doc_ids = batch.column("doc_id").slice(lo, hi - lo)
                sizes = np.diff(off)
                new = np.column_stack([ordinal + np.arange(len(sizes)), doc_ids.fill_null(0).to_numpy(zero_copy_only=False), doc_ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64),
                                       at + len(held) + off[:-1], sizes])
                held, known, ordinal = np.concatenate([held, ids]), np.concatenate([known, new]), ordinal + len(sizes)
                while len(held) >= LANES * block_ids:
                    take = LANES * block_ids
                    yield _block_rows(file, block, held[:take], at, known, block_ids)
                    block, at, held = block + LANES, at + take, held[take:]
                    known = known[known[:, 3] + known[:, 4] > at]
        if len(held):
            yield _block_rows(file, block, held, at, known, block_ids)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    given.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SCHEMA).write.parquet(path)


def _lane_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of LANES blocks, as the coder takes them at once; the last may have fewer."""
    held: list[pa.RecordBatch] = []
    for batch in chain(batches, [None]):
        if batch is not None and len(batch):
            held.append(batch)
        while (rows := sum(map(len, held))) >= LANES or (batch is None and rows):
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield whole.slice(0, LANES)
            held = [whole.slice(LANES)] if rows > LANES else []


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decoded pieces (file, ordinal, doc_id, begin, start, n, crc) of the documents in the files.

    ``begin`` counts the file's ids before the document, ``start`` the document's before the
    piece; ``crc`` is the piece's share of its document's CRC-32; ``with_ids`` adds the ids.
    """
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _lane_batches(batches):
            ids = np.concatenate(decode_blocks(part.column("payload").to_pylist()))
            flat = {c: part.column(c).flatten() for c in _LISTS}
            counts = flat["counts"].to_numpy()
            ends = np.cumsum(counts)
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            spans = list(zip((4 * (ends - counts)).tolist(), (4 * ends).tolist(), strict=True))
            crc = crc_carried(np.array([zlib.crc32(raw[a:b]) for a, b in spans], np.int64), 4 * flat["after"].to_numpy())
            file = np.repeat(part.column("file").to_numpy(), pc.list_value_length(part.column("counts")).to_numpy())
            columns = [pa.array(file), flat["ordinals"], flat["doc_ids"], flat["begins"], flat["starts"], flat["counts"], pa.array(crc)]
            names = ["file", "ordinal", "doc_id", "begin", "start", "n", "crc"]
            if with_ids:
                columns.append(pa.array([bytes(raw[a:b]) for a, b in spans], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "file int, ordinal long, doc_id long, begin long, start long, n long, crc long" + (", ids binary" if with_ids else "")
    return spark.read.schema(SCHEMA).parquet(path).mapInArrow(run, schema)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files."""
    docs = (read_pieces(spark, path).groupBy("file", "ordinal")
            .agg(F.first("doc_id").alias("doc_id"), F.first("begin").alias("begin"), F.sum("n").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32")))
    # Ids of the files before each file, from the index alone: one row per file.
    sizes = (spark.read.schema(SCHEMA).parquet(path).groupBy("file")
             .agg(F.sum(F.expr("aggregate(counts, 0L, (a, b) -> a + b)")).alias("size")))
    base = sizes.select("file", (F.sum("size").over(Window.orderBy("file")) - F.col("size")).alias("base"))
    return docs.join(base, "file").select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files to the shared folder and read every document back."""
    spark = docs.sparkSession
    path = f"{run_folder(spark)}/clickpath-tokens-{uuid.uuid4().hex}"
    write_files(docs, tokenizer, path)
    return read_documents(spark, path)
