"""Operator 9, benchmark decontamination: an FM-index for each training shard.

A shard is a slice of documents.  Its words become the numbers of the benchmark's
vocabulary; whatever the benchmark never uses (and every document border) is a separator,
and a run of those is one.  Over that sequence the task builds

* the suffix order by prefix doubling, where only suffixes that still tie are sorted again
  and separators, being distinct, end every comparison;
* the Burrows-Wheeler column in a wavelet matrix, one bit vector with counts per level;
* suffix positions sampled at run starts and at every eighth place.

All test phrases (windows of 13 consecutive benchmark words) are searched backwards at once,
two ranks a step; rows of the phrases that remain walk to a sampled position, and the
occurrences of all phrases are merged into spans of words to remove.

The benchmark is the stated query set: Spark numbers its items by a running sum of their bytes
into blocks of a bounded size, and each block is one pass over the shards.  A benchmark of
several blocks is stored so, and the state of the documents is stored between passes: driver
and tasks hold one block at a time, whatever the number of blocks, and the disk two states.

Defined results: null and empty texts have no words and are never contaminated; an item
without words has no window; an item without an id marks words but is not counted or
listed; repeated items count once, repeated documents are rows of their own; extra columns
are ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.llm.common import LOWER, byte_slices, byte_table, doc_text, flat_bytes, prepare, runs
from clickpath.llm.tokens import spread
from clickpath.storage import stored, unstored

WINDOW_WORDS = 13
#: A document is contaminated if at least one in so many of its words is hit.
HIT_SHARE = 20
#: Benchmark text (bytes) that one pass holds.
BLOCK_BYTES = 4 << 20
#: What an item counts besides its text and id; bounds the items of a block.
ITEM_BYTES = 16
_WORD = byte_table(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]|[A-Z]")
_SAMPLE = 8
_FOUND = ("n_words", "starts", "ends", "items")


def column_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of a string column, A-Z lower-cased, and the row offsets into them."""
    data, offsets = flat_bytes(column)
    word = _WORD[data]
    starts, stops = runs(word, offsets)
    letters = pa.py_buffer(LOWER[data[word]])
    bounds = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), letters) if len(starts) else pa.array([], pa.string())
    return words, np.searchsorted(starts, offsets)


class Phrases:
    """The windows of a block of benchmark items over their own vocabulary (ids from 1)."""

    def __init__(self, ids: list[str | None], texts: list[str | None], size: int = WINDOW_WORDS):
        words, offsets = column_words(pa.array(texts, pa.string()))
        coded = words.dictionary_encode()
        self.vocabulary = coded.dictionary
        symbols = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        counts = np.diff(offsets)
        n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        item = np.repeat(np.arange(len(ids)), n)
        at = spread(np.arange(len(symbols)), offsets[:-1], n.astype(np.int64)) if len(symbols) else np.zeros(0, np.int64)
        width = np.minimum(counts, size)[item]
        # Right-aligned, zeros in front of short phrases: backward search starts at the end.
        back = np.arange(size - 1, -1, -1)
        grid = np.where(back < width[:, None], symbols[np.clip(at[:, None] + width[:, None] - 1 - back, 0, len(symbols) - 1)], 0) if len(at) else np.zeros((0, size), np.int64)
        self.phrases, which = np.unique(grid, axis=0, return_inverse=True)
        self.widths = (self.phrases > 0).sum(1)
        order = np.argsort(which.ravel(), kind="stable")
        self.items = [str(x) if x is not None else None for x in ids]
        self.owner = item[order]
        self.owned = np.searchsorted(which.ravel()[order], np.arange(len(self.phrases) + 1))


class ShardIndex:
    """FM-index of a sequence of symbols; 0 separates, and the sequence ends with one."""

    def __init__(self, symbols: np.ndarray, largest: int):
        n = len(symbols)
        order = suffix_order(symbols)
        self.levels = max(1, int(largest).bit_length())
        self.before = np.searchsorted(np.sort(symbols), np.arange(largest + 1))
        column = symbols[order - 1]
        sampled = (column == 0) | (order % _SAMPLE == 0)
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - sampled
        self.samples = order[sampled]
        self.ones, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (column >> level & 1).astype(bool)
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(n - int(ones[-1]))
            column = np.concatenate([column[~bit], column[bit]])
        every = np.arange(largest + 1)
        self.origin = self._descend(every, np.zeros(len(every), np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, ones, zeros in zip(range(self.levels - 1, -1, -1), self.ones, self.zeros, strict=True):
            up = ones[at]
            at = np.where(symbol >> level & 1, zeros + up, at - up)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the column before row ``at``."""
        return self._descend(symbol, at) - self.origin[symbol]

    def back(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix that begins one place earlier."""
        symbol, at = np.zeros(len(row), np.int64), row
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            up = ones[at]
            bit = ones[at + 1] > up
            symbol = symbol << 1 | bit
            at = np.where(bit, zeros + up, at - up)
        return self.before[symbol] + at - self.origin[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (right-aligned, zeros in front) that occur, and their row ranges."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.sampled), np.int64)
        done = []
        for step in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[which, step]
            over = symbol == 0
            done.append((which[over], low[over], high[over]))
            which, low, high, symbol = (x[~over] for x in (which, low, high, symbol))
            low, high = (self.before[symbol] + self.rank(symbol, x) for x in (low, high))
            which, low, high = (x[low < high] for x in (which, low, high))
        done.append((which, low, high))
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in these rows."""
        place = np.empty(len(rows), np.int64)
        which, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(which):
            known = self.sampled[rows]
            place[which[known]] = self.samples[self.sample_rank[rows[known]]] + steps
            which, rows, steps = which[~known], self.back(rows[~known]), steps + 1
        return place


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, separators (0) distinct by place; the last symbol must be one."""
    n = len(symbols)
    kind = np.uint16 if symbols.max(initial=0) < 65536 else np.uint32
    order = np.argsort(symbols.astype(kind), kind="stable")
    inorder = symbols[order]
    new = np.ones(n, bool)
    new[1:] = (inorder[1:] != inorder[:-1]) | (inorder[1:] == 0)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    reach = 1
    while True:
        alone = new & np.concatenate([new[1:], [True]])
        slots = np.flatnonzero(~alone)
        if not len(slots):
            return order
        tied = order[slots]
        key = rank[tied] << 32 | rank[tied + reach]
        way = np.argsort(key, kind="stable")
        order[slots] = tied[way]
        key = key[way]
        first = np.ones(len(slots), bool)
        first[1:] = key[1:] != key[:-1]
        new[slots] = first
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        reach *= 2


def scan_shard(column: pa.Array, block: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row offsets of the words, marks of hit words (one more than words), and (row, item) hits."""
    words, offsets = column_words(column)
    hit = np.zeros(len(words) + 1, np.int64)
    none = np.zeros(0, np.int64)
    if not len(words) or not len(block.phrases):
        return offsets, hit, none, none
    known = pc.index_in(words, value_set=block.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    # One separator in front of every document and for every run of unknown words.
    first = np.zeros(len(known) + 1, np.int64)
    np.add.at(first, offsets[:-1], 1)
    starts_row = first[:-1] > 0
    unknown = known == 0
    fresh = ~unknown & (starts_row | np.concatenate([[True], unknown[:-1]]))
    at = np.flatnonzero(~unknown)
    if not len(at):
        return offsets, hit, none, none
    place = np.arange(len(at)) + np.cumsum(fresh[at])
    symbols = np.zeros(place[-1] + 2, np.int64)
    symbols[place] = known[at]
    word_at = np.zeros(len(symbols), np.int64)
    word_at[place] = at
    index = ShardIndex(symbols, len(block.vocabulary))
    which, low, high = index.search(block.phrases)
    many = high - low
    rows = spread(np.arange(len(symbols)), low, many) if len(low) else none
    begin = word_at[index.locate(rows)]
    phrase = np.repeat(which, many)
    np.add.at(hit, begin, 1)
    np.subtract.at(hit, begin + block.widths[phrase], 1)
    owners = np.diff(block.owned)[phrase]
    doc = np.searchsorted(offsets, begin, side="right") - 1
    pairs = np.unique(np.repeat(doc, owners) * len(block.items) + spread(block.owner, block.owned[phrase], owners)) if len(phrase) else none
    return offsets, np.cumsum(hit), pairs // max(1, len(block.items)), pairs % max(1, len(block.items))


def _numbered(items: DataFrame, limit: int) -> DataFrame:
    """``items``, stored, with the ``block`` that each belongs to: by the bytes before it."""
    kept = stored(items.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "benchmark")
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition of the benchmark.
    before = kept.groupBy("part").agg(F.sum("size").alias("held")).select("part", F.coalesce(F.sum("held").over(every), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = F.col("before") + F.sum("size").over(within) - F.col("size")
    return stored(kept.join(F.broadcast(before), "part").select("item_id", "text", F.floor(done / F.lit(limit)).cast("long").alias("block")), "benchmark-blocks")


def _blocks(benchmark: DataFrame, size: int, limit: int) -> tuple[int, Iterator[Phrases]]:
    """How many blocks the benchmark has, and the blocks, drawn one at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    length = F.coalesce(F.octet_length("text"), F.lit(0)) + F.coalesce(F.octet_length("item_id"), F.lit(0)) + ITEM_BYTES
    items = items.withColumn("size", length.cast("long"))
    total = items.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]

    def phrases(rows: DataFrame) -> Phrases:
        found = rows.select("item_id", "text").collect()
        return Phrases([r["item_id"] for r in found], [r["text"] for r in found], size)

    if total <= limit:
        return 1, (phrases(x) for x in (items,))
    numbered = _numbered(items, limit)
    numbers = [r["block"] for r in numbered.select("block").distinct().orderBy("block").collect()]
    return len(numbers), (phrases(numbered.filter(F.col("block") == k)) for k in numbers)


def _pass(block: Phrases, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in byte_slices(doc_text(batch)):
                part = batch.slice(lo, hi - lo)
                offsets, hit, doc, item = scan_shard(doc_text(part), block)
                spans = merged(part, offsets, hit)
                names: list[set[str]] = [set(x or ()) for x in part.column("items").to_pylist()]
                for d, i in zip(doc.tolist(), item.tolist(), strict=True):
                    if block.items[i] is not None:
                        names[d].add(block.items[i])
                columns = [*(part.column(c) for c in carried), pa.array(np.diff(offsets)), *spans, pa.array([sorted(x) for x in names], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, [*carried, *_FOUND])

    return run


def merged(part: pa.RecordBatch, offsets: np.ndarray, hit: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Spans of hit words by document, with those of earlier blocks, as two list columns."""
    marks = (hit[:-1] > 0).astype(np.int8)
    for name, lists in (("starts", part.column("starts")), ("ends", part.column("ends"))):
        if name == "starts" and len(lists.flatten()):
            depth = np.zeros(len(marks) + 1, np.int64)
            base = np.repeat(offsets[:-1], np.diff(lists.offsets.to_numpy()))
            np.add.at(depth, base + lists.flatten().to_numpy(), 1)
            later = part.column("ends")
            np.subtract.at(depth, base + later.flatten().to_numpy(), 1)
            marks |= (np.cumsum(depth[:-1]) > 0).astype(np.int8)
    starts, stops = runs(marks.astype(bool), offsets)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    bounds = pa.array(np.searchsorted(doc, np.arange(len(offsets))).astype(np.int32))
    return tuple(pa.ListArray.from_arrays(bounds, pa.array(x - offsets[doc], pa.int64())) for x in (starts, stops))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, share: int = HIT_SHARE, block_bytes: int = BLOCK_BYTES, keep_text: bool = True) -> DataFrame:
    """``(doc, n_words, starts, ends, items, n_hit, contaminated)`` for every document.

    ``doc`` holds the columns of ``docs`` (without the text unless ``keep_text``: then the last
    pass brings no text back from Python), ``starts`` and ``ends`` are the merged spans of
    words to remove (words from 0, end exclusive), ``items`` the benchmark items that have a
    window in the document.
    """
    prepare(docs.sparkSession)
    empty = {"starts": "array<long>", "ends": "array<long>", "items": "array<string>"}
    given = F.struct(*(c for c in docs.columns if keep_text or c != "text")).alias("doc")
    state = docs.select(given, *([] if keep_text else ["text"]), F.lit(0).cast("long").alias("n_words"),
                        *(F.array().cast(t).alias(c) for c, t in empty.items()))
    left, blocks = _blocks(benchmark, size, block_bytes)
    last = None
    while left:
        left -= 1
        carried = [c for c in state.columns if c == "doc" or (c == "text" and left)]
        state = state.mapInArrow(_pass(next(blocks), carried), T.StructType([state.schema[c] for c in (*carried, *_FOUND)]))
        if left:
            state, done = stored(state, "decontamination"), last
            last = state
            if done is not None:         # its one reader has just been stored
                unstored(done)
    n_hit = F.expr("aggregate(zip_with(starts, ends, (a, b) -> b - a), 0L, (x, y) -> x + y)")
    return (state.withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))))
