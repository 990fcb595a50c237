"""Operator 3, packing: minimum bin slack over the remaining-length multiset.

Every document becomes its token ids and an end id, and is cut at multiples of the capacity.
The full pieces are sequences of their own; what is left of each document, its remainder, is
shorter than the capacity.  All that matters for packing the remainders is how many there
are of each length, and that table has at most ``capacity - 1`` rows however large the
corpus is.  Each step of the plan fixes the longest length left and fills the rest of the
window by a subset-sum over the lengths left: bit ``s`` of an integer says that a total of
``s`` can be reached, one shift per copy adds a length, and walking back over the stored
integers gives the counts of the fullest window.  The window is repeated as often as its
lengths last, so a step uses up one length at least and the plan stays small.

A piece is ranked inside its length by counts per (length, partition), so a length that a
third of all documents share is ranked by all tasks that hold it, and a rank picks its window
by binary search in the plan.

Defined results: null and empty texts are one end id; repeated rows (also repeated doc_ids)
are packed as rows of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import byte_slices, prepare
from clickpath.llm.tokens import END_ID, encoder
from clickpath.storage import stored

CAPACITY = 2048
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_CUT = _PIECES + ", part int, nth long"
_PACKED = _PIECES + ", sequence_id long, offset long"


def _nth_of_equal(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(values, kind="stable")
    inorder = values[order]
    nth = np.empty(len(values), np.int64)
    nth[order] = np.arange(len(values)) - np.searchsorted(inorder, inorder)
    return nth


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``capacity`` ids; ``with_ids`` adds them (uint32, little-endian).

    ``part`` is the partition that made the row and ``nth`` its place there among the pieces
    of the same length; store the rows before :func:`pack`, which reads them twice.
    """

    prepare(docs.sparkSession)
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for lo, hi in byte_slices(batch.column("text")):
                ids, off = enc.encode(batch.column("text").slice(lo, hi - lo), END_ID)
                sizes = np.diff(off)
                n = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * capacity
                begin = off[row] + start
                end = np.minimum(begin + capacity, off[row + 1])
                length = end - begin
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                spans = list(zip((4 * begin).tolist(), (4 * end).tolist(), strict=True))
                cols = [
                    batch.column("doc_id").slice(lo, hi - lo).take(pa.array(row)),
                    pa.array(start), pa.array(length),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                    pa.array(sizes[row]), pa.array(np.full(len(row), part, np.int32)),
                    pa.array(seen[length] + _nth_of_equal(length)),
                ]
                seen += np.bincount(length, minlength=capacity + 1)
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]
                if with_ids:
                    cols.append(pa.array([bytes(raw[a:b]) for a, b in spans], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = _CUT + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def fullest(counts: dict[int, int], first: int, room: int) -> dict[int, int]:
    """The window with one ``first`` and the lengths that leave the least slack in ``room``."""
    left = dict(counts)
    left[first] -= 1
    everything = (1 << (room + 1)) - 1
    reach, layers = 1, []
    for length in sorted((x for x, c in left.items() if c and x <= room), reverse=True):
        copies = min(left[length], room // length)
        before, grown, step = reach, reach, 1
        while copies:                      # copies as 1 + 2 + 4 + ... + rest, so any count can be met
            take = min(step, copies)
            grown |= (grown << (length * take)) & everything
            copies -= take
            step *= 2
        layers.append((length, before))
        reach = grown
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used = {first: 1}
    for length, before in reversed(layers):
        while not before >> total & 1:     # this total needs a copy of the length
            used[length] = used.get(length, 0) + 1
            total -= length
    return used


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(lengths of a window, how many such windows) until every remainder is placed."""
    left = {int(x): int(c) for x, c in counts.items() if c > 0}
    plan = []
    while left:
        longest = max(left)
        used = fullest(left, longest, capacity - longest)
        times = min(left[x] // c for x, c in used.items())
        plan.append((used, times))
        for x, c in used.items():
            left[x] -= c * times
            if not left[x]:
                del left[x]
    return plan


class Slots:
    """Window and offset of the ``rank``-th remainder of each length."""

    def __init__(self, plan: list[tuple[dict[int, int], int]]):
        given: dict[int, int] = {}
        rows = []
        first = 0
        for used, times in plan:
            offset = 0
            for length, c in used.items():
                rows.append((length, given.get(length, 0), first, c, offset))
                given[length] = given.get(length, 0) + c * times
                offset += length * c
            first += times
        self.windows = first
        rows.sort()
        self.length, self.rank, self.first, self.copies, self.offset = (
            np.array(x, np.int64) for x in (zip(*rows) if rows else [[]] * 5))

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = 1 + max([int(self.length.max(initial=0)), int(length.max(initial=0))])
        low = np.searchsorted(self.length, np.arange(width + 1))
        sequence = np.empty(len(length), np.int64)
        offset = np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            if len(part):
                x = int(length[part[0]])
                a, b = low[x], low[x + 1]
                k = a + np.searchsorted(self.rank[a:b], rank[part], side="right") - 1
                nth = rank[part] - self.rank[k]
                sequence[part] = self.first[k] + nth // self.copies[k]
                offset[part] = self.offset[k] + nth % self.copies[k] * x
        return sequence, offset


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place pieces (stored rows of :func:`pieces`) in sequences: adds sequence_id and offset."""
    per_part = stored(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    # At most one row for each length: bounded by the capacity, not by the corpus.
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    counts.pop(capacity, None)
    slots = Slots(plan_windows(counts, capacity))
    # Rank of a row inside its length: rows of earlier partitions, and its place in its own.
    earlier = per_part.select("length", "part", F.expr("sum(n) over (partition by length order by part) - n").alias("earlier"))
    schema = _PACKED + (", ids binary" if "ids" in cut.columns else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, before, nth = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "earlier", "nth"))
            rank, short = before + nth, length < capacity
            sequence, offset = rank + slots.windows, np.zeros(len(rank), np.int64)
            sequence[short], offset[short] = slots.place(length[short], rank[short])
            found = {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays([found[c] if c in found else batch.column(c) for c in names], names)

    # ``earlier`` has a row per length and partition, so it grows with the input: both sides are shuffled.
    return cut.join(earlier.hint("merge"), ["length", "part"]).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Packed pieces of ``docs(doc_id, text)``; a sequence is its pieces by offset."""
    return pack(stored(pieces(docs, tokenizer, capacity, with_ids), "pack-pieces"), capacity)
