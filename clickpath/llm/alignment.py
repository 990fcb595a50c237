"""Operator 11, cross-tokenizer alignment: divide and conquer at shared cuts.

A text is encoded by a byte-level tokenizer (A) and a piece model (B); both give byte ranges of
the same bytes.  Places where a token of A and one of B end together cut the text into groups.
An interval of both token lists is searched for a common end near its middle token: bisect for
the first end of the other list, then for its next end in this list, and so on outwards, to the
right and then to the left.  A found cut halves the interval; an interval without one is a leaf,
one group.  All intervals of all texts of a slice are searched together, level by level.

Every cut links the two tokens that end there.  A task keeps its texts' links as places in a
block's list of distinct pairs, so what Spark groups and joins for the corpus-wide counts is one
row per block and pair (no pair can be more frequent there than blocks are), and the counts come
back to a block as one list.  No count table is collected or broadcast; only the highest count
of each id of B is, which the vocabulary bounds.

Defined results: a text that is null or empty, or whose joined token bytes of A or B are not
those of a space and the text, has no tokens: zeros and empty texts; very long texts are aligned
whole; repeated rows, also with one doc_id or none, are rows of their own and all count; an
empty table gives no rows; extra columns are ignored; a vocabulary with a token of no bytes is
refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import byte_slices, flat_bytes, prepare
from clickpath.llm.tokens import encoder, spread
from clickpath.storage import stored

#: Links of a block, up to one slice more; text that is aligned in one go.
BLOCK_LINKS, SLICE = 1 << 20, 2 << 20
_VOCABULARIES: dict[tuple[str, str], object] = {}


class Entries:
    """Byte strings by id, as one buffer."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.array([len(x) for x in entries], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(bytearray(b"".join(entries)), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return spread(self.flat, self.starts[ids], self.lengths[ids])


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters for themselves, the other bytes in order for those from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteLevel:
    """A byte-level tokenizer file: ids of spaced texts, and the bytes of every id."""

    def __init__(self, path: str):
        self.encoder = encoder(path, plain_specials=True)
        ids = self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        of, entries = byte_characters(), [b"?"] * (max(ids.values()) + 1)
        for token, k in ids.items():
            entries[k] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        self.entries = _checked(entries)

    def encode(self, texts: pa.Array, spaced: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, offsets = self.encoder.encode(spaced, None)
        return ids.astype(np.int64), offsets


class Pieces:
    """A piece model file, which puts the space before a text itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        entries = []
        for k in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(k)
            entries.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(k) else piece.replace("▁", " ").encode())
        self.entries = _checked(entries)

    def encode(self, texts: pa.Array, spaced: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(texts.to_pylist(), num_threads=1)
        counts = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), np.concatenate([[0], np.cumsum(counts)])


def _checked(entries: list[bytes]) -> Entries:
    if not all(entries):
        raise ValueError("a token of the vocabulary has no bytes")
    return Entries(entries)


def _vocabulary(kind: type, path: str):
    key = (kind.__name__, path)
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = kind(path)
    return _VOCABULARIES[key]


def shared_cuts(a_end: np.ndarray, b_end: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end: indices past their last token in either list, ascending.

    ``a_end`` and ``b_end`` are the strictly ascending ends of the tokens; ``a`` and ``b`` the
    offsets of the texts into them, whose last tokens end together.
    """
    a0, a1, b0, b1 = a[:-1], a[1:], b[:-1], b[1:]
    some = a1 > a0
    a0, a1, b0, b1 = a0[some], a1[some], b0[some], b1[some]
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    while len(a0):
        single = (a1 - a0 == 1) | (b1 - b0 == 1)
        leaves.append((a1[single], b1[single]))
        a0, a1, b0, b1 = (x[~single] for x in (a0, a1, b0, b1))
        middle = (a0 + a1 - 2) // 2
        cut_a, cut_b, left = _near(a_end, b_end, a0, a1, b0, middle)
        leaf = cut_a < 0
        leaves.append((a1[leaf], b1[leaf]))
        # What lies right of a cut that was found to the left of the middle has none.
        leaves.append((a1[left], b1[left]))
        right = ~leaf & ~left
        cut = ~leaf
        a0, a1, b0, b1 = (np.concatenate([x, y]) for x, y in ((a0[cut], cut_a[right] + 1), (cut_a[cut] + 1, a1[right]), (b0[cut], cut_b[right] + 1), (cut_b[cut] + 1, b1[right])))
    ends = [np.concatenate(x) if leaves else np.zeros(0, np.int64) for x in zip(*leaves, strict=True)] if leaves else [np.zeros(0, np.int64)] * 2
    order = np.argsort(ends[0], kind="stable")
    return ends[0][order], ends[1][order]


def _near(a_end, b_end, a0, a1, b0, middle):
    """The tokens that end together next to the middle token of each interval, -1 without any
    inside it, and whether they lie left of it."""
    cut_a, cut_b = np.full(len(a0), -1), np.full(len(a0), -1)
    left = np.zeros(len(a0), bool)
    live, i = np.arange(len(a0)), middle.copy()
    while len(live):                                  # to the right, the interval's own end excluded
        j = np.searchsorted(b_end, a_end[i])
        same = b_end[j] == a_end[i]
        cut_a[live[same]], cut_b[live[same]] = i[same], j[same]
        live, j = live[~same], j[~same]
        i = np.searchsorted(a_end, b_end[j])
        inside = i < a1[live] - 1
        live, i = live[inside], i[inside]
    live = np.flatnonzero(cut_a < 0)
    i = middle[live]
    while len(live):                                  # and to the left
        j = np.searchsorted(b_end, a_end[i], side="right") - 1
        inside = j >= b0[live]
        live, i, j = live[inside], i[inside], j[inside]
        same = b_end[j] == a_end[i]
        cut_a[live[same]], cut_b[live[same]], left[live[same]] = i[same], j[same], True
        live, j = live[~same], j[~same]
        i = np.searchsorted(a_end, b_end[j], side="right") - 1
        inside = i >= a0[live]
        live, i = live[inside], i[inside]
    return cut_a, cut_b, left


class Aligned:
    """Tokens and groups of a slice of texts."""

    def __init__(self, column: pa.Array, a: ByteLevel, b: Pieces):
        column = column.cast(pa.string()).fill_null("")
        filled = np.asarray(pc.greater(pc.binary_length(column), 0))
        texts = column.filter(pa.array(filled))
        spaced = pc.binary_join_element_wise(" ", texts, "")
        data, offsets = flat_bytes(spaced)
        sides = [[*v.encode(texts, spaced), v.entries] for v in (a, b)]
        sizes = np.diff(offsets)
        good = np.ones(len(texts), bool)
        for ids, off, entries in sides:
            good &= np.diff(np.concatenate([[0], np.cumsum(entries.lengths[ids])])[off]) == sizes
        self._keep(sides, good)
        data = data[np.repeat(good, sizes)]
        same = np.ones(len(data) + 1, bool)
        for ids, _, entries in sides:
            same[:-1] &= entries.joined(ids) == data
        kept = np.flatnonzero(good)
        whole = np.logical_and.reduceat(same, np.concatenate([[0], np.cumsum(sizes[kept])[:-1]]).astype(np.int64)) if len(kept) else np.zeros(0, bool)
        self._keep(sides, whole)
        (self.a, a_off, a_entries), (self.b, b_off, b_entries) = sides
        self.a_to, self.b_to = shared_cuts(np.cumsum(a_entries.lengths[self.a]), np.cumsum(b_entries.lengths[self.b]), a_off, b_off)
        rows = np.flatnonzero(filled)[kept[whole]]     # the rows that have tokens
        self.counts = np.zeros((3, len(column)), np.int64)
        self.counts[0, rows], self.counts[1, rows] = np.diff(a_off), np.diff(b_off)
        self.counts[2, rows] = np.diff(np.searchsorted(self.a_to, a_off, side="right"))

    @staticmethod
    def _keep(sides: list, good: np.ndarray) -> None:
        for side in sides:
            counts = np.diff(side[1])
            side[0] = side[0][np.repeat(good, counts)]
            side[1] = np.concatenate([[0], np.cumsum(counts[good])])

    def links(self) -> np.ndarray:
        """The pair of ids at every cut: A's in the upper half, B's in the lower."""
        return self.a[self.a_to - 1] << 32 | self.b[self.b_to - 1]

    def written(self, decimals: Entries) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for every row."""
        n_a, n_b = (np.diff(x, prepend=0) for x in (self.a_to, self.b_to))
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        # A token stands after the tokens before it in its own list and those of earlier groups in the other.
        ids[np.arange(len(self.a)) + np.repeat(self.b_to - n_b, n_a)] = self.a
        ids[np.arange(len(self.b)) + np.repeat(self.a_to, n_b)] = self.b
        out = decimals.joined(ids)
        ends = np.cumsum(decimals.lengths[ids])
        out[ends[self.a_to + self.b_to - n_b - 1] - 1] = ord("|")
        out[ends[self.a_to + self.b_to - 1] - 1] = ord(";")
        stops = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(self.counts[0] + self.counts[1])])]
        raw = out.tobytes()
        return [raw[x:max(x, y - 1)] for x, y in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]


_DOCS = {"doc_id": "array<bigint>", "n_a": "array<bigint>", "n_b": "array<bigint>", "n_groups": "array<bigint>", "groups_sha256": "array<string>"}
_BLOCK = "block bigint, " + ", ".join(f"{c} {t}" for c, t in _DOCS.items()) + ", links binary, codes array<bigint>, counts array<bigint>"


def _one(values, kind: pa.DataType) -> pa.Array:
    return pa.array([values], pa.list_(kind))


def aligned_blocks(docs: DataFrame, a: str, b: str, with_groups: bool = False, block_links: int = BLOCK_LINKS) -> DataFrame:
    """Blocks of aligned documents: their counts and digests, and their links as places in the
    block's distinct pairs ``codes`` (``counts`` times each); ``with_groups`` adds the groups written out.
    Store the result before reading it twice."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = _vocabulary(ByteLevel, a), _vocabulary(Pieces, b)
        decimals = Entries([b"%d," % k for k in range(max(len(one.entries.lengths), len(other.entries.lengths)))])
        block = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def closed() -> pa.RecordBatch:
            codes, places, counts = np.unique(np.concatenate([x[4] for x in held]), return_inverse=True, return_counts=True)
            places = places.astype(np.uint16 if len(codes) <= 1 << 16 else np.uint32)
            columns = [pa.array([block]), _one(list(chain.from_iterable(x[0] for x in held)), pa.int64()),
                       *(_one(np.concatenate([x[1][k] for x in held]), pa.int64()) for k in range(3)), _one(list(chain.from_iterable(x[2] for x in held)), pa.string()),
                       pa.array([places.tobytes()], pa.binary()), _one(codes, pa.int64()), _one(counts, pa.int64())]
            names = ["block", *_DOCS, "links", "codes", "counts"]
            if with_groups:
                columns.append(_one(list(chain.from_iterable(x[3] for x in held)), pa.string()))
                names.append("groups")
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for lo, hi in byte_slices(batch.column("text"), SLICE):
                found = Aligned(batch.column("text").slice(lo, hi - lo), one, other)
                groups = found.written(decimals)
                digests = [hashlib.sha256(x).hexdigest() if x else "" for x in groups]
                held.append((batch.column("doc_id").slice(lo, hi - lo).to_pylist(), found.counts, digests, [x.decode() for x in groups] if with_groups else [], found.links()))
                if sum(len(x[4]) for x in held) >= block_links:
                    yield closed()
                    held, block = [], block + 1
        if held:
            yield closed()

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, _BLOCK + (", groups array<string>" if with_groups else ""))


def rated_pairs(blocks: DataFrame) -> DataFrame:
    """``(code, count, best)``: links of every id pair, and whether no pair of its B id has more."""
    pairs = blocks.select(F.explode(F.arrays_zip("codes", "counts")).alias("p")).select(F.col("p.codes").alias("code"), F.col("p.counts").alias("n"))
    counted = stored(pairs.groupBy("code").agg(F.sum("n").alias("count")), "pairs")
    b = F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")
    tops = counted.groupBy(b).agg(F.max("count").alias("top"))
    # One row for each id of B's vocabulary.
    return counted.select("*", b).join(F.broadcast(tops), "b").select("code", "count", (F.col("count") == F.col("top")).alias("best"))


def _summed(extra: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1)
                lists = {c: row.column(c).flatten() for c in (*_DOCS, *extra, "count", "best")}
                count, best = lists["count"].to_numpy(), lists["best"].to_numpy(zero_copy_only=False)
                places = np.frombuffer(row.column("links")[0].as_py(), np.uint16 if len(count) <= 1 << 16 else np.uint32)
                to = np.concatenate([[0], np.cumsum(lists["n_groups"].to_numpy())])
                sums = [np.diff(np.concatenate([[0], np.cumsum(x[places].astype(np.int64))])[to]) for x in (best, count)]
                yield pa.RecordBatch.from_arrays([*(lists[c] for c in (*_DOCS, *extra)), lists["n_groups"], *map(pa.array, sums)],
                                                 [*_DOCS, *extra, "n_links", "n_best", "count_sum"])

    return run


def align(docs: DataFrame, a: str, b: str, with_groups: bool = False, block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per document of ``docs(doc_id, text)``: ``n_a``, ``n_b``, ``n_groups``, ``groups_sha256``,
    ``n_links``, ``n_best`` and ``count_sum``; ``with_groups`` adds the groups as ``a1,a2|b1;a3|b2,b3``.

    ``a`` is a byte-level tokenizer file, ``b`` a piece model file.
    """
    extra = ["groups"] if with_groups else []
    blocks = stored(aligned_blocks(docs, a, b, with_groups, block_links), "aligned")
    pairs = blocks.select("block", F.posexplode("codes").alias("at", "code"))
    rated = pairs.hint("merge").join(rated_pairs(blocks), "code")
    back = rated.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "count", "best"))).alias("rated"))
    none = F.array().cast("array<struct<at:int,count:bigint,best:boolean>>")
    whole = blocks.drop("codes", "counts").hint("merge").join(back, "block", "left").withColumn("rated", F.coalesce("rated", none))
    given = whole.select(*_DOCS, *extra, "links", F.col("rated.count").alias("count"), F.col("rated.best").alias("best"))
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string" + (", groups string" if with_groups else "") + ", n_links bigint, n_best bigint, count_sum bigint"
    return given.mapInArrow(_summed(extra), schema)
