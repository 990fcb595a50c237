"""Operator 7, SimHash near-duplicates: Golay-code fuzzy hashing.

A text's fingerprint has a 64-bit majority vote of its word shingles' hashes.  Equal
fingerprints are one vertex.  To find all pairs within 3 bits without comparing all, the
fingerprint is cut into segments of 22, 21 and 21 bits, each read as a word of the perfect
binary Golay code (23, 12, 7), whose radius-3 spheres cover every word:

* a word that differs from another by one bit lies within 4 of the other's nearest
  codeword, so a segment has one *asking* key (the index of its nearest codeword) and about
  five *answering* keys (the indices of all codewords within 4);
* of 3 errors over 3 segments, either every segment has one, and then the first two share
  codeword keys; or two segments have at most one together, and then one of them is equal
  and the other shares a codeword key.

Askers and answerers meet in an equi-join on (segments, exact value or codeword indices) and
are verified by the bit distance.  A key that more than ``CROWD`` fingerprints ask for would
make too many pairs; its members are linked exactly in linear space instead: two
fingerprints within 3 bits have a common word within 1 of one and 2 of the other, so
everything within 2 of a word is linked to the smallest fingerprint within 1 of it.

Defined results: null text and text without words have fingerprint zero and are linked like
others; a null doc_id keeps its row and never names a component (null if its group has no
doc_id); repeated rows share a component; no rows, no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.llm.common import LOWER, byte_slices, byte_table, flat_bytes, prepare, runs
from clickpath.llm.components import components
from clickpath.storage import stored

SHINGLE_WORDS, MAX_BITS, SEED = 3, 3, 42
CROWD = 32
_SEGMENTS = ((42, 22), (21, 21), (0, 21))       # shift, width
_WORD = byte_table(r"[^\x20\x09-\x0D]")
_GENERATOR = 0b101011100011                     # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def fingerprint_column(column: pa.Array, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Unsigned fingerprints of a string column (A-Z lower-cased, words joined by one space)."""
    data, offsets = flat_bytes(column)
    out = np.zeros(len(offsets) - 1, np.uint64)
    word = _WORD[data]
    starts, stops = runs(word, offsets)
    if not len(starts):
        return out
    # All words, each followed by one space: a shingle is then one slice.
    sizes = stops - starts + 1
    at = np.cumsum(sizes) - sizes
    text = np.full(int(sizes.sum()), 0x20, np.uint8)
    keep = np.ones(len(text), bool)
    keep[at + sizes - 1] = False
    text[keep] = LOWER[data[word]]
    buffer = text.tobytes()
    row_words = np.diff(np.searchsorted(starts, offsets))
    row_first = np.cumsum(row_words) - row_words
    n = np.where(row_words >= words, row_words - words + 1, np.minimum(row_words, 1))
    has = np.flatnonzero(n)
    first = np.repeat(row_first[has] - (np.cumsum(n[has]) - n[has]), n[has]) + np.arange(n.sum())
    last = first + np.repeat(np.minimum(row_words[has], words), n[has]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(buffer[a:b], SEED) for a, b in zip(at[first].tolist(), (at[last] + sizes[last] - 1).tolist(), strict=True)], np.uint64)
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    votes = np.add.reduceat(bits, np.cumsum(n[has]) - n[has], axis=0, dtype=np.int32)
    major = np.packbits(2 * votes > n[has][:, None], axis=1)
    out[has] = major.view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, *carry, bits)``; ``bits`` is the fingerprint as a signed long."""
    prepare(docs.sparkSession)
    kept = ["doc_id", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in byte_slices(batch.column("text"), 1 << 20):
                prints = fingerprint_column(batch.column("text").slice(lo, hi - lo), words)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in kept), pa.array(prints.view(np.int64))], [*kept, "bits"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, T.StructType([*given.drop("text").schema.fields, T.StructField("bits", T.LongType())]))


@cache
def golay() -> tuple[np.ndarray, np.ndarray]:
    """Check bits of every message, and for every syndrome the error words of weight 4 or less.

    Error words come by weight, so the first leads to the nearest codeword; -1 fills up.
    """

    def check(message: int) -> int:
        rest = message << 11
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= _GENERATOR << (bit - 11)
        return rest

    single = [1 << i if i < 11 else check(1 << (i - 11)) for i in range(23)]
    errors: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for places in combinations(range(23), weight):
            syndrome = 0
            for i in places:
                syndrome ^= single[i]
            errors[syndrome].append(sum(1 << i for i in places))
    width = max(map(len, errors))
    return np.array([check(m) for m in range(4096)]), np.array([e + [-1] * (width - len(e)) for e in errors])


def codewords(segment: np.ndarray) -> np.ndarray:
    """Indices of the codewords within 4 of each segment, nearest first, -1 where there are no more."""
    checks, errors = golay()
    found = errors[checks[segment >> 11] ^ (segment & 2047)]
    return np.where(found >= 0, (segment[:, None] ^ found) >> 11, -1)


def segment_keys(bits: np.ndarray, asking: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key that the fingerprints ask for, or answer to."""
    parts = [(bits.view(np.uint64) >> np.uint64(s)).astype(np.int64) & ((1 << w) - 1) for s, w in _SEGMENTS]
    near = [codewords(p)[:, :1] if asking else codewords(p) for p in parts]
    rows, keys = [], []

    def add(tag: int, lead: np.ndarray, follow: np.ndarray) -> None:
        both = (lead[:, :, None] << 12 | follow[:, None, :]) | tag << 36
        row, i, j = np.nonzero((lead >= 0)[:, :, None] & (follow >= 0)[:, None, :])
        rows.append(row)
        keys.append(both[row, i, j])

    add(0, near[0], near[1])
    for tag, (equal, close) in enumerate(((0, 2), (2, 0), (1, 2), (2, 1)), 1):
        add(tag, parts[equal][:, None], near[close])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(prints: DataFrame, asking: bool) -> DataFrame:
    name = "u" if asking else "v"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy()
            for lo in range(0, len(bits), 4096):
                row, key = segment_keys(bits[lo:lo + 4096], asking)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(bits[lo:lo + 4096][row])], ["key", name])

    return prints.select("bits").mapInArrow(run, f"key long, {name} long")


def _crowd_links(members: DataFrame) -> DataFrame:
    """Links that connect all pairs of ``members(bits)`` within 3 bits, in linear space."""
    one = [0] + [1 << i for i in range(64)]
    two = [1 << i | 1 << j for i, j in combinations(range(64), 2)]
    flips = np.array(one + two, np.uint64).view(np.int64)
    near = np.arange(len(flips)) < len(one)

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = batch["bits"].to_numpy(np.int64)
            for lo in range(0, len(bits), 64):
                part = bits[lo:lo + 64]
                yield pd.DataFrame({"word": (part[:, None] ^ flips).ravel(), "bits": np.repeat(part, len(flips)), "near": np.tile(near, len(part))})

    spread = members.repartition(members.sparkSession.sparkContext.defaultParallelism * 4)
    rows = spread.mapInPandas(around, "word long, bits long, near boolean")
    hub = F.expr("min(if(near, bits, null)) over (partition by word)")
    return rows.select(F.col("bits").alias("u"), hub.alias("v")).filter("u <> v").distinct()


def links(prints: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Links ``(u, v)`` that connect all pairs of the distinct ``prints(bits)`` within ``max_bits`` (3 at most)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the codeword keys find pairs of up to 3 differing bits")
    prepare(prints.sparkSession)
    ask, answer = _keyed(prints, True), _keyed(prints, False)
    crowded = stored(ask.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("key"), "simhash-crowded")
    calm = ask
    found = []
    if max_bits == 3 and not crowded.isEmpty():
        calm = ask.join(crowded, "key", "left_anti")
        members = (ask.join(crowded, "key", "left_semi").select(F.col("u").alias("bits"))
                   .unionAll(answer.join(crowded, "key", "left_semi").select(F.col("v").alias("bits"))).distinct())
        found.append(_crowd_links(stored(members, "simhash-members")))
    apart = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    # Spark takes the keys to be about as large as the fingerprints; about 50 answer for each.
    met = calm.join(answer.hint("merge"), (calm["key"] == answer["key"]) & (F.col("u") != F.col("v")) & apart)
    found.append(met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")))
    return found[0] if len(found) == 1 else found[0].unionAll(found[1])


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, crowd: int = CROWD, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *carry, bits, component_id, group)`` for every row of ``docs(doc_id, text)``.

    ``group`` is the smallest fingerprint of the component, which is there without doc_ids too.
    """
    prints = stored(fingerprints(docs, words, carry), "simhash-prints")
    distinct = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    root = components(stored(links(distinct, max_bits, crowd), "simhash-links")).withColumnRenamed("u", "bits")
    rooted = distinct.join(root, "bits", "left").select("bits", "first", F.coalesce("root", "bits").alias("group"))
    named = rooted.groupBy("group").agg(F.min("first").alias("component_id"))
    lookup = rooted.select("bits", "group").join(named, "group").select("bits", "component_id", "group")
    return prints.join(lookup, "bits").select("doc_id", *carry, "bits", "component_id", "group")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each component: its smallest doc_id (nulls last), then text hash."""
    told = docs.withColumn("__text", F.xxhash64("text"))
    found = near_duplicates(told.select("doc_id", "text", "__text"), carry=("__text",), **options)
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__text")).alias("kept"))
    keys = ["__id", "__none", "__text"]
    kept = first.select(F.coalesce("kept.doc_id", F.lit(0).cast("long")).alias("__id"), F.col("kept.none").alias("__none"), F.col("kept.__text").alias("__text"))
    told = told.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), "__none": F.col("doc_id").cast("long").isNull()})
    # Equal rows lie where the join has brought them: the texts move once.
    return told.join(kept.hint("merge"), keys, "left_semi").dropDuplicates(keys).select(*docs.columns)


def hex_digits(bits: Column) -> Column:
    """16 lower-case hexadecimal digits of a fingerprint column."""
    return F.lpad(F.lower(F.hex(bits)), 16, "0")
