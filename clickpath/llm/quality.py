"""Operator 5, quality rules: an isolation forest on rule statistics.

Every whole text gives its rule statistics (words, symbols, repeated lines and windows, ...)
in one pass.  Two plain rules reject a text outright.  For the others an isolation forest
decides: trees split small random samples at random values of random statistics, and a text
that is cut off after few splits is anomalous.  How anomalous is too much is calibrated on
the labelled rows: of all thresholds on the score, the one with the best balance of rejected
bad and kept good rows, among those that lose at most ``MAX_LOSS`` of the good ones.

What is fitted on is bounded: ``TREES * SAMPLE`` rows of statistics (those with the smallest
hash), and per-label counts in ``BINS`` score bins over all labelled rows.

Defined results: null and empty texts have no words and fail; null doc_ids keep their row;
repeated rows get equal verdicts; a document labelled twice counts as bad if one label says
so, null labels are ignored; without labelled rows of both kinds only the plain rules reject;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import byte_slices, byte_table, flat_bytes, hashed_sample, prepare, runs
from clickpath.storage import stored

LEAST_WORDS, MOST_REPEATED = 50, 50      # words; per cent of words in repeated windows
TREES, SAMPLE, BINS, SEED = 128, 256, 1000, 20
MAX_LOSS = 0.005
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_marks")
_WORD, _SYMBOL = byte_table(r"[^\x20\x09-\x0D]"), byte_table(r"[#*$%&|<>]")
_MARK, _NEWLINE = byte_table(r"[!-/:-@\[-`{-~]"), byte_table(r"\n")
_CODE_POINT = np.array([b & 0xC0 != 0x80 for b in range(256)])


def _per_row(at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(at, offsets))


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Rule statistics of a string column, by name."""
    data, offsets = flat_bytes(column)
    word = _WORD[data]
    starts, stops = runs(word, offsets)
    row_words = np.searchsorted(starts, offsets)
    out = {"n_words": np.diff(row_words)}
    for name, mask in (("word_chars", word & _CODE_POINT[data]), ("n_symbols", _SYMBOL[data]), ("n_marks", _MARK[data])):
        out[name] = _per_row(np.flatnonzero(mask), offsets)
    out["n_dup_lines"] = _equal_lines(data, offsets, starts)
    bounds = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[word])) if len(starts) else pa.array([], pa.string())
    ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), out["n_words"])
    out["n_distinct"] = np.bincount(np.unique(row << 32 | ids) >> 32, minlength=len(offsets) - 1) if len(ids) else np.zeros(len(offsets) - 1, np.int64)
    out["n_repeat_words"] = _repeated(ids, row, row_words)
    return {name: out[name].astype(np.int64) for name in COUNTS}


def _repeated(ids: np.ndarray, row: np.ndarray, row_words: np.ndarray) -> np.ndarray:
    """Words of each row inside 3-word windows that the row has twice or more."""
    rows = len(row_words) - 1
    if len(ids) < 3:
        return np.zeros(rows, np.int64)
    first = np.flatnonzero(row[:-2] == row[2:])
    size = int(ids.max()) + 1
    if 3 * size.bit_length() <= 62:
        key = (ids[first] * size + ids[first + 1]) * size + ids[first + 2]
    else:
        pair = np.unique(ids[first] * size + ids[first + 1], return_inverse=True)[1]
        key = pair * size + ids[first + 2]
    order = np.argsort(key, kind="stable")           # equal windows by place, so by row
    key, at = key[order], first[order]
    same = (key[1:] == key[:-1]) & (row[at[1:]] == row[at[:-1]])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[at[twice] + k] = True
    return np.bincount(row[covered], minlength=rows)


def _equal_lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the row."""
    rows = len(offsets) - 1
    kept = ~_NEWLINE[data]
    starts, stops = runs(kept, offsets)
    has = np.searchsorted(word_starts, stops) > np.searchsorted(word_starts, starts)
    starts, stops = starts[has], stops[has]
    row = np.searchsorted(offsets, starts, side="right") - 1
    if not len(starts):
        return np.zeros(rows, np.int64)
    # The lines' bytes, one after the other, without what lies between them.
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, stops, 1)
    text = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    bounds = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    lines = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(text))
    key = row << 32 | lines.dictionary_encode().indices.to_numpy().astype(np.int64)
    return np.bincount(row, minlength=rows) - np.bincount(np.unique(key) >> 32, minlength=rows)


def rule_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, <counts>)`` of every row of ``docs(doc_id, text)``."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in byte_slices(batch.column("text")):
                found = statistics(batch.column("text").slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *map(pa.array, found.values())], ["doc_id", *found])

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def shape(frame: pd.DataFrame) -> np.ndarray:
    """What the forest looks at: statistics of form that hardly depend on a text's length.

    Symbols and punctuation per word, and how fast the vocabulary grows.  Statistics that
    ordinary short texts stretch (digits, capitals, repeated lines) only blur the forest.
    """
    words = np.maximum(frame["n_words"].to_numpy(float), 1)
    distinct = frame["n_distinct"].to_numpy(float)
    return np.column_stack([frame["n_symbols"] / words, frame["n_marks"] / words, np.log(distinct + 1) / np.log(words + 1)])


@dataclass
class Forest:
    """Trees as rows of arrays: feature (-1 at a leaf), split value, left child, path length at a leaf."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    length: np.ndarray
    usual: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / usual path): near 1 is anomalous, 0.5 and less is ordinary."""
        total = np.zeros(len(x))
        if not len(self.feature):
            return total
        for feature, split, left, length in zip(self.feature, self.split, self.left, self.length, strict=True):
            node = np.zeros(len(x), np.int64)
            open_ = feature[node] >= 0
            while open_.any():
                at = node[open_]
                node[open_] = left[at] + (x[open_, feature[at]] >= split[at])
                open_ = feature[node] >= 0
            total += length[node]
        return 2.0 ** -(total / len(self.feature) / max(self.usual, 1e-9))


def usual_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def grow(x: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
    """An isolation forest on the rows of ``x``."""
    random = np.random.default_rng(seed)
    sample = min(sample, len(x))
    depth_limit = int(np.ceil(np.log2(max(sample, 2))))
    size = 2 ** (depth_limit + 1)
    feature, split, left = np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size), np.int64)
    length = np.zeros((trees, size))
    for t in range(trees if sample else 0):
        todo, used = [(0, x[random.choice(len(x), sample, replace=False)], 0)], 1
        while todo:
            node, rows, depth = todo.pop()
            spread = np.flatnonzero(rows.min(0) < rows.max(0)) if len(rows) > 1 else []
            if depth >= depth_limit or not len(spread):
                length[t, node] = depth + usual_path(len(rows))
                continue
            f = random.choice(spread)
            cut = random.uniform(rows[:, f].min(), rows[:, f].max())
            high = rows[:, f] >= cut
            if high.all():                     # the cut fell on the smallest value
                cut = np.nextafter(rows[:, f].min(), np.inf)
                high = rows[:, f] >= cut
            feature[t, node], split[t, node], left[t, node] = f, cut, used
            todo += [(used, rows[~high], depth + 1), (used + 1, rows[high], depth + 1)]
            used += 2
    return Forest(feature if sample else feature[:0], split, left, length, usual_path(sample))


def threshold(bins: pd.DataFrame, max_loss: float = MAX_LOSS) -> float:
    """Score from which rows are rejected, from counts ``(bin, bad, good)`` of labelled rows."""
    bins = bins.sort_values("bin", ascending=False)
    bad, good = bins["bad"].cumsum(), bins["good"].cumsum()
    if not len(bins) or not bins["bad"].sum() or not bins["good"].sum():
        return float("inf")
    gain = bad / bad.iloc[-1] - good / good.iloc[-1]
    gain[good > max_loss * good.iloc[-1]] = -1.0
    best = gain.idxmax()
    return float(bins["bin"][best]) / BINS if gain[best] > 0 else float("inf")


def quality(docs: DataFrame, labels: DataFrame, trees: int = TREES, sample: int = SAMPLE, max_loss: float = MAX_LOSS) -> DataFrame:
    """``(doc_id, <counts>, base_failed, score, kept)`` for every row of ``docs``."""
    counted = stored(rule_statistics(docs), "quality-counts")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    counted = counted.withColumn("base_failed", failed)
    drawn = hashed_sample(counted.filter(~failed), ["doc_id", *COUNTS], trees * sample)
    forest = grow(shape(drawn.toPandas()), trees, sample)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(score=forest.score(shape(batch)))

    schema = ", ".join([*(f"{c} {t}" for c, t in counted.dtypes), "score double"])
    scored = stored(counted.mapInPandas(run, schema), "quality-scores")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    bins = (scored.filter(~F.col("base_failed")).join(known, "doc_id").groupBy(F.floor(F.col("score") * BINS).alias("bin"))
            .agg(F.count_if(F.col("quality") == 0).alias("bad"), F.count_if(F.col("quality") != 0).alias("good")).toPandas())
    limit = threshold(bins, max_loss)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.floor(F.col("score") * BINS) < F.lit(limit) * BINS))
