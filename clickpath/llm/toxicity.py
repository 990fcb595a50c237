"""Operator 8, toxicity: a weighted lexicon matched by Aho-Corasick after folding.

Folding undoes common disguises before anything is read: letters of other scripts that look
like Latin ones, full-width forms, invisible characters, and digits or signs that stand for
letters inside a word (``1d10t``, ``tr@sh``).

The lexicon is learned from labelled rows: whole words and word beginnings (stems of 3 to 8
characters), each weighted by the log-odds of standing in a toxic document.  Its exception
phrases, a hit with the word (of any length) before or after it, are learned likewise: a phrase that clean
documents use excuses the hit inside it.  All go into one Aho-Corasick automaton, and a
document's score is a logistic function of its hits' weight, that weight over its length, and
the number of different entries hit.

What is learned is bounded: ``SAMPLE_ROWS`` labelled rows (those with the smallest hash of
their doc_id), and ``MOST_ENTRIES`` entries and exceptions each, chosen on the driver among at
most 50 times as many that toxic texts hold.  Rows whose
crc32(doc_id) mod 4 is 2 are never learned from.  Copies of a text are learned from once.
Scoring covers every whole text.

Defined results: null and empty texts have no hits and get the score of a text without hits;
a null doc_id is not held out; repeated rows get equal scores; a document labelled twice
counts as toxic if one label says so, null labels are ignored; without labelled rows of both
kinds every score is 0; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.llm.common import byte_slices, doc_text, hashed_sample, prepare
from clickpath.storage import stored

SAMPLE_ROWS = 20_000
MOST_ENTRIES = 4_000
THRESHOLD = 0.3
_STEMS = range(3, 9)
_LEAST_WEIGHT, _LEAST_GAIN = 1.5, 15.0

# Letters that look like Latin ones, in the order of the Latin letters.
HOMOGLYPHS = {"a": "аαɑ", "b": "Ьв", "c": "сϲ", "d": "ԁ", "e": "еεє", "g": "ɡ", "h": "һн", "i": "іιı", "j": "ј", "k": "кκ", "l": "ӏ", "m": "м",
              "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уү", "z": "ᴢ"}
INVISIBLE = "­​‌‍⁠﻿"
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_FOLD = str.maketrans({c: latin for latin, alike in HOMOGLYPHS.items() for c in alike} | dict.fromkeys(INVISIBLE)
                      | {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0xFF01, 0xFF5F)})
_WORD = re.compile(r"[^\W_]+")
# Substitutes with a letter on both sides, or a digit that begins a word of two letters or more.
_SUBSTITUTE, _LETTER = "[" + "".join(SUBSTITUTES) + "]{1,3}", r"[^\W\d_]"
_DISGUISED = re.compile(rf"(?<={_LETTER}){_SUBSTITUTE}(?={_LETTER})|(?<![\w@$!])[0134578](?={_LETTER}(?:{_LETTER}|{_SUBSTITUTE}{_LETTER}))")


def fold(text: str | None) -> str:
    """Lower-case text with disguises undone."""
    low = (text or "").lower()
    if not low.isascii():
        low = low.translate(_FOLD)
    return _DISGUISED.sub(lambda m: "".join(SUBSTITUTES[c] for c in m[0]), low)


@dataclass
class Lexicon:
    """``words`` match whole words, ``stems`` word beginnings; ``exceptions`` excuse hits inside them."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for entry in {*self.words, *self.stems, *self.exceptions}:
            found.add_word(entry, entry)
        if len(found):
            found.make_automaton()
        return found

    def hits(self, automaton, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, entry, weight) of the heaviest hit at each word of a folded text."""
        best: dict[int, tuple[int, int, str, float]] = {}
        excused: list[tuple[int, int]] = []
        if not len(automaton):
            return []
        known = set(self.exceptions)
        for last, entry in automaton.iter(text):
            start, end = last + 1 - len(entry), last + 1
            if start and text[start - 1].isalnum():
                continue
            whole = end == len(text) or not text[end].isalnum()
            if whole and entry in known:
                excused.append((start, end))
            weight = max(self.words.get(entry, 0.0) if whole else 0.0, self.stems.get(entry, 0.0))
            if weight > 0 and (start not in best or best[start][3] < weight):
                best[start] = (start, end, entry, weight)
        if excused:
            best = {a: h for a, h in best.items() if not any(x <= a and h[1] <= y for x, y in excused)}
        return [best[a] for a in sorted(best)]


def measures(lexicon: Lexicon, automaton, text: str) -> tuple[float, float, float]:
    """Weight of a folded text's hits, the same over its length, and different entries hit."""
    hits = lexicon.hits(automaton, text)
    if not hits:
        return 0.0, 0.0, 0.0
    weight = sum(h[3] for h in hits)
    n_words = text.count(" ") + text.count("\n") + 1
    return math.log1p(weight), math.log1p(100 * weight / (n_words + 20)), math.log1p(len({h[2] for h in hits}))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(text, toxic)`` of at most ``rows`` labelled documents that are not held out."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
             .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sample = hashed_sample(known, ["doc_id"], rows)                          # bounded, so it may be broadcast
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id").select("text", "toxic")


def _log_odds(pos, neg, n_pos: int, n_neg: int):
    return np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))


def _gain(pos, neg, n_pos: int, n_neg: int):
    """Likelihood-ratio statistic of an entry standing in toxic documents."""
    expect = (pos + neg) * n_pos / max(1, n_pos + n_neg)
    return 2 * (pos * np.log(np.maximum(pos, 1e-9) / expect) + neg * np.log(np.maximum(neg, 1e-9) / np.maximum(pos + neg - expect, 1e-9)))


def _counted(rows: DataFrame, texts_entries) -> DataFrame:
    """Documents of each kind that hold an entry: partial counts per task, then a sum."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 512):          # few texts at a time: their entries are many
                pos, neg, part = Counter(), Counter(), batch.iloc[lo:lo + 512]
                for text, toxic in zip(part["text"], part["toxic"], strict=True):
                    (pos if toxic else neg).update(texts_entries(text))
                entries = list(pos.keys() | neg.keys())
                if entries:          # an empty frame has no string column
                    yield pd.DataFrame({"entry": entries, "pos": [pos[e] for e in entries], "neg": [neg[e] for e in entries]})

    counted = rows.mapInPandas(run, "entry string, pos long, neg long")
    return counted.groupBy("entry").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _entries(text: str) -> set[str]:
    words = set(_WORD.findall(text))
    return {"=" + w for w in words} | {w[:n] for w in words for n in _STEMS if n <= len(w)}


def _beginnings(entry: str) -> list[str]:
    """The stems that an entry lies under."""
    word = entry.lstrip("=")
    return [word[:n] for n in _STEMS if n < len(word) or (n == len(word) and entry[0] == "=")]


def learn(rows: DataFrame, most: int = MOST_ENTRIES) -> tuple[Lexicon, np.ndarray]:
    """Lexicon and logistic coefficients from ``rows(text, toxic)`` (a bounded sample)."""
    prepare(rows.sparkSession)

    def folded_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            texts = [fold(t) for t in batch["text"]]
            # Near copies share the smallest hash of their word triples more often than not.
            keys = []
            for text in texts:
                words = _WORD.findall(text)
                keys.append(min((xxhash.xxh64_intdigest(" ".join(words[i:i + 3])) >> 1 for i in range(max(1, len(words) - 2))), default=0))
            yield pd.DataFrame({"copy": keys, "text": texts, "toxic": batch["toxic"]})

    folded = rows.mapInPandas(folded_rows, "copy long, text string, toxic int")
    kept = stored(folded.groupBy("copy", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"), "toxic-sample")
    totals = dict(kept.groupBy("toxic").count().collect())
    n_pos, n_neg = sum(n for y, n in totals.items() if y), totals.get(0, 0)
    lexicon = Lexicon()
    if not n_pos or not n_neg:
        return lexicon, np.array([-np.inf, 0.0, 0.0, 0.0])
    # Only entries that several toxic documents hold can be learned: they are found first, and
    # the clean documents are searched for those alone.
    held = _counted(kept.filter("toxic <> 0"), _entries).filter(F.col("pos") >= max(3, n_pos // 500)).select("entry", "pos")
    held = held.orderBy(F.col("pos").desc(), "entry").limit(50 * most).toPandas()
    wanted = frozenset(held["entry"])
    clean = _counted(kept.filter("toxic = 0"), lambda text: wanted & _entries(text)).select("entry", "neg").toPandas()
    found = held.merge(clean, "left", on="entry").fillna({"neg": 0}).astype({"pos": "int64", "neg": "int64"})
    found["weight"] = _log_odds(found["pos"], found["neg"], n_pos, n_neg)
    found = found[(found["weight"] >= _LEAST_WEIGHT) & (_gain(found["pos"], found["neg"], n_pos, n_neg) >= _LEAST_GAIN)]
    support = dict(zip(found["entry"], found["pos"], strict=True))
    # A stem must say something beside the longer entry that most often stands behind it.
    most_under: dict[str, int] = {}
    for entry, pos in support.items():
        for p in _beginnings(entry):
            most_under[p] = max(pos, most_under.get(p, 0))
    beside = found["pos"] - found["entry"].map(most_under).fillna(0).astype(int)
    says = (_log_odds(beside, found["neg"], n_pos, n_neg) >= _LEAST_WEIGHT) & (beside >= 0.05 * found["pos"])
    found = found[says | ~found["entry"].isin(most_under)]
    found = found.assign(size=found["entry"].str.len()).sort_values(["size", "entry"])
    for entry, weight in zip(found["entry"], found["weight"], strict=True):
        word = entry.lstrip("=")
        shorter = max((lexicon.stems.get(p, 0.0) for p in _beginnings(entry)), default=0.0)
        if shorter < weight - 0.5 and len(lexicon.words) + len(lexicon.stems) < most:
            (lexicon.words if entry[0] == "=" else lexicon.stems)[word] = float(weight)
    lexicon.exceptions = _exceptions(kept, lexicon, n_pos, n_neg, most)
    return lexicon, _calibrated(kept, lexicon)


def with_neighbours(text: str, start: int, end: int) -> set[str]:
    """The word ``text[start:end]`` with the word before it and with the word after it, of any
    length, where a single space stands between."""
    first, last = start, end
    if text[start - 1:start] == " ":
        first -= 1
        while first and text[first - 1].isalnum():
            first -= 1
    if text[end:end + 1] == " ":
        last += 1
        while text[last:last + 1].isalnum():
            last += 1
    return {x for x in (text[first:end], text[start:last]) if len(x) > end - start + 1}


def _exceptions(rows: DataFrame, lexicon: Lexicon, n_pos: int, n_neg: int, most: int) -> list[str]:
    """Phrases of a hit and a neighbouring word that clean documents use at least as often."""
    kept: list = []

    def phrases(text: str) -> set[str]:
        if not kept:
            kept.append(lexicon.automaton())
        found = set()
        for start, end, _, _ in lexicon.hits(kept[0], text):
            while end < len(text) and text[end].isalnum():
                end += 1
            found |= with_neighbours(text, start, end)
        return found

    counted = _counted(rows, phrases).filter((F.col("neg") >= 3) & (F.col("neg") * n_pos >= F.col("pos") * n_neg))
    return [r["entry"] for r in counted.orderBy(F.col("neg").desc(), "entry").limit(most).collect()]


def _measured(rows: DataFrame, lexicon: Lexicon, carried: str, folded: bool) -> DataFrame:
    """``carried`` (a column, or the struct ``doc`` that holds the text) and the measures of each text."""
    names = ["weight", "density", "variety"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            for lo, hi in byte_slices(doc_text(batch)):
                part = batch.slice(lo, hi - lo)
                got = np.array([measures(lexicon, automaton, (text or "") if folded else fold(text)) for text in doc_text(part).to_pylist()], float)
                yield pa.RecordBatch.from_arrays([part.column(carried), *map(pa.array, got.T)], [carried, *names])

    schema = T.StructType([rows.schema[carried], *(T.StructField(c, T.DoubleType()) for c in names)])
    return rows.mapInArrow(run, schema)


def _calibrated(rows: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Ridge-penalised logistic regression (Newton steps) on the bounded sample's measures."""
    data = _measured(rows, lexicon, "toxic", True).toPandas()
    x = np.column_stack([np.ones(len(data)), data[["weight", "density", "variety"]].to_numpy()])
    y = (data["toxic"].to_numpy() > 0).astype(float)
    beta = np.zeros(4)
    ridge = np.diag([1e-3, 0.1, 0.1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def score(docs: DataFrame, lexicon: Lexicon, beta: np.ndarray, threshold: float = THRESHOLD, keep_text: bool = True) -> DataFrame:
    """``(doc, score, predicted)`` for every row; ``doc`` holds the columns of ``docs`` (without the text
    unless ``keep_text``: then no text comes back from Python)."""
    prepare(docs.sparkSession)
    given = F.struct(*(c for c in docs.columns if keep_text or c != "text")).alias("doc")
    measured = _measured(docs.select(given, *([] if keep_text else ["text"])), lexicon, "doc", False)
    if not np.isfinite(beta[0]):
        value = F.lit(0.0)
    else:
        z = F.lit(float(beta[0])) + sum(F.col(c) * float(b) for c, b in zip(("weight", "density", "variety"), beta[1:], strict=True))
        value = 1 / (1 + F.exp(-z))
    return measured.select("doc", value.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = SAMPLE_ROWS, keep_text: bool = True) -> DataFrame:
    """Learn from ``labels(doc_id, toxic)`` and score every row of ``docs``."""
    lexicon, beta = learn(training_rows(docs, labels, rows))
    return score(docs, lexicon, beta, threshold, keep_text)
