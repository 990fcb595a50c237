"""Operator 4, secret scans: corpus-wide ownership frequency.

A task scans whole texts for candidates.  Three kinds are always reported (*base*):
assignments to a secret's name, access key ids and long runs of hexadecimal digits.  A fourth
kind, ``live``, is any other long mixed run of key characters; it is reported only if the
corpus says it belongs to somebody.  For that, the values of all candidates are hashed and
counted over the corpus: in how many distinct repositories and of how many distinct owners
does a value stand?  A value that many owners share, or that one or two owners have all over
their repositories, is a copied example (documentation, a template, a checksum); one that
stays with few owners and few repositories looks like a live credential, however many
documents of those repositories hold it.

Owners are counted after (value, owner, repository) is made distinct, with map-side partial
aggregation, so a value that stands in a third of all documents is a few rows per task.
Documents without a candidate never take part in a shuffle.

Defined results: null and empty texts have no spans; a null owner or repository counts as
one more owner or repository; repeated rows each get their spans and count as one owner; an
empty table gives no rows; extra columns are ignored by :func:`scan` and kept by
:func:`redact`.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.llm.common import LOWER, byte_slices, byte_table, doc_text, flat_bytes, prepare, runs
from clickpath.storage import stored

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("live",)
# Fixed patterns of the base kinds (A-Z and a-z only, whatever the text's language).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
#: A ``live`` candidate: so many key characters, of at least two classes, this many bits each.
LIVE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LIVE_CHARS, LIVE_BITS = 20, 3.0
#: A value of more owners than this is a copied example.
MAX_OWNERS = 2
#: So is one that stands in more repositories than this, whoever owns them.  An owner's live key
#: may be in a few; with (source, lang) as repositories, four languages of one owner are too many.
MAX_REPOSITORIES = 3

_HEX_BYTES, _LIVE_BYTES = byte_table(r"[0-9a-f]"), byte_table(r"[A-Za-z0-9+/_=-]")
SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("value", T.StringType())])


def bits_per_char(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def _mixed(value: str) -> bool:
    digits = sum(c.isdigit() for c in value)
    letters = sum(c.isalpha() for c in value)
    return digits >= 3 and letters >= 3 and bits_per_char(value) >= LIVE_BITS


def text_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Candidates of one text as (kind, start, end, value), by start and then kind."""
    found = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    taken = sorted((a, b) for _, a, b, _ in found)
    at, reach = 0, 0
    for m in LIVE.finditer(text):
        a, b = m.span()
        while at < len(taken) and taken[at][0] < b:
            reach = max(reach, taken[at][1])
            at += 1
        if a >= reach and _mixed(m[0]):
            found.append(("live", a, b, m[0]))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _spotted(column: pa.Array) -> np.ndarray:
    """Rows that can hold a candidate: a secret's name, or a long run of key characters."""
    data, offsets = flat_bytes(column)
    mark = np.zeros(len(offsets) - 1, bool)
    if not len(data):
        return mark
    places = [a[b - a >= least] for inside, least in ((_HEX_BYTES[data], HEX_CHARS), (_LIVE_BYTES[data], ACCESS_CHARS)) for a, b in [runs(inside, offsets)]]
    lower = LOWER[data].tobytes()
    for name in NAMES:
        at = lower.find(name)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            mark[row] = True                 # one look at a row is enough
            at = lower.find(name, int(offsets[row + 1]) - len(name) + 1 if offsets[row + 1] - len(name) >= at else at + 1)
    mark[np.searchsorted(offsets, np.concatenate(places), side="right") - 1] = True
    return mark


def scan(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang"), keep_text: bool = False) -> DataFrame:
    """``(doc, row, owner, repository, spans)`` of every document, stored.

    ``doc`` holds the columns of ``docs`` (the text only if asked for), ``row`` numbers the
    rows, and ``spans`` are the candidates of all kinds with their value's SHA-256.
    """
    prepare(docs.sparkSession)
    kept = F.struct(*(c for c in docs.columns if keep_text or c != "text"))
    text = [] if keep_text else [F.col("text").cast("string").alias("text")]
    given = docs.select(kept.alias("doc"), *text, F.col(owner).cast("string").alias("owner"),
                        F.to_json(F.struct(*repository)).alias("repository"))
    schema = T.StructType([*given.drop("text").schema.fields, T.StructField("spans", T.ArrayType(SPAN))])
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in byte_slices(doc_text(batch)):
                part = batch.slice(lo, hi - lo)
                texts = doc_text(part)
                spans: list[list[dict]] = [[] for _ in range(hi - lo)]
                for k in np.flatnonzero(_spotted(texts)).tolist():
                    spans[k] = [{"kind": kind, "start": a, "end": b, "value": hashlib.sha256(v.encode()).hexdigest()} for kind, a, b, v in text_spans(texts[k].as_py())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc", "owner", "repository")), pa.array(spans, span_type)], ["doc", "owner", "repository", "spans"])

    return stored(given.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "secret-spans")


def ownership(scanned: DataFrame) -> DataFrame:
    """``(value, n_repositories, n_owners, n_uses)`` of every candidate value in the corpus."""
    uses = scanned.filter(F.size("spans") > 0).select("owner", "repository", F.explode("spans.value").alias("value"))
    nameless = F.coalesce("owner", F.lit("\x00"))
    kept = uses.groupBy("value", nameless.alias("owner"), "repository").agg(F.count(F.lit(1)).alias("n"))
    by_owner = kept.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"))
    return by_owner.groupBy("value").agg(F.sum("repositories").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_uses"))


def judged(scanned: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``(row, spans)`` of the documents with reported spans; each span says whether it is ``copied``.

    Base spans are always reported, ``live`` ones if their value is not copied.
    """
    uses = scanned.filter(F.size("spans") > 0).select("row", F.explode("spans").alias("span"))
    rated = uses.join(ownership(scanned), uses["span"]["value"] == F.col("value"))
    copied = (F.col("n_owners") > max_owners) | (F.col("n_repositories") > max_repositories)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("span.kind"))
    return (rated.filter((F.col("span.kind") != "live") | ~copied)
            .groupBy("row").agg(F.array_sort(F.collect_list(F.struct(F.col("span.start").alias("start"), order.alias("order"), F.col("span.kind").alias("kind"), F.col("span.end").alias("end"),
                                                                     copied.alias("copied"), "n_owners", "n_repositories"))).alias("spans")))


def secrets(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang"), max_owners: int = MAX_OWNERS,
            max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``(doc, spans)`` for every document: its columns but the text, and its reported spans by start and kind."""
    scanned = scan(docs, owner, repository)
    marked = judged(scanned, max_owners, max_repositories)
    plain, seen = scanned.filter(F.size("spans") == 0), scanned.filter(F.size("spans") > 0)
    found = seen.select("row", "doc").join(marked, "row", "left").select("doc", "spans")
    none = F.lit(None).cast(marked.schema["spans"].dataType)
    return (found.unionAll(plain.select("doc", none.alias("spans")))
            .withColumn("spans", F.coalesce("spans", F.array().cast(marked.schema["spans"].dataType))))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every reported span replaced by a mark; other texts are left alone."""
    limits = options.pop("max_owners", MAX_OWNERS), options.pop("max_repositories", MAX_REPOSITORIES)
    scanned = scan(docs, **options, keep_text=True)
    plain, seen = scanned.filter(F.size("spans") == 0), scanned.filter(F.size("spans") > 0)
    joined = seen.select("row", "doc").join(judged(scanned, *limits), "row", "left")
    clean = plain.select("doc.*").unionByName(joined.filter(F.col("spans").isNull()).select("doc.*"))
    dirty = joined.filter(F.col("spans").isNotNull()).select("doc", F.col("doc.text").cast("string").alias("text"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_masked(t, s) for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], ["doc", "text"])

    masked = dirty.mapInArrow(run, dirty.drop("spans").schema)
    doc = F.col("doc").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(masked.select(doc.alias("doc")).select("doc.*"))


def _masked(text: str, spans: list[dict]) -> str:
    """The text with its spans, merged where they overlap, replaced by marks."""
    out, at = [], 0
    for span in spans:
        if span["start"] >= at:
            out += [text[at:span["start"]], "<EXAMPLE>" if span["copied"] else "<SECRET>"]
        at = max(at, span["end"])
    return "".join([*out, text[at:]])
