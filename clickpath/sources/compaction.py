"""Compaction of raw streams: many small files become few, beside running writers and readers.

A raw stream is ``<stream>/batch=<name>/dt=D/*``.  Compaction writes the lines of many batches
to one new batch ``compact-<tag>`` and then commits, by one rename, a manifest that names it
and the batches it replaces.  Readers leave out replaced batches and compact batches that no
manifest names, by partition pruning, so they see every line once before, during and after.
The replaced folders stay until :func:`clean`, for readers that have listed them already.

Only finished batches are taken, and never the last batch of a stream, which a restarted query
may write again.  Lines are moved as they are, readable or not.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.sources import layer

FOLDER, PREFIX = "_compact", "compact-"
#: Batches whose files are on average smaller than half of this are worth rewriting.
TARGET_BYTES = 128 << 20


def _manifests(spark: SparkSession, path: str) -> list[str]:
    return layer.folders(spark, f"{path}/{FOLDER}", "manifest-")


def state(spark: SparkSession, path: str) -> dict | None:
    """The last committed manifest of a raw stream's folder: ``number``, ``made`` and ``replaced`` batches."""
    names = _manifests(spark, path)
    return json.loads(layer.read_text(spark, f"{path}/{FOLDER}/{names[-1]}")) if names else None


def _commit(spark: SparkSession, path: str, number: int, made: list[str], replaced: list[str]) -> None:
    text = json.dumps({"number": number, "made": sorted(made), "replaced": sorted(replaced)})
    layer.commit_text(spark, f"{path}/{FOLDER}/manifest-{number:010d}.json", text)


def live(rows: DataFrame, path: str) -> DataFrame:
    """Rows of the batches that count, by their partition column ``batch``."""
    found = state(rows.sparkSession, path)
    if found is None:
        return rows
    batch = F.col("batch")
    committed = batch.isin(found["made"]) if found["made"] else F.lit(False)
    replaced = batch.isin(found["replaced"]) if found["replaced"] else F.lit(False)
    return rows.where((~batch.startswith(PREFIX) | committed) & ~replaced)


def _files(spark: SparkSession, path: str) -> dict[str, list[tuple[str, int]]]:
    """(ingest date's folder, size) of the data files of every batch."""
    fs, out = layer._fs(spark, path), {}
    found = fs.listFiles(layer._path(spark, path), True)
    while found.hasNext():
        status = found.next()
        where = re.search(r"/batch=([^/]*)/(.*/)?([^/]*)$", status.getPath().toString())
        if where and not where[3].startswith(("_", ".")):
            out.setdefault(where[1], []).append((where[2] or "", int(status.getLen())))
    return out


def _least(files: list[tuple[str, int]], target_bytes: int) -> int:
    """Files that the bytes of every ingest date need."""
    by_date: dict[str, int] = {}
    for date, size in files:
        by_date[date] = by_date.get(date, 0) + size
    return sum(max(1, -(-size // target_bytes)) for size in by_date.values())


def _may_come_again(names: list[str]) -> set[str]:
    """The last batch of every numbered series."""
    last: dict[str, int] = {}
    for name in names:
        m = re.fullmatch(r"(.*-)(\d+)", name)
        if m:
            last[m[1]] = max(last.get(m[1], -1), int(m[2]))
    return {f"{series}{k}" for series, k in last.items()}


def compact(spark: SparkSession, root: str, stream: str = "events", target_bytes: int = TARGET_BYTES) -> dict:
    """Rewrite the small files of a raw stream (``events`` or ``bad``); what was done, in files and bytes.

    The lines of one ingest date are brought together and cut by bytes at run time, so a hot
    date is several files and many small dates share a task."""
    path = f"{root}/{stream}"
    sizes = _files(spark, path) if layer.exists(spark, path) else {}
    found = state(spark, path)
    if found is None and sizes:
        # From here on readers know which compact batches count.
        found = {"number": 0, "made": [], "replaced": []}
        _commit(spark, path, **found)
    known = sizes and set(sizes) - set(found["replaced"]) - {b for b in sizes if b.startswith(PREFIX) and b not in found["made"]}
    fixed = _may_come_again([b for b in sizes if not b.startswith(PREFIX)])
    taken = sorted(b for b in known or () if b not in fixed and sum(n for _, n in sizes[b]) < len(sizes[b]) * target_bytes / 2
                   and layer.exists(spark, f"{path}/batch={b}/_SUCCESS"))
    before, files = sum(len(sizes[b]) for b in known or ()), [f for b in taken for f in sizes[b]]
    if len(files) <= _least(files, target_bytes):
        return {"batches": 0, "files_before": before, "files_after": before, "bytes": 0}
    made = f"{PREFIX}{uuid.uuid4().hex}"
    lines = spark.read.schema("value string, batch string, dt date").option("basePath", path).text([f"{path}/batch={b}" for b in taken])
    lines.select("value", "dt").hint("rebalance", F.col("dt")).write.partitionBy("dt").text(f"{path}/batch={made}")
    _commit(spark, path, found["number"] + 1, [b for b in found["made"] if b not in taken] + [made], found["replaced"] + taken)
    after = _files(spark, path).get(made, [])
    return {"batches": len(taken), "files_before": before, "files_after": before - len(files) + len(after), "bytes": sum(n for _, n in files)}


def clean(spark: SparkSession, root: str, stream: str = "events") -> int:
    """Remove the replaced batches' folders, compact batches of attempts that died, and old
    manifests; run it when no reader still uses an earlier listing and no compaction is under way."""
    path = f"{root}/{stream}"
    found = state(spark, path)
    if found is None:
        return 0
    names = [x.split("=", 1)[1] for x in layer.folders(spark, path, "batch=")]
    gone = [b for b in names if b in found["replaced"] or (b.startswith(PREFIX) and b not in found["made"])]
    for b in gone:
        layer.remove(spark, f"{path}/batch={b}")
    _commit(spark, path, found["number"] + 1, found["made"], [])
    for name in _manifests(spark, path)[:-1]:
        layer.remove(spark, f"{path}/{FOLDER}/{name}")
    return len(gone)
