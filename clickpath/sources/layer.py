"""Which folders make up a derived layer: numbered manifests, each committed by one rename.

A layer is a folder that any Parquet reader can read by its ``event_date=`` partitions (the
plain layout), or, with snapshots, hidden folders that a manifest names.  Either way the
manifest names the folders of the index that incremental rebuilds look ids up in:

    <root>/event_date=D/*.parquet                     rows, plain layout
    <root>/_layer/manifest-<n>.json                   {"dates": {D: folder} or null, "index": {dt: folder}}
    <root>/_layer/data/tag=<t>/event_date=D/*.parquet rows, with snapshots
    <root>/_layer/index/tag=<t>/dt=D/bucket=B/*.parquet  index entries of the copies ingested on D

A reader takes the manifest of the highest number; a writer writes folders of its own and then
commits the next number, which fails if another writer has it.  A rebuild that dies leaves
folders that no manifest names.  A manifest has a line per date, whatever the rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

FOLDER = "_layer"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Manifest:
    number: int = 0
    #: Folder of every event date below the root; None: the plain layout.
    dates: dict[str, str] | None = None
    #: Folder of the index entries of every ingest date; None: no index.
    index: dict[str, str] | None = field(default=None)


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _fs(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    return _fs(spark, name).exists(_path(spark, name))


def folders(spark: SparkSession, name: str, prefix: str = "") -> list[str]:
    """Names of the folders and files right below ``name`` that begin with ``prefix``."""
    if not exists(spark, name):
        return []
    found = (s.getPath().getName() for s in _fs(spark, name).listStatus(_path(spark, name)))
    return sorted(x for x in found if x.startswith(prefix))


def remove(spark: SparkSession, name: str) -> None:
    _fs(spark, name).delete(_path(spark, name), True)


def read_text(spark: SparkSession, name: str) -> str:
    stream = _fs(spark, name).open(_path(spark, name))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commit_text(spark: SparkSession, name: str, text: str) -> None:
    """Write a file that is there whole or not at all; an error if it is there already."""
    jvm, fs = spark.sparkContext._jvm, _fs(spark, name)
    folder, _, last = name.rpartition("/")
    draft = f"{folder}/.{last}.{uuid.uuid4().hex}"
    out = fs.create(_path(spark, draft), False)
    out.write(bytearray(text.encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    files.rename(_path(spark, draft), _path(spark, name), options)


def _name(number: int) -> str:
    return f"manifest-{number:010d}.json"


def _load(spark: SparkSession, root: str, name: str) -> Manifest:
    return Manifest(**json.loads(read_text(spark, f"{root}/{FOLDER}/{name}")))


def current(spark: SparkSession, root: str) -> Manifest:
    """The committed manifest; an empty one of the plain layout if there is none."""
    names = folders(spark, f"{root}/{FOLDER}", "manifest-")
    return _load(spark, root, names[-1]) if names else Manifest()


def commit(spark: SparkSession, root: str, after: Manifest, dates: dict[str, str] | None, index: dict[str, str]) -> Manifest:
    """Make ``dates`` and ``index`` the layer; ``after`` is the manifest that they come from."""
    made = Manifest(after.number + 1, dates, index)
    commit_text(spark, f"{root}/{FOLDER}/{_name(made.number)}", json.dumps(made.__dict__, sort_keys=True))
    return made


def new_folder(kind: str) -> str:
    """A folder below the root for rows (``data``) or index entries (``index``) of one job."""
    return f"{FOLDER}/{kind}/tag={uuid.uuid4().hex}"


def clean(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove what none of the last ``keep`` (at least one) manifests names (what readers of older ones, or a
    rebuild under way, still use goes too: run it when there are none).  How many folders went."""
    names = folders(spark, f"{root}/{FOLDER}", "manifest-")
    kept = [_load(spark, root, n) for n in names[-keep:]]
    # _layer/<kind>/tag=<t> goes once no manifest names any partition of it.
    used = {"/".join(f.split("/")[:3]) for m in kept for part in (m.dates, m.index) for f in (part or {}).values()}
    made = {f"{FOLDER}/{kind}/{x}" for kind in ("data", "index") for x in folders(spark, f"{root}/{FOLDER}/{kind}", "tag=")}
    for name in [f"{FOLDER}/{n}" for n in names[:-keep]] + sorted(made - used):
        remove(spark, f"{root}/{name}")
    return len(made - used)
