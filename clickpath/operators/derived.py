"""Derived layer (D4) - clock columns plus duplicate-delivery removal - and its rebuild, whole
(A5, E17) or by ingest dates (H5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickpath.config import Config
from clickpath.functions.clock import event_time, event_time_trusted, skew_seconds
from clickpath.sources import layer
from clickpath.sources.buckets import Bucketed
from clickpath.sources.schema import EVENT_COLUMNS, INGEST_DATE
from clickpath.storage import stored

#: Buckets of ids in the index of an ingest date.
INDEX_BUCKETS = 16
_ENTRY = "event_id string, ingested_at timestamp, hash long, event_date date, n long, mark string"


def with_clock(events: DataFrame, cfg: Config = Config()) -> DataFrame:
    """C13/C14 columns; ``event_date`` becomes the date of the trusted ``event_time``."""
    ts, ing = F.col("event_timestamp"), F.col("ingested_at")
    return (events.drop("event_date")
            .withColumn("skew_seconds", skew_seconds(ts, ing))
            .withColumn("event_time_trusted", event_time_trusted(ts, ing, cfg.skew_limit_seconds))
            .withColumn("event_time", event_time(ts, ing, cfg.skew_limit_seconds))
            .withColumn("event_date", F.to_date("event_time")))


def dedup_deliveries(events: DataFrame, copies: str | None = None) -> DataFrame:
    """Keep the earliest-ingested copy of each ``event_id``; rows without an id are all kept.

    One scan and one aggregation.  Rows without an id are grouped by their content (two hashes,
    128 bits), so they spread evenly, and a group of equal ones is given out as often as it
    counts; copies of an id collapse
    before the shuffle, so one id delivered millions of times moves at most one row per
    input partition.  Ties on ``ingested_at`` (NULLs last) break on the row's content hash,
    so the survivor is deterministic, and so are the groups when a task is repeated.
    ``copies`` names a column for how many rows each survivor stands for.
    """
    cols = events.columns
    nameless = F.col("event_id").isNull()
    content = F.when(nameless, F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols).alias("b")))
    order = F.struct(F.col("ingested_at").isNull(), F.col("ingested_at"), F.xxhash64(*[c for c in EVENT_COLUMNS if c in cols]))
    kept = events.groupBy(F.col("event_id").alias("_id"), content.alias("_content")).agg(
        F.min_by(F.struct(*cols), order).alias("_row"), F.count(F.lit(1)).alias("_n"))
    times = F.when(F.col("_id").isNull(), F.array_repeat(F.lit(1).cast("long"), F.col("_n").cast("int"))).otherwise(F.array("_n"))
    return kept.select("_row", F.explode(times).alias("_copies_")).select("_row.*", *([F.col("_copies_").alias(copies)] if copies else []))


def derived_events(events: DataFrame, cfg: Config = Config(), copies: str | None = None) -> DataFrame:
    """Clock columns + dedup.  Input: contract events (``dt`` optional)."""
    return with_clock(dedup_deliveries(events, copies), cfg)


def bucketed_derived(events: Bucketed, cfg: Config = Config()) -> DataFrame:
    """D4 over a table bucketed by ``event_id``: its buckets move no rows, and neither do the rows
    without an id, which are all kept.  Ids delivered so often that they would crowd a bucket
    are pre-aggregated and exchanged."""
    if events.by != ["event_id"]:
        raise ValueError(f"deduplication needs buckets of event_id, not of {events.by}")
    named = F.col("event_id").isNotNull()
    often = derived_events(events.apart.where(named), cfg)
    return derived_events(events.rows, cfg).unionByName(often).unionByName(with_clock(events.apart.where(~named), cfg))


def rebuild_stats(raw: DataFrame, cfg: Config = Config()) -> DataFrame:
    """E17 as a query: raw, derived, duplicates removed, untrusted clocks, partitions; one scan."""
    d = derived_events(raw, cfg, copies="_copies")
    return (d.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("raw_events"), F.count(F.lit(1)).alias("derived_events"),
                  F.count_if(~F.col("event_time_trusted")).alias("untrusted_clock"), F.count_distinct("event_date").alias("partitions"))
            .select("raw_events", "derived_events", (F.col("raw_events") - F.col("derived_events")).alias("duplicates_removed"),
                    "untrusted_clock", "partitions"))


def write_derived(derived: DataFrame, dest: str, max_records_per_file: int = 5_000_000, only_touched: bool = False) -> None:
    """A5: Parquet (zstd), partitioned by ``event_date``, rows ordered by ``event_time``.

    The rebalance is by date and sized by Spark at run time: small dates share a task, a hot
    date is split into as many as its bytes need, and ``maxRecordsPerFile`` bounds a file.
    A full static overwrite, so that a vanished date does not survive a rebuild, or with
    ``only_touched`` an overwrite of the dates in ``derived``.  ``dest`` must not be the path
    being read.
    """
    (derived.hint("rebalance", F.col("event_date"))
            .sortWithinPartitions("event_date", "event_time")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic" if only_touched else "static")
            .option("compression", "zstd")
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy("event_date")
            .parquet(dest))


def list_table_files(spark, root: str, suffix: str) -> list[tuple[str, int]]:
    """(parent directory, size) of every data file under ``root`` via the Hadoop FileSystem
    API - metadata only, no data is read; works for any scheme the cluster can reach."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(path, True)
    out = []
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            out.append((st.getPath().getParent().toString(), int(st.getLen())))
    return out


def _ingest_date(raw: DataFrame) -> Column:
    return F.col("dt") if "dt" in raw.columns else F.to_date("ingested_at")


def _copies(raw: DataFrame, cfg: Config) -> DataFrame:
    """All copies with clock columns, their ingest date and content hash."""
    rows = raw.select(*EVENT_COLUMNS, _ingest_date(raw).alias(INGEST_DATE))
    return with_clock(rows, cfg).withColumn("hash", F.xxhash64(*EVENT_COLUMNS))


def _entries(copies: DataFrame) -> DataFrame:
    """Index entries: the first copy of each id within an ingest date, and, for the rows without
    an id, their number and a mark of their content per ingest and event date (bucket -1)."""
    first = F.min(F.struct(F.col("ingested_at").isNull().alias("none"), "ingested_at", "hash", "event_date")).alias("k")
    named = copies.where(F.col("event_id").isNotNull()).groupBy("event_id", F.col(INGEST_DATE).alias("dt")).agg(first)
    named = named.select("event_id", "k.ingested_at", "k.hash", "k.event_date", F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("mark"), "dt",
                         F.pmod(F.xxhash64("event_id"), F.lit(INDEX_BUCKETS)).cast("int").alias("bucket"))
    nameless = copies.where(F.col("event_id").isNull()).groupBy("event_date", F.col(INGEST_DATE).alias("dt")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("hash").cast("decimal(38,0)")).cast("string").alias("mark"))
    return named.unionByName(nameless.withColumn("bucket", F.lit(-1)), allowMissingColumns=True)


def _write_index(entries: DataFrame, dest: str) -> dict[str, str]:
    """Write the entries into a folder of their own; the folder of each ingest date."""
    folder = layer.new_folder("index")
    entries.repartition("dt", "bucket").write.partitionBy("dt", "bucket").parquet(f"{dest}/{folder}")
    return {x.split("=", 1)[1]: f"{folder}/{x}" for x in layer.folders(entries.sparkSession, f"{dest}/{folder}", "dt=")}


def _read_index(spark: SparkSession, dest: str, manifest: layer.Manifest) -> DataFrame:
    paths = [f"{dest}/{x}" for _, x in sorted((manifest.index or {}).items())]
    schema = _ENTRY + ", dt date, bucket int"
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{dest}/{layer.FOLDER}/index").parquet(*paths).drop("tag")


def _data_folder(spark: SparkSession, dest: str, manifest: layer.Manifest, snapshots: bool | None) -> str | None:
    """Where a rebuild writes its rows: a new hidden folder with snapshots, else None."""
    keeps = manifest.dates is not None if snapshots is None else snapshots
    return layer.new_folder("data") if keeps else None


def _partitions(spark: SparkSession, dest: str, folder: str) -> dict[str, str]:
    return {x.split("=", 1)[1]: f"{folder}/{x}" for x in layer.folders(spark, f"{dest}/{folder}", "event_date=")}


def rebuild_derived(raw: DataFrame, dest: str, cfg: Config = Config(), snapshots: bool | None = None) -> dict:
    """Compaction job: raw contract events -> derived layer and its index, returning rebuild stats.

    With ``snapshots`` the rows go to folders of their own and one rename of a manifest makes
    them the layer, so readers (:func:`clickpath.sources.io.read_derived`) see the old layer
    whole until they see the new one whole, also where a rebuild dies.  Without, the folder is
    plain Parquet for any reader and is overwritten.  By default a layer stays as it is kept.

    Counts are collected with ``observe`` during the single write job; files and bytes
    come from the written table's file metadata."""
    spark, out = raw.sparkSession, Observation("out")
    manifest = layer.current(spark, dest)
    folder = _data_folder(spark, dest, manifest, snapshots)
    rows = raw.select(*EVENT_COLUMNS, _ingest_date(raw).alias(INGEST_DATE))
    kept = derived_events(rows, cfg, copies="_copies")
    write_derived(kept.observe(out, F.sum("_copies").alias("raw"), F.count(F.lit(1)).alias("n"),
                               F.count_if(~F.col("event_time_trusted")).alias("untrusted")).drop("_copies"), f"{dest}/{folder}" if folder else dest)
    # Spark plans nothing to observe over an input that it knows to be empty.
    got = {"raw": 0, "n": 0, "untrusted": 0} if raw.isEmpty() else out.get
    raw_n = got["raw"] or 0
    index = _write_index(_entries(_copies(raw, cfg)), dest)
    # A plain overwrite takes the manifests with it.
    layer.commit(spark, dest, manifest if folder else layer.current(spark, dest), _partitions(spark, dest, folder) if folder else None, index)
    files = [f for f in list_table_files(spark, f"{dest}/{folder}" if folder else dest, ".parquet") if folder or f"/{layer.FOLDER}/" not in f[0]]
    return {
        "raw_events": raw_n,
        "derived_events": got["n"],
        "duplicates_removed": raw_n - got["n"],
        "untrusted_clock": got["untrusted"],
        "partitions": len({d for d, _ in files}),
        "files": len(files),
        "bytes": sum(size for _, size in files),
    }


def _date_key(date: object) -> str:
    return layer.NO_DATE if date is None else str(date)


def in_dates(column: Column, dates: list) -> Column:
    """Whether a date is one of ``dates`` (None: no date)."""
    some = [F.to_date(F.lit(str(d))) for d in dates if d is not None]
    found = F.coalesce(column.isin(*some), F.lit(False)) if some else F.lit(False)
    return found | column.isNull() if None in dates else found


def fold_dates(spark: SparkSession, raw_of: Callable[[list], DataFrame], existing_of: Callable[[layer.Manifest, list[str]], DataFrame], dest: str,
               dates: list, cfg: Config = Config(), snapshots: bool | None = None) -> int:
    """H5: make the layer what a full rebuild over all ingest dates folded so far would be.

    The index holds, for every id and ingest date, the order key of that date's first copy.
    Its entries of ``dates`` are replaced by those of ``raw_of(dates)``; the ids of both
    decide what else is looked up, in the buckets of the index that they fall into.  An id whose
    earliest copy is another one than before loses its old row and gets its new one, which may
    come from a date folded earlier (``raw_of`` of that date is read for such ids).  Rows without
    an id are compared by number and content of an (ingest date, event date).  Only event dates
    in which a row changed are rewritten; folding a date again without a change rewrites none.
    Dates may be folded in any order, and a first fold makes the layer.  Returns the rows
    written."""
    manifest = layer.current(spark, dest)
    if manifest.index is None and layer.folders(spark, dest, "event_date="):
        raise ValueError(f"{dest} has rows but no index: rebuild it once")
    folder = _data_folder(spark, dest, manifest, snapshots)
    copies = _copies(raw_of(dates), cfg)
    cols = [c for c in copies.columns if c != "hash"]
    order = F.struct(F.col("ingested_at").isNull(), F.col("ingested_at"), F.col("hash"))

    def firsts(rows: DataFrame) -> DataFrame:
        first = rows.where(F.col("event_id").isNotNull()).groupBy("event_id", INGEST_DATE).agg(F.min_by(F.struct(*cols, "hash"), order).alias("row"))
        return first.select("row.*").select(*cols, "hash")

    fresh = stored(firsts(copies).unionByName(copies.where(F.col("event_id").isNull()).select(*cols, "hash")), "fold-fresh")
    made = stored(_entries(fresh), "fold-entries")
    old, ours = _read_index(spark, dest, manifest), in_dates(F.col("dt"), dates)

    # Ids that have, or had, a copy on one of the dates, and all their entries.
    named = F.col("event_id").isNotNull()
    touched = stored(made.where(named).select("event_id", "bucket").unionByName(old.where(named & ours).select("event_id", "bucket")).distinct(), "fold-ids")
    buckets = [r["bucket"] for r in touched.select("bucket").distinct().collect()]
    before = old.where(named & F.col("bucket").isin(buckets)).join(touched.select("event_id"), "event_id", "left_semi")
    key = F.struct(F.col("ingested_at").isNull(), F.col("ingested_at"), F.col("hash"), F.col("dt").isNull(), F.col("dt").alias("dt"), F.col("event_date").alias("event_date"))
    after = before.where(~ours).unionByName(made.where(named).select(*before.columns))
    was, now = (x.groupBy("event_id").agg(F.min(key).alias(name)) for x, name in ((before, "was"), (after, "now")))
    changed = stored(was.join(now, "event_id", "full").where(~F.col("was").eqNullSafe(F.col("now"))).select(
        "event_id", F.col("was").isNotNull().alias("left"), F.col("was.event_date").alias("from_date"),
        F.col("now").isNotNull().alias("comes"), F.col("now.event_date").alias("to_date"), F.col("now.dt").alias("dt"), F.col("now.hash").alias("hash")), "fold-changed")

    # (ingest date, event date) pairs whose rows without an id changed.
    def summed(rows: DataFrame, name: str) -> DataFrame:
        return rows.where(~named & ours).select(F.struct("dt", "event_date").alias("pair"), F.struct("n", "mark").alias(name))

    pairs = stored(summed(old, "was").join(summed(made, "now"), "pair", "full").where(~F.col("was").eqNullSafe(F.col("now"))).select("pair.dt", "pair.event_date"), "fold-pairs")
    dated = (changed.where("left").select(F.col("from_date").alias("d")).unionAll(changed.where("comes").select("to_date")).unionAll(pairs.select("event_date")).distinct())
    rewritten = [_date_key(r["d"]) for r in dated.collect()]

    # What stays in those event dates, and what comes.
    existing = existing_of(manifest, rewritten)
    held = F.struct(F.col(INGEST_DATE).alias("dt"), "event_date")
    gone = pairs.select(F.struct("dt", "event_date").alias("_pair"))
    keep = existing.join(changed.select("event_id"), "event_id", "left_anti").select(*existing.columns)
    keep = keep.join(gone, keep["event_id"].isNull() & held.eqNullSafe(F.col("_pair")), "left_anti")
    wanted = changed.where("comes").select("event_id", F.col("dt").alias("_want"), "hash")

    def chosen(rows: DataFrame) -> DataFrame:
        match = [rows["event_id"] == wanted["event_id"], rows[INGEST_DATE].eqNullSafe(wanted["_want"]), rows["hash"] == wanted["hash"]]
        return rows.join(wanted, match, "left_semi").select(*cols)

    nameless = fresh.where(F.col("event_id").isNull())
    comes = chosen(fresh).unionByName(nameless.join(gone, held.eqNullSafe(F.col("_pair")), "left_semi").select(*cols))
    elsewhere = [r["dt"] for r in changed.where(F.col("comes") & ~ours).select("dt").distinct().collect()]
    if elsewhere:      # copies of other dates that are now the earliest
        ids = changed.where(F.col("comes") & ~ours).select("event_id")
        comes = comes.unionByName(chosen(firsts(_copies(raw_of(elsewhere), cfg).join(ids, "event_id", "left_semi"))))
    merged = stored(keep.unionByName(comes.select(*keep.columns)), "fold")

    if folder:
        write_derived(merged, f"{dest}/{folder}")
        kept = {d: x for d, x in (manifest.dates or {}).items() if d not in rewritten}
        data = kept | _partitions(spark, dest, folder)
    else:
        data = None
        if rewritten:
            write_derived(merged, dest, only_touched=True)
            there = {_date_key(r["event_date"]) for r in merged.select("event_date").distinct().collect()}
            for date in set(rewritten) - there:
                layer.remove(spark, f"{dest}/event_date={date}")
    index = {d: x for d, x in (manifest.index or {}).items() if d not in {_date_key(x) for x in dates}}
    layer.commit(spark, dest, manifest, data, index | _write_index(made, dest))
    return merged.count()
