"""Zone map of the raw events (E18): which event dates each file holds.

Raw events lie by ingest date, and a client's clock may be off by any time, so a filter on the
ingest date cannot stand for one on the event date.  The zone map holds the first and last
event date of every file, under ``<root>/zones``.  A read of some event dates opens the files
whose zone meets them, and those that the map does not know yet; so it always equals the
filtered full scan, however old the map is.  Files of raw streams are written once under names
of their own, so an entry never goes stale; entries of files that are gone are not looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.sources import compaction, io, layer
from clickpath.storage import stored

_SCHEMA = "file string, rows long, first_date date, last_date date"
_FILE = r"/(batch=[^/]*/dt=[^/]*/[^/]*)$"


def _below(path: Column) -> Column:
    """A file's name below the stream's folder."""
    return F.regexp_extract(path, _FILE, 1)


def _files(spark: SparkSession, root: str) -> DataFrame:
    """``(file, batch)`` of the files that count, by Spark's listing; none is opened."""
    path = f"{root}/events"
    if not layer.exists(spark, path):
        return spark.createDataFrame([], "file string, batch string")
    listed = spark.read.format("binaryFile").option("basePath", path).load(path).select(_below(F.col("path")).alias("file"))
    return compaction.live(listed.withColumn("batch", F.regexp_extract("file", r"^batch=([^/]*)/", 1)), path)


def _map(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/zones"
    if not layer.exists(spark, path):
        return spark.createDataFrame([], _SCHEMA)
    # A file that two updates saw has equal entries.
    return spark.read.schema(_SCHEMA).parquet(path).dropDuplicates(["file"])


def _opened(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """The events of ``files`` alone; only their names reach the driver, as for any read."""
    return io.read_events(spark, root, [f"{root}/events/{r['file']}" for r in files.select("file").collect()])


def update_zones(spark: SparkSession, root: str) -> int:
    """Add the files that the map does not know; only they are read.  How many there were."""
    new = stored(_files(spark, root).join(_map(spark, root), "file", "left_anti").select("file"), "zone-files")
    n = new.count()
    if n:
        # The scan gives a file's name as a URI.
        named = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
        seen = _opened(spark, root, new).select(_below(named).alias("file"), "event_date").groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"), F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"))
        made = new.join(seen, "file", "left").select("file", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "first_date", "last_date")
        made.write.mode("append").parquet(f"{root}/zones")
    return n


def zones(spark: SparkSession, root: str) -> DataFrame:
    """``(file, dt, rows, first_date, last_date)`` of the files that count; NULLs where the map has no entry."""
    dt = F.regexp_extract("file", r"/dt=([^/]*)/", 1).try_cast("date")
    return _files(spark, root).join(_map(spark, root), "file", "left").select("file", dt.alias("dt"), "rows", "first_date", "last_date")


def read_between(spark: SparkSession, root: str, first, last) -> DataFrame:
    """The raw events with an ``event_date`` from ``first`` to ``last``; equals the filtered full
    scan, and opens no file whose zone lies outside."""
    lo, hi = F.to_date(F.lit(first)), F.to_date(F.lit(last))
    meets = F.col("rows").isNull() | ((F.col("first_date") <= hi) & (F.col("last_date") >= lo))
    return _opened(spark, root, zones(spark, root).where(meets)).where(F.col("event_date").between(lo, hi))
