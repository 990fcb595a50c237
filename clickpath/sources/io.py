"""File sources and sinks (A1-A6).  Paths are Hadoop URIs: ``file://``, ``s3a://``,
``gs://``, ``abfss://`` all work unchanged (A6).

Raw streams are NDJSON under ``<root>/<events|bad>/batch=<name>/dt=YYYY-MM-DD/``, whoever
writes them: a streaming micro-batch under its id (so a re-run replaces itself), an append or
a replay under a name of its own.  Schemas are declared,
never inferred: a dataset where no row carries ``page`` still has a ``page`` column.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.operators.ingest import allow_repeated_keys
from clickpath.sources import compaction, layer
from clickpath.sources.layer import exists as _exists
from clickpath.sources.schema import BAD_SCHEMA, DERIVED_SCHEMA, EVENT_SCHEMA, INGEST_DATE


def _with_dt(schema: T.StructType, *more: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("dt", T.DateType()), *more])


_BATCH = T.StructField("batch", T.StringType())
_LINE = "_corrupt_record"
#: No limit to the digits of a number: one of any length makes its field unreadable, not its line.
_JSON = {"maxNumLen": str(2**31 - 1)}


def _readable(line: Column) -> Column:
    """Whether a line is a JSON object (or an array of them, whose elements are rows)."""
    listed = F.size(F.from_json(line, "array<map<string,string>>", _JSON)) > 0
    return F.from_json(line, "map<string,string>", _JSON).isNotNull() | F.coalesce(listed, F.lit(False))


def _read_lines(spark: SparkSession, path: str, fields: list[T.StructField], files: list[str] | None = None, per_trigger: int | None = None) -> DataFrame:
    """Rows of the NDJSON files below ``path`` (only of ``files`` there, if given), with ``_LINE``: the text of a line of which a field that is read
    does not convert (that field is NULL), else NULL.  With ``per_trigger`` they are a stream of so many files a micro-batch.

    Which lines are rows depends on the line alone, never on the columns that a query reads."""
    schema = _with_dt(T.StructType(fields), _BATCH, T.StructField(_LINE, T.StringType()))
    reader = spark.read if per_trigger is None else spark.readStream.option("maxFilesPerTrigger", per_trigger)
    rows = reader.schema(schema).option("basePath", path).options(**_JSON).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE).json(path if files is None else files)
    # A compacted batch holds lines that a stream has read as they landed.
    rows = compaction.live(rows, path) if per_trigger is None else rows.where(~F.col("batch").startswith(compaction.PREFIX))
    # Always true, and not known to be so: Spark refuses a read of the line's text without any field.
    with_field = F.xxhash64(fields[0].name) >= F.lit(-(2**63))
    return rows.where((F.col(_LINE).isNull() | _readable(F.col(_LINE))) & with_field).drop("batch")


def _time(name: str) -> Column:
    """A timestamp; RFC 3339 allows the letters T and Z in lower case too."""
    text = F.translate(F.get_json_object(_LINE, f"$.{name}"), "tz", "TZ")
    return F.coalesce(F.col(name), text.try_cast("timestamp"))


def _whole_number(device_field: str) -> Column:
    """An integer as JSON Schema has it: 1280.0 is one; over 64 bits it is NULL."""
    number = F.get_json_object(_LINE, f"$.device.{device_field}").try_cast("decimal(38,10)")
    return F.coalesce(F.col("device")[device_field], F.when(number == F.floor(number), number.try_cast("bigint")))


def read_events(spark: SparkSession, root: str, files: list[str] | None = None) -> DataFrame:
    """A1: raw good events (declared schema, hive ``dt``) plus ``event_date``.

    Unknown fields are ignored, missing ones are NULL and so is a field that does not convert;
    a line that is no JSON object is no row (:func:`read_dropped` has those).  No ``events/``
    directory yet is an empty table.  ``params`` keeps
    the object's JSON text.  A filter on ``dt`` prunes directories before any file is opened;
    with ``files`` only those are read."""
    path = f"{root}/events"
    if files == [] or not _exists(spark, path):
        return spark.createDataFrame([], _with_dt(EVENT_SCHEMA)).withColumn("event_date", F.to_date("event_timestamp"))
    return _typed_events(_read_lines(spark, path, EVENT_SCHEMA.fields, files))


def stream_events(spark: SparkSession, root: str, max_files: int = 1000) -> DataFrame:
    """A1 as a stream: the same rows as :func:`read_events`, file by file as batches land.

    Compacted batches are left out, for they repeat lines that have landed before: start a
    stream before the batches that it has not read yet are cleaned up.  ``events/`` must exist."""
    return _typed_events(_read_lines(spark, f"{root}/events", EVENT_SCHEMA.fields, per_trigger=max_files))


def _typed_events(rows: DataFrame) -> DataFrame:
    """Event rows of :func:`_read_lines`, with what other spellings of a value say, and ``event_date``."""
    device = F.col("device")
    for name in ("screen_width", "screen_height"):
        device = device.withField(name, _whole_number(name))
    partly = F.col(_LINE).isNotNull()
    rows = rows.withColumns({**{name: _time(name) for name in ("event_timestamp", "ingested_at")},
                             "device": F.when(partly & F.col("device").isNotNull(), device).otherwise(F.col("device"))})
    return rows.drop(_LINE).withColumn("event_date", F.to_date("event_timestamp"))


def read_bad(spark: SparkSession, root: str) -> DataFrame:
    """A2: rejected rows.  No ``bad/`` directory is the normal state: an empty table with
    the declared schema is returned (so "0 rejected" is a result, not a missing view).
    Lines that are partly or not readable: as in :func:`read_events`."""
    path = f"{root}/bad"
    if not _exists(spark, path):
        return spark.createDataFrame([], _with_dt(BAD_SCHEMA))
    allow_repeated_keys(spark)
    # The payload is any JSON value: read as a variant, a string keeps its quotes and a null is one.
    fields = [T.StructField(f.name, T.VariantType()) if f.name == "payload" else f for f in BAD_SCHEMA.fields]
    rows = _read_lines(spark, path, fields).withColumn("ingested_at", _time("ingested_at"))
    return rows.withColumn("payload", F.to_json("payload")).drop(_LINE)


def read_dropped(spark: SparkSession, root: str, stream: str = "events") -> DataFrame:
    """``(value, batch, dt)``: the lines of a raw stream that are no row of it, for they are no
    JSON object (cut off, say); blank lines aside.  Rows and these make up the whole stream."""
    path, schema = f"{root}/{stream}", "value string, batch string, dt date"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = compaction.live(spark.read.schema(schema).option("basePath", path).text(path), path)
    return lines.where((F.trim("value") != "") & ~_readable(F.col("value")))


def read_layer(spark: SparkSession, root: str, manifest: layer.Manifest, dates: list[str] | None = None) -> DataFrame:
    """Rows of a derived layer as ``manifest`` has it, with their ingest date (``INGEST_DATE``);
    only of the partitions ``dates``, if given."""
    reader = spark.read.schema(DERIVED_SCHEMA)
    if manifest.dates is None:
        there = layer.folders(spark, root, "event_date=")
        paths = [f"{root}/{x}" for x in there if dates is None or x.split("=", 1)[1] in dates]
        base = root
    else:
        paths = [f"{root}/{x}" for d, x in sorted(manifest.dates.items()) if dates is None or d in dates]
        base = f"{root}/{layer.FOLDER}/data"
    if not paths:
        return spark.createDataFrame([], DERIVED_SCHEMA)
    return reader.option("basePath", base).parquet(*paths).select(*DERIVED_SCHEMA.fieldNames())


def read_derived(spark: SparkSession, root: str) -> DataFrame:
    """A3: the derived layer with hive ``event_date`` (partition pruning), in its declared schema.

    A layer with snapshots is read as its last committed manifest names it; a layer that is
    not there yet, or has no rows, is an empty table."""
    return read_layer(spark, root, layer.current(spark, root)).drop(INGEST_DATE)


def spread_small(df: DataFrame, path: str) -> DataFrame:
    """``df``, read from ``path``, over all cores where its files make fewer splits than there are.

    Files of a few megabytes are one task however much work a row is.  Larger inputs stay as
    they are read."""
    spark = df.sparkSession
    split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    status = layer._fs(spark, path).getContentSummary(layer._path(spark, path))
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if status.getLength() < split * cores else df


def _event_json(df: DataFrame) -> DataFrame:
    cols = [F.try_parse_json("params").alias("params") if c == "params" else F.col(c)
            for c in EVENT_SCHEMA.fieldNames()]
    return df.select(F.to_json(F.struct(*cols), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
                     .alias("value"), "dt")


def _bad_json(df: DataFrame) -> DataFrame:
    cols = [F.try_parse_json(c).alias(c) if c == "payload" else F.col(c) for c in BAD_SCHEMA.fieldNames()]
    return df.select(F.to_json(F.struct(*cols), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"})
                     .alias("value"), "dt")


#: Text files that a task has open at once; the rows of further dates are sorted first.
OPEN_FILES = 64


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Within, tasks write a file of every date at once instead of sorting all their rows by date."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_raw(df: DataFrame, root: str, stream: str, batch: str | None = None, compression: str | None = None) -> None:
    """A4: NDJSON partitioned by ingest date.  ``stream`` is ``events`` (contract rows) or
    ``bad`` (rejected rows).  Spark's commit protocol gives unique file names and atomic
    visibility.  A ``batch`` written again replaces itself; without one it is a new batch.
    ``compression`` names a codec of Spark's text files; readers tell it by the files' names."""
    body = _event_json(df) if stream == "events" else _bad_json(df)
    path = f"{root}/{stream}/batch={batch or uuid.uuid4().hex}"
    with _unsorted(df.sparkSession):
        body.write.mode("overwrite").partitionBy("dt").text(path, compression=compression)


COUNTS = "bodies long, received long, accepted long, rejected long, batch string, dt date"


def write_counts(counts: DataFrame, root: str, batch: str) -> None:
    """A batch's accepted and rejected elements per ingest date; written again, it replaces itself."""
    counts.coalesce(1).write.mode("overwrite").partitionBy("dt").json(f"{root}/counts/batch={batch}")


def read_counts(spark: SparkSession, root: str) -> DataFrame:
    """What every batch of a running or finished ingest took in, accepted and rejected."""
    path = f"{root}/counts"
    if not _exists(spark, path):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).option("basePath", path).json(path)
