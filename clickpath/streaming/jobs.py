"""Structured Streaming jobs (H1-H5).

The batch rebuild stays authoritative: a 166-day-late event exists, so no watermark may
ever drop data from the derived layer.  The streaming jobs are bounded, opt-in views:

H1 continuous ingest    landed bodies -> B1-B7 -> events/ + bad/ (foreachBatch, idempotent)
H2 live dedup           duplicate deliveries removed within a server-clock horizon, raw stream to raw stream
H3 live sessions        inactivity sessions: session windows, or a log kept in state and corrected by late rows
H4 live quality         per-minute skew buckets, id coverage, reject rate: windowed, or as parts of batches
H5 incremental rebuild  re-write only the event dates touched by newly arrived dt
"""

from __future__ import annotations

import json
from bisect import bisect_right
from operator import itemgetter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql import functions as F

from clickpath.config import SESSION_GAP_SECONDS, Config
from clickpath.operators import ingest as I
from clickpath.operators.derived import in_dates, fold_dates
from clickpath.functions.clock import round_half_away, skew_seconds
from clickpath.operators.health import SKEW_BUCKETS, SKEW_OVERFLOW, skew_bucket
from clickpath.shipping import ship_package
from clickpath.sources import compaction, io, layer

# Spark's session window merges events exactly one gap apart; the event model splits at >= gap.
LIVE_SESSION_GAP = f"{SESSION_GAP_SECONDS - 1} seconds 999999 microseconds"


def landed_bodies(spark: SparkSession, landing: str, max_files: int = 1000, whole_files: bool = False) -> DataFrame:
    """A7 as a stream: one request body per line of landed text files, or per file with
    ``whole_files`` (bodies of several lines).  The arrival stamp is the file's modification
    time - stable when a micro-batch is replayed."""
    return (spark.readStream.option("maxFilesPerTrigger", max_files).text(landing, wholetext=whole_files)
            .select(F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias("received_at")))


def landed_pixels(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """A8 as a stream: one pixel request's ``e`` parameter per line of landed text files."""
    lines = (spark.readStream.option("maxFilesPerTrigger", max_files).text(landing)
             .select(F.col("value").alias("e"), F.col("_metadata.file_modification_time").alias("received_at")))
    return I.decode_pixel(lines)


def ingest_stream(spark: SparkSession, landing: str, sink_root: str, checkpoint: str, trigger: dict | None = None,
                  collector_instance: str = "spark", pixels: str | None = None, whole_files: bool = False, compression: str | None = None):
    """H1: continuous ingest of landed bodies and, with ``pixels``, of landed pixel requests.

    Each micro-batch is processed once (a table below ``sink_root`` until its writes are done) and
    written under its own batch id, so a batch replayed after a failure replaces its output;
    ``compression`` as in :func:`clickpath.sources.io.write_raw`.  Beside the rows it
    writes the batch's counts (:func:`clickpath.sources.io.read_counts`) and its part of the
    quality minutes (:func:`read_quality`), which a restart neither loses nor doubles."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        seen, name = Observation(f"bodies-{batch_id}"), f"stream-{batch_id}"
        given = batch.withColumn("collector_instance", F.lit(collector_instance)).observe(seen, F.count(F.lit(1)).alias("n"))
        judged, work = I.ingest(given), f"{sink_root}/_work-{name}"
        try:
            judged.write.mode("overwrite").parquet(work)
            processed = batch.sparkSession.read.schema(judged.schema).parquet(work)
            io.write_raw(I.good_events(processed), sink_root, "events", name, compression)
            io.write_raw(I.bad_rows(processed), sink_root, "bad", name, compression)
            counts = I.fork_counts(processed).withColumn("bodies", F.lit(0 if batch.isEmpty() else seen.get["n"]).cast("long"))
            io.write_counts(counts, sink_root, name)
            parts = quality_parts(I.good_events(processed), I.bad_rows(processed))
            parts.coalesce(1).write.mode("overwrite").parquet(f"{sink_root}/quality/batch={name}")
        finally:
            layer.remove(spark, work)

    bodies = landed_bodies(spark, landing, whole_files=whole_files)
    if pixels:
        bodies = bodies.withColumn("decode_error", F.lit(None).cast("string")).unionByName(landed_pixels(spark, pixels))
    w = bodies.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def live_dedup(events: DataFrame, horizon: str = "1 hour") -> DataFrame:
    """H2: drop duplicate deliveries of an ``event_id`` that arrive within ``horizon``.

    The horizon runs on the time of arrival in this job, which only moves forward: no row is
    ever late, so a distinct id is never lost, however old its stamps are.  Rows without an
    id pass through untouched and never enter the dedup state.  Keeps the first copy
    *processed*; the batch rebuild keeps the earliest *ingested* - the two agree when copies
    arrive in order."""
    ids = (events.where(F.col("event_id").isNotNull()).withColumn("_arrived", F.current_timestamp())
           .withWatermark("_arrived", horizon).dropDuplicatesWithinWatermark(["event_id"]).drop("_arrived"))
    return events.where(F.col("event_id").isNull()).unionByName(ids)


def dedup_stream(spark: SparkSession, raw_root: str, dest: str, checkpoint: str, horizon: str = "1 hour", max_files: int = 1000, trigger: dict | None = None):
    """H2 as a job: the raw stream of ``raw_root`` without duplicate deliveries, as a raw stream
    in ``dest``.  A micro-batch is a batch of that stream; done again, it replaces itself."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        io.write_raw(batch, dest, "events", f"stream-{batch_id}")

    w = live_dedup(io.stream_events(spark, raw_root, max_files), horizon).writeStream.foreachBatch(write_batch)
    return w.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def live_sessions(events: DataFrame, cfg: Config = Config(), lateness: str = "1 hour",
                  time_col: str = "event_time") -> DataFrame:
    """H3: provisional inactivity sessions per visitor (session windows on the trusted
    clock).  Emitted when the watermark passes; later batch results supersede them."""
    gap = LIVE_SESSION_GAP if cfg.session_gap_seconds == SESSION_GAP_SECONDS else \
        f"{cfg.session_gap_seconds - 1} seconds 999999 microseconds"
    return (events.withWatermark(time_col, lateness)
            .groupBy("anonymous_id", F.session_window(time_col, gap).alias("session"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count_if(F.col("event_name") == "page_view").alias("page_views"))
            .select("anonymous_id", F.col("session.start").alias("session_start"),
                    F.col("session.end").alias("session_end"), "events", "page_views"))


def _quality_counts(events: DataFrame, bad: DataFrame | None) -> tuple[DataFrame, dict]:
    """Rows of both kinds, and the counts of H4 over them."""
    cols = ["ingested_at", "event_timestamp", "event_id"]
    rows = events.select(*cols, F.lit(False).alias("_rejected"))
    if bad is not None:
        rows = rows.unionByName(bad.select("ingested_at", F.lit(True).alias("_rejected")), allowMissingColumns=True)
    good = ~F.col("_rejected")
    skew = skew_seconds(F.col("event_timestamp"), F.col("ingested_at"))
    bucket = F.when(good, skew_bucket(skew))
    labels = [label for _, _, label in SKEW_BUCKETS] + [SKEW_OVERFLOW]
    return rows, {"events": F.count_if(good), "rejected": F.count_if(~good), "with_event_id": F.count("event_id"),
                  **{f"skew_bucket_{i}": F.count_if(bucket == lab) for i, lab in enumerate(labels)},
                  "untrusted_clock": F.count_if(good & (F.abs(skew) > F.lit(86400)))}


def _with_rate(counts: DataFrame) -> DataFrame:
    pct = round_half_away(F.lit(100.0) * F.col("rejected") / (F.col("events") + F.col("rejected")), 2)
    names = [c for c in counts.columns if c not in ("minute_start", "events", "rejected")]
    return counts.select("minute_start", "events", "rejected", pct.alias("reject_pct"), *names)


def live_quality(events: DataFrame, bad: DataFrame | None = None, lateness: str = "10 minutes") -> DataFrame:
    """H4: per ingest minute - accepted and rejected rows, reject rate, clock-skew buckets
    (the last one for everything ahead of the others), event_id coverage.

    ``bad`` are the rejected rows; without them nothing counts as rejected.  On a stream, rows
    later than ``lateness`` are left out (:class:`LateRows` counts them); :func:`read_quality`
    leaves out none."""
    rows, counts = _quality_counts(events, bad)
    found = rows.withWatermark("ingested_at", lateness).groupBy(F.window("ingested_at", "1 minute").alias("minute")).agg(*(c.alias(n) for n, c in counts.items()))
    return _with_rate(found.select(F.col("minute.start").alias("minute_start"), *counts))


def quality_parts(events: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """H4, mergeable: the counts of a part of the rows (a micro-batch, say) per ingest minute."""
    rows, counts = _quality_counts(events, bad)
    return rows.groupBy(F.date_trunc("minute", "ingested_at").alias("minute_start")).agg(*(c.alias(n) for n, c in counts.items()))


def read_quality(spark: SparkSession, root: str) -> DataFrame:
    """H4 over all batches that an ingest stream has written: no row is too late to count."""
    none = spark.createDataFrame([], "ingested_at timestamp, event_timestamp timestamp, event_id string")
    shape, path = quality_parts(none).schema, f"{root}/quality"
    if not io._exists(spark, path):
        return _with_rate(spark.createDataFrame([], shape))
    parts = spark.read.schema(shape).option("basePath", path).parquet(path).drop("batch")
    return _with_rate(parts.groupBy("minute_start").agg(*(F.sum(c).alias(c) for c in shape.fieldNames()[1:])))


class LateRows(StreamingQueryListener):
    """Counts what windowed queries leave out behind their watermark, by query name (or id).

    Rows are counted as they reach the state: after a task's pre-aggregation, so a count of
    groups there, but never zero where a row was left out."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(event.name or str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        name = event.progress.name or str(event.progress.id)
        self.dropped[name] = self.dropped.get(name, 0) + sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        pass


_SESSION_LOG = ("anonymous_id string, kind string, session_start timestamp, client_session_id string, "
                "distinct_client_session_ids long, events long, version long")
_MINUTE = 60_000_000


def _joined(sessions: list[list], rows: list[tuple[int, str | None]], gap_minutes: int) -> set[int]:
    """Put rows (microseconds, client session id) into their visitor's sessions, ``[start, end, rows, ids]``
    in order of time; sessions that they connect become one.  The starts of those that they touched."""
    runs: list[list] = []
    for at, sid in sorted(rows, key=itemgetter(0)):
        if not runs or at // _MINUTE - runs[-1][1] // _MINUTE >= gap_minutes:
            runs.append([at, at, 0, set()])
        run = runs[-1]
        run[1], run[2] = at, run[2] + 1
        if sid is not None:
            run[3].add(sid)
    touched = set()
    for start, end, n, ids in runs:
        # Sessions lie a gap apart: of those that begin before the run, only the last can be near it.
        lo = bisect_right(sessions, start, key=itemgetter(0))
        if lo and start // _MINUTE - sessions[lo - 1][1] // _MINUTE < gap_minutes:
            lo -= 1
        hi = lo
        while hi < len(sessions) and sessions[hi][0] // _MINUTE - end // _MINUTE < gap_minutes:
            hi += 1
        near = sessions[lo:hi]
        made = [min(start, near[0][0]), max(end, near[-1][1]), n + sum(s[2] for s in near), sorted(ids.union(*(s[3] for s in near)))] if near else [start, end, n, sorted(ids)]
        touched.update(s[0] for s in near)
        touched.add(made[0])
        sessions[lo:hi] = [made]
    return touched


def live_session_log(events: DataFrame, cfg: Config = Config(), time_col: str = "event_timestamp", horizon: str = "30 days", forget: str | None = None) -> DataFrame:
    """H3 without loss: gap sessions (D3's rule) of every visitor, kept in state and corrected by late rows.

    The output (update mode) is a log: a session as it is now (kind ``session``; ``events`` 0 where
    it has become part of an earlier one), rows without a time (``untimed``), and rows more than
    ``horizon`` behind their visitor's latest, which find their session closed (``late``).  All rows
    are in one of the three; :func:`live_session_table` is the current state of the log.

    A visitor's state is its sessions within the horizon and one number for the closed ones.
    With ``forget`` a visitor that has sent nothing for so long is dropped from the state."""
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    gap, span = cfg.session_gap_seconds // 60, int(pd.Timedelta(horizon).value // 1000)
    idle = int(pd.Timedelta(forget).total_seconds() * 1000) if forget else None
    names = [x.split()[0] for x in _SESSION_LOG.split(", ")]

    def update(key, batches, state):
        (visitor,) = key
        if state.hasTimedOut:
            state.remove()
            return
        sessions, closed, version = json.loads(state.get[0]) if state.exists else ([], None, 0)
        touched, untimed, late = set(), 0, 0
        for batch in batches:
            timed = [(int(at), sid) for at, sid in zip(batch["_at"].tolist(), batch["session_id"].tolist(), strict=True) if at == at]
            kept = timed if closed is None else [row for row in timed if row[0] >= closed]
            untimed, late = untimed + len(batch) - len(timed), late + len(timed) - len(kept)
            touched |= _joined(sessions, kept, gap)
        version += 1
        now, starts = {s[0]: s for s in sessions}, sorted(touched)
        # A session that is part of an earlier one now has no rows and no ids.
        rows = [("session", min(ids, default=None), len(ids), n) for _, _, n, ids in (now.get(t, (t, t, 0, ())) for t in starts)]
        rows += [(kind, None, 0, n) for kind, n in (("untimed", untimed), ("late", late)) if n]
        if sessions:
            # A session closes when no row within the horizon can touch it any more.
            limit = sessions[-1][1] - span
            open_ = [s for s in sessions if s[1] // _MINUTE + gap > limit // _MINUTE]
            if len(open_) < len(sessions):
                closed = max(closed or limit, limit)
            sessions = open_
        state.update((json.dumps([sessions, closed, version]),))
        if idle:
            state.setTimeoutDuration(idle)
        if rows:
            # A frame of arrays: pandas need not look at every value, and a visitor has few.
            kinds, ids, distinct, events = (np.array(x, dtype) for x, dtype in zip(zip(*rows), (object, object, np.int64, np.int64), strict=True))
            times = np.full(len(rows), "NaT", "datetime64[us]")
            times[:len(starts)] = np.array(starts, np.int64).view("datetime64[us]")
            columns = (np.full(len(rows), visitor, object), kinds, times, ids, distinct, events, np.full(len(rows), version, np.int64))
            yield pd.DataFrame(dict(zip(names, columns, strict=True)))

    given = events.select("anonymous_id", "session_id", F.unix_micros(time_col).alias("_at"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout
    return given.groupBy("anonymous_id").applyInPandasWithState(update, _SESSION_LOG, "state string", "update", timeout)


def live_session_table(log: DataFrame) -> DataFrame:
    """The sessions that a :func:`live_session_log` has arrived at, in the columns of D3."""
    w = F.max_by(F.struct("client_session_id", "distinct_client_session_ids", "events"), "version").alias("s")
    now = log.where("kind = 'session'").groupBy("anonymous_id", "session_start").agg(w).where("s.events > 0")
    return now.select("anonymous_id", "s.client_session_id", "s.distinct_client_session_ids", "session_start", "s.events")


def session_log_stream(spark: SparkSession, raw_root: str, dest: str, checkpoint: str, cfg: Config = Config(), horizon: str = "30 days",
                       forget: str | None = None, max_files: int = 1000, trigger: dict | None = None):
    """H3 as a job: :func:`live_session_log` over the raw stream of ``raw_root``.  A micro-batch's
    part of the log lies under its id in ``dest``; done again, it replaces itself."""
    ship_package(spark)                    # the state update runs on the workers

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{dest}/log/batch=stream-{batch_id}")

    w = live_session_log(io.stream_events(spark, raw_root, max_files), cfg, horizon=horizon, forget=forget).writeStream.outputMode("update").foreachBatch(write_batch)
    return w.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def read_session_log(spark: SparkSession, dest: str) -> DataFrame:
    """The log of :func:`session_log_stream`; before its first micro-batch an empty table."""
    path = f"{dest}/log"
    if not io._exists(spark, path):
        return spark.createDataFrame([], _SESSION_LOG)
    return spark.read.schema(_SESSION_LOG).option("basePath", path).parquet(path).select(*(x.split()[0] for x in _SESSION_LOG.split(", ")))


def incremental_rebuild(spark: SparkSession, raw_root: str, dest: str, new_dts: list, cfg: Config = Config(), snapshots: bool | None = None) -> int:
    """H5: fold ingest dates (None: rows without one) into the derived layer, in any order, so
    that it equals a full rebuild over all dates folded; running it again changes nothing.

    See :func:`clickpath.operators.derived.fold_dates`.  ``snapshots`` switches the layer by one
    rename (by default as the layer is kept).  Returns the rows written."""
    def raw_of(dates: list) -> DataFrame:
        return io.read_events(spark, raw_root).where(in_dates(F.col("dt"), dates))

    def existing_of(manifest, dates: list[str]) -> DataFrame:
        return io.read_layer(spark, dest, manifest, dates)

    return fold_dates(spark, raw_of, existing_of, dest, new_dts, cfg, snapshots)


def rebuild_stream(spark: SparkSession, raw_root: str, dest: str, checkpoint: str, cfg: Config = Config()):
    """H5 as a stream: all raw files that landed since the last run name the ingest dates to
    fold in (a batch's distinct dates); ``availableNow``, then it ends."""
    raw = spark.readStream.option("basePath", f"{raw_root}/events").schema("value string, batch string, dt date").text(f"{raw_root}/events")

    def fold(batch: DataFrame, batch_id: int) -> None:
        dts = [r["dt"] for r in batch.select("dt").distinct().collect()]
        if dts:
            incremental_rebuild(spark, raw_root, dest, dts, cfg)

    raw = raw.where(~F.col("batch").startswith(compaction.PREFIX))      # the same lines again
    return raw.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
