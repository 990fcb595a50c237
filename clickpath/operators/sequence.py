"""Per-visitor sequential logic as a skew-safe prefix scan.

A window ``PARTITION BY visitor ORDER BY ts`` puts every event of one visitor in one task;
one bot holding a third of all rows would then be one task.  Here the rows are range-sorted
by (visitor, ts, tiebreak, row) and the partitions of that sort are the chunks, so a visitor
with many rows - even at one timestamp, or with none at all - is cut by the number of rows:

1. windows over (visitor, chunk) compute what is local to a chunk; the result is stored;
2. one summary row per visitor and chunk carries state across chunks;
3. the summary is joined back on (visitor, chunk).

Results equal the single-window form for any cut.  NULL timestamps sort last, and rows that
tie in everything keep the order in which they were read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.storage import stored

KEY, CHUNK, ROW = "_seq_key", "_seq_chunk", "_seq_row"


def seq_key(c: Column) -> Column:
    """Injective non-NULL encoding of a possibly-NULL string key (so equi-joins keep NULLs)."""
    return F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c))


def _chunked(df: DataFrame, key: str, order: list[Column], chunks: int | None) -> DataFrame:
    """Rows with their key and the partition of a global sort that they fall in."""
    # A sort by range reads its input twice, and a row's place must be the same each time.
    numbered = stored(df.withColumn(KEY, seq_key(F.col(key))), "sequence-input").withColumn(ROW, F.monotonically_increasing_id())
    by = [F.col(KEY).asc(), *order]
    cut = numbered.repartitionByRange(chunks, *by) if chunks else numbered.repartitionByRange(*by)
    return cut.withColumn(CHUNK, F.spark_partition_id())


def scan(df: DataFrame, key: str, ts: str, specs: dict[str, tuple[str, Column]] | None = None,
         tiebreak: list[str] | None = None, opens: Callable[[Column, Column], Column] | None = None,
         chunks: int | None = None) -> DataFrame:
    """Add sequential state per ``key``, in order of ``ts`` and ``tiebreak`` (NULLs last).

    ``specs`` maps an output column to ``(kind, expr)``:

    * ``"last"``   - the last non-NULL ``expr`` up to and including this row;
    * ``"before"`` - the last non-NULL ``expr`` strictly before this row;
    * ``"prev"``   - ``expr`` on the previous row;
    * ``"first"``  - ``expr`` on the key's first row.

    ``is_first`` marks the key's first row.  ``opens(previous ts, ts)``, which must be
    NULL-safe, says whether a row opens a session; then ``opened`` is that flag,
    ``opened_at`` the latest non-NULL opening ``ts`` and ``opened_nth`` the session's number
    from 1.  ``chunks`` fixes the number of chunks (results do not depend on it).
    """
    specs = specs or {}
    order = [F.col(ts).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak or []], F.col(ROW).asc()]
    x = _chunked(df, key, order, chunks)
    w = Window.partitionBy(KEY, CHUNK).orderBy(*order)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    local = {"_rn": F.row_number().over(w)}
    for name, (kind, expr) in specs.items():
        if kind == "first":
            local[f"_l_{name}"] = expr
        elif kind == "prev":
            local[f"_l_{name}"], local[f"_e_{name}"] = F.lag(expr).over(w), expr
        elif kind in ("last", "before"):
            local[f"_l_{name}"] = F.last(expr, ignorenulls=True).over(upto if kind == "last" else before)
            local[f"_e_{name}"] = F.last(expr, ignorenulls=True).over(upto)
        else:
            raise ValueError(f"unknown kind {kind!r}")
    x = x.select("*", *[c.alias(n) for n, c in local.items()])
    if opens:
        inside = F.when(F.col("_rn") > 1, opens(F.lag(F.col(ts)).over(w), F.col(ts))).otherwise(F.lit(False))
        x = x.withColumn("_op", inside)
        x = x.select("*", F.last(F.when(F.col("_op"), F.col(ts)), ignorenulls=True).over(upto).alias("_at"),
                     F.sum(F.col("_op").cast("long")).over(upto).alias("_nth"))
    x = stored(x, "sequence")

    # One row per key and chunk.
    rn = F.col("_rn")
    summary = [F.max_by(f"_e_{n}", rn).alias(f"_s_{n}") if k != "first" else F.min_by(f"_l_{n}", rn).alias(f"_s_{n}") for n, (k, _) in specs.items()]
    if opens:
        summary += [F.min_by(ts, rn).alias("_first_ts"), F.max_by(ts, rn).alias("_last_ts"), F.max_by("_at", rn).alias("_end_at"), F.max("_nth").alias("_end_nth")]
    ends = x.groupBy(KEY, CHUNK).agg(F.count(F.lit(1)).alias("_rows"), *summary)
    wc = Window.partitionBy(KEY).orderBy(CHUNK)
    earlier = wc.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.row_number().over(wc).alias("_chunk_nth")]
    for name, (kind, _) in specs.items():
        s = F.col(f"_s_{name}")
        state = (F.first(s).over(wc.rowsBetween(Window.unboundedPreceding, 0)) if kind == "first"
                 else F.lag(s).over(wc) if kind == "prev" else F.last(s, ignorenulls=True).over(earlier))
        carried.append(state.alias(f"_c_{name}"))
    if opens:
        ends = ends.withColumn("_open", opens(F.lag("_last_ts").over(wc), F.col("_first_ts")))
        at = F.coalesce("_end_at", F.when(F.col("_open"), F.col("_first_ts")))
        carried += [F.col("_open"), F.col("_first_ts"), F.last(at, ignorenulls=True).over(earlier).alias("_c_at"),
                    F.coalesce(F.sum(F.col("_open").cast("long") + F.col("_end_nth")).over(earlier), F.lit(0)).alias("_c_nth")]
    x = x.join(ends.select(KEY, CHUNK, *carried), [KEY, CHUNK])

    out = {"is_first": (rn == 1) & (F.col("_chunk_nth") == 1)}
    for name, (kind, _) in specs.items():
        mine, c = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        out[name] = c if kind == "first" else F.when(rn == 1, c).otherwise(mine) if kind == "prev" else F.coalesce(mine, c)
    if opens:
        out["opened"] = F.when(rn == 1, F.col("_open")).otherwise(F.col("_op"))
        out["opened_at"] = F.coalesce("_at", F.when(F.col("_open"), F.col("_first_ts")), "_c_at")
        out["opened_nth"] = F.col("_c_nth") + F.col("_open").cast("long") + F.col("_nth")
    return x.select(*df.columns, *[c.alias(n) for n, c in out.items()])


def number_sessions(df: DataFrame, key: str, ts: str, is_new: Callable[[Column, Column], Column],
                    tiebreak: list[str] | None = None, out: str = "session_number", chunks: int | None = None) -> DataFrame:
    """Number each row's gap-session within ``key``, starting at 1."""
    found = scan(df, key, ts, tiebreak=tiebreak, opens=is_new, chunks=chunks)
    return found.select(*df.columns, F.col("opened_nth").alias(out))
