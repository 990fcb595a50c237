"""Three clocks: ingest date ``dt``, client ``event_date``, trusted ``event_time``.

Integer arithmetic on microseconds throughout, so boundary counts are exact (a double
division of epoch microseconds can round 59.999999 s up to the next second).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickpath.config import SKEW_LIMIT_SECONDS

MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
          "day": 86_400_000_000}


def skew_limit_seconds() -> Column:
    """C12."""
    return F.lit(SKEW_LIMIT_SECONDS)


def epoch_floor(ts: Column, unit_micros: int) -> Column:
    """floor(epoch_micros / unit) computed exactly on longs (also right before 1970)."""
    m = F.unix_micros(ts)
    # (m - pmod(m, u)) is an exact multiple of u below 2**53, so the double quotient is exact.
    return ((m - F.pmod(m, F.lit(unit_micros))) / F.lit(unit_micros)).cast("long")


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end`` (DuckDB date_diff).

    10:00:59 -> 10:30:01 is 30 minutes by this count, 29 by elapsed time."""
    u = MICROS[unit]
    return epoch_floor(end, u) - epoch_floor(start, u)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Signed elapsed seconds as a double (fractional)."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def skew_seconds(event_ts: Column, ingested_at: Column) -> Column:
    """Client clock minus ingest clock, signed fractional seconds."""
    return elapsed_seconds(ingested_at, event_ts)


def event_time_trusted(event_ts: Column, ingested_at: Column,
                       limit: int = SKEW_LIMIT_SECONDS) -> Column:
    """C14: the client clock is believed when |skew| <= limit."""
    return F.abs(skew_seconds(event_ts, ingested_at)) <= F.lit(limit)


def event_time(event_ts: Column, ingested_at: Column, limit: int = SKEW_LIMIT_SECONDS) -> Column:
    """C14: trusted event time - client clock when trusted, else the server's ingest time."""
    return F.when(event_time_trusted(event_ts, ingested_at, limit), event_ts).otherwise(ingested_at)


def round_half_away(x: Column, digits: int) -> Column:
    """round() on the binary double, half away from zero (same result in Spark and DuckDB).

    Spark's ``round`` goes through the decimal text (1.005 -> 1.01) while binary rounding
    gives 1.0; this form is exact IEEE arithmetic, so every engine agrees."""
    p = float(10 ** digits)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(p) + F.lit(0.5)) / F.lit(p)
