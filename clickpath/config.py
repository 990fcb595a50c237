"""Engine configuration: one frozen value object passed to every job."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the event model (they decide results, so they are not tunable per run).
SESSION_GAP_SECONDS = 1800          # 30 minutes of inactivity ends a session
SKEW_LIMIT_SECONDS = 86400          # |client clock - ingest clock| beyond this is not trusted
FIRST_TOUCH_TTL_SECONDS = 63072000  # first-touch campaign kept two years
LAST_TOUCH_TTL_SECONDS = 15552000   # last-touch campaign kept 180 days
MAX_PARAMS = 25                     # at most 25 flat params per event
REDACTED = "<REDACTED>"


@dataclass(frozen=True)
class Config:
    """Per-deployment settings.

    ``internal_domains`` is a comma separated list of the property's own registrable
    domains; a referrer host equal to one of them, or ending in ``.`` + one of them, is a
    self-referral and never becomes a traffic source.

    ``chunks`` is a physical knob only: per-visitor sequential logic (gap sessionisation,
    previous page, last touch) is a prefix scan over the partitions of a global sort, so
    that one very active visitor is spread over many tasks.  Unset, the number of
    partitions is Spark's.  Results do not depend on it.
    """

    internal_domains: str = ""
    session_gap_seconds: int = SESSION_GAP_SECONDS
    skew_limit_seconds: int = SKEW_LIMIT_SECONDS
    chunks: int | None = None

    def internal_domain_list(self) -> list[str]:
        return [d.strip().lower() for d in self.internal_domains.split(",") if d.strip()]
