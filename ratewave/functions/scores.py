"""Derived columns: trending score, alert tag, ingest lag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trending_score(n_col: str = "n_ratings", avg_col: str = "avg_rating") -> Column:
    """Popularity weighted by quality: count times average rating."""
    return F.col(n_col) * F.col(avg_col)


def lag_seconds(event_time: str = "event_time", now: Column | None = None) -> Column:
    """Event age in whole seconds (both ends truncated to the second)."""
    now = F.current_timestamp() if now is None else now
    return F.unix_timestamp(now) - F.unix_timestamp(F.col(event_time))


def lag_millis(event_time: str = "event_time", now: Column | None = None) -> Column:
    """Event age in whole milliseconds (a long: sums of it stay exact)."""
    now = F.current_timestamp() if now is None else now
    return F.unix_millis(now) - F.unix_millis(F.col(event_time))
