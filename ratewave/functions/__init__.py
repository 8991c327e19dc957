from ratewave.functions.parse import (
    encode_events,
    iso_timestamp,
    parse_event_time,
    parse_events,
)
from ratewave.functions.scores import lag_seconds, lag_millis, trending_score

__all__ = [
    "encode_events",
    "iso_timestamp",
    "parse_event_time",
    "parse_events",
    "lag_seconds",
    "lag_millis",
    "trending_score",
]
