from ratewave.sources.files import id_frame, read_ratings_text, read_result_dir
from ratewave.sources.streams import kafka_options, read_event_files, read_kafka
from ratewave.sources.tables import (
    events_stream,
    events_to_ratings,
    rating_events,
    ratings,
    read_table,
    register_views,
    table_stream,
)

__all__ = [
    "id_frame",
    "read_ratings_text",
    "read_result_dir",
    "kafka_options",
    "read_event_files",
    "read_kafka",
    "events_stream",
    "events_to_ratings",
    "rating_events",
    "ratings",
    "read_table",
    "register_views",
    "table_stream",
]
