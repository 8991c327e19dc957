from ratewave.streaming.app import (
    REFERENCE_SPEC,
    WindowSpec,
    start_app,
    start_final_windows,
    start_recommendations,
    start_user_updates_console,
    start_user_windows,
    start_window_updates,
    trending_stream,
    user_stream,
)
from ratewave.streaming.compaction import compact, compact_outputs, remove_folded
from ratewave.streaming.progress import ProgressStore, dropped_rows, store_progress
from ratewave.streaming.scoring import batch_metrics, batch_recommendations, make_batch_handler
from ratewave.streaming.sinks import (
    AVAILABLE_NOW,
    console_options,
    publish_records,
    run_to_end,
    start_query,
    trigger_kwargs,
    write_batch_partition,
)

__all__ = [
    "REFERENCE_SPEC",
    "WindowSpec",
    "start_app",
    "start_final_windows",
    "start_recommendations",
    "start_user_updates_console",
    "start_user_windows",
    "start_window_updates",
    "trending_stream",
    "user_stream",
    "compact",
    "compact_outputs",
    "remove_folded",
    "ProgressStore",
    "dropped_rows",
    "store_progress",
    "batch_metrics",
    "batch_recommendations",
    "make_batch_handler",
    "AVAILABLE_NOW",
    "console_options",
    "publish_records",
    "run_to_end",
    "start_query",
    "trigger_kwargs",
    "write_batch_partition",
]
