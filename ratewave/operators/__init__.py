from ratewave.operators.alerts import alert_condition, threshold_alerts
from ratewave.operators.cleaning import clean_ratings
from ratewave.operators.sampling import hash_split, random_split, sample_n
from ratewave.operators.serving import (
    best_per_key,
    distinct_values,
    first_recs,
    latest_alerts,
    recs_counters,
    result_counters,
    top_trending,
)
from ratewave.operators.topk import ItemBlocks, block_visits, prepare_items, topk_blocks, topk_dot
from ratewave.operators.windows import (
    flatten_window,
    item_window_stats,
    rounded,
    trending,
    user_window_counts,
    with_event_watermark,
)

__all__ = [
    "alert_condition",
    "threshold_alerts",
    "clean_ratings",
    "hash_split",
    "random_split",
    "sample_n",
    "best_per_key",
    "distinct_values",
    "first_recs",
    "latest_alerts",
    "recs_counters",
    "result_counters",
    "top_trending",
    "ItemBlocks",
    "block_visits",
    "prepare_items",
    "topk_blocks",
    "topk_dot",
    "flatten_window",
    "item_window_stats",
    "rounded",
    "trending",
    "user_window_counts",
    "with_event_watermark",
]
