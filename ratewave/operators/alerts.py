"""Threshold alerts over window statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Alert thresholds and tag.
DEFAULT_MIN_AVG = 4.5  # strict: an average of exactly 4.5 does not alert
DEFAULT_MIN_N = 5  # inclusive
ALERT_TAG = "TRENDING"


def alert_condition(min_avg: float = DEFAULT_MIN_AVG, min_n: int = DEFAULT_MIN_N):
    return (F.col("avg_rating") > F.lit(min_avg)) & (F.col("n_ratings") >= F.lit(min_n))


def threshold_alerts(
    stats: DataFrame,
    min_avg: float = DEFAULT_MIN_AVG,
    min_n: int = DEFAULT_MIN_N,
    tag: str = ALERT_TAG,
    key: str = "item_id",
) -> DataFrame:
    """Rows of ``stats`` whose average is above ``min_avg`` with ``min_n`` ratings.

    Works on the ``window`` struct or on flattened ``window_start/_end``
    columns.  On an update-mode stream a window may alert more than once
    (each time it is updated); in append mode it alerts once, when closed.
    """
    window_cols = ["window"] if "window" in stats.columns else ["window_start", "window_end"]
    return stats.filter(alert_condition(min_avg, min_n)).select(
        F.lit(tag).alias("type"),
        F.col(key),
        "avg_rating",
        "n_ratings",
        *window_cols,
    )
