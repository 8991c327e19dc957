"""Read-side queries over stored window results (or any trending frame)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewave.operators.alerts import DEFAULT_MIN_AVG, DEFAULT_MIN_N, alert_condition, threshold_alerts


def best_per_key(df: DataFrame, key: str | Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """One row per ``key`` (one or more columns): the greatest by
    ``order_desc`` (lexicographic).

    Expressed as ``max(struct(order..., rest...))`` per key, an aggregate
    with a map-side partial step: a key holding a third of all rows is
    reduced inside each task before the shuffle, unlike a ``row_number``
    window, which would sort the whole hot key in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order_desc]
    best = F.max(F.struct(*[F.col(c) for c in order_desc], *[F.col(c) for c in rest]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, *[F.col(f"_best.{c}").alias(c) for c in [*order_desc, *rest]]
    )


def top_trending(trending: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` distinct items by their best trending score.

    Ties: higher score, then later window, then smaller item id.
    """
    best = best_per_key(
        trending.select(
            "item_id", "trending_score", "window_start", "window_end", "avg_rating", "n_ratings"
        ),
        "item_id",
        ["trending_score", "window_start"],
    )
    return best.orderBy(
        F.col("trending_score").desc(), F.col("window_start").desc(), F.col("item_id").asc()
    ).limit(n).select("item_id", "avg_rating", "n_ratings", "trending_score", "window_start", "window_end")


def latest_alerts(
    trending: DataFrame,
    n: int = 20,
    min_avg: float = DEFAULT_MIN_AVG,
    min_n: int = DEFAULT_MIN_N,
) -> DataFrame:
    """The ``n`` most recent alert windows (by window end, then item id).

    On a Parquet scan the threshold predicate is pushed to the reader.
    """
    return (
        threshold_alerts(trending, min_avg, min_n)
        .orderBy(F.col("window_end").desc(), F.col("item_id").asc())
        .limit(n)
    )


def result_counters(
    trending: DataFrame,
    min_avg: float = DEFAULT_MIN_AVG,
    min_n: int = DEFAULT_MIN_N,
) -> DataFrame:
    """One row: windows seen, distinct items, alerting windows (one pass)."""
    return trending.agg(
        F.count(F.lit(1)).alias("trending_windows"),
        F.countDistinct("item_id").alias("distinct_items"),
        F.coalesce(F.sum(F.when(alert_condition(min_avg, min_n), 1).otherwise(0)), F.lit(0)).cast("long").alias("alert_windows"),
    )


def recs_counters(recs: DataFrame) -> DataFrame:
    """One row: recommendation rows and distinct micro-batches holding them."""
    return recs.agg(
        F.count(F.lit(1)).alias("rec_rows"),
        F.countDistinct("batch_id").alias("rec_batches"),
    )


def first_recs(recs: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` recommendation rows in a stable order (batch, user)."""
    return recs.orderBy(F.col("batch_id").asc(), F.col("user_id").asc()).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
