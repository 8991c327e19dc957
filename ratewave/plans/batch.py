"""Registered batch queries over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
columns match the SQL oracle of the same name (``ratewave.plans.oracle``).
Averages, deviations and scores are rounded to 6 places on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewave.functions.parse import encode_events, iso_timestamp, parse_events
from ratewave.operators import (
    clean_ratings,
    distinct_values,
    flatten_window,
    item_window_stats,
    latest_alerts,
    result_counters,
    rounded,
    threshold_alerts,
    top_trending,
    trending,
    user_window_counts,
)
from ratewave.operators.windows import DEFAULT_SIZE, DEFAULT_SLIDE
from ratewave.sources.tables import events_to_ratings, rating_events, ratings, read_table

DIGITS = 6
# Windows over the driver's events: 6 h / 2 h (events are ~4 minutes apart,
# so the reference's 30 s / 10 s windows hold one or two events each).
WIDE_SIZE, WIDE_SLIDE = "6 hours", "2 hours"
REF_SIZE, REF_SLIDE = DEFAULT_SIZE, DEFAULT_SLIDE

ROUNDTRIP_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("item_id", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)


def _ntz(df: DataFrame, col: str = "event_time") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


def q_clean_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ratings(ratings(spark, sf_dir), rating_range=(0.5, 5.0))


def q_parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = encode_events(rating_events(spark, sf_dir))
    return _ntz(parse_events(records))


def q_event_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = encode_events(rating_events(spark, sf_dir))
    parsed = parse_events(records, schema=ROUNDTRIP_SCHEMA, keep=["key"])
    return _ntz(
        parsed.select(
            F.col("key").cast("string").alias("key"), "user_id", "item_id", "rating", "event_time"
        )
    )


def dirty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records with malformed values, derived from the events table:
    ``error`` events carry truncated JSON, ``signup`` events a timestamp
    that is not a time, ``view`` events the user id as a JSON string."""
    ev = events_to_ratings(read_table(spark, sf_dir, "events"), keep=["event_type"])
    fields = [F.col("user_id"), F.col("item_id"), F.col("rating")]
    good = F.to_json(F.struct(*fields, iso_timestamp("event_time").alias("timestamp")))
    bad_time = F.to_json(F.struct(*fields, F.lit("not-a-time").alias("timestamp")))
    user_text = F.to_json(
        F.struct(F.col("user_id").cast("string").alias("user_id"), *fields[1:],
                 iso_timestamp("event_time").alias("timestamp"))
    )
    kind = F.col("event_type")
    value = (
        F.when(kind == "error", F.substring(good, 1, 20))
        .when(kind == "signup", bad_time)
        .when(kind == "view", user_text)
        .otherwise(good)
    )
    return ev.select(value.cast("binary").alias("value"))


def q_parse_events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(parse_events(dirty_records(spark, sf_dir)))


def trending_frame(spark: SparkSession, sf_dir: str, size=WIDE_SIZE, slide=WIDE_SLIDE) -> DataFrame:
    return flatten_window(trending(rating_events(spark, sf_dir), size, slide))


def q_item_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    re = rating_events(spark, sf_dir)
    return rounded(flatten_window(item_window_stats(re, WIDE_SIZE, WIDE_SLIDE)), DIGITS)


def q_item_window_stats_30s(spark: SparkSession, sf_dir: str) -> DataFrame:
    re = rating_events(spark, sf_dir)
    return rounded(flatten_window(item_window_stats(re, REF_SIZE, REF_SLIDE)), DIGITS)


def q_user_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_window(user_window_counts(rating_events(spark, sf_dir), WIDE_SIZE, WIDE_SLIDE))


def q_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trending_frame(spark, sf_dir), DIGITS)


def q_trending_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(threshold_alerts(trending_frame(spark, sf_dir)), DIGITS)


def q_top_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_trending(rounded(trending_frame(spark, sf_dir), DIGITS), n=10)  # ranks by the published score


def q_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(latest_alerts(trending_frame(spark, sf_dir), n=20), DIGITS)


def q_result_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_counters(trending_frame(spark, sf_dir))


def q_distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(rating_events(spark, sf_dir), "user_id")


BATCH_QUERIES = {
    "clean_ratings": q_clean_ratings,
    "parse_events": q_parse_events,
    "parse_events_dirty": q_parse_events_dirty,
    "event_json_roundtrip": q_event_json_roundtrip,
    "item_window_stats": q_item_window_stats,
    "item_window_stats_30s": q_item_window_stats_30s,
    "user_window_counts": q_user_window_counts,
    "trending": q_trending,
    "trending_alerts": q_trending_alerts,
    "top_trending": q_top_trending,
    "latest_alerts": q_latest_alerts,
    "result_counters": q_result_counters,
    "distinct_users": q_distinct_users,
}
