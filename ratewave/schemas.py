"""Explicit schemas: no inference pass over the input."""

from __future__ import annotations

from pyspark.sql import types as T

# Event message value (JSON object of four fields).
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# Ratings table with the source's header names (CSV with header).
RAW_RATINGS_CSV_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

TRENDING_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("n_ratings", T.LongType()),
        T.StructField("rating_variance", T.DoubleType()),
        T.StructField("trending_score", T.DoubleType()),
    ]
)

BATCH_ID = T.StructField("batch_id", T.LongType())

# Stored outputs of the streaming app (per-batch folders add ``batch_id``).
TRENDING_OUT = T.StructType([*TRENDING_SCHEMA.fields, BATCH_ID])
# Closed windows are also filed by the date of their end.
WINDOWS_OUT = T.StructType([*TRENDING_OUT.fields, T.StructField("window_date", T.DateType())])
# What the app keeps beside them, per batch.
WINDOW_COUNTS_OUT = T.StructType([T.StructField("n_windows", T.LongType()), T.StructField("n_alerts", T.LongType()), BATCH_ID])
ITEM_BITMAPS_OUT = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("items", T.BinaryType()), BATCH_ID])
BEST_OUT = T.StructType(
    [TRENDING_SCHEMA[c] for c in ("item_id", "trending_score", "window_start", "window_end", "avg_rating", "n_ratings")] + [BATCH_ID]
)
RECS_COUNTS_OUT = T.StructType([T.StructField("n_recs", T.LongType()), BATCH_ID])
ALERTS_OUT = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("n_ratings", T.LongType()),
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        BATCH_ID,
    ]
)
USER_WINDOWS_OUT = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("interactions", T.LongType()),
    ]
)
METRICS_OUT = T.StructType(
    [
        T.StructField("n_events", T.LongType()),
        T.StructField("avg_lag_s", T.DoubleType()),
        T.StructField("avg_lag_exact_s", T.DoubleType()),
        BATCH_ID,
    ]
)
STATE_METRICS_OUT = T.StructType(
    [
        T.StructField("input_rows", T.LongType()),
        T.StructField("dropped_rows", T.LongType()),
        T.StructField("state_rows", T.LongType()),
        BATCH_ID,
    ]
)
RECS_OUT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField(
            "recommendations",
            T.ArrayType(
                T.StructType(
                    [T.StructField("item_id", T.LongType()), T.StructField("rating", T.FloatType())]
                )
            ),
        ),
        BATCH_ID,
    ]
)
