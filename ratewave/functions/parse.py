"""Event encoding and decoding (JSON values, keyed records).

All expressions are built-in Catalyst functions, so parsing stays inside
whole-stage codegen and works on static and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewave.schemas import EVENT_SCHEMA

REQUIRED_EVENT_COLUMNS = ["user_id", "item_id", "rating", "event_time"]

# ISO-8601 with an explicit numeric offset, e.g. 2026-05-12T14:30:00.000000+00:00
ISO_OFFSET_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def iso_timestamp(col: Column | str) -> Column:
    """Render a timestamp as ISO-8601 text with a numeric UTC offset."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c.cast("timestamp"), ISO_OFFSET_PATTERN)


def parse_event_time(col: Column | str) -> Column:
    """ISO text to TIMESTAMP; malformed text gives NULL instead of an error.

    A plain cast raises under ANSI mode (the Spark 4 default), which would
    stop a whole stream on one bad record.
    """
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(T.TimestampType())


def parse_events(
    df: DataFrame,
    value_col: str = "value",
    schema: T.StructType = EVENT_SCHEMA,
    keep: list[str] | None = None,
) -> DataFrame:
    """Decode JSON event values into typed columns and drop unusable rows.

    Binary values are read as UTF-8 text; JSON that does not parse, fields
    that are missing or of the wrong JSON type, integer overflow, NaN
    ratings and times that are not ISO-8601 all end as NULL or NaN and the
    row is dropped.  ``keep`` carries extra input columns (e.g. ``key``).
    """
    text = F.col(value_col).cast("string")
    carried = [F.col(c) for c in (keep or [])]
    # The parsed struct is produced by a generator (``inline`` of a
    # one-element array).  A filter cannot be pushed below a generator, so
    # each value is parsed once.  With a plain ``select("d.*")`` the NULL
    # filter is pushed under the projection and the JSON is parsed again
    # for every field it tests.
    return (
        df.select(*carried, F.inline(F.array(F.from_json(text, schema))))
        .withColumn("event_time", parse_event_time("timestamp"))
        .dropna(subset=REQUIRED_EVENT_COLUMNS)
    )


def encode_events(
    df: DataFrame,
    key_col: str = "user_id",
    time_col: str = "event_time",
    as_binary: bool = True,
) -> DataFrame:
    """Keyed JSON records: key = user id text, value = JSON of the 4 fields.

    Keying by user keeps each user's events on one partition of a keyed log.
    """
    value = F.to_json(
        F.struct(
            F.col("user_id"),
            F.col("item_id"),
            F.col("rating"),
            iso_timestamp(time_col).alias("timestamp"),
        )
    )
    key = F.col(key_col).cast("string")
    if as_binary:
        key, value = key.cast("binary"), value.cast("binary")
    return df.select(key.alias("key"), value.alias("value"))
