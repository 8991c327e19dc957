"""Malformed and edge-case event messages (decode + clean)."""

from pyspark.sql import functions as F

from ratewave.functions.parse import encode_events, parse_events
from ratewave.operators.cleaning import clean_ratings

GOOD = '{"user_id":1,"item_id":2,"rating":4.7,"timestamp":"2026-05-12T14:30:00+00:00"}'

CASES = [
    (GOOD, True),
    (GOOD.replace("+00:00", "+02:00"), True),
    ("garbage", False),
    ("null", False),
    ("[]", False),
    ("", False),
    (None, False),
    ('{"user_id":1}', False),
    (GOOD.replace('"user_id":1', '"user_id":3000000000'), True),  # beyond 32 bits
    (GOOD.replace('"rating":4.7', '"rating":"4.5"'), False),
    (GOOD.replace('"user_id":1', '"user_id":"7"'), False),
    (GOOD.replace('"rating":4.7', '"rating":"NaN"'), False),
    (GOOD.replace('"rating":4.7', '"rating":9.5'), True),
    (GOOD.replace("2026-05-12T14:30:00+00:00", "not-a-time"), False),
    (GOOD.replace('"user_id":1', '"user_id":30000000000000000000'), False),
]


def _records(spark, values):
    rows = [(i, None if v is None else v.encode()) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, value binary")


def test_malformed_messages_dropped(spark):
    df = parse_events(_records(spark, [v for v, _ in CASES]), keep=["id"])
    kept = sorted(r.id for r in df.collect())
    assert kept == [i for i, (_, ok) in enumerate(CASES) if ok]


def test_offset_is_honoured(spark):
    df = parse_events(_records(spark, [CASES[1][0]]))
    t = df.select(F.date_format("event_time", "HH:mm:ss").alias("t")).first().t
    assert t == "12:30:00"


def test_nan_rating_dropped(spark):
    df = parse_events(_records(spark, [CASES[11][0]]))
    assert df.count() == 0


def test_stream_keeps_out_of_range_batch_filter_removes(spark):
    df = parse_events(_records(spark, [CASES[12][0]]))
    assert df.count() == 1
    assert clean_ratings(df.withColumnRenamed("event_time", "ts"), (0.5, 5.0)).count() == 0


def test_encode_then_parse_roundtrip(spark):
    src = spark.createDataFrame(
        [(7, 3, 4.5, "2026-05-12 14:30:00.123456")], "user_id int, item_id int, rating double, t string"
    ).select("user_id", "item_id", "rating", F.col("t").cast("timestamp").alias("event_time"))
    rec = encode_events(src)
    assert rec.first().key == b"7"
    back = parse_events(rec, keep=["key"]).first()
    assert (back.user_id, back.item_id, back.rating) == (7, 3, 4.5)
    assert back.event_time == src.first().event_time
