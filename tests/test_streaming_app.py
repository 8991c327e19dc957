"""The four-query streaming app on a JSON-line folder, and the console sink."""

import json
import os
import time

import pytest

from pyspark.sql import functions as F

from ratewave.functions.parse import parse_events
from ratewave.models import BASELINE, fit_als
from ratewave.sources.streams import read_event_files
from ratewave.streaming import console_options, start_app, start_query


def _write(folder, rows, name):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for u, i, r, t in rows:
            fh.write(json.dumps({"user_id": u, "item_id": i, "rating": r,
                                 "timestamp": f"2026-05-12T{t}+00:00"}) + "\n")


def test_app_runs_all_queries(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    rows = [(u, 7, 4.8, f"14:30:{s:02d}") for u, s in zip(range(1, 7), range(1, 7))]
    rows += [(9, 8, 2.0, "14:40:00")]  # moves the watermark past the first windows
    _write(src, rows, "a.json")
    model = fit_als(spark.createDataFrame([(u, i, 4.0) for u in range(1, 10) for i in (7, 8, 9)],
                                          "user_id int, item_id int, rating float"), BASELINE)
    events = parse_events(read_event_files(spark, src))
    qs = start_app(events, out, model, window_trigger="1 second", recs_trigger="1 second", prefix="t_")
    try:
        assert {q.name for q in qs.values()} == {"t_trending_final", "t_trending_updates",
                                                 "t_user_windows", "t_recommendations"}
        for q in qs.values():
            q.processAllAvailable()
        # Windows closed by the watermark are emitted by a following no-data
        # batch (processing-time trigger): wait for it, with a deadline.
        deadline = time.time() + 60
        while time.time() < deadline:
            done = os.path.isdir(f"{out}/trending") and (
                spark.read.parquet(f"{out}/trending").filter("item_id = 7").count() == 3
            )
            if done and os.path.isdir(f"{out}/user_windows/_spark_metadata"):
                if spark.read.parquet(f"{out}/user_windows").filter("user_id = 1").count() == 3:
                    break
            time.sleep(1)
        for q in qs.values():
            q.processAllAvailable()
    finally:
        for q in qs.values():
            q.stop()
    final = spark.read.parquet(f"{out}/trending")
    assert final.filter("item_id = 7").count() == 3
    for part in os.listdir(f"{out}/trending"):  # small batches: one file each, not one per partition
        if part.startswith("batch_id="):
            files = [f for f in os.listdir(f"{out}/trending/{part}") if f.endswith(".parquet")]
            assert len(files) <= 1
    alerts = spark.read.parquet(f"{out}/alerts")
    assert alerts.filter("item_id = 7").count() == 3  # six 4.8 ratings in each of 3 windows
    updates = spark.read.parquet(f"{out}/trending_updates")
    assert updates.filter("item_id = 8").count() == 3
    users = spark.read.parquet(f"{out}/user_windows")
    assert users.filter("user_id = 1").count() == 3
    recs = spark.read.parquet(f"{out}/recs")
    assert recs.select("user_id").distinct().count() == 7
    assert recs.agg(F.min(F.size("recommendations"))).first()[0] == 3


def test_app_console_outputs(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    _write(src, [(1, 2, 3.0, "14:30:00"), (2, 2, 4.0, "14:30:05")], "a.json")
    qs = start_app(parse_events(read_event_files(spark, src)), out, None,
                   window_trigger="1 second", recs_trigger="1 second", console_rows=5, prefix="c_")
    try:
        assert "user_updates" in qs
        for q in qs.values():
            q.processAllAvailable()
            assert q.exception() is None
    finally:
        for q in qs.values():
            q.stop()


def test_console_sink(spark, tmp_dir, capfd):
    src = os.path.join(tmp_dir, "in")
    _write(src, [(1, 2, 3.0, "14:30:00")], "a.json")
    q = start_query(parse_events(read_event_files(spark, src)), sink="console",
                    checkpoint=os.path.join(tmp_dir, "ck"), options=console_options(5))
    q.awaitTermination(120)
    assert q.exception() is None


def test_publish_then_stream_back(spark, tmp_dir):
    from conftest import SF001
    from ratewave.functions.parse import encode_events
    from ratewave.sources.tables import rating_events
    from ratewave.streaming import publish_records, start_query

    src = rating_events(spark, SF001)
    folder = os.path.join(tmp_dir, "topic")
    publish_records(encode_events(src), "text", folder)
    back = parse_events(read_event_files(spark, folder))
    q = start_query(back, sink="memory", name="roundtrip_check", checkpoint=os.path.join(tmp_dir, "ck"))
    q.awaitTermination(120)
    got = spark.sql("SELECT user_id, item_id, CAST(rating AS DOUBLE) AS rating, event_time FROM roundtrip_check")
    assert got.count() == src.count()
    assert got.exceptAll(src.select("user_id", "item_id", F.col("rating").cast("float").cast("double").alias("rating"), "event_time")).count() == 0


def test_update_mode_alerts_repeat_per_window(spark, tmp_dir):
    """N6: in update mode a window alerts again on each update; append alerts once."""
    from ratewave.sources.streams import read_event_files
    from ratewave.streaming import REFERENCE_SPEC, run_to_end, start_window_updates, start_final_windows

    src = os.path.join(tmp_dir, "in")
    _write(src, [(u, 7, 4.8, "14:30:01") for u in range(5)], "a.json")
    _write(src, [(u, 7, 4.9, "14:30:02") for u in range(5, 8)], "b.json")
    _write(src, [(9, 8, 1.0, "14:40:00")], "c.json")
    base = 1_700_000_000
    for i, n in enumerate(["a.json", "b.json", "c.json"]):
        os.utime(os.path.join(src, n), (base + 10 * i, base + 10 * i))
    ev = lambda: parse_events(read_event_files(spark, src, max_files_per_trigger=1))
    run_to_end(start_window_updates(ev(), os.path.join(tmp_dir, "u"), REFERENCE_SPEC))
    run_to_end(start_final_windows(ev(), os.path.join(tmp_dir, "f"), REFERENCE_SPEC))
    upd = spark.read.parquet(os.path.join(tmp_dir, "u", "alert_updates")).filter("item_id = 7")
    fin = spark.read.parquet(os.path.join(tmp_dir, "f", "alerts")).filter("item_id = 7")
    assert fin.count() == 3
    assert upd.count() == 6  # each of the 3 windows alerted in batch 0 and again in batch 1


def test_failed_batch_replays_without_duplicates(spark, tmp_dir):
    """A batch that fails after writing (before its commit) is replayed on
    restart from the checkpoint; its batch_id folder is overwritten."""
    from ratewave.streaming import make_batch_handler, start_query

    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    _write(src, [(u, 1, 3.0, "14:30:00") for u in range(10)], "a.json")
    ck = os.path.join(tmp_dir, "ck")
    handler = make_batch_handler(out, None, now=F.lit("2026-05-12 14:31:00").cast("timestamp"))

    def crash_after_write(batch, batch_id):
        handler(batch, batch_id)
        raise RuntimeError("simulated failure before commit")

    q = start_query(parse_events(read_event_files(spark, src)), sink="foreach_batch",
                    checkpoint=ck, batch_fn=crash_after_write)
    with pytest.raises(Exception, match="simulated failure"):
        q.awaitTermination(120)
    q = start_query(parse_events(read_event_files(spark, src)), sink="foreach_batch",
                    checkpoint=ck, batch_fn=handler)
    q.awaitTermination(120)
    assert q.exception() is None
    metrics = spark.read.parquet(os.path.join(out, "metrics"))
    assert metrics.count() == 1
    row = metrics.first()
    assert row.batch_id == 0 and row.n_events == 10 and row.avg_lag_s == 60.0


def test_alerts_compare_the_raw_average(spark, tmp_dir):
    """Averages of 4.50000024 alert; rounded to six places they would not."""
    import datetime as dt

    from ratewave.operators import threshold_alerts, trending
    from ratewave.operators.windows import flatten_window, rounded

    at = dt.datetime(2026, 5, 12, 14, 30)
    rows = [(u, 7, 4.50000024, at) for u in range(5)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, event_time timestamp")
    alerts = threshold_alerts(flatten_window(trending(df, "30 seconds", "10 seconds")))
    assert alerts.count() == 3 and {r.avg_rating for r in rounded(alerts, 6).collect()} == {4.5}


def test_batch_folders_appear_whole_and_never_empty(spark, tmp_dir):
    from ratewave.streaming.sinks import write_batch_partition

    root = os.path.join(tmp_dir, "rows")
    write_batch_partition(spark.range(10), root, 0, n_rows=10, rows_per_file=4)
    assert sorted(os.listdir(root)) == ["batch_id=0"] and spark.read.parquet(root).count() == 10
    write_batch_partition(spark.range(3), root, 0)  # a replay replaces
    assert spark.read.parquet(root).count() == 3
    write_batch_partition(spark.range(0), root, 0)
    assert os.listdir(root) == []


def test_run_to_end_has_no_deadline_of_its_own():
    import inspect

    from ratewave.streaming.sinks import run_to_end

    assert inspect.signature(run_to_end).parameters["timeout_s"].default is None


def test_no_machine_folder_on_a_cluster():
    from ratewave.session import _one_process

    assert _one_process("local[*]") and _one_process("local")
    assert not any(map(_one_process, ("yarn", "spark://h:7077", "local-cluster[2,1,1024]")))


def test_a_query_leaves_the_callers_time_zone(spark):
    from ratewave.plans import all_queries

    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    other.conf.set("spark.sql.shuffle.partitions", "5")
    got = all_queries()["latest_alerts"](other, "/root/testdata/sf0.001")
    assert other.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert got.sparkSession.conf.get("spark.sql.shuffle.partitions") == "5"
    assert got.collect() == all_queries()["latest_alerts"](spark, "/root/testdata/sf0.001").collect()
