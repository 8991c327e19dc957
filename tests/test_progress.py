"""Stored progress of stateful queries, and lag metrics observed on a batch's only read."""

import os
import time
from datetime import datetime

from pyspark.sql import functions as F

from ratewave.functions.parse import parse_events
from ratewave.schemas import METRICS_OUT
from ratewave.sources.files import read_result_dir
from ratewave.sources.streams import read_event_files
from ratewave.streaming.app import REFERENCE_SPEC, start_final_windows
from ratewave.streaming.progress import ProgressStore, dropped_rows, store_progress, stored_progress
from ratewave.streaming.scoring import batch_metrics, make_batch_handler
from ratewave.streaming.sinks import run_to_end, write_batch_partition
from test_late_data import BATCHES, _write_batches


def _replay(spark, tmp_dir, name):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    _write_batches(src, BATCHES)
    events = parse_events(read_event_files(spark, src, max_files_per_trigger=1))
    return run_to_end(start_final_windows(events, out, REFERENCE_SPEC, name=name)), out


def test_dropped_rows_by_batch(spark, tmp_dir):
    q, out = _replay(spark, tmp_dir, "progress_direct")
    for _ in range(2):  # storing again changes nothing
        store_progress(spark, q.recentProgress, out, "final")
    assert tuple(dropped_rows(spark, out, "final").first()) == (6, 1)
    by_batch = {r.batch_id: (r.input_rows, r.dropped_rows) for r in stored_progress(spark, out, "final").collect()}
    assert by_batch[3] == (3, 6) and by_batch[0] == (1, 0)
    assert tuple(dropped_rows(spark, out, "nothing").first()) == (0, 0)


def test_a_listener_stores_while_the_stream_runs(spark, tmp_dir):
    listener = ProgressStore(spark, os.path.join(tmp_dir, "out"), ["progress_listened"])
    spark.streams.addListener(listener)
    try:
        _, out = _replay(spark, tmp_dir, "progress_listened")
        until = time.time() + 30  # events come after the batches
        while time.time() < until and dropped_rows(spark, out, "progress_listened").first()[0] < 6:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert tuple(dropped_rows(spark, out, "progress_listened").first()) == (6, 1)


def _events(spark, n):
    rows = [(i % 3, i, 4.0, datetime(2026, 5, 12, 14, 30, i)) for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating float, event_time timestamp")


def _jobs(spark, run):
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("observed"))
    spark.sparkContext.setJobGroup("observed", "")
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(set(spark.sparkContext.statusTracker().getJobIdsForGroup("observed")) - before)


def test_lag_is_observed_not_computed_apart(spark, tmp_dir):
    now = F.lit("2026-05-12 14:31:00").cast("timestamp")
    handle, batch = make_batch_handler(tmp_dir, None, now=now), _events(spark, 7)
    jobs = _jobs(spark, lambda: handle(batch, 4))
    got = read_result_dir(spark, f"{tmp_dir}/metrics", METRICS_OUT).drop("batch_id")
    want = batch_metrics(batch, 4, now).drop("batch_id")
    assert got.collect() == want.collect()
    row = spark.createDataFrame(want.collect(), want.schema)
    storing = _jobs(spark, lambda: write_batch_partition(row, f"{tmp_dir}/again", 4, n_rows=1))
    assert jobs == storing + 1  # one pass over the batch, beside writing the row of metrics


def test_an_empty_batch_leaves_nothing(spark, tmp_dir):
    handle = make_batch_handler(tmp_dir, None)
    handle(_events(spark, 3).where("user_id > 5"), 0)
    handle(spark.createDataFrame([], _events(spark, 1).schema), 1)
    assert not os.path.exists(f"{tmp_dir}/metrics")
