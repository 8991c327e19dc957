"""Watermark late-data sequence: one JSON file per micro-batch."""

import json
import os

from pyspark.sql import functions as F

from ratewave.functions.parse import parse_events
from ratewave.sources.streams import read_event_files
from ratewave.streaming.app import REFERENCE_SPEC, start_final_windows
from ratewave.streaming.sinks import run_to_end

DAY = "2026-05-12"
BATCHES = [
    [("14:30:05", 1)],
    [("14:32:00", 2)],
    [("14:32:01", 2)],
    [("14:30:45", 3), ("14:30:20", 4), ("14:30:55", 5)],
    [("14:36:00", 6)],
]


def _write_batches(folder, batches):
    os.makedirs(folder, exist_ok=True)
    base = 1_700_000_000
    for i, batch in enumerate(batches):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as fh:
            for n, (hms, item) in enumerate(batch):
                fh.write(json.dumps({"user_id": 10 + n, "item_id": item, "rating": 4.0,
                                     "timestamp": f"{DAY}T{hms}+00:00"}) + "\n")
        os.utime(path, (base + 10 * i, base + 10 * i))


def _run(spark, tmp_dir, batches):
    src = os.path.join(tmp_dir, "in")
    out = os.path.join(tmp_dir, "out")
    _write_batches(src, batches)
    events = parse_events(read_event_files(spark, src, max_files_per_trigger=1))
    q = run_to_end(start_final_windows(events, out, REFERENCE_SPEC))
    dropped = sum(
        op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators
    )
    rows = spark.read.parquet(f"{out}/trending").filter(F.col("item_id").isin(3, 4, 5))
    got = sorted(
        (r.window_start.strftime("%H:%M:%S"), r.window_end.strftime("%H:%M:%S"), r.item_id)
        for r in rows.collect()
    )
    return got, dropped


def test_late_rows_dropped_per_window(spark, tmp_dir):
    got, dropped = _run(spark, tmp_dir, BATCHES)
    assert got == [("14:30:40", "14:31:10", 3), ("14:30:40", "14:31:10", 5), ("14:30:50", "14:31:20", 5)]
    assert dropped == 6


def test_late_filter_uses_previous_batch_watermark(spark, tmp_dir):
    got, dropped = _run(spark, tmp_dir, [b for i, b in enumerate(BATCHES) if i != 2])
    assert len(got) == 9
    assert dropped == 0
