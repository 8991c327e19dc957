"""Stream/batch equivalence over many micro-batches of the real events table."""

import os

from pyspark.sql import functions as F

from conftest import SF01
from ratewave.operators import best_per_key, flatten_window, rounded, trending
from ratewave.schemas import TRENDING_OUT
from ratewave.streaming.summaries import stored_windows
from ratewave.sources.files import read_result_dir
from ratewave.sources.tables import events_to_ratings, read_table
from ratewave.streaming.app import start_final_windows, start_window_updates
from ratewave.plans.stream import WIDE_SPEC
from ratewave.streaming.sinks import run_to_end


DAYS_PER_FILE = 4


def _day_files(spark, folder):
    """events split into one Parquet file per 4 days, oldest first by mtime."""
    ev = read_table(spark, SF01, "events")
    span = F.floor(F.datediff(F.to_date("ts"), F.lit("2000-01-01")) / DAYS_PER_FILE)
    days = sorted(r.d for r in ev.select(span.alias("d")).distinct().collect())
    base = 1_700_000_000
    for i, d in enumerate(days):
        path = os.path.join(folder, f"span={d}")
        ev.filter(span == F.lit(d)).coalesce(1).write.parquet(path)
        for f in os.listdir(path):
            if f.endswith(".parquet"):
                os.rename(os.path.join(path, f), os.path.join(folder, f"events-{i:03d}.parquet"))
                os.utime(os.path.join(folder, f"events-{i:03d}.parquet"), (base + i, base + i))
    return ev.schema, len(days)


def test_many_batches_equal_batch_result(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "events")
    os.makedirs(folder)
    schema, n_days = _day_files(spark, folder)
    assert n_days >= 6

    def stream():
        raw = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
               .option("pathGlobFilter", "events-*.parquet").parquet(folder))
        return events_to_ratings(raw)

    out_f, out_u = os.path.join(tmp_dir, "f"), os.path.join(tmp_dir, "u")
    qf = run_to_end(start_final_windows(stream(), out_f, WIDE_SPEC))
    qu = run_to_end(start_window_updates(stream(), out_u, WIDE_SPEC))
    assert len([p for p in qf.recentProgress if p.numInputRows > 0]) == n_days

    batch = rounded(flatten_window(trending(events_to_ratings(read_table(spark, SF01, "events")),
                                           "6 hours", "2 hours")), 6)
    wm = events_to_ratings(read_table(spark, SF01, "events")).agg(F.max("event_time")).first()[0]
    closed = batch.filter(F.col("window_end").cast("timestamp") <= F.lit(wm) - F.expr("INTERVAL 1 MINUTE"))

    final = rounded(stored_windows(spark, out_f).drop("batch_id"), 6)
    assert final.count() == closed.count()
    assert final.exceptAll(closed).count() == 0

    updates = read_result_dir(spark, f"{out_u}/trending_updates", TRENDING_OUT)
    assert updates.count() > batch.count()  # windows crossing a file boundary update twice
    last = best_per_key(updates, ["window_start", "window_end", "item_id"], ["batch_id"]).drop("batch_id")
    assert rounded(last.select(batch.columns), 6).exceptAll(batch).count() == 0
    assert last.count() == batch.count()
