"""Registered streaming queries.

Each one streams the ``events`` table from its folder with the
``available_now`` trigger into a fresh folder below the shared checkpoint
root, waits for the end, and returns a batch read of what the sink wrote.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewave.operators.serving import best_per_key, top_trending
from ratewave.operators.windows import rounded
from ratewave.schemas import ALERTS_OUT, METRICS_OUT, TRENDING_OUT, TRENDING_SCHEMA
from ratewave.schemas import USER_WINDOWS_OUT as USERS_OUT
from ratewave.session import shared_dir
from ratewave.sources.files import read_result_dir
from ratewave.sources.tables import events_stream, events_to_ratings, read_table
from ratewave.streaming.app import (
    REFERENCE_SPEC,
    WindowSpec,
    start_final_windows,
    start_recommendations,
    start_user_windows,
    start_window_updates,
)
from ratewave.streaming.compaction import compact_outputs
from ratewave.streaming.progress import dropped_rows, store_progress
from ratewave.streaming.sinks import AVAILABLE_NOW, run_to_end
from ratewave.streaming.summaries import (
    latest_stored_alerts,
    stored_best,
    stored_counters,
    stored_windows,
)

DIGITS = 6
WIDE_SPEC = WindowSpec(size="6 hours", slide="2 hours", watermark="1 minute")
# Fixed "now" for a reproducible lag measurement.
FIXED_NOW = "2025-01-01 00:00:00"

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_ratings(events_stream(spark, sf_dir))


def _run_dir(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, "runs", name, unique=True)


def _replay(spark: SparkSession, sf_dir: str, start) -> None:
    """Run one available-now replay of the events table."""
    run_to_end(start(_events(spark, sf_dir)))


def _final_run(spark: SparkSession, sf_dir: str, spec: WindowSpec = WIDE_SPEC, name: str = "final") -> str:
    out = _run_dir(spark, name)
    _replay(spark, sf_dir, lambda ev: start_final_windows(ev, out, spec, AVAILABLE_NOW))
    return out


def q_stream_item_window_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _final_run(spark, sf_dir)
    return rounded(stored_windows(spark, out).drop("batch_id"), DIGITS)


def q_stream_item_window_final_30s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows at the reference parameters: 30 s / 10 s, 1 minute watermark."""
    out = _final_run(spark, sf_dir, REFERENCE_SPEC, "final30")
    return rounded(stored_windows(spark, out).drop("batch_id"), DIGITS)


def q_stream_item_window_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows merged from panes by two chained stateful aggregations."""
    out = _final_run(spark, sf_dir, replace(WIDE_SPEC, panes=True), "panes")
    return rounded(stored_windows(spark, out).drop("batch_id"), DIGITS)


def q_stream_alerts_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _final_run(spark, sf_dir)
    return rounded(read_result_dir(spark, f"{out}/alerts", ALERTS_OUT).drop("batch_id"), DIGITS)


def q_stream_user_window_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _run_dir(spark, "users")
    _replay(spark, sf_dir, lambda ev: start_user_windows(ev, out, WIDE_SPEC, AVAILABLE_NOW))
    return read_result_dir(spark, f"{out}/user_windows", USERS_OUT)


def q_stream_update_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last emitted version of every (window, item) in update mode."""
    out = _run_dir(spark, "updates")
    _replay(spark, sf_dir, lambda ev: start_window_updates(ev, out, WIDE_SPEC, AVAILABLE_NOW))
    updates = read_result_dir(spark, f"{out}/trending_updates", TRENDING_OUT)
    last = best_per_key(updates, ["window_start", "window_end", "item_id"], ["batch_id"])
    return rounded(last.select(*[f.name for f in TRENDING_SCHEMA.fields]), DIGITS)


def q_batch_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per micro-batch ingest lag against a fixed clock."""
    out = _run_dir(spark, "lag")
    now = F.lit(FIXED_NOW).cast("timestamp")
    run_to_end(start_recommendations(_events(spark, sf_dir), out, model=None, now=now))
    m = read_result_dir(spark, f"{out}/metrics", METRICS_OUT)
    return m.select(
        "batch_id",
        "n_events",
        F.round("avg_lag_s", DIGITS).alias("avg_lag_s"),
        F.round("avg_lag_exact_s", DIGITS).alias("avg_lag_exact_s"),
    )


def q_served_top_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 trending items of the stream's stored windows, from each batch's best rows."""
    out = _final_run(spark, sf_dir)
    return top_trending(rounded(stored_best(spark, out), DIGITS), n=10)


def q_served_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest 20 alerts of the stored windows, read backward by date (threshold pushed to the scan)."""
    out = _final_run(spark, sf_dir)
    return rounded(latest_stored_alerts(spark, out, n=20), DIGITS)


def q_served_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter tiles (windows seen, distinct items, alerting windows) of the stream's stored
    windows, merged from each batch's summary.  The table comes in four batches."""
    start = lambda ev, out: start_final_windows(ev, out, WIDE_SPEC, AVAILABLE_NOW)
    return stored_counters(spark, _in_ranges(spark, sf_dir, "counters", start))


# The events are dealt to so many files by equal ranges of time; every tenth
# event of the first range is held back to the last file.
RANGES = 4
HELD_EVERY, HELD_REST = 10, 3


def _range_number(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """(the events table, the number 0 .. RANGES - 1 of an event's time range)."""
    events = read_table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    r = events.agg(F.min(micros).alias("lo"), F.max(micros).alias("hi")).first()
    lo, hi = (r.lo or 0), (r.hi or 0)
    return events, F.expr(f"(unix_micros(cast(ts as timestamp)) - {lo}L) * {RANGES} div ({hi}L - {lo}L + 1)")


def _in_ranges(spark: SparkSession, sf_dir: str, name: str, start, held_back: bool = False, after=None) -> str:
    """Feed the whole events table to one streaming query, a time range at a time.

    Each range is added to a folder in the shared work folder, and the query started by
    ``start(events, out)`` runs until it has read it and ends; the next one goes on from its
    checkpoint, in another batch.  ``held_back``: a slice of the first range comes with the last.  ``after(query, out)`` is called when a
    range has been read."""
    events, number = _range_number(spark, sf_dir)
    if held_back:
        late = (number == 0) & (F.col("event_id") % HELD_EVERY == HELD_REST)
        number = F.when(late, F.lit(RANGES - 1)).otherwise(number)
    out = _run_dir(spark, name)
    for i in range(RANGES):
        events.where(number == i).write.mode("append").parquet(f"{out}/input")
        source = spark.readStream.schema(events.schema).parquet(f"{out}/input")
        query = run_to_end(start(events_to_ratings(source), out))
        if after:
            after(query, out)
    return out


def q_stream_update_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each window of an item was emitted: once for each range with an event in it."""
    start = lambda ev, out: start_window_updates(ev, out, WIDE_SPEC, AVAILABLE_NOW)
    out = _in_ranges(spark, sf_dir, "update_log", start)
    updates = read_result_dir(spark, f"{out}/trending_updates", TRENDING_OUT)
    return updates.groupBy("window_start", "window_end", "item_id").agg(
        F.count(F.lit(1)).alias("emissions"), F.max("n_ratings").alias("n_ratings")
    )


def q_stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last state of each window of an item when a slice of the first range comes with the last:
    windows that the watermark has passed by then don't take the late events."""
    start = lambda ev, out: start_window_updates(ev, out, WIDE_SPEC, AVAILABLE_NOW)
    out = _in_ranges(spark, sf_dir, "late_drop", start, held_back=True)
    updates = read_result_dir(spark, f"{out}/trending_updates", TRENDING_OUT)
    last = best_per_key(updates, ["window_start", "window_end", "item_id"], ["batch_id"])
    return last.select("window_start", "window_end", "item_id", "n_ratings")


def q_stream_dropped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the state dropped as late in the replay of ``stream_late_drop``, summed
    from what each batch stored."""
    start = lambda ev, out: start_window_updates(ev, out, WIDE_SPEC, AVAILABLE_NOW)
    store = lambda q, out: store_progress(spark, q.recentProgress, out, "updates")
    return dropped_rows(spark, _in_ranges(spark, sf_dir, "dropped", start, held_back=True, after=store), "updates")


def q_served_compacted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored windows of a stream whose old batches are folded after each range."""
    start = lambda ev, out: start_final_windows(ev, out, WIDE_SPEC, AVAILABLE_NOW)
    out = _in_ranges(spark, sf_dir, "compacted", start, after=lambda q, out: compact_outputs(spark, out))
    return rounded(stored_windows(spark, out).drop("batch_id"), DIGITS)


def q_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows of a query that was stopped and started again from its checkpoint
    after each range: the answer of an uninterrupted one."""
    start = lambda ev, out: start_final_windows(ev, out, WIDE_SPEC, AVAILABLE_NOW)
    out = _in_ranges(spark, sf_dir, "restart", start)
    return rounded(stored_windows(spark, out).drop("batch_id"), DIGITS)


STREAM_QUERIES = {
    "stream_update_log": q_stream_update_log,
    "stream_late_drop": q_stream_late_drop,
    "stream_dropped_rows": q_stream_dropped_rows,
    "served_compacted_windows": q_served_compacted_windows,
    "stream_restart": q_stream_restart,
    "served_counters": q_served_counters,
    "served_top_trending": q_served_top_trending,
    "served_latest_alerts": q_served_latest_alerts,
    "stream_item_window_final": q_stream_item_window_final,
    "stream_item_window_panes": q_stream_item_window_panes,
    "stream_item_window_final_30s": q_stream_item_window_final_30s,
    "stream_user_window_final": q_stream_user_window_final,
    "stream_alerts_final": q_stream_alerts_final,
    "stream_update_last": q_stream_update_last,
    "batch_lag": q_batch_lag,
}
