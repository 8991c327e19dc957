"""Small tables beside the stored windows, so that readers need not scan them.

Each micro-batch of closed windows also leaves, under the same ``batch_id``:

* ``window_counts``: one row, its windows and its alerting windows;
* ``window_items``: its distinct items as bitmaps (exact, mergeable by OR), one per bucket of
  32,768 ids;
* ``window_best``: its best window of each item.

Readers merge the batches: counters add up, bitmaps unite, the best of the bests is the best.
The work is by batches and items, not by windows.  A replayed batch replaces its rows.
Windows are stored by batch and, inside, by the date of their end, so that the latest ones are
found by folder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewave.operators.alerts import DEFAULT_MIN_AVG, DEFAULT_MIN_N, alert_condition
from ratewave.operators.serving import best_per_key, latest_alerts
from ratewave.schemas import (
    BEST_OUT,
    ITEM_BITMAPS_OUT,
    RECS_COUNTS_OUT,
    TRENDING_OUT,
    WINDOW_COUNTS_OUT,
    WINDOWS_OUT,
)
from ratewave.sources.files import read_result_dir
from ratewave.streaming.sinks import write_batch_partition

#: Places of the published score, by which the best window of an item is chosen.
SCORE_DIGITS = 6
DATE = "window_date"


def dated(windows: DataFrame) -> DataFrame:
    """With the date of the window's end, the folder it is stored in."""
    return windows.withColumn(DATE, F.to_date("window_end"))


def _best(windows: DataFrame, digits: int) -> DataFrame:
    shown = windows.withColumn("shown", F.round("trending_score", digits))
    return best_per_key(shown, "item_id", ["shown", "window_start"]).drop("shown")


def write_summaries(
    windows: DataFrame,
    out_dir: str,
    batch_id: int,
    min_avg: float = DEFAULT_MIN_AVG,
    min_n: int = DEFAULT_MIN_N,
    digits: int = SCORE_DIGITS,
) -> None:
    """The three tables of one batch of closed windows (``windows`` should be cached)."""
    alerts = F.count_if(alert_condition(min_avg, min_n)).alias("n_alerts")
    counts = windows.agg(F.count(F.lit(1)).alias("n_windows"), alerts)
    write_batch_partition(counts, f"{out_dir}/window_counts", batch_id, n_rows=1)
    items = windows.where("item_id IS NOT NULL").groupBy(F.bitmap_bucket_number("item_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("item_id")).alias("items")
    )
    write_batch_partition(items, f"{out_dir}/window_items", batch_id)
    best = _best(windows, digits).select(*[f.name for f in BEST_OUT.fields if f.name != "batch_id"])
    write_batch_partition(best, f"{out_dir}/window_best", batch_id)


def write_recs_counts(recs: DataFrame, out_dir: str, batch_id: int) -> None:
    """One row for a batch: the recommendation rows written."""
    counts = recs.agg(F.count(F.lit(1)).alias("n_recs"))
    write_batch_partition(counts, f"{out_dir}/recs_counts", batch_id, n_rows=1)


def stored_windows(spark: SparkSession, out_dir: str, with_date: bool = False) -> DataFrame:
    """All closed windows, with their ``batch_id`` (and ``window_date``, which prunes folders)."""
    rows = read_result_dir(spark, f"{out_dir}/trending", WINDOWS_OUT)
    return rows if with_date else rows.select(*TRENDING_OUT.names)


def stored_counters(spark: SparkSession, out_dir: str) -> DataFrame:
    """``operators.result_counters`` of the stored windows, from the batches' summaries."""
    counts = read_result_dir(spark, f"{out_dir}/window_counts", WINDOW_COUNTS_OUT)
    items = read_result_dir(spark, f"{out_dir}/window_items", ITEM_BITMAPS_OUT)
    united = items.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("items")).alias("n"))
    zero = F.lit(0).cast("long")
    distinct = united.agg(F.coalesce(F.sum("n"), zero).alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n_windows"), zero).alias("trending_windows"), F.coalesce(F.sum("n_alerts"), zero).alias("alert_windows")
    ).select("trending_windows", distinct.scalar().alias("distinct_items"), "alert_windows")


def stored_best(spark: SparkSession, out_dir: str, digits: int = SCORE_DIGITS) -> DataFrame:
    """The best stored window of each item, from the batches' bests."""
    return _best(read_result_dir(spark, f"{out_dir}/window_best", BEST_OUT).drop("batch_id"), digits)


def stored_recs_counters(spark: SparkSession, out_dir: str) -> DataFrame:
    """``operators.recs_counters`` of the stored recommendations, from one row per batch."""
    counts = read_result_dir(spark, f"{out_dir}/recs_counts", RECS_COUNTS_OUT)
    return counts.agg(
        F.coalesce(F.sum("n_recs"), F.lit(0).cast("long")).alias("rec_rows"), F.count_if(F.col("n_recs") > 0).alias("rec_batches")
    )


def stored_dates(windows: DataFrame) -> list[str]:
    """The dates under which windows are stored, latest first, from the file listing alone."""
    found = (re.search(rf"/{DATE}=(\d{{4,}}-\d\d-\d\d)/", f) for f in windows.inputFiles())
    return sorted({m.group(1) for m in found if m}, reverse=True)


def latest_stored_alerts(
    spark: SparkSession,
    out_dir: str,
    n: int = 20,
    min_avg: float = DEFAULT_MIN_AVG,
    min_n: int = DEFAULT_MIN_N,
) -> DataFrame:
    """``operators.latest_alerts`` of the stored windows, reading backward: the last date's
    folders first, then twice as many dates each time, until there are ``n`` alerts."""
    windows = stored_windows(spark, out_dir, with_date=True)
    dates, span = stored_dates(windows), 1
    while span < len(dates):
        recent = windows.where(F.col(DATE) >= F.lit(dates[span - 1]).cast("date"))
        found = latest_alerts(recent, n, min_avg, min_n)
        if found.count() >= n:  # at most n rows
            return found
        span *= 2
    return latest_alerts(windows, n, min_avg, min_n)
