"""What the state of a query did, batch by batch: rows dropped by the watermark, rows held.

Spark counts, at each stateful operator, the rows that came too late (groups, since they are
combined before they reach the state).  The counts are part of a batch's progress, which is known
only when the batch has ended; they are stored then, by a listener on a running stream or from the
recent progress of one that has ended, under the batch's id, so that storing twice is no harm.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from ratewave.schemas import BATCH_ID, STATE_METRICS_OUT
from ratewave.sources.files import read_result_dir
from ratewave.streaming.sinks import write_batch_partition

STATE_METRICS = "state_metrics"


def store_progress(spark: SparkSession, progress: Iterable[StreamingQueryProgress], out_dir: str, name: str) -> None:
    """One row for each batch of a stateful query, at ``out_dir/state_metrics/<name>``."""
    fields = [f for f in STATE_METRICS_OUT.fields if f != BATCH_ID]
    for p in progress:
        if not p.stateOperators:
            continue
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        held = sum(op.numRowsTotal for op in p.stateOperators)
        row = spark.createDataFrame([(p.numInputRows, dropped, held)], type(STATE_METRICS_OUT)(fields))
        write_batch_partition(row, f"{out_dir}/{STATE_METRICS}/{name}", p.batchId, n_rows=1)


def stored_progress(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """``input_rows, dropped_rows, state_rows, batch_id`` of each stored batch."""
    return read_result_dir(spark, f"{out_dir}/{STATE_METRICS}/{name}", STATE_METRICS_OUT)


def dropped_rows(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """One row: the late rows dropped so far, and the batches that dropped some."""
    return stored_progress(spark, out_dir, name).agg(
        F.coalesce(F.sum("dropped_rows"), F.lit(0).cast("long")).alias("dropped_rows"),
        F.count_if(F.col("dropped_rows") > 0).alias("batches_with_drops"),
    )


class ProgressStore(StreamingQueryListener):
    """Stores the progress of the named queries of a session as their batches end
    (``spark.streams.addListener(ProgressStore(spark, out_dir, names))``)."""

    def __init__(self, spark: SparkSession, out_dir: str, names: Iterable[str]) -> None:
        self.spark, self.out_dir, self.names = spark, out_dir, set(names)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name in self.names:
            store_progress(self.spark, [event.progress], self.out_dir, event.progress.name)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
