"""Per micro-batch work: ingest lag metrics and Top-k recommendations.

The handler runs on the driver once per micro-batch but only plans Spark
jobs over the batch; no event rows are collected.  The batch is read once:
the job that finds its users (or, without a model, only reads it) also counts
events and averages their lag, as observed metrics.  Output goes to
``batch_id=<id>`` folders written with overwrite, so a replayed batch
(after a failure between write and commit) replaces rather than duplicates.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewave.functions.scores import lag_millis, lag_seconds
from ratewave.models.als import prepare_item_factors, recommend
from ratewave.models.versions import LatestModel, ModelInUse
from ratewave.operators.topk import ItemBlocks
from ratewave.schemas import BATCH_ID, METRICS_OUT
from ratewave.sources.files import read_result_dir
from ratewave.streaming.sinks import write_batch_partition
from ratewave.streaming.summaries import write_recs_counts

log = logging.getLogger("ratewave.streaming")

METRICS = T.StructType([f for f in METRICS_OUT.fields if f != BATCH_ID])


def lag_metrics(now: Column | None = None) -> list[Column]:
    """Aggregates ``n_events, avg_lag_s`` (from whole epoch seconds) and
    ``avg_lag_exact_s`` (from milliseconds)."""
    return [
        F.count(F.lit(1)).alias("n_events"),
        F.avg(lag_seconds("event_time", now).cast("double")).alias("avg_lag_s"),
        (F.avg(lag_millis("event_time", now)) / F.lit(1000.0)).alias("avg_lag_exact_s"),
    ]


def batch_metrics(batch: DataFrame, batch_id: int, now: Column | None = None) -> DataFrame:
    """One row: ``batch_id`` and the :func:`lag_metrics` of a batch at rest."""
    return batch.agg(F.lit(int(batch_id)).cast("long").alias("batch_id"), *lag_metrics(now))


def batch_recommendations(
    model: ALSModel,
    batch: DataFrame,
    k: int = 5,
    id_maps: dict[str, DataFrame] | None = None,
    items: ItemBlocks | None = None,
) -> DataFrame:
    """Top-k for the distinct users seen in the batch (known users only).

    With ``id_maps`` (``models.load_id_maps``) the batch's source ids are
    translated to the model's and the answer is in source ids.
    """
    users = batch.select("user_id").distinct()
    return recommend(model, users, k, id_maps=id_maps, items=items)


def make_batch_handler(
    out_dir: str,
    model: ALSModel | None = None,
    k: int = 5,
    now: Column | None = None,
    show_rows: int = 0,
    id_maps: dict[str, DataFrame] | None = None,
    latest: LatestModel | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback writing ``metrics/`` and (with a model) ``recs/``.

    A ``model`` is fixed for the life of the query; ``latest`` is asked for its model before
    each batch.  Either way a model's item factors are translated, packed and written once."""
    fixed = None
    if model is not None:
        fixed = ModelInUse("", model, id_maps or {}, prepare_item_factors(model, id_maps))

    def handle(batch: DataFrame, batch_id: int) -> None:
        used = latest.get() if latest is not None else fixed
        seen = Observation()
        watched = batch.observe(seen, *lag_metrics(now))
        users = None
        try:
            if used is None:
                watched.write.format("noop").mode("overwrite").save()
            else:
                users = watched.select("user_id").distinct().persist(StorageLevel.MEMORY_AND_DISK)
                if not users.count():  # no events; an empty plan may have lost its metrics
                    return
            row = seen.get
            if not row["n_events"]:
                return
            log.info("batch %d: %d events, avg lag %.2f s", batch_id, row["n_events"],
                     row["avg_lag_exact_s"] if row["avg_lag_exact_s"] is not None else float("nan"))
            metrics = batch.sparkSession.createDataFrame([tuple(row[c] for c in METRICS.names)], METRICS)
            write_batch_partition(metrics, f"{out_dir}/metrics", batch_id, n_rows=1)
            if used is not None:
                recs = batch_recommendations(used.model, users, k, used.id_maps, used.items)
                path = write_batch_partition(recs, f"{out_dir}/recs", batch_id, n_rows=row["n_events"])
                written = read_result_dir(batch.sparkSession, path, recs.schema)
                write_recs_counts(written, out_dir, batch_id)
                if show_rows:  # what was written; computing it again would be a second top-k
                    written.show(show_rows, truncate=False)
        finally:
            if users is not None:
                users.unpersist()

    return handle
