"""The streaming trending application, as a small set of queries.

Reading a source once per output (one query per sink) multiplies source
reads and state stores.  Here:

* ``final``: item windows in **append** mode, emitted once per window when
  the watermark passes its end; a ``foreachBatch`` fan-out writes the
  trending rows and the alert rows of each batch.
* ``updates``: item windows in **update** mode (every change, as the
  reference's console outputs), fanned out to an update log, alert updates
  and an optional console print.
* ``users``: user windows in append mode to a Parquet file sink.
* ``recs``: per-batch lag metrics and Top-k recommendations (stateless).

Each query has its own checkpoint below ``out_dir``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from ratewave.models.versions import LatestModel
from ratewave.operators.alerts import DEFAULT_MIN_AVG, DEFAULT_MIN_N, threshold_alerts
from ratewave.operators.windows import (
    flatten_window,
    trending,
    user_window_counts,
    with_event_watermark,
)
from ratewave.streaming.scoring import make_batch_handler
from ratewave.streaming.sinks import (
    AVAILABLE_NOW,
    console_options,
    start_query,
    write_batch_partition,
)
from ratewave.streaming.summaries import DATE, dated, write_summaries


@dataclass(frozen=True)
class WindowSpec:
    size: str = "30 seconds"
    slide: str = "10 seconds"
    watermark: str = "1 minute"
    #: Final windows from panes: fewer rows in state and shuffle; a late event counts only
    #: while its pane (of slide width) is open.  Append mode only.
    panes: bool = False


REFERENCE_SPEC = WindowSpec()

# Processing-time triggers of the window queries and of the
# per-batch recommendation query.
WINDOW_TRIGGER = "10 seconds"
RECS_TRIGGER = "5 seconds"


def trending_stream(events: DataFrame, spec: WindowSpec, final: bool = True) -> DataFrame:
    wm = with_event_watermark(events, "event_time", spec.watermark)
    return flatten_window(trending(wm, spec.size, spec.slide, panes=spec.panes and final))


def user_stream(events: DataFrame, spec: WindowSpec, final: bool = True) -> DataFrame:
    wm = with_event_watermark(events, "event_time", spec.watermark)
    return flatten_window(user_window_counts(wm, spec.size, spec.slide, panes=spec.panes and final))


def _fanout(
    out_dir: str,
    rows_name: str,
    alerts_name: str,
    min_avg: float,
    min_n: int,
    console_rows: int = 0,
    closed: bool = False,
):
    """``closed``: the rows are final, so they are filed by date and summed up for readers."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        cached = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = cached.count()
            if not n:
                return
            if closed:
                write_batch_partition(dated(cached), f"{out_dir}/{rows_name}", batch_id, n_rows=n, partition_by=[DATE])
                write_summaries(cached, out_dir, batch_id, min_avg, min_n)
            else:
                write_batch_partition(cached, f"{out_dir}/{rows_name}", batch_id, n_rows=n)
            alerts = threshold_alerts(cached, min_avg, min_n)
            write_batch_partition(alerts, f"{out_dir}/{alerts_name}", batch_id, n_rows=n)
            if console_rows:
                cached.show(console_rows, truncate=False)
                alerts.show(console_rows, truncate=False)
        finally:
            cached.unpersist()

    return handle


def start_final_windows(
    events: DataFrame,
    out_dir: str,
    spec: WindowSpec = REFERENCE_SPEC,
    trigger: str | None = AVAILABLE_NOW,
    min_avg: float = DEFAULT_MIN_AVG,
    min_n: int = DEFAULT_MIN_N,
    name: str | None = None,
) -> StreamingQuery:
    """Closed windows once each: ``trending/`` and ``alerts/`` by batch, and the summaries that
    readers merge (:mod:`ratewave.streaming.summaries`)."""
    return start_query(
        trending_stream(events, spec),
        name=name,
        sink="foreach_batch",
        mode="append",
        checkpoint=f"{out_dir}/_checkpoints/final",
        trigger=trigger,
        batch_fn=_fanout(out_dir, "trending", "alerts", min_avg, min_n, closed=True),
    )


def start_window_updates(
    events: DataFrame,
    out_dir: str,
    spec: WindowSpec = REFERENCE_SPEC,
    trigger: str | None = AVAILABLE_NOW,
    min_avg: float = DEFAULT_MIN_AVG,
    min_n: int = DEFAULT_MIN_N,
    console_rows: int = 0,
    name: str | None = None,
) -> StreamingQuery:
    """Every window change: ``trending_updates/`` and ``alert_updates/``."""
    return start_query(
        trending_stream(events, spec, final=False),
        name=name,
        sink="foreach_batch",
        mode="update",
        checkpoint=f"{out_dir}/_checkpoints/updates",
        trigger=trigger,
        batch_fn=_fanout(out_dir, "trending_updates", "alert_updates", min_avg, min_n, console_rows),
    )


def start_user_windows(
    events: DataFrame,
    out_dir: str,
    spec: WindowSpec = REFERENCE_SPEC,
    trigger: str | None = AVAILABLE_NOW,
    name: str | None = None,
) -> StreamingQuery:
    """Closed user windows to an exactly-once Parquet file sink."""
    return start_query(
        user_stream(events, spec),
        name=name,
        sink="parquet",
        mode="append",
        path=f"{out_dir}/user_windows",
        checkpoint=f"{out_dir}/_checkpoints/users",
        trigger=trigger,
    )


def start_user_updates_console(
    events: DataFrame,
    out_dir: str,
    spec: WindowSpec = REFERENCE_SPEC,
    trigger: str | None = WINDOW_TRIGGER,
    num_rows: int = 20,
    name: str | None = None,
) -> StreamingQuery:
    """User-window changes printed on the driver (update mode, console)."""
    return start_query(
        user_stream(events, spec, final=False),
        name=name,
        sink="console",
        mode="update",
        checkpoint=f"{out_dir}/_checkpoints/user_updates",
        trigger=trigger,
        options=console_options(num_rows),
    )


def start_recommendations(
    events: DataFrame,
    out_dir: str,
    model: ALSModel | None,
    k: int = 5,
    trigger: str | None = AVAILABLE_NOW,
    now: Column | None = None,
    show_rows: int = 0,
    name: str | None = None,
    id_maps: dict[str, DataFrame] | None = None,
    latest: LatestModel | None = None,
) -> StreamingQuery:
    """Per batch: lag metrics and (with a model) Top-k for the batch's users.  ``latest``: the
    model is the newest version published before each batch."""
    return start_query(
        events,
        name=name,
        sink="foreach_batch",
        mode="append",
        checkpoint=f"{out_dir}/_checkpoints/recs",
        trigger=trigger,
        batch_fn=make_batch_handler(out_dir, model, k, now, show_rows, id_maps, latest),
    )


def start_app(
    events: DataFrame,
    out_dir: str,
    model: ALSModel | None = None,
    spec: WindowSpec = REFERENCE_SPEC,
    window_trigger: str | None = WINDOW_TRIGGER,
    recs_trigger: str | None = RECS_TRIGGER,
    console_rows: int = 0,
    prefix: str = "",
    id_maps: dict[str, DataFrame] | None = None,
    latest: LatestModel | None = None,
) -> dict[str, StreamingQuery]:
    """Start the queries; wait with ``spark.streams.awaitAnyTermination()``.

    ``id_maps``: those saved with the model (``models.load_id_maps``), if its ids were mapped.
    ``latest``: instead of ``model`` and ``id_maps``, whatever version is newest before a batch.
    ``console_rows > 0`` also prints trending and alert updates (from the
    update fan-out) and user-window updates (one more query) on the driver.
    """
    queries = {
        "final": start_final_windows(
            events, out_dir, spec, window_trigger, name=f"{prefix}trending_final"
        ),
        "updates": start_window_updates(
            events, out_dir, spec, window_trigger, console_rows=console_rows,
            name=f"{prefix}trending_updates",
        ),
        "users": start_user_windows(events, out_dir, spec, window_trigger, name=f"{prefix}user_windows"),
        "recs": start_recommendations(
            events, out_dir, model, trigger=recs_trigger, name=f"{prefix}recommendations", id_maps=id_maps, latest=latest
        ),
    }
    if console_rows:
        queries["user_updates"] = start_user_updates_console(
            events, out_dir, spec, window_trigger, console_rows, name=f"{prefix}user_updates"
        )
    return queries
