"""Starting streaming queries: sink, output mode, trigger, checkpoint.

Every query gets a checkpoint folder (on the shared file system), so a
restarted driver or a lost executor resumes from the last committed batch.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ratewave.session import remove_folder
from ratewave.sources.files import latest_manifest

AVAILABLE_NOW = "available_now"
ONCE = "once"


def trigger_kwargs(trigger: str | None) -> dict:
    """``'10 seconds'`` -> processing-time trigger; ``'available_now'`` ->
    process what is there (in batches of the source's rate setting, or one) and stop; ``None`` -> as fast
    as possible."""
    if trigger is None:
        return {}
    if trigger == AVAILABLE_NOW:
        return {"availableNow": True}
    if trigger == ONCE:
        return {"once": True}
    return {"processingTime": trigger}


def start_query(
    df: DataFrame,
    sink: str,
    checkpoint: str,
    mode: str = "append",
    trigger: str | None = AVAILABLE_NOW,
    path: str | None = None,
    name: str | None = None,
    batch_fn: Callable[[DataFrame, int], None] | None = None,
    options: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Start one streaming query.

    ``sink``: ``parquet`` (exactly-once file sink, append only), ``console``
    (rows shown on the driver, ``numRows``/``truncate`` options), ``memory``
    (tests), ``foreach_batch`` (``batch_fn(batch_df, batch_id)``), or any
    other format name (e.g. ``kafka``).
    """
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**trigger_kwargs(trigger)) if trigger else w
    if name:
        w = w.queryName(name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if sink == "foreach_batch":
        if batch_fn is None:
            raise ValueError("foreach_batch needs batch_fn")
        return w.foreachBatch(batch_fn).start()
    if sink == "console":
        return w.format("console").start()
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.format(sink)
    return w.start(path) if path else w.start()


def console_options(num_rows: int = 20, truncate: bool = False) -> dict[str, str]:
    return {"numRows": str(num_rows), "truncate": str(truncate).lower()}


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``available_now`` query; raise if it failed.

    Without ``timeout_s`` it may take as long as its input needs; with it (tests), the
    query is stopped and an error raised after that time."""
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination() is None
    if not finished:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


ROWS_PER_FILE = 1_000_000


def write_batch_partition(
    df: DataFrame,
    root: str,
    batch_id: int,
    fmt: str = "parquet",
    n_rows: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    partition_by: Sequence[str] = (),
) -> str:
    """Put the rows of one batch at ``root/batch_id=<id>``, in place of any earlier ones:
    replaying a batch replaces its rows, where an append would duplicate them.

    The rows are written beside it, in a folder that readers of ``root`` skip, and the
    finished folder is renamed, so no reader meets half a batch.  A batch without rows has
    no folder.  With ``n_rows`` (an upper bound the caller already knows) the finished rows
    are dealt to about ``rows_per_file`` rows per file; only the writing is that narrow, not
    what makes the rows.  ``partition_by``: columns that become folders inside the batch's.
    A batch that has been folded (``streaming.compaction``) can't be written again.
    """
    spark = df.sparkSession
    folded = latest_manifest(spark, root)
    if folded is not None and batch_id <= folded.through:
        raise ValueError(f"{root}: batches up to {folded.through} have been folded; batch {batch_id} can't be replaced")
    path = f"{root.rstrip('/')}/batch_id={int(batch_id)}"
    if n_rows is not None:
        df = df.repartition(max(1, math.ceil(n_rows / rows_per_file)))
    new = f"{root.rstrip('/')}/_writing-{int(batch_id)}-{uuid.uuid4().hex}"
    df.write.format(fmt).partitionBy(*partition_by).save(new)
    remove_folder(spark, path)
    if spark.read.format(fmt).schema(df.schema).load(new).isEmpty():
        remove_folder(spark, new)
        return path
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = Path(new).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(Path(new), Path(path)):
        raise OSError(f"could not move {new} to {path}")
    return path


def publish_records(
    records: DataFrame,
    fmt: str = "text",
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """Batch-publish keyed records (``key``, ``value``).

    ``fmt="text"``: one JSON value per line under ``path`` (what
    :func:`ratewave.sources.read_event_files` streams back);
    ``fmt="kafka"``: to a topic (``options`` carry
    ``kafka.bootstrap.servers`` and ``topic``); records with the same key
    go to the same topic partition.
    """
    if fmt == "text":
        records.select(records["value"].cast("string").alias("value")).write.mode("append").text(path)
        return
    w = records.write.format(fmt).options(**(options or {}))
    if path:
        w.save(path)
    else:
        w.save()
