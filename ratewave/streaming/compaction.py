"""Folding the folders of old batches into few large files.

A stream leaves a folder for each batch, so listing and opening files ends up costing more than
reading rows.  :func:`compact` writes the rows of the old batches into one part and then publishes
a manifest that names the parts and the last batch they hold; ``sources.read_result_dir`` reads
the parts and, beside them, the folders of later batches only.

* Readers: a manifest appears by one rename, so a reader sees all batches once, by the manifest
  before or by the new one.  Nothing is deleted here; :func:`remove_folded` deletes what has been
  folded for longer than any reader runs.
* Replays: Spark replays only the last batch it began.  The newest folder is therefore left, and
  all older ones belong to committed batches.  Writing a folded batch again is an error
  (``write_batch_partition``) rather than rows that nobody reads.
* Two at a time: a manifest's number is taken once; the later one drops its part.
* Work: a part takes in the parts before it that are no larger, so each part is larger than all
  later ones together and a row is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewave import schemas as S
from ratewave.session import remove_folder
from ratewave.sources.files import (
    FOLDED,
    MANIFESTS,
    Manifest,
    Part,
    hadoop_folder,
    latest_manifest,
    manifest_numbers,
    read_manifest,
)
from ratewave.streaming.progress import STATE_METRICS
from ratewave.streaming.sinks import ROWS_PER_FILE
from ratewave.streaming.summaries import DATE

#: The app's outputs by batch: folder, schema, columns that are folders.
OUTPUTS: tuple[tuple[str, T.StructType, tuple[str, ...]], ...] = (
    ("trending", S.WINDOWS_OUT, (DATE,)),
    ("alerts", S.ALERTS_OUT, ()),
    ("trending_updates", S.TRENDING_OUT, ()),
    ("alert_updates", S.ALERTS_OUT, ()),
    ("metrics", S.METRICS_OUT, ()),
    ("recs", S.RECS_OUT, ()),
    ("window_counts", S.WINDOW_COUNTS_OUT, ()),
    ("window_items", S.ITEM_BITMAPS_OUT, ()),
    ("window_best", S.BEST_OUT, ()),
    ("recs_counts", S.RECS_COUNTS_OUT, ()),
)


def batch_folders(spark: SparkSession, root: str) -> list[int]:
    """The ids of the batches that have a folder of their own, in order."""
    path, fs = hadoop_folder(spark, root)
    if not fs.exists(path):
        return []
    names = (s.getPath().getName().partition("=") for s in fs.listStatus(path))
    return sorted(int(value) for key, _, value in names if key == "batch_id" and value.isdigit())


def _publish(spark: SparkSession, root: str, manifest: Manifest) -> bool:
    """Whether the manifest's number was free and is now this one."""
    jvm = spark.sparkContext._jvm
    folder = f"{root.rstrip('/')}/{MANIFESTS}"
    new, fs = hadoop_folder(spark, f"{folder}/_new-{uuid.uuid4().hex}")
    stream = fs.create(new, False)
    stream.write(bytearray(manifest.to_json().encode()))
    stream.close()
    target, _ = hadoop_folder(spark, f"{folder}/{manifest.number}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(new), fs.makeQualified(target), no_options)
        return True
    except Exception:  # noqa: BLE001 - any failure, unless the number is taken
        fs.delete(new, False)
        if manifest.number not in manifest_numbers(spark, root):
            raise
        return False


def compact(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    rows_per_file: int = ROWS_PER_FILE,
) -> Manifest | None:
    """Fold all batches of ``root`` but the newest; the new manifest, or None where there was
    nothing to fold or another call was quicker.

    Rows are dealt by range (of ``partition_by``, then the batch, then a hash of the row), so
    files are of about ``rows_per_file`` rows whatever the batches' sizes, and a date or a batch
    lies in few files."""
    old = latest_manifest(spark, root) or Manifest(-1, -1, ())
    ids = [b for b in batch_folders(spark, root) if b > old.through][:-1]
    if not ids:
        return None
    base = root.rstrip("/")
    rows = spark.read.schema(schema).parquet(base).select(*schema.names)
    rows = rows.where(F.col("batch_id").between(ids[0], ids[-1]))
    n, parts = rows.count(), list(old.parts)
    while parts and parts[-1].n_rows <= n:
        last = parts.pop()
        n += last.n_rows
        rows = rows.unionAll(spark.read.schema(schema).parquet(f"{base}/{last.path}").select(*schema.names))
    path = f"{FOLDED}/{uuid.uuid4().hex}"
    dealt = rows.repartitionByRange(max(1, math.ceil(n / rows_per_file)), *partition_by, "batch_id", F.xxhash64(*schema.names))
    dealt.write.partitionBy(*partition_by).parquet(f"{base}/{path}")
    manifest = Manifest(old.number + 1, ids[-1], (*parts, Part(path, n)))
    if _publish(spark, root, manifest):
        return manifest
    remove_folder(spark, f"{base}/{path}")
    return None


def remove_folded(spark: SparkSession, root: str, older_than_s: float = 24 * 3600.0) -> int:
    """Delete the folders and parts that no manifest of the last ``older_than_s`` seconds needs;
    how many.  That time must exceed the longest read and the longest :func:`compact`."""
    base, limit = root.rstrip("/"), (time.time() - older_than_s) * 1000
    numbers = manifest_numbers(spark, root)

    def written(name: str) -> int:
        path, fs = hadoop_folder(spark, f"{base}/{name}")
        return fs.getFileStatus(path).getModificationTime()

    settled = [n for n in numbers if written(f"{MANIFESTS}/{n}.json") <= limit]
    if not settled:
        return 0
    kept = [read_manifest(spark, root, n) for n in numbers if n >= settled[-1]]
    gone = [f"batch_id={b}" for b in batch_folders(spark, root) if b <= kept[0].through]
    needed = {p.path for m in kept for p in m.parts}
    path, fs = hadoop_folder(spark, f"{base}/{FOLDED}")
    there = [f"{FOLDED}/{s.getPath().getName()}" for s in fs.listStatus(path)]
    gone += [p for p in there if p not in needed and written(p) <= limit]
    gone += [f"{MANIFESTS}/{n}.json" for n in numbers if n < settled[-1]]
    for name in gone:
        remove_folder(spark, f"{base}/{name}")
    return len(gone)


def outputs(spark: SparkSession, out_dir: str) -> list[tuple[str, T.StructType, tuple[str, ...]]]:
    """:data:`OUTPUTS` and the stored progress of each query below ``out_dir``."""
    path, fs = hadoop_folder(spark, f"{out_dir.rstrip('/')}/{STATE_METRICS}")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return [*OUTPUTS, *((f"{STATE_METRICS}/{n}", S.STATE_METRICS_OUT, ()) for n in names)]


def compact_outputs(spark: SparkSession, out_dir: str, rows_per_file: int = ROWS_PER_FILE) -> dict[str, Manifest]:
    """:func:`compact` for every output of the streaming app below ``out_dir``."""
    base = out_dir.rstrip("/")
    found = {n: compact(spark, f"{base}/{n}", s, by, rows_per_file) for n, s, by in outputs(spark, base)}
    return {name: m for name, m in found.items() if m is not None}
