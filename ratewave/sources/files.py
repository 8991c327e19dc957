"""File sources: ratings text files, result folders, inline id lists."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewave.schemas import RAW_RATINGS_CSV_SCHEMA

# Source column name -> canonical column name.
RATINGS_COLUMN_MAP = {
    "userId": "user_id",
    "movieId": "item_id",
    "rating": "rating",
    "timestamp": "timestamp",
}


def read_ratings_text(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    header: bool = True,
    schema: T.StructType = RAW_RATINGS_CSV_SCHEMA,
) -> DataFrame:
    """Ratings from delimited text with explicit types (no inference scan).

    With a header the columns of ``schema`` are taken by name, in whatever order
    and beside whatever others they stand; a missing one is an error, and so is
    a file of the folder whose header differs from the first one's.
    ``sep='::', header=False`` reads the ``UserID::MovieID::Rating::Timestamp``
    layout, by position.  Columns come back renamed to ``user_id, item_id,
    rating, timestamp`` with ``rating`` as float; a value that doesn't parse is
    NULL; range and NULL cleaning is a separate step.
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep).option("mode", "PERMISSIVE")
    names = [f.name for f in schema.fields]
    if header:
        there = reader.csv(path).columns
        if missing := [n for n in names if n not in there]:
            raise ValueError(f"{path}: no column {', '.join(missing)} in the header {there}")
    text = T.StructType([T.StructField(n, T.StringType()) for n in (there if header else names)])
    raw = reader.option("enforceSchema", "false").schema(text).csv(path)
    kinds = {f.name: f.dataType for f in schema.fields} | {"rating": T.FloatType()}
    return raw.select(*[F.col(n).try_cast(kinds[n]).alias(RATINGS_COLUMN_MAP.get(n, n)) for n in names])


#: Below a result folder; names that begin with "_" are skipped by Spark's readers.
MANIFESTS, FOLDED = "_manifests", "_folded"
_MANIFEST = re.compile(r"(\d+)\.json")


@dataclass(frozen=True)
class Part:
    """Folded batches in one folder below the result folder."""

    path: str
    n_rows: int


@dataclass(frozen=True)
class Manifest:
    """Which batches of a result folder are folded (all up to ``through``), and where they are."""

    number: int
    through: int
    parts: tuple[Part, ...]

    def to_json(self) -> str:
        return json.dumps({"through": self.through, "parts": [asdict(p) for p in self.parts]})


def hadoop_folder(spark: SparkSession, path: str):
    """(path, its file system) through Hadoop, wherever the folder is."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def manifest_numbers(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the published manifests, oldest first."""
    path, fs = hadoop_folder(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(path):
        return []
    names = (_MANIFEST.fullmatch(s.getPath().getName()) for s in fs.listStatus(path))
    return sorted(int(m.group(1)) for m in names if m)


def read_manifest(spark: SparkSession, root: str, number: int) -> Manifest:
    path, fs = hadoop_folder(spark, f"{root.rstrip('/')}/{MANIFESTS}/{number}.json")
    stream = fs.open(path)
    try:
        found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(number, found["through"], tuple(Part(**p) for p in found["parts"]))


def latest_manifest(spark: SparkSession, root: str) -> Manifest | None:
    numbers = manifest_numbers(spark, root)
    return read_manifest(spark, root, numbers[-1]) if numbers else None


def read_result_dir(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All Parquet result files under ``path``; an empty frame if there are none.

    A folder written by a streaming file sink is read through its
    ``_spark_metadata`` log, and per-batch folders appear by a rename, so
    half-written files of a failed batch are never seen.  Batches that have been
    folded (``streaming.compaction``) are read from where the latest manifest says,
    and only the later ones from folders of their own.
    """
    folded = latest_manifest(spark, path)
    rows = _read_files(spark, path, schema)
    if folded is None:
        return rows
    rows = rows.where(F.col("batch_id") > folded.through).select(*schema.names)
    for part in folded.parts:
        rows = rows.unionAll(_read_files(spark, f"{path.rstrip('/')}/{part.path}", schema).select(*schema.names))
    return rows


def _read_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as exc:  # noqa: BLE001 - only "no files" is expected here
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def id_frame(
    spark: SparkSession, ids: Iterable[int], name: str = "user_id", dtype: T.DataType | None = None
) -> DataFrame:
    """A small inline table of ids (e.g. users to spot-check)."""
    schema = T.StructType([T.StructField(name, dtype or T.LongType(), False)])
    return spark.createDataFrame([(int(i),) for i in ids], schema)
