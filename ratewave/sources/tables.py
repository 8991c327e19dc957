"""Parquet tables and the two canonical views built over them.

* ``rating_events``: rating events derived from the ``events`` table
  (one rating per event; item ``k % 20`` where ``k`` is the JSON field in
  ``props``; item 0 is the hot item, with ratings 4.5..5.0).
* ``ratings``: explicit ratings derived from ``lineitem`` joined with
  ``orders`` (user = customer, item = part).

Both are lazy DataFrames; Catalyst prunes them to the columns a query uses
and pushes filters into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of the rating_events view (must agree with the SQL oracle).
HOT_ITEM = 0
N_ITEMS = 20
HOT_BASE, HOT_SPREAD = 4.5, 6  # hot item: 4.5 + (event_id % 6) / 10
BASE, SPREAD = 1.0, 41  # other items: 1.0 + (event_id % 41) / 10


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def events_to_ratings(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Map raw ``events`` rows (static or streaming) to rating events.

    ``event_time`` is a session-zone TIMESTAMP (the source column is
    TIMESTAMP_NTZ, which a watermark does not accept).  ``keep`` carries
    extra source columns through.
    """
    k = F.get_json_object(F.col("props"), "$.k").try_cast("long")
    item = (k % F.lit(N_ITEMS)).cast("long")
    rating = (
        F.when(item == F.lit(HOT_ITEM), F.lit(HOT_BASE) + (F.col("event_id") % HOT_SPREAD) / F.lit(10.0))
        .otherwise(F.lit(BASE) + (F.col("event_id") % SPREAD) / F.lit(10.0))
        .cast("double")
    )
    return events.select(
        F.col("user_id").cast("long").alias("user_id"),
        item.alias("item_id"),
        rating.alias("rating"),
        F.col("ts").cast("timestamp").alias("event_time"),
        *[F.col(c) for c in (keep or [])],
    )


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_ratings(read_table(spark, sf_dir, "events"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit ratings: one per order line, user = customer, item = part.

    ``rating = (quantity % 10 + 1) / 2`` is in 0.5..5.0; ``timestamp`` is the
    order date in epoch seconds.  A shuffle join on the order key; both
    sides are pruned to three columns before the exchange.  Ids keep the
    source keys' width (customer keys pass int32 at large scale factors;
    only ``models.with_int_ids`` narrows them).
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(od, li.l_orderkey == od.o_orderkey)
    return joined.select(
        F.col("o_custkey").cast("long").alias("user_id"),
        F.col("l_partkey").cast("long").alias("item_id"),
        ((F.col("l_quantity") % 10 + 1) / 2).cast("float").alias("rating"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("timestamp"),
    )


def _is_directory(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath) and fs.getFileStatus(hpath).isDirectory()


def table_stream(
    spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A Parquet table as a file stream.

    A table stored as a folder of part files is streamed as that folder; a
    table stored as one file is streamed from its parent folder with a
    file-name filter (a file stream source needs a folder).
    """
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if _is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def events_stream(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The ``events`` table as a file stream."""
    return table_stream(spark, sf_dir, "events", max_files_per_trigger)


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Temp views ``rating_events`` and ``ratings`` for ``spark.sql(...)``.

    Views are lazy plans: a SQL query over them is optimised together with
    the view (pruning and pushdown reach the Parquet scans).
    """
    rating_events(spark, sf_dir).createOrReplaceTempView("rating_events")
    ratings(spark, sf_dir).createOrReplaceTempView("ratings")
    return ["rating_events", "ratings"]
