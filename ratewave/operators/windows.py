"""Event-time window statistics (tumbling when ``slide == size``).

The functions take a static or a streaming frame.  On a stream, apply a
watermark first (:func:`with_event_watermark`) so window state is evicted
and append mode can emit each window once, when it closes.

Plan shape on a static frame: where ``size`` is a multiple of ``slide``, each
event goes to one pane (of ``slide`` width), a partial hash aggregate combines
the events per (pane, key) before the shuffle, and the finished panes, not the
events, are expanded into ``size / slide`` windows and merged there: counts add
up, means and squared deviations merge pairwise.  A very hot key costs one
partial row per pane and task.

On a stream each event is expanded into its windows, then combined before the
shuffle: a late event then counts in those of its windows that are still open.
``panes=True`` makes a stream build panes too (two chained stateful aggregations,
append mode only); a late event then counts if its pane is open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewave.functions.scores import trending_score

# Window size, slide and watermark delay of the trending job.
DEFAULT_SIZE = "30 seconds"
DEFAULT_SLIDE = "10 seconds"
DEFAULT_WATERMARK = "1 minute"


def with_event_watermark(
    df: DataFrame, time_col: str = "event_time", delay: str = DEFAULT_WATERMARK
) -> DataFrame:
    return df.withWatermark(time_col, delay)


def window_column(time_col: str, size: str, slide: str | None) -> Column:
    return F.window(F.col(time_col), size, slide or size)


def flatten_window(df: DataFrame, ntz: bool = True, keep_struct: bool = False) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` / ``window_end``.

    ``ntz=True`` gives zone-free timestamps (stable across readers).
    """
    kind = "timestamp_ntz" if ntz else "timestamp"
    cols = [
        F.col("window.start").cast(kind).alias("window_start"),
        F.col("window.end").cast(kind).alias("window_end"),
    ]
    rest = [c for c in df.columns if c != "window" or keep_struct]
    return df.select(*cols, *rest)


_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400, "week": 604_800}


def duration_seconds(text: str) -> float | None:
    """Seconds of ``'30 seconds'`` and the like; None for other forms."""
    number, _, unit = text.strip().lower().partition(" ")
    scale = _SECONDS.get(unit.strip().removesuffix("s"))
    return int(number) * scale if scale and number.isdigit() else None


def _divides(size: str, slide: str | None) -> bool:
    a, b = duration_seconds(size), duration_seconds(slide or size)
    return bool(a and b and b < a and a % b == 0)


def _pane_time(streaming: bool) -> Column:
    """What puts a pane into windows; on a stream the column must carry the watermark on."""
    return F.window_time("pane") if streaming else F.col("pane.start")


def _merged(parts: Column) -> Column:
    """(m, mean, m2) of panes' (start, m, mean, m2) together, by pairwise updates: no large sums
    cancel.  A window has at most size / slide panes of a key."""
    none = F.struct(F.lit(0).cast("long").alias("m"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def step(a: Column, b: Column) -> Column:
        m = a["m"] + b["m"]
        apart = b["mean"] - a["mean"]
        mean = a["mean"] + apart * b["m"] / m
        m2 = a["m2"] + b["m2"] + apart * apart * a["m"] * b["m"] / m
        both = F.struct(m.alias("m"), mean.alias("mean"), m2.alias("m2"))
        return F.when(b["m"] == 0, a).otherwise(F.when(a["m"] == 0, F.struct(b["m"], b["mean"], b["m2"])).otherwise(both))

    return F.aggregate(F.array_sort(parts), none, step)


def _pane_stats(df: DataFrame, size: str, slide: str, key: str, value_col: str, time_col: str) -> DataFrame:
    value = F.col(value_col).cast("double")
    panes = df.groupBy(window_column(time_col, slide, None).alias("pane"), F.col(key)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(value).alias("m"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("m2"),
    )
    window = F.window(_pane_time(df.isStreaming), size, slide).alias("window")
    part = F.struct(F.col("pane.start").alias("start"), "m", "mean", "m2")
    out = panes.groupBy(window, F.col(key)).agg(F.sum("n").alias("n_ratings"), F.collect_list(part).alias("parts"))
    all_ = _merged(F.col("parts"))
    out = out.select("window", key, "n_ratings", all_.alias("all"))
    deviation = F.sqrt(F.col("all.m2") / (F.col("all.m") - 1))
    return out.select(
        "window",
        key,
        F.when(F.col("all.m") > 0, F.col("all.mean")).alias("avg_rating"),
        "n_ratings",
        F.when(F.col("all.m") > 1, deviation).alias("rating_variance"),
    )


def item_window_stats(
    df: DataFrame,
    size: str = DEFAULT_SIZE,
    slide: str | None = DEFAULT_SLIDE,
    key: str = "item_id",
    value_col: str = "rating",
    time_col: str = "event_time",
    panes: bool | None = None,
) -> DataFrame:
    """Per (window, key): average, count and sample standard deviation.

    ``rating_variance`` keeps the established column name although it holds
    the sample standard deviation (NULL for a single rating).  ``panes``: whether
    events are first combined in panes; by default on static frames.  Sizes that are
    no multiple of the slide have no panes.
    """
    if (not df.isStreaming if panes is None else panes) and _divides(size, slide):
        return _pane_stats(df, size, slide, key, value_col, time_col)
    return df.groupBy(window_column(time_col, size, slide).alias("window"), F.col(key)).agg(
        F.avg(value_col).alias("avg_rating"),
        F.count(F.lit(1)).alias("n_ratings"),
        F.stddev_samp(value_col).alias("rating_variance"),
    )


def trending(
    df: DataFrame,
    size: str = DEFAULT_SIZE,
    slide: str | None = DEFAULT_SLIDE,
    key: str = "item_id",
    value_col: str = "rating",
    time_col: str = "event_time",
    panes: bool | None = None,
) -> DataFrame:
    """Item window statistics plus ``trending_score = n_ratings * avg_rating``, unrounded:
    thresholds compare these, and stores keep them."""
    return item_window_stats(df, size, slide, key, value_col, time_col, panes).withColumn("trending_score", trending_score())


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """``df`` for publication: its average, deviation and score rounded, the last step of a query."""
    shown = ("avg_rating", "rating_variance", "trending_score")
    return df.select(*[F.round(c, digits).alias(c) if c in shown else F.col(c) for c in df.columns])


def user_window_counts(
    df: DataFrame,
    size: str = DEFAULT_SIZE,
    slide: str | None = DEFAULT_SLIDE,
    key: str = "user_id",
    time_col: str = "event_time",
    panes: bool | None = None,
) -> DataFrame:
    """Per (window, user): number of interactions."""
    if (not df.isStreaming if panes is None else panes) and _divides(size, slide):
        of_pane = df.groupBy(window_column(time_col, slide, None).alias("pane"), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
        window = F.window(_pane_time(df.isStreaming), size, slide).alias("window")
        return of_pane.groupBy(window, F.col(key)).agg(F.sum("n").alias("interactions"))
    return df.groupBy(window_column(time_col, size, slide).alias("window"), F.col(key)).agg(
        F.count(F.lit(1)).alias("interactions")
    )
