"""Windows merged from panes against windows that events are expanded into."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ratewave.operators.windows import (
    duration_seconds,
    item_window_stats,
    user_window_counts,
    window_column,
)


def _events(spark, seed, n):
    rnd = random.Random(seed)
    start = datetime(2024, 2, 28, 23, 58)
    rows = [
        (rnd.choice([1, 2, 3, None]), rnd.choice([None, 1e9 + rnd.random(), rnd.randint(1, 5) / 2]), start + timedelta(seconds=rnd.randint(0, 400)))
        for _ in range(n)
    ]
    return spark.createDataFrame([*rows, (1, 1.0, None)], "item_id long, rating double, event_time timestamp")


def _key(r):
    return r.window.start, r.item_id is not None, r.item_id or 0


@pytest.mark.parametrize(("size", "slide"), [("30 seconds", "10 seconds"), ("1 minute", "30 seconds"), ("45 seconds", "10 seconds"), ("30 seconds", None)])
def test_panes_give_the_windows_of_events(spark, size, slide):
    ev = _events(spark, 4, 600)
    got = sorted(item_window_stats(ev, size, slide).collect(), key=_key)
    want = sorted(item_window_stats(ev, size, slide, panes=False).collect(), key=_key)
    assert len(got) == len(want) and got[0].__fields__ == want[0].__fields__
    for a, b in zip(got, want):
        assert (a.window, a.item_id, a.n_ratings) == (b.window, b.item_id, b.n_ratings)
        assert (a.avg_rating is None) == (b.avg_rating is None)
        if b.avg_rating is not None:
            assert a.avg_rating == pytest.approx(b.avg_rating, rel=1e-12)
        assert (a.rating_variance is None) == (b.rating_variance is None)
        if b.rating_variance is not None:
            assert a.rating_variance == pytest.approx(b.rating_variance, rel=1e-6, abs=1e-9)
    counts = user_window_counts(ev.withColumn("user_id", F.col("item_id")), size, slide)
    plain = ev.groupBy(window_column("event_time", size, slide).alias("window"), "item_id").count()
    assert sorted(map(str, (tuple(r) for r in counts.collect()))) == sorted(map(str, (tuple(r) for r in plain.collect())))


def test_events_are_combined_before_they_are_expanded(spark):
    ev = _events(spark, 1, 50)
    plan = ev._sc._jvm.PythonSQLUtils.explainString
    lines = plan(item_window_stats(ev)._jdf.queryExecution(), "simple").splitlines()
    expand = next(i for i, x in enumerate(lines) if "Expand" in x)
    assert sum("Expand" in x for x in lines) == 1
    # from the root down: the expansion stands above the panes' aggregation
    assert any("avg(" in x and "Aggregate" in x for x in lines[expand + 1 :])
    assert not any("avg(" in x and "Aggregate" in x for x in lines[:expand])


def test_durations():
    assert [duration_seconds(x) for x in ("30 seconds", "1 minute", "6 hours", "2 days", "1 month", "1 hour 5 minutes", "x")] == [
        30, 60, 21_600, 172_800, None, None, None,
    ]
