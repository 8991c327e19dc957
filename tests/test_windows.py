"""Window statistics, trending score and alert thresholds."""

import datetime as dt

import pytest

from ratewave.operators import (
    flatten_window,
    item_window_stats,
    threshold_alerts,
    trending,
    user_window_counts,
)

T0 = dt.datetime(2026, 5, 12, 14, 30, 5)


def _events(spark, rows):
    return spark.createDataFrame(
        rows, "user_id int, item_id int, rating double, event_time timestamp"
    )


def test_single_rating_has_null_deviation(spark):
    df = flatten_window(item_window_stats(_events(spark, [(1, 1, 4.0, T0)])))
    rows = df.collect()
    assert len(rows) == 3  # 30 s / 10 s: three overlapping windows
    assert all(r.rating_variance is None and r.n_ratings == 1 for r in rows)


def test_boundary_event_windows_are_half_open(spark):
    t = dt.datetime(2026, 5, 12, 14, 30, 0)
    df = flatten_window(item_window_stats(_events(spark, [(1, 1, 4.0, t)])))
    starts = sorted(r.window_start.strftime("%H:%M:%S") for r in df.collect())
    assert starts == ["14:29:40", "14:29:50", "14:30:00"]


@pytest.mark.parametrize(
    "ratings,alerts",
    [
        ([4.5] * 6, 0),  # average exactly 4.5: strict, no alert
        ([4.8] * 5, 3),  # count exactly 5 above 4.5: alert in each of 3 windows
        ([4.8] * 4, 0),  # count 4: none
        ([4.8] * 6, 3),  # six at one instant: 3 windows, 3 alerts
    ],
)
def test_alert_thresholds(spark, ratings, alerts):
    df = _events(spark, [(i, 9, r, T0) for i, r in enumerate(ratings)])
    out = threshold_alerts(flatten_window(trending(df)))
    assert out.count() == alerts
    if alerts:
        assert out.select("type").distinct().first().type == "TRENDING"


def test_trending_score(spark):
    rows = [(i, 1, 4.8, T0) for i in range(10)] + [(i, 2, 3.0, T0) for i in range(3)]
    df = flatten_window(trending(_events(spark, rows), "1 minute", "1 minute"))
    got = {r.item_id: r.trending_score for r in df.collect()}
    assert got[1] == pytest.approx(48.0)
    assert got[2] == pytest.approx(9.0)


def test_user_counts_and_tumbling(spark):
    rows = [(1, 1, 3.0, T0), (1, 2, 3.0, T0 + dt.timedelta(seconds=20)), (2, 1, 3.0, T0)]
    df = flatten_window(user_window_counts(_events(spark, rows), "1 minute", None))
    got = {(r.user_id): r.interactions for r in df.collect()}
    assert got == {1: 2, 2: 1}


def test_window_stats_use_partial_aggregation(spark):
    df = item_window_stats(_events(spark, [(1, 1, 4.0, T0)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and "Expand" in plan


def test_float_average_precision(spark):
    df = spark.createDataFrame([(1, 1, 4.7, T0), (2, 1, 4.5, T0)], "user_id int, item_id int, rating float, event_time timestamp")
    r = item_window_stats(df, "1 minute", None).first()
    assert r.avg_rating == pytest.approx(4.599999904632568, abs=1e-15)


def test_serving_counters_and_first_recs(spark):
    from ratewave.operators import first_recs, recs_counters, result_counters

    t = spark.createDataFrame(
        [(1, 4.8, 6), (1, 4.0, 9), (2, 4.6, 5), (3, 4.9, 4)], "item_id int, avg_rating double, n_ratings long"
    )
    r = result_counters(t).first()
    assert (r.trending_windows, r.distinct_items, r.alert_windows) == (4, 3, 2)
    recs = spark.createDataFrame([(u, b) for b in (0, 1) for u in (5, 3, 9)], "user_id int, batch_id long")
    c = recs_counters(recs).first()
    assert (c.rec_rows, c.rec_batches) == (6, 2)
    assert [(x.batch_id, x.user_id) for x in first_recs(recs, 4).collect()] == [(0, 3), (0, 5), (0, 9), (1, 3)]


def test_sql_over_registered_views_equals_dataframe_form(spark):
    from conftest import SF001
    from ratewave.plans.batch import q_trending
    from ratewave.sources import register_views

    register_views(spark, SF001)
    sql = spark.sql("""
        SELECT CAST(window.start AS TIMESTAMP_NTZ) AS window_start,
               CAST(window.end AS TIMESTAMP_NTZ) AS window_end, item_id,
               round(avg(rating), 6) AS avg_rating, count(*) AS n_ratings,
               round(stddev_samp(rating), 6) AS rating_variance,
               round(count(*) * avg(rating), 6) AS trending_score
        FROM rating_events
        GROUP BY window(event_time, '6 hours', '2 hours'), item_id""")
    df = q_trending(spark, SF001)
    assert sql.count() == df.count()
    assert sql.exceptAll(df).count() == 0 and df.exceptAll(sql).count() == 0
