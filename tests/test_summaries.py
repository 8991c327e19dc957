"""Summaries beside the stored windows against scans of all of them."""

import re
from datetime import date, datetime

import pytest

from conftest import SF001
from ratewave.operators.serving import latest_alerts, recs_counters, result_counters, top_trending
from ratewave.operators.windows import rounded
from ratewave.plans.stream import RANGES, WIDE_SPEC, _in_ranges
from ratewave.schemas import TRENDING_SCHEMA
from ratewave.streaming import summaries as S
from ratewave.streaming.app import _fanout, start_final_windows
from ratewave.streaming.sinks import AVAILABLE_NOW


LIMITS = (4.0, 2)  # alerts of the small table


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def stored(spark):
    return _in_ranges(spark, SF001, "summaries", lambda ev, out: start_final_windows(ev, out, WIDE_SPEC, AVAILABLE_NOW, *LIMITS))


def _same(spark, out):
    windows = S.stored_windows(spark, out).drop("batch_id")
    assert S.stored_counters(spark, out).collect() == result_counters(windows, *LIMITS).collect()
    best = [top_trending(rounded(x, 6)).collect() for x in (S.stored_best(spark, out), windows)]
    assert best[0] == best[1] and len(best[0]) == 10
    for n in (1, 20, 100_000):
        assert S.latest_stored_alerts(spark, out, n, *LIMITS).collect() == latest_alerts(windows, n, *LIMITS).collect()
    return result_counters(windows, *LIMITS).first()


def test_merged_batches_give_the_answers_of_a_scan(spark, stored):
    n = _same(spark, stored)
    assert n.trending_windows > 500 and n.distinct_items == 20 and n.alert_windows > 0
    assert S.stored_windows(spark, stored).select("batch_id").distinct().count() >= RANGES - 1


def test_a_replayed_batch_changes_nothing(spark, stored):
    before = S.stored_counters(spark, stored).collect()
    ids = [r.batch_id for r in S.stored_windows(spark, stored).select("batch_id").distinct().collect()]
    again = S.stored_windows(spark, stored).where(f"batch_id = {max(ids)}").drop("batch_id")
    again = spark.createDataFrame(again.collect(), again.schema)
    _fanout(stored, "trending", "alerts", *LIMITS, closed=True)(again, max(ids))
    _same(spark, stored)
    assert S.stored_counters(spark, stored).collect() == before


def test_summaries_alone_are_read(spark, stored):
    for df in (S.stored_counters(spark, stored), S.stored_best(spark, stored)):
        assert "/trending" not in re.sub(r"\s", "", _plan(df)) and "window_" in _plan(df)


def test_alerts_are_read_backward_by_date(spark, stored):
    dates = S.stored_dates(S.stored_windows(spark, stored, with_date=True))
    assert dates == sorted(dates, reverse=True) and len(dates) > 10
    plan = _plan(S.latest_stored_alerts(spark, stored, 1, *LIMITS))
    filters = re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)
    assert "window_date#" in filters and ">=" in filters
    assert "GreaterThan(avg_rating,4.0)" in plan


def test_a_store_without_windows(spark, tmp_dir):
    assert S.stored_counters(spark, tmp_dir).first().asDict() == {"trending_windows": 0, "distinct_items": 0, "alert_windows": 0}
    assert S.stored_best(spark, tmp_dir).collect() == [] and S.latest_stored_alerts(spark, tmp_dir).collect() == []
    assert tuple(S.stored_recs_counters(spark, tmp_dir).first()) == (0, 0)


def test_wide_and_missing_item_ids(spark, tmp_dir):
    ids = [0, -1, -32768, -32769, 32767, 32768, 2**62, -(2**62), None, 0]
    at = datetime(2024, 1, 1)
    batches = [ids[:6], ids[4:], []]
    for b, own in enumerate(batches):
        rows = [(at, at, i, 4.6 + b, 5, None, float(n)) for n, i in enumerate(own)]
        _fanout(tmp_dir, "trending", "alerts", 4.5, 5, closed=True)(spark.createDataFrame(rows, TRENDING_SCHEMA), b)
    windows = S.stored_windows(spark, tmp_dir)
    assert S.stored_counters(spark, tmp_dir).collect() == result_counters(windows).collect()
    assert S.stored_windows(spark, tmp_dir, with_date=True).select("window_date").distinct().collect()[0][0] == date(2024, 1, 1)
    assert {r.item_id for r in S.stored_best(spark, tmp_dir).collect()} == set(ids)


def test_counts_of_recommendations(spark, tmp_dir):
    for b, n in ((0, 7), (3, 2), (3, 4), (5, 0)):
        S.write_recs_counts(spark.range(n), tmp_dir, b)
    recs = spark.createDataFrame([(0,)] * 7 + [(3,)] * 4, "batch_id long")
    assert S.stored_recs_counters(spark, tmp_dir).collect() == recs_counters(recs).collect()
