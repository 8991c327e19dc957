"""Physical-plan properties that matter at scale."""

import os
import re

import pytest

import __spark_entry__ as E
from conftest import SF001
from ratewave.functions.parse import encode_events, parse_events
from ratewave.operators import latest_alerts
from ratewave.plans.batch import BATCH_QUERIES, trending_frame
from ratewave.plans.model import (
    q_rmse_fixed,
    q_sample_n,
    q_sample_n_rows,
    q_split_invariants,
    q_split_train_rows,
    q_topk_dot,
)
from ratewave.sources.tables import rating_events


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize(
    "name,fn",
    sorted(BATCH_QUERIES.items())
    + [("rmse_fixed", q_rmse_fixed), ("sample_n", q_sample_n),
       ("split_invariants", q_split_invariants), ("topk_dot", q_topk_dot),
       ("sample_n_rows", q_sample_n_rows), ("split_train_rows", q_split_train_rows)],
)
def test_no_pairwise_joins(spark, name, fn):
    plan = _plan(fn(spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_event_json_parsed_once(spark):
    records = encode_events(rating_events(spark, SF001))
    plan = _plan(parse_events(records))
    # one decode of the value (the encoder side holds no from_json)
    assert plan.count("from_json(") == 1


def test_stored_results_filter_pushed_to_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "trending")
    trending_frame(spark, SF001).write.parquet(path)
    plan = _plan(latest_alerts(spark.read.parquet(path)))
    assert "GreaterThan(avg_rating,4.5)" in plan and "GreaterThanOrEqual(n_ratings,5)" in plan


def test_window_scan_is_pruned(spark):
    plan = _plan(E.queries()["trending"](spark, SF001))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,props:string>" in plan
    assert "partial_avg" in plan


def test_rmse_reads_ratings_once(spark):
    plan = _plan(q_rmse_fixed(spark, SF001))
    scans = re.findall(r"^\(\d+\) Scan parquet", plan, flags=re.M)
    assert len(scans) == 2  # lineitem and orders, once each


def test_recommendations_have_no_cartesian_product(spark):
    from ratewave.plans.model import q_als_recommend

    plan = _plan(q_als_recommend(spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
