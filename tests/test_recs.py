"""ALS model invariants, Top-k, per-batch scoring and replay."""

import os

import pytest
from pyspark.sql import functions as F

from ratewave.models import (
    BASELINE,
    fit_als,
    load_model,
    recommend,
    recommend_exact,
    save_model,
    with_int_ids,
)
from ratewave.operators.cleaning import clean_ratings
from ratewave.sources.files import id_frame
from ratewave.sources.tables import ratings
from ratewave.streaming.scoring import make_batch_handler

from conftest import SF001


@pytest.fixture(scope="module")
def trained(spark):
    r = clean_ratings(ratings(spark, SF001)).cache()
    return r, fit_als(r, BASELINE)


def _known(r, n=2):
    return [row.user_id for row in r.select("user_id").distinct().orderBy("user_id").limit(n).collect()]


def test_topk_for_listed_users(spark, trained):
    r, model = trained
    u1, u2 = _known(r)
    recs = recommend(model, id_frame(spark, [u1, u2, u2, 10**8]), 5).collect()
    assert sorted(x.user_id for x in recs) == [u1, u2]
    catalogue = {x.item_id for x in r.select("item_id").distinct().collect()}
    for x in recs:
        scores = [e.rating for e in x.recommendations]
        assert len(scores) == 5 and scores == sorted(scores, reverse=True)
        assert all(e.item_id in catalogue for e in x.recommendations)


def test_factors_nonnegative(trained):
    _, model = trained
    lo = model.itemFactors.select(F.explode("features").alias("f")).agg(F.min("f")).first()[0]
    assert lo >= 0.0


def test_exact_topk_matches_model(spark, trained):
    r, model = trained
    users = id_frame(spark, _known(r, 20))
    mllib = recommend(model, users, 5, method="mllib").collect()
    a = {x.user_id: [e.rating for e in x.recommendations] for x in mllib}
    b = {x.user_id: [e.rating for e in x.recommendations] for x in recommend_exact(model, users, 5).collect()}
    assert a.keys() == b.keys()
    for u in a:
        assert a[u] == pytest.approx(b[u], rel=1e-4, abs=1e-5)


def test_save_load_same_output(spark, trained, tmp_dir):
    r, model = trained
    path = save_model(model, os.path.join(tmp_dir, "als"))
    users = id_frame(spark, _known(r, 5))
    a = recommend(model, users, 5).orderBy("user_id").collect()
    b = recommend(load_model(path), users, 5).orderBy("user_id").collect()
    assert a == b


def test_batch_handler_empty_replay(spark, trained, tmp_dir):
    r, model = trained
    handle = make_batch_handler(tmp_dir, model, k=5, now=F.lit("2026-01-01").cast("timestamp"))
    empty = spark.createDataFrame([], "user_id int, item_id int, rating double, event_time timestamp")
    handle(empty, 0)
    assert not os.path.exists(os.path.join(tmp_dir, "recs"))
    batch = r.limit(50).select("user_id", "item_id", F.col("rating").cast("double"),
                               F.lit("2025-12-31 23:59:00").cast("timestamp").alias("event_time"))
    handle(batch, 1)
    handle(batch, 1)  # replay of the same batch id
    recs = spark.read.parquet(os.path.join(tmp_dir, "recs"))
    n_users = batch.select("user_id").distinct().count()
    assert recs.count() == n_users
    m = spark.read.parquet(os.path.join(tmp_dir, "metrics")).first()
    assert m.n_events == 50 and m.avg_lag_s == pytest.approx(60.0)


def test_wide_ids_get_dense_int_map(spark):
    df = spark.createDataFrame([(3_000_000_000, 5, 4.0), (3_000_000_001, 5, 3.0), (7, 6, 1.0)],
                               "user_id long, item_id long, rating double")
    out, maps = with_int_ids(df)
    assert set(maps) == {"user_id"}
    assert out.schema["user_id"].dataType.simpleString() == "int"
    assert sorted(x.user_id for x in out.collect()) == [0, 1, 2]


def test_rmse_frame_equals_evaluator(spark, trained):
    from pyspark.ml.evaluation import RegressionEvaluator

    from ratewave.models import predict, rmse_frame

    r, model = trained
    pred = predict(model, r)
    ours = rmse_frame(pred).first().rmse
    ref = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction").evaluate(pred)
    assert ours == pytest.approx(ref, rel=1e-9)


def test_mean_baseline_rmse_equals_join_form(spark, trained):
    from ratewave.models import mean_baseline_rmse, rmse_frame

    r, _ = trained
    means = r.groupBy("item_id").agg(F.avg("rating").alias("prediction"))
    direct = rmse_frame(r.join(means, "item_id")).first()
    fast = mean_baseline_rmse(r, "item_id").first()
    assert fast.n_pairs == direct.n_pairs
    assert fast.rmse == pytest.approx(direct.rmse, rel=1e-9)


def test_wide_ids_roundtrip_through_als(spark):
    base = 5_000_000_000
    rows = [(base + u, base * 2 + i, float((u * i) % 5 + 1)) for u in range(30) for i in range(12)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating float")
    dense, maps = with_int_ids(df)
    assert set(maps) == {"user_id", "item_id"}
    model = fit_als(dense, BASELINE)
    recs = recommend(model, df.select("user_id"), 3, id_maps=maps).collect()
    assert len(recs) == 30
    assert all(base <= r.user_id < base + 30 for r in recs)
    for r in recs:
        items = [e.item_id for e in r.recommendations]
        scores = [e.rating for e in r.recommendations]
        assert len(items) == 3 and all(base * 2 <= i < base * 2 + 12 for i in items)
        assert scores == sorted(scores, reverse=True)


def test_dense_id_map_contiguous_in_value_order(spark):
    from pyspark.sql import functions as F

    from ratewave.models import dense_id_map

    base = 7_000_000_000
    df = spark.range(0, 20000).select(((F.col("id") * 7919) % 20000 + base).alias("user_id")).repartition(13)
    m = dense_id_map(df.union(df), "user_id", "d").collect()  # duplicates collapse
    pairs = sorted((r.user_id, r.d) for r in m)
    assert [d for _, d in pairs] == list(range(20000))
    assert [u for u, _ in pairs] == [base + i for i in range(20000)]


def test_predictions_map_back_to_source_ids(spark):
    from ratewave.models import predict, to_source_pairs

    base = 6_000_000_000
    rows = [(base + u, i, float((u + i) % 5 + 1)) for u in range(25) for i in range(8)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating float")
    dense, maps = with_int_ids(df)
    model = fit_als(dense, BASELINE)
    pred = to_source_pairs(predict(model, dense), maps).collect()
    assert len(pred) == 200
    assert {r.user_id for r in pred} == {base + u for u in range(25)}


def test_fit_lets_go_of_old_shuffles(spark):
    """Checkpoints every other iteration; a factor goes to eight blocks at most."""
    from ratewave.models import als

    built = als.build_als(als.BASELINE, num_blocks=als.DEFAULT_BLOCKS)
    assert built.getCheckpointInterval() <= 2
    assert built.getNumUserBlocks() <= 8 and built.getNumItemBlocks() <= 8
    assert (built.getRank(), built.getMaxIter(), built.getRegParam()) == (10, 10, 0.1)
