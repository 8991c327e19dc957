"""Registered model, sampling and top-k queries.

Fitted factors are floating point and differ between engines, so the model
queries report what another engine can state: which pairs and users have an
answer, and flags that the answer is what the stored factors give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewave.models.als import (
    BASELINE,
    RETUNE,
    RMSE_GATE,
    evaluate_rmse,
    fit_als,
    gated_retune,
    load_id_maps,
    load_model,
    predict,
    recommend,
    rmse_frame,
    to_source_pairs,
    with_int_ids,
)
from ratewave.models.baseline import mean_baseline_rmse
from ratewave.models.versions import publish_model
from ratewave.operators.cleaning import clean_ratings
from ratewave.operators.sampling import (
    hash_split,
    modular_unit_hash,
    numbered_copies,
    sample_n,
    split_part,
    unit_hash,
)
from ratewave.operators.serving import first_recs
from ratewave.operators.topk import topk_dot
from ratewave.schemas import RECS_OUT
from ratewave.session import materialize, shared_dir
from ratewave.sources.files import id_frame, read_ratings_text, read_result_dir
from ratewave.sources.tables import events_stream, events_to_ratings, ratings, read_table
from ratewave.streaming.app import start_recommendations
from ratewave.streaming.sinks import AVAILABLE_NOW, run_to_end
from ratewave.streaming.summaries import stored_recs_counters

DIGITS = 6
# train/test split and its seed, Top-k length, the listed users of the spot check.
SPLIT = (0.8, 0.2)
SPLIT_SEED = 42
TOP_K = 5
LISTED_USERS = (1, 42, 100, 200, 500)
SAMPLE_N, SAMPLE_SEED = 500, 1
RATING_KEYS = ["user_id", "item_id", "rating", "timestamp"]
PORTABLE_KEYS = ["user_id", "item_id", "timestamp"]
#: Predictions and scores are stored as floats.
FLOAT_ERROR = 1e-4


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ratings(ratings(spark, sf_dir), rating_range=(0.5, 5.0))


def clean_table_with_maps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    """Clean ratings written once to the shared folder, for model jobs.

    Ids keep the source width until the compact table exists; the int32
    check then scans only that table, and ids beyond int32 are remapped to
    dense ints (maps returned for translating recommendations back).  Rows
    are named by content and number among equal ones (``numbered_copies``),
    so a split is the same on any cluster and in any layout.
    """
    return with_int_ids(materialize(numbered_copies(clean(spark, sf_dir)), "ratings"), ["user_id", "item_id"])


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_table_with_maps(spark, sf_dir)[0]


def portable_unit(seed: int) -> Column:
    """The hash that the SQL oracles compute too."""
    return modular_unit_hash(PORTABLE_KEYS, seed)


def portable_split(spark: SparkSession, sf_dir: str, rating: Column | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """(train, test, id maps): split on source ids, which another engine can do too.  ``rating``:
    in place of the table's."""
    source = clean(spark, sf_dir)
    source = source if rating is None else source.withColumn("rating", rating)
    source = source.withColumn("_part", split_part(SPLIT, portable_unit(SPLIT_SEED)))
    table, maps = with_int_ids(materialize(source, "ratings"), ["user_id", "item_id"])
    return *(table.where(F.col("_part") == i).drop("_part") for i in (0, 1)), maps


def q_sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = materialize(clean(spark, sf_dir), "ratings")
    s = materialize(sample_n(src, SAMPLE_N, SAMPLE_SEED, RATING_KEYS), "sample")
    missing = s.join(src, RATING_KEYS, "left_anti").agg(F.count(F.lit(1)).alias("n_missing"))
    sizes = s.agg(F.count(F.lit(1)).alias("n_rows"))
    total = src.agg(F.count(F.lit(1)).alias("n_source"))
    return sizes.select("n_rows", total.scalar().alias("n_source"), missing.scalar().alias("n_missing"))


def q_sample_n_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact-N sample itself, drawn with the portable modular hash so an
    independent engine can re-derive the same rows."""
    src = materialize(clean(spark, sf_dir), "ratings")
    return sample_n(src, SAMPLE_N, SAMPLE_SEED, RATING_KEYS, unit=portable_unit(SAMPLE_SEED))


def q_split_train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 80% training part of the seeded split (portable modular hash)."""
    return hash_split(clean(spark, sf_dir), SPLIT, SPLIT_SEED, unit=portable_unit(SPLIT_SEED))[0]


def q_als_predict_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cold-start handling of predictions, checkable elsewhere: with the
    portable split, a test rating gets a prediction exactly when its user
    and its item both occur in the training part."""
    train, test, _ = portable_split(spark, sf_dir)
    model = fit_als(train, BASELINE)
    n_test = test.agg(F.count(F.lit(1))).scalar()
    return predict(model, test).agg(F.count(F.lit(1)).alias("n_predicted")).select(
        n_test.alias("n_test"), "n_predicted"
    )


def q_split_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the parts of the default split, from one pass over the ratings."""
    parts = clean(spark, sf_dir).select(split_part(SPLIT, unit_hash(RATING_KEYS, SPLIT_SEED)).alias("part"))
    sizes = parts.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("part") == 0).alias("n_train"),
        F.count_if(F.col("part") == 1).alias("n_test"),
    )
    share = F.abs(F.col("n_train") / F.col("n_total") - F.lit(SPLIT[0]))
    return sizes.select(
        "n_total",
        (F.col("n_train") + F.col("n_test")).alias("n_parts_sum"),
        (share < F.lit(0.02)).cast("int").alias("train_frac_ok"),
    )


# Fixed values of the text round trip: rows that must go, by rules another engine knows.
TEXT_RANGE = (1.0, 4.5)
NULL_EVERY, NAN_EVERY = 7, 11


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings as text columns, some without a rating and some with one that is no number."""
    r = ratings(spark, sf_dir)
    text = (
        F.when(F.col("item_id") % NULL_EVERY == 0, F.lit(None))
        .when(F.col("item_id") % NAN_EVERY == 0, F.lit("NaN"))
        .otherwise(F.col("rating").cast("string"))
    )
    return r.select(
        F.col("timestamp").cast("string").alias("timestamp"),
        text.alias("rating"),
        F.col("item_id").cast("string").alias("movieId"),
        F.col("user_id").cast("string").alias("userId"),
    )


def q_clean_ratings_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings written as CSV, columns in another order, read back by name and cleaned."""
    path = shared_dir(spark, "text", "csv", unique=True)
    _spoiled(spark, sf_dir).write.mode("overwrite").option("header", "true").csv(path)
    return clean_ratings(read_ratings_text(spark, path), rating_range=TEXT_RANGE)


def q_clean_ratings_colons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``user::item::rating::timestamp`` lines without a header."""
    path = shared_dir(spark, "text", "colons", unique=True)
    line = F.concat_ws("::", "userId", "movieId", F.coalesce("rating", F.lit("")), "timestamp")
    _spoiled(spark, sf_dir).select(line.alias("value")).write.mode("overwrite").text(path)
    return clean_ratings(read_ratings_text(spark, path, sep="::", header=False), rating_range=TEXT_RANGE)


def q_rmse_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RMSE of the item-mean baseline predictor over all ratings."""
    out = mean_baseline_rmse(clean(spark, sf_dir), "item_id")
    return out.select("n_pairs", F.round("rmse", DIGITS).alias("rmse"))


def near(a: Column, b: Column) -> Column:
    return (F.abs(a - b) <= FLOAT_ERROR * F.greatest(F.lit(1.0), F.abs(b))).cast("int")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def q_als_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test pairs that get a prediction, and whether it is the product of the stored factors."""
    train, test, maps = portable_split(spark, sf_dir)
    model = fit_als(train, BASELINE)
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("item_id"), F.col("features").alias("i"))
    pred = predict(model, test).join(users, "user_id").join(items, "item_id")
    pred = pred.select(
        "user_id", "item_id", "timestamp", near(F.col("prediction"), dot(F.col("u"), F.col("i"))).alias("is_product")
    )
    return to_source_pairs(pred, maps)


# Fixed values of the planted ratings: 3 plus or minus 1 plus or minus 0.5, by two signs of user
# and item, so of rank 3; the RMSE that a fit must stay below (the mean alone has 1.1), and the
# share of recommended items that must be of the best kind (chance: a quarter).
PLANTED_RMSE, PLANTED_SHARE = 0.5, 0.75


def planted_rating(user: Column, item: Column) -> Column:
    sign = lambda c, k: F.when(F.floor(c / F.lit(k)) % 2 == 0, 1.0).otherwise(-1.0)
    return F.lit(3.0) + sign(user, 1) * sign(item, 1) + F.lit(0.5) * sign(user, 2) * sign(item, 2)


def q_als_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit of ratings of known low rank on the real user and item pairs: how many test pairs are
    predicted, whether their RMSE is low, and whether the recommended items are those that the
    users like best.  A fit that has learned nothing fails both."""
    train, test, maps = portable_split(spark, sf_dir, planted_rating(F.col("user_id"), F.col("item_id")))
    model = fit_als(train, BASELINE)
    pred = rmse_frame(predict(model, test)).select("n_pairs", (F.col("rmse") < PLANTED_RMSE).cast("int").alias("rmse_is_low"))
    of_users = {c: m for c, m in maps.items() if c == "user_id"}
    recs = recommend(model, to_source_pairs(train.select("user_id").distinct(), of_users), TOP_K, id_maps=maps)
    liked = recs.select("user_id", F.explode("recommendations.item_id").alias("item_id"))
    best = F.avg((planted_rating(F.col("user_id"), F.col("item_id")) == 4.5).cast("int"))
    share = liked.agg((best >= PLANTED_SHARE).cast("int"))
    return pred.select("n_pairs", "rmse_is_low", share.scalar().alias("best_items_found"))


def _model_on_all(spark: SparkSession, sf_dir: str):
    r, maps = clean_table_with_maps(spark, sf_dir)
    return r, fit_als(r, BASELINE), maps


def _sorted_desc(recs: str) -> Column:
    return F.expr(
        f"coalesce(forall(sequence(1, size({recs}) - 1), i -> {recs}[i].rating <= {recs}[i - 1].rating), true)"
    )


def q_als_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: the list's length, whether it is in order, and how many of its scores are
    the product of the stored factors."""
    r, model, maps = _model_on_all(spark, sf_dir)
    recs = recommend(model, to_source_pairs(r.select("user_id").distinct(), {c: m for c, m in maps.items() if c == "user_id"}), TOP_K, id_maps=maps)
    users = to_source_pairs(
        model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("u")), {c: m for c, m in maps.items() if c == "user_id"}
    )
    items = to_source_pairs(
        model.itemFactors.select(F.col("id").alias("item_id"), F.col("features").alias("i")), {c: m for c, m in maps.items() if c == "item_id"}
    )
    flat = recs.select(
        "user_id",
        F.size("recommendations").alias("n_items"),
        F.when(F.size("recommendations") > 1, _sorted_desc("recommendations")).otherwise(True).cast("int").alias("in_order"),
        F.explode("recommendations").alias("r"),
    ).select("user_id", "n_items", "in_order", "r.item_id", "r.rating")
    # AQE splits the popular items' side of this join
    scored = flat.join(users, "user_id").join(items, "item_id")
    return scored.groupBy("user_id", "n_items", "in_order").agg(
        F.sum(near(F.col("rating"), dot(F.col("u"), F.col("i")))).alias("n_products")
    )


def q_listed_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spot check: the listed users that the model knows, with the lengths of their lists."""
    _, model, maps = _model_on_all(spark, sf_dir)
    recs = recommend(model, id_frame(spark, LISTED_USERS), TOP_K, id_maps=maps)
    return recs.select("user_id", F.size("recommendations").alias("n_items"))


def recs_invariants(recs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row of checks over ``user_id, recommendations`` rows."""
    unsorted = F.expr(
        "size(recommendations) > 1 AND exists(sequence(1, size(recommendations) - 1), "
        "i -> recommendations[i].rating > recommendations[i - 1].rating)"
    )
    per_user = recs.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.countDistinct("user_id").alias("n_distinct_users"),
        F.min(F.size("recommendations")).alias("min_len"),
        F.max(F.size("recommendations")).alias("max_len"),
        F.count(F.when(unsorted, 1)).alias("n_unsorted"),
    )
    items = recs.select(F.explode("recommendations").alias("r")).select("r.item_id", "r.rating")
    unknown = items.join(catalogue, "item_id", "left_anti").agg(F.count(F.lit(1)))
    negative = items.agg(F.count(F.when(F.col("rating") < 0, 1)))
    return per_user.select(
        "*", unknown.scalar().alias("n_unknown_items"), negative.scalar().alias("n_negative")
    )


def q_als_recommend_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, model, _ = _model_on_all(spark, sf_dir)
    recs = recommend(model, r.select("user_id"), TOP_K)
    return recs_invariants(recs, r.select("item_id").distinct())


def q_als_gated_retune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline fit; RMSE above the gate triggers the retune; the chosen model is saved to
    the shared folder with its id maps and loaded back.

    Per fit: its parameters and whether it was chosen; and of the chosen one, whether the
    loaded model predicts the same, and the evaluator and the plain aggregate agree."""
    train, test, maps = portable_split(spark, sf_dir)
    model, report = gated_retune(train, test, BASELINE, [RETUNE], RMSE_GATE)
    path = publish_model(model, shared_dir(spark, "models", "als", unique=True), maps)
    again, again_maps = load_model(path), load_id_maps(spark, path)
    keys = ["user_id", "item_id", "timestamp", "rating"]
    before, after = (
        predict(m, test).groupBy(*keys).agg(F.sum("prediction").alias(name)) for m, name in ((model, "p"), (again, "q"))
    )
    both = before.join(after, keys, "full").agg(
        F.count_if(~F.col("p").eqNullSafe(F.col("q"))).alias("differ"), F.count(F.lit(1)).alias("n")
    ).first()
    plain = rmse_frame(predict(model, test)).first()
    same = int(both.differ == 0 and both.n > 0 and again_maps.keys() == maps.keys())
    agree = int(abs(plain.rmse - evaluate_rmse(again, test)) < 1e-9)
    rows = [
        (r["stage"], int(r["rank"]), float(r["reg_param"]), int(r["max_iter"]), int(r["chosen"]),
         int(r["rmse"] > RMSE_GATE), same, agree)
        for r in report
    ]
    return spark.createDataFrame(
        rows,
        "stage string, rank int, reg_param double, max_iter int, chosen int, above_gate int, "
        "same_after_reload int, rmse_agrees int",
    )


def q_topk_dot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest neighbours (largest dot product, self excluded) of
    every embedding."""
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    top = topk_dot(
        emb, emb, TOP_K,
        query_id="vec_id", query_vec="embedding", item_id="vec_id", item_vec="embedding",
        exclude_self=True,
    )
    return top.select("query_id", "item_id", "rank", F.round("score", DIGITS).alias("score"))


def _streamed_recs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, object, dict, str]:
    """(recommendations written per micro-batch of the streamed events, model, id maps, the folder)."""
    _, model, maps = _model_on_all(spark, sf_dir)
    events = events_to_ratings(events_stream(spark, sf_dir))
    out = shared_dir(spark, "runs", "recs", unique=True)
    run_to_end(start_recommendations(events, out, model, TOP_K, AVAILABLE_NOW, id_maps=maps))
    return read_result_dir(spark, f"{out}/recs", RECS_OUT), model, maps, out


def q_stream_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the events; per batch, Top-5 for the batch's known users: each user's list, and
    whether its items and scores are those of the batch answer for that user."""
    recs, model, maps, _ = _streamed_recs(spark, sf_dir)
    users = read_table(spark, sf_dir, "events").select("user_id").distinct()
    want = recommend(model, users, TOP_K, id_maps=maps).withColumnRenamed("recommendations", "want")
    pair = lambda c: F.transform(c, lambda r: F.struct(r["item_id"], F.round(r["rating"], 4)))
    same = pair(F.col("recommendations")).eqNullSafe(pair(F.col("want")))
    return recs.join(want, "user_id", "left").select(
        "batch_id", "user_id", F.size("recommendations").alias("n_items"), same.cast("int").alias("same_as_batch")
    )


def q_served_recs_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter tiles over the stored recommendations, from each batch's count."""
    return stored_recs_counters(spark, _streamed_recs(spark, sf_dir)[3])


def q_served_first_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 stored recommendations (by batch, then user)."""
    first = first_recs(_streamed_recs(spark, sf_dir)[0], 20)
    return first.select("batch_id", "user_id", F.size("recommendations").alias("n_items"))


MODEL_QUERIES = {
    "clean_ratings_csv": q_clean_ratings_csv,
    "clean_ratings_colons": q_clean_ratings_colons,
    "listed_recommend": q_listed_recommend,
    "served_recs_counters": q_served_recs_counters,
    "served_first_recs": q_served_first_recs,
    "sample_n": q_sample_n,
    "sample_n_rows": q_sample_n_rows,
    "split_invariants": q_split_invariants,
    "split_train_rows": q_split_train_rows,
    "rmse_fixed": q_rmse_fixed,
    "als_predict": q_als_predict,
    "als_predict_coverage": q_als_predict_coverage,
    "als_planted": q_als_planted,
    "als_recommend": q_als_recommend,
    "als_recommend_invariants": q_als_recommend_invariants,
    "als_gated_retune": q_als_gated_retune,
    "topk_dot": q_topk_dot,
    "stream_recommend": q_stream_recommend,
}
