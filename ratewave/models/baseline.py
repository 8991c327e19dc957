"""Baseline predictors evaluated without materialising predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_baseline_rmse(ratings: DataFrame, key: str = "item_id", rating_col: str = "rating") -> DataFrame:
    """One row ``n_pairs, rmse`` for predicting each rating by its key's mean.

    The squared error of a group around its own mean is ``n * var_pop``, so
    the RMSE is ``sqrt(sum(n_k * var_pop_k) / sum(n_k))``: one scan and one
    partially aggregated shuffle, instead of joining every rating back to
    its group mean (a second scan, and a join skewed by hot keys).
    """
    per_key = ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.var_pop(F.col(rating_col).cast("double")).alias("v"),
    )
    return per_key.agg(
        F.sum("n").alias("n_pairs"),
        F.sqrt(F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("rmse"),
    )
