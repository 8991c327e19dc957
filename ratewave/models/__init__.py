from ratewave.models.als import (
    BASELINE,
    REPORT_SCHEMA,
    RETUNE,
    RMSE_GATE,
    AlsParams,
    build_als,
    dense_id_map,
    evaluate_rmse,
    fit_als,
    gated_retune,
    load_id_maps,
    load_model,
    predict,
    prepare_item_factors,
    recommend,
    rmse_frame,
    save_model,
    source_item_factors,
    to_source_pairs,
    to_source_users,
    with_int_ids,
)
from ratewave.models.baseline import mean_baseline_rmse
from ratewave.models.exact import recommend_exact
from ratewave.models.versions import LatestModel, current_model, model_versions, publish_model

__all__ = [
    "BASELINE",
    "REPORT_SCHEMA",
    "RETUNE",
    "RMSE_GATE",
    "AlsParams",
    "build_als",
    "dense_id_map",
    "evaluate_rmse",
    "fit_als",
    "gated_retune",
    "load_id_maps",
    "load_model",
    "mean_baseline_rmse",
    "predict",
    "prepare_item_factors",
    "recommend",
    "recommend_exact",
    "LatestModel",
    "current_model",
    "model_versions",
    "publish_model",
    "rmse_frame",
    "save_model",
    "source_item_factors",
    "to_source_pairs",
    "to_source_users",
    "with_int_ids",
]
