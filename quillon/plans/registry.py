"""Query registry: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillon.plans import intake as I
from quillon.plans import recommender as R
from quillon.plans import rule_lists as L
from quillon.plans import survey as V
from quillon.plans import weather as W

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "interactions_scan": R.q_interactions_scan,
        "alias_lines": R.q_alias_lines,
        "interactions_line_counts": R.q_interactions_line_counts,
        "name_lines": R.q_name_lines,
        "alias_resolved_plays": R.q_alias_resolved_plays,
        "active_users": R.q_active_users,
        "active_ratings": R.q_active_ratings,
        "user_split_counts": R.q_user_split_counts,
        "user_split_rows": R.q_user_split_rows,
        "fold_counts": R.q_fold_counts,
        "events_split_counts": R.q_events_split_counts,
        "popularity_top50": R.q_popularity_top50,
        "popularity_user_auc": R.q_popularity_user_auc,
        "popularity_mean_auc": R.q_popularity_mean_auc,
        "popularity_at_50": R.q_popularity_at_50,
        "name_search": R.q_name_search,
        "rule_top10": L.q_rule_top10,
        "rule_unseen_top10": L.q_rule_unseen_top10,
        "rule_labels": L.q_rule_labels,
        "rule_user_auc": L.q_rule_user_auc,
        "rule_pooled_auc": L.q_rule_pooled_auc,
        "rule_confusion": L.q_rule_confusion,
        "rule_named": L.q_rule_named,
        "lookup_line_counts": L.q_lookup_line_counts,
        "weather_files": I.q_weather_files,
        "csv_quarantine": I.q_csv_quarantine,
        "filed_metrics": I.q_filed_metrics,
        "weather_counts": W.q_weather_counts,
        "weather_parse": W.q_weather_parse,
        "weather_year_bounds": W.q_weather_year_bounds,
        "weather_split_counts": W.q_weather_split_counts,
        "weather_medians": W.q_weather_medians,
        "weather_imputed": W.q_weather_imputed,
        "weather_correlation": W.q_weather_correlation,
        "best_correlation": W.q_best_correlation,
        "weather_ols_mse": W.q_weather_ols_mse,
        "weather_ridge_coef": W.q_weather_ridge_coef,
        "best_one_feature": W.q_best_one_feature,
        "weather_lr_full": W.q_weather_lr_full,
        "weather_rf": W.q_weather_rf,
        "best_regressor": W.q_best_regressor,
        "weather_job": W.q_weather_job,
        "survey_filtered": V.q_survey_filtered,
        "hash_split_counts": V.q_hash_split_counts,
        "band_counts": V.q_band_counts,
        "sorted_labels": V.q_sorted_labels,
        "fold_balance": V.q_fold_balance,
        "holdout_balance": V.q_holdout_balance,
        "string_index_levels": V.q_string_index_levels,
        "feature_matrix": V.q_feature_matrix,
        "binary_report": V.q_binary_report,
        "multiclass_report": V.q_multiclass_report,
        "auc_exact": V.q_auc_exact,
        "dt_tvs": V.q_dt_tvs,
        "dt_cv": V.q_dt_cv,
        "dt_tvs_reference_grid": V.q_dt_tvs_reference_grid,
        "gbt_ovr": V.q_gbt_ovr,
        "rf_cv": V.q_rf_cv,
        "model_comparison": V.q_model_comparison,
        "model_roundtrip": V.q_model_roundtrip,
        "doc_quality_tree": V.q_doc_quality_tree,
        "stump_rows": V.q_stump_rows,
        "tree_routing": V.q_tree_routing,
        "forest_routing": V.q_forest_routing,
        "boosted_routing": V.q_boosted_routing,
        "weather_rf_routing": W.q_weather_rf_routing,
        "weather_lr_conditions": W.q_weather_lr_conditions,
        "als_profile_check": R.q_als_profile_check,
        "als_residual": R.q_als_residual,
        "als_list_check": R.q_als_list_check,
        "als_top50": R.q_als_top50,
        "als_user_auc": R.q_als_user_auc,
        "als_metrics": R.q_als_metrics,
        "als_grid": R.q_als_grid,
        "recommender_job": R.q_recommender_job,
        "als_profile_top25": R.q_als_profile_top25,
    }
    return q
