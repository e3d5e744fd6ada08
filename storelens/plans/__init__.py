"""Dataset plans: ingest, staging, marts, reports, dashboard, pipeline."""

from storelens.plans.dashboard import (
    DashboardInputs,
    FrameView,
    app_view,
    category_list,
    dashboard_frame,
    dashboard_panels,
    for_category,
    frame_view,
    kpis,
    kpis_by_category,
    rating_vs_installs,
    rating_vs_installs_sample,
    sentiment_by_category,
    sentiment_distribution,
    top_rated_apps,
    top_rated_by_category,
    view,
    view_of_frame,
)
from storelens.plans.examples import example_filtered, example_union
from storelens.plans.ingest import clean_apps, clean_reviews
from storelens.plans.marts import (
    dim_apps,
    dim_categories,
    fact_app_metrics,
    fact_app_metrics_keyed,
    review_counts,
    review_metrics,
)
from storelens.plans.pipeline import run_pipeline
from storelens.plans.reports import (
    category_ratings,
    sentiment_histogram,
    top_apps_by_reviews,
    top_categories_by_reviews,
    top_rated,
)
from storelens.plans.staging import stg_apps, stg_reviews

__all__ = [
    "DashboardInputs", "FrameView", "app_view", "category_list", "category_ratings", "clean_apps",
    "clean_reviews", "dashboard_frame", "dashboard_panels", "dim_apps", "dim_categories",
    "example_filtered", "example_union", "fact_app_metrics",
    "fact_app_metrics_keyed", "for_category", "frame_view", "kpis", "kpis_by_category",
    "rating_vs_installs", "rating_vs_installs_sample", "review_counts", "review_metrics",
    "run_pipeline", "sentiment_by_category", "sentiment_distribution", "sentiment_histogram",
    "stg_apps", "stg_reviews", "top_apps_by_reviews",
    "top_categories_by_reviews", "top_rated", "top_rated_apps", "top_rated_by_category", "view",
    "view_of_frame",
]
