"""Analytics marts (M5-M8): dimensions and the two fact tables.

Aggregate-before-join throughout: reviews are reduced to one row per app
name (partial aggregation map-side, so a hot app collapses before the
shuffle) and only then joined to the app grain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions import md5_key_sql, sentiment_score_sql
from storelens.operators import distinct_on, rounded_mean
from storelens.functions.sql import project
from storelens.sources.csv import POSITION

DIM_APPS_GROUP = (
    "app_name", "app_size_bytes", "app_price", "content_rating",
    "last_updated_date", "current_version", "android_version", "source_unique_key",
)


def dim_apps(stg_apps: DataFrame) -> DataFrame:
    """Distinct app versions with app_id = md5(app_name‖current_version).
    app_id is not unique: rows differing in other columns keep the same id."""
    return (distinct_on(stg_apps, DIM_APPS_GROUP)
            .transform(project, f"{md5_key_sql('app_name', 'current_version')} AS app_id",
                       *DIM_APPS_GROUP))


def dim_categories(stg_apps: DataFrame) -> DataFrame:
    """Distinct (category, genres) with category_id = md5(category‖genres)."""
    pairs = distinct_on(stg_apps.where("app_category IS NOT NULL"), ("app_category", "app_genres"))
    return pairs.transform(project, f"{md5_key_sql('app_category', 'app_genres')} AS category_id",
                           "app_category", "app_genres")


def review_counts(stg_reviews: DataFrame) -> DataFrame:
    """Reviews per app name and sentiment label: the one pass over the reviews
    from which their metrics and the dashboard's multiplicities derive."""
    return stg_reviews.groupBy("app_name", "review_sentiment").agg(F.expr("count(1)").alias("n_reviews"))


def review_metrics(counts: DataFrame) -> DataFrame:
    """Per app name, from ``review_counts``: mean sentiment score (unscored
    labels skipped; scores are halves, so their sums are exact) and the review
    count (all rows)."""
    score = sentiment_score_sql("review_sentiment")
    return counts.groupBy("app_name").agg(
        F.expr(f"try_divide(sum({score} * n_reviews), sum(CASE WHEN {score} IS NOT NULL THEN n_reviews END))")
        .alias("avg_sentiment"),
        F.expr("sum(n_reviews)").alias("total_reviews"))


FACT_COLUMNS = (
    "app_id", "app_name", "app_category", "app_genres", "app_price",
    "content_rating", "android_version", "current_version", "avg_sentiment",
    "total_reviews",
)


def fact_app_metrics(dim_apps_df: DataFrame, dim_categories_df: DataFrame,
                     stg_reviews: DataFrame | None, counts: DataFrame | None = None) -> DataFrame:
    """The warehouse fact as defined: apps LEFT JOIN categories ON
    app_name = app_genres, LEFT JOIN per-app review metrics ON app_name.
    Apps without reviews keep NULL metrics.  ``counts`` (``review_counts``)
    stands for the reviews where it is at hand."""
    apps = dim_apps_df.select("app_id", "app_name", "app_price", "content_rating",
                              "android_version", "current_version")
    cats = dim_categories_df.select("app_genres", "app_category")
    rev = review_metrics(review_counts(stg_reviews) if counts is None else counts)
    return (apps.join(cats, apps["app_name"] == cats["app_genres"], "left")
            .join(rev, "app_name", "left")
            .select(*FACT_COLUMNS))


KEYED_COLUMNS = (
    "app_id", "app_name", "category_id", "app_price", "average_user_rating",
    "total_installs", "avg_sentiment", "total_reviews",
)


def fact_app_metrics_keyed(stg_apps: DataFrame, stg_reviews: DataFrame | None,
                           digits: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """One row per (app_id, app_name, category_id) with the columns the
    consumers select: mean rating (rounded exactly to ``digits`` when given,
    see ``operators.rounded_mean``), largest installs and price, and the
    review metrics of the app name (from ``counts`` where given).  A source
    position in ``stg_apps`` is kept as the group's first."""
    place = [POSITION] if POSITION in stg_apps.columns else []
    mean = (F.expr("avg(app_rating)") if digits is None
            else rounded_mean("app_rating", "_one", digits))
    keyed = (stg_apps
             .transform(project, f"{md5_key_sql('app_name', 'current_version')} AS app_id",
                        "app_name",
                        f"{md5_key_sql('app_category', 'app_genres')} AS category_id",
                        "app_price", "app_rating", "installs_int", "1L AS _one", *place)
             .groupBy("app_id", "app_name", "category_id")
             .agg(F.expr("max(app_price)").alias("app_price"),
                  mean.alias("average_user_rating"),
                  F.expr("max(installs_int)").alias("total_installs"),
                  *[F.min(p).alias(p) for p in place]))
    rev = review_metrics(review_counts(stg_reviews) if counts is None else counts)
    return keyed.join(rev, "app_name", "left").select(*KEYED_COLUMNS, *place)
