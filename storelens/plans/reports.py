"""Reports read straight off the fact tables (M9, M15-M17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.operators import equal_width_histogram, exact_mean, top_k
from storelens.functions.sql import project


def top_rated(fact_keyed: DataFrame, dim_apps_df: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` (app_name, average_user_rating) of fact ⋈ dim_apps ON app_id.

    dim_apps may hold several rows per app_id; the join then repeats the fact
    row once per dim row.  Those repeats are identical in the output columns,
    so dim_apps is first reduced to (app_id, app_name, count) and each joined
    row is repeated only min(count, n) times — the top n cannot hold more —
    instead of emitting every pair of a hot app_id.
    """
    names = dim_apps_df.groupBy("app_id", "app_name").agg(F.expr("count(1)").alias("_n"))
    rows = (fact_keyed.select("app_id", "average_user_rating")
            .join(names, "app_id")
            .transform(project, "app_id", "app_name", "average_user_rating",
                       f"explode(sequence(1L, least(_n, {int(n)}L))) AS _copy"))
    best = top_k(rows, n, [F.col("average_user_rating").desc_nulls_last()],
                 ties=["app_name", "app_id"])
    return best.select("app_name", "average_user_rating")


def sentiment_histogram(fact: DataFrame, bins: int = 20) -> DataFrame:
    """Distribution of per-app average sentiment in ``bins`` equal bins on
    [0, 1]; apps without a score are left out."""
    return equal_width_histogram(fact, "avg_sentiment", bins=bins, lo=0.0, hi=1.0)


def top_apps_by_reviews(fact: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` fact rows with most reviews (apps without reviews last)."""
    return top_k(fact.select("app_id", "app_name", "total_reviews"), n,
                 [F.col("total_reviews").desc_nulls_last()], ties=["app_name", "app_id"])


def top_categories_by_reviews(fact: DataFrame, n: int = 10) -> DataFrame:
    """Reviews summed per category (rows without a category dropped, an
    all-NULL sum counts 0), top ``n``."""
    per_cat = (fact.where("app_category IS NOT NULL")
               .groupBy("app_category")
               .agg(F.expr("CAST(coalesce(sum(total_reviews), 0L) AS BIGINT)").alias("total_reviews")))
    return top_k(per_cat, n, [F.col("total_reviews").desc_nulls_last()], ties=["app_category"])


def category_ratings(stg_apps: DataFrame) -> DataFrame:
    """Rated listings and their mean rating per category, exact for any ratings."""
    return exact_mean(stg_apps.where("app_category IS NOT NULL"), ["app_category"], "app_rating",
                      out="average_rating").withColumnRenamed("n", "listings")
