"""The dashboard dataset (M10) and the metrics read from it (M11-M14, M18).

The dashboard frame is fact ⋈ dim_apps ⋈ dim_categories ⟕ reviews: one row
per (fact row, dim_apps row of its app_id, category row, review of the app
name).  It is a fan-out — at sf0.1 ~17 million rows out of ~0.5 million
reviews — and a popular app multiplies every one of its listing rows by all
of its reviews.

Its rows only differ by the columns they copy from the four inputs, so each
input is first reduced to counts per distinct value of the columns used
(aggregate-before-join: hot keys collapse in the map-side partial
aggregate), and the frame is described by *weighted* rows:

* ``FrameView.apps``: one row per (fact row, app name, category) with
  ``weight`` = the number of frame rows it stands for;
* ``FrameView.sentiments``: one row per (app name, category, sentiment)
  with ``weight`` = the number of frame rows carrying that sentiment.

Every metric is a weighted aggregate of these views, so none of them
builds the fan-out.  ``dashboard_frame`` materialises the rows only when
the dataset itself is asked for, spreading hot groups over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions import bytes_to_mb_sql, compact_number_sql, lit, thousands_sql
from storelens.operators import (
    exact_sample,
    expand_rows,
    rounded_mean,
    share_of_total,
    top_k,
    weighted_mean,
    weighted_sum,
)
from storelens.functions.sql import project, select_sql
from storelens.plans.marts import review_counts
from storelens.sources.csv import POSITION

UNKNOWN_CATEGORY = "Unknown"

FRAME_COLUMNS = (
    "app_name", "category_name", "app_size_bytes", "price", "average_user_rating",
    "total_installs", "total_reviews", "last_updated_date", "review_sentiment",
    "app_size_mb",
)


@dataclass(frozen=True)
class DashboardInputs:
    fact: DataFrame            # fact_app_metrics_keyed
    dim_apps: DataFrame
    dim_categories: DataFrame
    reviews: DataFrame | None  # stg_reviews
    counts: DataFrame | None = None  # review_counts, where it is at hand


@dataclass(frozen=True)
class FrameView:
    apps: DataFrame        # app_name, category_name, price, average_user_rating, total_installs, weight
    sentiments: DataFrame  # app_name, category_name, review_sentiment, weight

    def cache(self) -> "FrameView":
        """Keep both (app-grain, small) views in executor memory while several
        panels are computed from them; lost blocks are recomputed."""
        return FrameView(self.apps.cache(), self.sentiments.cache())

    def unpersist(self) -> None:
        self.apps.unpersist()
        self.sentiments.unpersist()


def _categories(inp: DashboardInputs) -> DataFrame:
    return (inp.dim_categories
            .groupBy(F.col("category_id"), F.col("app_category").alias("category_name"))
            .agg(F.expr("count(1)").alias("_n_cat")))


def _sentiment_counts(inp: DashboardInputs) -> DataFrame:
    """The counts that the fact's review metrics derive from: their shuffle is
    shared, the reviews are scanned once."""
    counts = review_counts(inp.reviews) if inp.counts is None else inp.counts
    return counts.withColumnRenamed("n_reviews", "_n_rev")


def dashboard_frame(inp: DashboardInputs, partitions: int | None = None) -> DataFrame:
    """The frame's rows (M10), with ``app_size_mb`` = size in MiB (0 when
    unknown).  Joins run on the reduced inputs; the copies are generated
    last by ``expand_rows``, which splits hot groups across tasks.
    ``partitions`` sizes the output (default: the shuffle-partition setting);
    the frame is many times larger than its inputs, so size it for the
    expected row count when materialising it at scale."""
    d = (inp.dim_apps.groupBy("app_id", "app_name", "app_size_bytes", "last_updated_date")
         .agg(F.expr("count(1)").alias("_n_dim")))
    f = inp.fact.transform(project, "app_id", "category_id", "app_price AS price",
                           "average_user_rating", "total_installs", "total_reviews")
    rows = (f.join(d, "app_id")
            .join(_categories(inp), "category_id")
            .join(_sentiment_counts(inp), "app_name", "left"))
    keep = [c for c in FRAME_COLUMNS if c != "app_size_mb"]
    rows = rows.transform(project, *keep, "_n_dim * _n_cat * coalesce(_n_rev, 1L) AS _mult")
    out = expand_rows(rows, "_mult", partitions=partitions)
    return out.transform(project, *keep, f"{bytes_to_mb_sql('app_size_bytes')} AS app_size_mb")


def frame_view(inp: DashboardInputs) -> FrameView:
    """Row-weighted view: each weight is the number of frame rows."""
    d = inp.dim_apps.groupBy("app_id", "app_name").agg(F.expr("count(1)").alias("_n_dim"))
    s = _sentiment_counts(inp)
    # per-name totals from the per-sentiment counts: one pass over the reviews
    r = s.groupBy("app_name").agg(F.expr("sum(_n_rev)").alias("_n_any"))
    place = [POSITION] if POSITION in inp.fact.columns else []
    f = inp.fact.transform(project, "app_id", "category_id", "app_price AS price",
                           "average_user_rating", "total_installs", *place)
    base = (f.join(d, "app_id").join(_categories(inp), "category_id")
            .transform(project, "app_name", "category_name", "price", "average_user_rating",
                       "total_installs", "_n_dim * _n_cat AS _w_app", *place))
    apps = (base.join(r, "app_name", "left")
            .transform(project, "app_name", "category_name", "price", "average_user_rating",
                       "total_installs", "_w_app * coalesce(_n_any, 1L) AS weight", *place))
    per_name = base.groupBy("app_name", "category_name").agg(F.expr("sum(_w_app)").alias("_m"))
    sentiments = (per_name.join(s, "app_name")
                  .transform(project, "app_name", "category_name", "review_sentiment",
                             "_m * _n_rev AS weight"))
    return FrameView(apps, sentiments)


def app_view(inp: DashboardInputs) -> FrameView:
    """App-weighted view: every keyed fact row counts once (with its category
    name), and each of its app's reviews counts once."""
    place = [POSITION] if POSITION in inp.fact.columns else []
    f = (inp.fact.join(_categories(inp), "category_id")
         .transform(project, "app_name", "category_name", "app_price AS price",
                    "average_user_rating", "total_installs", "_n_cat AS weight", *place))
    per_name = f.groupBy("app_name", "category_name").agg(F.expr("sum(weight)").alias("_m"))
    sentiments = (per_name.join(_sentiment_counts(inp), "app_name")
                  .transform(project, "app_name", "category_name", "review_sentiment",
                             "_m * _n_rev AS weight"))
    return FrameView(f, sentiments)


def view_of_frame(frame: DataFrame) -> FrameView:
    """View of an already materialised frame (every row weight 1)."""
    return FrameView(
        frame.transform(project, "app_name", "category_name", "price", "average_user_rating",
                        "total_installs", "1L AS weight"),
        frame.transform(project, "app_name", "category_name", "review_sentiment", "1L AS weight"),
    )


def view(inp: DashboardInputs, weighting: str = "row") -> FrameView:
    if weighting == "row":
        return frame_view(inp)
    if weighting == "app":
        return app_view(inp)
    raise ValueError(f"weighting must be 'row' or 'app', not {weighting!r}")


def for_category(df: DataFrame, category: str | None) -> DataFrame:
    """No category: all rows; otherwise rows whose category (NULL read as
    'Unknown') equals it."""
    if not category:
        return df
    return df.where(f"coalesce(category_name, {lit(UNKNOWN_CATEGORY)}) = {lit(category)}")


def _mean(column: str, digits: int | None):
    m = weighted_mean(column, "weight") if digits is None else rounded_mean(column, "weight", digits)
    return m.alias(column)


def kpis(v: FrameView, category: str | None = None) -> DataFrame:
    """One row: total_apps (distinct names), avg_rating (mean rounded half-up
    to 2 decimals, computed exactly; 0.0 when there is none), total_installs
    (DECIMAL(38, 0)), installs_display (compact) and total_apps_display (thousands separators)."""
    return _kpi_columns(for_category(v.apps, category).agg(*_kpi_aggregates()))


def _kpi_aggregates() -> list:
    return [F.expr("count(DISTINCT app_name)").alias("total_apps"),
            rounded_mean("average_user_rating", "weight", 2).alias("_mean"),
            weighted_sum("total_installs", "weight").alias("_installs")]


def _kpi_columns(out: DataFrame, *keys: str) -> DataFrame:
    return select_sql(out, [
        *keys,
        "total_apps",
        "coalesce(_mean, CAST(0.0 AS DOUBLE)) AS avg_rating",
        "_installs AS total_installs",
        f"{compact_number_sql('_installs')} AS installs_display",
        f"{thousands_sql('total_apps')} AS total_apps_display",
    ])


def _selections(df: DataFrame) -> DataFrame:
    """Category names as the drop-down shows them."""
    return df.withColumn("category_name", F.expr(f"coalesce(category_name, {lit(UNKNOWN_CATEGORY)})"))


def kpis_by_category(v: FrameView) -> DataFrame:
    """``kpis`` of every selection of the drop-down in one aggregation: one row
    per category, and one with a NULL category for all of them together."""
    out = _selections(v.apps).groupingSets([["category_name"], []], "category_name").agg(
        *_kpi_aggregates())
    return _kpi_columns(out, "category_name")


def top_rated_by_category(v: FrameView, n: int = 10, digits: int | None = None) -> DataFrame:
    """``top_rated_apps`` of every selection in one run: category_name (NULL:
    all), rank from 1, app_name, average_user_rating.  Every task keeps the
    ``n`` best of a category before the rows are dealt by category."""
    per_app = (_selections(v.apps)
               .groupingSets([["category_name", "app_name"], ["app_name"]], "category_name", "app_name")
               .agg(_mean("average_user_rating", digits)))
    order = Window.partitionBy("category_name").orderBy(
        F.col("average_user_rating").desc_nulls_last(), F.col("app_name").asc_nulls_last())
    return (per_app.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
            .select("category_name", "rank", "app_name", "average_user_rating"))


def sentiment_by_category(v: FrameView) -> DataFrame:
    """``sentiment_distribution`` of every selection in one aggregation:
    category_name (NULL: all), review_sentiment, n, share."""
    counts = (_selections(v.sentiments).where("review_sentiment IS NOT NULL")
              .groupingSets([["category_name", "review_sentiment"], ["review_sentiment"]],
                            "category_name", "review_sentiment")
              .agg(F.expr("CAST(sum(weight) AS BIGINT)").alias("n")))
    total = F.sum("n").over(Window.partitionBy("category_name"))  # a row per label
    return counts.withColumn("share", F.try_divide(F.col("n"), total))


def top_rated_apps(v: FrameView, category: str | None = None, n: int = 10,
                   digits: int | None = None) -> DataFrame:
    """Mean rating per app name, the ``n`` best (NULL means last, ties by
    name).  With ``digits`` the mean is rounded (exactly, see
    ``operators.rounded_mean``) before ranking."""
    a = for_category(v.apps, category)
    per_app = a.groupBy("app_name").agg(_mean("average_user_rating", digits))
    return top_k(per_app, n, [F.col("average_user_rating").desc_nulls_last()], ties=["app_name"])


def rating_vs_installs(v: FrameView, category: str | None = None,
                       digits: int | None = None, price: str = "min") -> DataFrame:
    """Per app name: mean rating (rounded exactly when ``digits`` is given),
    summed installs, a price and its plotting value.  The price is the smallest
    one, or with ``price="first"`` that of the app's first listing in the
    source files which has one (the listings were read with their position)."""
    a = for_category(v.apps, category)
    if price not in ("min", "first"):
        raise ValueError(f"price must be 'min' or 'first', not {price!r}")
    if price == "first" and POSITION not in a.columns:
        raise ValueError("the app listings have no source position")
    pick = ("min(price)" if price == "min"
            else f"min_by(price, {POSITION}) FILTER (WHERE price IS NOT NULL)")
    return (a.groupBy("app_name")
            .agg(_mean("average_user_rating", digits),
                 weighted_sum("total_installs", "weight").alias("total_installs"),
                 F.expr(pick).alias("price"))
            .transform(project, "app_name", "average_user_rating",
                       "total_installs", "price",
                       "coalesce(CAST(price AS DOUBLE), CAST(0.0 AS DOUBLE)) AS price_numeric_viz"))


def rating_vs_installs_sample(v: FrameView, category: str | None = None,
                              n: int = 2000, seed: int = 0,
                              digits: int | None = None) -> DataFrame:
    """``rating_vs_installs`` limited to an exact uniform sample of n apps."""
    return exact_sample(rating_vs_installs(v, category, digits), n, ["app_name"], seed=seed)


def sentiment_distribution(v: FrameView, category: str | None = None) -> DataFrame:
    """Frame rows per non-NULL sentiment label (case kept) and their share,
    largest first."""
    return (share_of_total(for_category(v.sentiments, category), "review_sentiment", "weight")
            .orderBy(F.col("n").desc(), F.col("review_sentiment").asc()))


def category_list(v: FrameView) -> DataFrame:
    """Sorted distinct category names present in the frame."""
    return (v.apps.select("category_name").where("category_name IS NOT NULL")
            .distinct().orderBy("category_name"))


def dashboard_panels(v: FrameView, category: str | None = None, n_top: int = 10,
                     n_sample: int = 2000, seed: int = 0) -> dict[str, DataFrame]:
    """Every panel of one dashboard refresh for a category selection: KPIs,
    top-rated apps, the rating/installs sample and the sentiment shares.
    Cache the view first (``v.cache()``) when all of them are evaluated."""
    return {
        "kpis": kpis(v, category),
        "top_rated_apps": top_rated_apps(v, category, n_top),
        "rating_vs_installs": rating_vs_installs_sample(v, category, n_sample, seed),
        "sentiment_distribution": sentiment_distribution(v, category),
    }
