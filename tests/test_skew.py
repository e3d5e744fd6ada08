"""Hot keys: one app holds a third of all reviews and many listing rows.
The weighted metrics and the expanded frame must equal a brute-force frame
built by plain joins, and the expansion must not land in one task."""

import pytest
from pyspark.sql import functions as F

from storelens import plans


@pytest.fixture(scope="module")
def hot(spark):
    apps = []
    for i in range(60):
        name = "HOT" if i < 12 else f"app{i % 25}"
        apps.append((name, "GAME" if i % 2 else "TOOLS", f"{1 + i % 40 / 10}", "1", "3M",
                     f"{i},000+", "Free", "0", "Everyone", "Action",
                     "2018-01-10", f"{i % 3}.0", "4.1 and up"))
    reviews = []
    for j in range(3000):
        name = "HOT" if j % 3 == 0 else f"app{j % 25}"
        reviews.append((name, f"r{j}", ("Positive", "Neutral", "Negative")[j % 3 if j % 7 else 0],
                        "0.1", "0.2"))
    from storelens.sources.schemas import APPS_RENAMED, REVIEWS_RAW
    ra = spark.createDataFrame(apps, APPS_RENAMED)
    rr = spark.createDataFrame(reviews, REVIEWS_RAW)
    sa = plans.stg_apps(plans.clean_apps(ra))
    sr = plans.stg_reviews(plans.clean_reviews(rr))
    da, dc = plans.dim_apps(sa), plans.dim_categories(sa)
    keyed = plans.fact_app_metrics_keyed(sa, sr)
    return plans.DashboardInputs(keyed, da, dc, sr)


def brute_frame(inp):
    """The frame exactly as the SQL defines it: plain joins, no weights."""
    fm, da, dc, sr = inp.fact.alias("fm"), inp.dim_apps.alias("da"), inp.dim_categories.alias("dc"), inp.reviews.alias("sr")
    return (fm.join(da, F.col("fm.app_id") == F.col("da.app_id"))
            .join(dc, F.col("fm.category_id") == F.col("dc.category_id"))
            .join(sr, F.col("da.app_name") == F.col("sr.app_name"), "left")
            .select(F.col("da.app_name").alias("app_name"), F.col("dc.app_category").alias("category_name"),
                    F.col("da.app_size_bytes").alias("app_size_bytes"), F.col("fm.app_price").alias("price"),
                    F.col("fm.average_user_rating").alias("average_user_rating"),
                    F.col("fm.total_installs").alias("total_installs"),
                    F.col("fm.total_reviews").alias("total_reviews"),
                    F.col("da.last_updated_date").alias("last_updated_date"),
                    F.col("sr.review_sentiment").alias("review_sentiment")))


def test_hot_app_frame_equals_brute_force(hot):
    got = plans.dashboard_frame(hot).drop("app_size_mb")
    exp = brute_frame(hot)
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    hot_rows = got.where("app_name = 'HOT'").count()
    assert hot_rows >= got.count() / 3


def test_hot_app_metrics_equal_brute_force(hot):
    frame_v = plans.view_of_frame(brute_frame(hot))
    row_v = plans.view(hot, "row")
    for cat in (None, "GAME"):
        a, b = plans.kpis(frame_v, cat).first(), plans.kpis(row_v, cat).first()
        assert (a.total_apps, a.avg_rating, a.total_installs) == (b.total_apps, b.avg_rating, b.total_installs)
        da = {r.review_sentiment: r.n for r in plans.sentiment_distribution(frame_v, cat).collect()}
        db = {r.review_sentiment: r.n for r in plans.sentiment_distribution(row_v, cat).collect()}
        assert da == db
        ra = {r.app_name: (round(r.average_user_rating, 9), r.total_installs)
              for r in plans.rating_vs_installs(frame_v, cat).collect()}
        rb = {r.app_name: (round(r.average_user_rating, 9), r.total_installs)
              for r in plans.rating_vs_installs(row_v, cat).collect()}
        assert ra == rb


def test_hot_group_expansion_is_spread(spark, hot):
    from storelens.operators import expand_rows
    counts = spark.createDataFrame([("HOT", 50_000), ("cold", 3)], "k string, n bigint")
    out = expand_rows(counts, "n", chunk_rows=2_000, partitions=8)
    sizes = out.rdd.glom().map(len).collect()
    assert sum(sizes) == 50_003
    assert max(sizes) < 50_003 / 2  # the hot group is not generated by one task
