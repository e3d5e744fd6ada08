"""Golden rows for every dataset (FIXTURES.md §3)."""

import datetime

import pytest

from storelens import plans
from tests.fixtures import Golden


@pytest.fixture(scope="module")
def g(spark):
    return Golden(spark)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_clean_apps_drops_and_fills(g):
    got = rows(g.clean_apps, "App", "Rating", "Installs", "Price")
    assert got == sorted([
        ("Alpha", 4.1, 10000, 0.0), ("Alpha", 4.1, 10000, 0.0),
        ("Beta", 0.0, 500, 4.99), ("Beta", 5.0, 1000, 5.99),
        ("Action", 0.0, 0, 0.0), ("é", 3.0, 5, 1.0),
    ], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert g.clean_apps.columns == [
        "App", "Category", "Rating", "Reviews", "Size", "Installs", "Type", "Price",
        "Content_Rating", "Genres", "Last_Updated", "Current_Ver", "Android_Ver"]


def test_stg_apps_values(g):
    got = rows(g.stg_apps, "app_name", "app_rating", "app_size_bytes", "installs_int",
               "app_price", "last_updated_date")
    exp = [
        ("Alpha", 4.1, 19922944.0, 10000, 0.0, None),
        ("Alpha", 4.1, 19922944.0, 10000, 0.0, None),
        ("Beta", 0.0, 8704.0, 500, 4.99, datetime.date(2018, 8, 1)),
        ("Beta", 5.0, None, 1000, 5.99, None),
        ("Action", 0.0, None, 0, 0.0, None),
        ("é", 3.0, None, 5, 1.0, None),
    ]
    assert got == sorted(exp, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_stg_apps_defaults_and_keys(g):
    by = {r["app_name"]: r for r in g.stg_apps.collect()}
    a = by["Action"]
    assert (a.app_category, a.app_type, a.content_rating, a.app_genres,
            a.current_version, a.android_version) == (
        "UNKNOWN", "Free", "Everyone", "Unknown", "2018", "Varies with device")
    betas = [r for r in g.stg_apps.collect() if r.app_name == "Beta"]
    assert {r.current_version for r in betas} == {"Varies with device"}
    assert by["Alpha"].source_unique_key == "a3090cdea7928901bc0b8c758a2d65a4"
    assert by["Action"].source_unique_key == "29bdf2d54ca9029bbdb771774c893d58"
    assert by["é"].source_unique_key == "f513529d503b62d7da7609f4036a45a9"


def test_stg_reviews(g):
    assert g.stg_reviews.count() == 6
    got = rows(g.stg_reviews, "app_name", "review_sentiment", "polarity", "subjectivity")
    assert ("Alpha", "POSITIVE", 0.0, 0.0) in got
    assert ("Beta", "Neutral", None, 0.0) in got
    assert ("Alpha", "Negative", -1.0, 1.0) in got
    keys = {r.source_unique_key for r in g.stg_reviews.where("review_text = 'good'").collect()}
    assert keys == {"b208540d25af1c003ac1809c0ce8fe50"}


def test_dims(g):
    assert g.dim_apps.count() == 5
    assert g.dim_apps.select("app_id").distinct().count() == 4
    ids = [r.app_id for r in g.dim_apps.where("app_name = 'Beta'").collect()]
    assert ids == ["fa82969225d83ec7767c9aabc01fd0c1"] * 2
    alpha = g.dim_apps.where("app_name = 'Alpha'").collect()
    assert [r.app_id for r in alpha] == ["38f1a00679e61384257dc7001e70add6"]
    cats = rows(g.dim_categories, "app_category", "app_genres", "category_id")
    assert cats == [
        ("ART", "Art", "740e7294a9b7bb7e24a977ec125cb2af"),
        ("GAME", "Action", "392fd3ab169779a3af5ad4292a46d930"),
        ("UNKNOWN", "Unknown", "0d5c00013e7546079cfedcc5b4beb9c5"),
    ]


def test_fact_literal(g):
    got = rows(g.fact, "app_name", "app_category", "avg_sentiment", "total_reviews", "app_price")
    assert got == [
        ("Action", "GAME", None, 1, 0.0),
        ("Alpha", None, 0.6666666666666666, 3, 0.0),
        ("Beta", None, 0.5, 1, 4.99),
        ("Beta", None, 0.5, 1, 5.99),
        ("é", None, None, None, 1.0),
    ]


def test_fact_keyed(g):
    got = rows(g.keyed, "app_name", "app_price", "average_user_rating", "total_installs",
               "avg_sentiment", "total_reviews")
    assert got == [
        ("Action", 0.0, 0.0, 0, None, 1),
        ("Alpha", 0.0, 4.1, 10000, 0.6666666666666666, 3),
        ("Beta", 5.99, 2.5, 1000, 0.5, 1),
        ("é", 1.0, 3.0, 5, None, None),
    ]


def test_top_rated_fanout(g):
    got = [(r.app_name, r.average_user_rating)
           for r in plans.top_rated(g.keyed, g.dim_apps, 5).collect()]
    assert got == [("Alpha", 4.1), ("é", 3.0), ("Beta", 2.5), ("Beta", 2.5), ("Action", 0.0)]


def test_dashboard_frame(g):
    f = plans.dashboard_frame(g.inputs)
    assert f.count() == 7
    by = {}
    for r in f.collect():
        by.setdefault(r.app_name, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {"Alpha": 3, "Beta": 2, "Action": 1, "é": 1}
    assert {r.app_size_mb for r in by["Alpha"]} == {19.0}
    assert sorted(r.app_size_mb for r in by["Beta"]) == [0.0, 0.00830078125]
    assert by["é"][0].review_sentiment is None


def test_kpis(g):
    v = plans.view(g.inputs, "row")
    k = plans.kpis(v).first()
    assert (k.total_apps, k.avg_rating, k.total_installs, k.installs_display) == (4, 2.9, 32005, "32.0K")
    k = plans.kpis(v, "GAME").first()
    assert (k.total_apps, k.avg_rating, k.total_installs, k.installs_display) == (2, 2.67, 2005, "2.0K")
    k = plans.kpis(v, "Unknown").first()
    assert (k.total_apps, k.avg_rating, k.total_installs, k.installs_display) == (0, 0.0, 0, "0")
    k = plans.kpis(plans.view(g.inputs, "app")).first()
    assert (k.total_apps, k.avg_rating, k.total_installs, k.installs_display) == (4, 2.4, 11005, "11.0K")


def test_top_rated_apps(g):
    got = [(r.app_name, r.average_user_rating)
           for r in plans.top_rated_apps(plans.view(g.inputs)).collect()]
    assert got == [("Alpha", 4.1), ("é", 3.0), ("Beta", 2.5), ("Action", 0.0)]


def test_rating_vs_installs(g):
    got = rows(plans.rating_vs_installs(plans.view(g.inputs)),
               "app_name", "average_user_rating", "total_installs", "price")
    assert got == [("Action", 0.0, 0, 0.0), ("Alpha", 4.1, 30000, 0.0),
                   ("Beta", 2.5, 2000, 5.99), ("é", 3.0, 5, 1.0)]


def test_sentiment_distribution(g):
    got = [(r.review_sentiment, r.n, round(r.share, 6))
           for r in plans.sentiment_distribution(plans.view(g.inputs)).collect()]
    assert got[0] == ("Neutral", 2, 0.333333)
    assert sorted(got[1:]) == [("Mixed", 1, 0.166667), ("Negative", 1, 0.166667),
                               ("POSITIVE", 1, 0.166667), ("Positive", 1, 0.166667)]


def test_sentiment_histogram(g):
    got = rows(plans.sentiment_histogram(g.fact), "bin", "n")
    assert got == [(10, 2), (13, 1)]


def test_top_apps_and_categories(g):
    got = [(r.app_name, r.total_reviews) for r in plans.top_apps_by_reviews(g.fact).collect()]
    assert got == [("Alpha", 3), ("Action", 1), ("Beta", 1), ("Beta", 1), ("é", None)]
    cats = [(r.app_category, r.total_reviews)
            for r in plans.top_categories_by_reviews(g.fact).collect()]
    assert cats == [("GAME", 1)]


def test_category_list(g):
    got = [r.category_name for r in plans.category_list(plans.view(g.inputs)).collect()]
    assert got == ["ART", "GAME", "UNKNOWN"]


def test_weighted_views_equal_materialised_frame(g):
    """Metrics from the weighted view == metrics over the built frame."""
    frame_v = plans.view_of_frame(plans.dashboard_frame(g.inputs))
    row_v = plans.view(g.inputs, "row")
    for fn in (plans.kpis, plans.top_rated_apps, plans.rating_vs_installs,
               plans.sentiment_distribution, plans.category_list):
        a = sorted(map(tuple, fn(frame_v).collect()))
        b = sorted(map(tuple, fn(row_v).collect()))
        assert a == b, fn.__name__


def test_clean_reviews_drops_store_id(spark):
    from pyspark.sql import functions as F
    from tests.fixtures import raw_reviews
    with_id = raw_reviews(spark).withColumn("_id", F.monotonically_increasing_id().cast("string"))
    out = plans.clean_reviews(with_id)
    assert "_id" not in out.columns
    assert out.count() == 6
