"""Registered queries over the driver tables (sf0.001): they run, have stable
schemas, and satisfy the invariants of SURVEY §5."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from storelens import plans
from storelens.queries import QUERIES, Models
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def m(spark):
    return Models(spark, SF_SMALL)


def test_entry_and_registry(spark):
    df = entry.entry(spark)
    assert df.columns == ["app_name", "average_user_rating"]
    assert df.count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_fixture_row_counts(m):
    assert m.clean_apps.count() == 184
    assert m.clean_reviews.count() == 5082
    assert m.dim_apps.count() == 184
    assert m.dim_categories.count() == 128
    assert plans.dashboard_frame(m.inputs).count() == 5195


def test_literal_fact_keeps_every_app(m):
    assert m.fact.count() >= m.dim_apps.count()


def test_sentiment_counts_sum_to_frame_sentiments(m):
    frame = plans.dashboard_frame(m.inputs)
    dist = plans.sentiment_distribution(m.view())
    assert dist.agg(F.sum("n")).first()[0] == frame.where("review_sentiment IS NOT NULL").count()
    assert abs(dist.agg(F.sum("share")).first()[0] - 1.0) < 1e-9


def test_histogram_counts_sum_to_scored_apps(m):
    h = plans.sentiment_histogram(m.fact)
    assert h.agg(F.sum("n")).first()[0] == m.fact.where("avg_sentiment IS NOT NULL").count()


def test_sample_is_exact_and_distinct(m):
    all_apps = plans.rating_vs_installs(m.view())
    s = plans.rating_vs_installs_sample(m.view(), None, 50)
    assert s.count() == 50 and s.select("app_name").distinct().count() == 50
    assert plans.rating_vs_installs_sample(m.view(), None, 10**6).count() == all_apps.count()


def test_weighted_metrics_equal_frame_metrics(m):
    frame_v = plans.view_of_frame(plans.dashboard_frame(m.inputs))
    row_v = m.view()
    for fn in (plans.kpis, plans.category_list):
        assert sorted(map(tuple, fn(frame_v).collect())) == sorted(map(tuple, fn(row_v).collect()))
    a = {r.review_sentiment: r.n for r in plans.sentiment_distribution(frame_v).collect()}
    b = {r.review_sentiment: r.n for r in plans.sentiment_distribution(row_v).collect()}
    assert a == b
    ra = {r.app_name: (round(r.average_user_rating, 9), r.total_installs, r.price)
          for r in plans.rating_vs_installs(frame_v).collect()}
    rb = {r.app_name: (round(r.average_user_rating, 9), r.total_installs, r.price)
          for r in plans.rating_vs_installs(row_v).collect()}
    assert ra == rb


def test_dashboard_panels_on_cached_view(m):
    v = m.view().cache()
    try:
        panels = plans.dashboard_panels(v, "PROMO")
        assert set(panels) == {"kpis", "top_rated_apps", "rating_vs_installs",
                               "sentiment_distribution"}
        assert panels["kpis"].count() == 1
        assert panels["top_rated_apps"].count() <= 10
    finally:
        v.unpersist()


def test_unique_check_fails_on_app_id(m):
    # app_id is md5(name || version) while dim_apps keeps other columns too
    assert m.dim_apps.select("app_id").distinct().count() == 183
    from storelens.operators import unique_violations
    assert unique_violations(m.dim_apps, "app_id").count() == 1
