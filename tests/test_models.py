"""One pass over the reviews, shares in one aggregation, every category in one
run, safe refresh, warehouse by name, first price, check suite."""

import os
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from storelens import plans
from storelens.functions import nan_to_null, to_number
from storelens.operators import exact_mean, has_columns, is_empty, rounded_mean, share_of_total, suite, unique_violations
from storelens.queries import QUERIES, Models
from storelens.sinks import current_path, land_table, read_current
from storelens.sinks.versions import POINTER, current_version
from storelens.sources import require_tables
from tests.conftest import SF_SMALL
from tools.plans import PATTERNS, final_only


def run_plan(df):
    df.collect()
    return final_only(df._jdf.queryExecution().executedPlan().toString())


def count(plan, what):
    import re
    return len(re.findall(PATTERNS[what], plan))


@pytest.fixture(scope="module")
def m(spark):
    return Models(spark, SF_SMALL)


@pytest.mark.parametrize("name", ["dashboard_frame", "kpis_row", "sentiment_distribution", "top_rated_apps"])
def test_reviews_are_scanned_once(spark, name):
    plan = run_plan(QUERIES[name](spark, SF_SMALL))
    assert plan.count("l_partkey") and sum("l_partkey" in x for x in plan.splitlines() if "FileScan" in x) == 1


def test_share_needs_no_second_run_of_its_view(spark):
    share = run_plan(QUERIES["sentiment_distribution"](spark, SF_SMALL))
    kpis = run_plan(QUERIES["kpis_row"](spark, SF_SMALL))
    assert count(share, "shuffles") <= count(kpis, "shuffles") + 1


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 9)], "x string, w int")
    assert {tuple(r) for r in share_of_total(df, "x", "w").collect()} == {("a", 3, 0.75), ("b", 1, 0.25)}
    assert share_of_total(df.limit(0), "x", "w").count() == 0


def test_pipeline_reads_staged_reviews_once(spark, tmp_dir, monkeypatch):
    from storelens.plans import pipeline
    seen = []
    monkeypatch.setattr(pipeline, "review_counts",
                        lambda df, f=pipeline.review_counts: (seen.append(1), f(df))[1])
    m = Models(spark, SF_SMALL)
    from storelens.sources import raw_apps, raw_reviews
    t = plans.run_pipeline(raw_apps(spark, SF_SMALL), raw_reviews(spark, SF_SMALL), tmp_dir)
    assert seen == [1]
    for name, want in (("fact_app_metrics", m.fact), ("fact_app_metrics_keyed", plans.fact_app_metrics_keyed(
            m.stg_apps, m.stg_reviews))):
        assert sorted(map(str, t[name].collect())) == sorted(map(str, want.collect()))


def test_every_category_in_one_run(m):
    v = m.view()
    kpis = {r[0]: tuple(r)[1:] for r in plans.kpis_by_category(v).collect()}
    top, share = plans.top_rated_by_category(v, 5).collect(), plans.sentiment_by_category(v).collect()
    assert set(kpis) == {None, *(r[0] for r in plans.category_list(v).collect())}
    for c, row in kpis.items():
        assert row == tuple(plans.kpis(v, c).first())
        assert [tuple(r)[2:] for r in sorted((r for r in top if r[0] == c), key=lambda r: r["rank"])] == [
            tuple(r) for r in plans.top_rated_apps(v, c, 5).collect()]
        assert sorted(tuple(r)[1:] for r in share if r[0] == c) == sorted(
            map(tuple, plans.sentiment_distribution(v, c).collect()))


def test_category_null_and_unknown_are_one_selection(spark):
    rows = [("a", None, 1.0, 4.0, 5, 2), ("b", "Unknown", 2.0, 2.0, 7, 1), ("c", "X", None, None, None, 3)]
    apps = spark.createDataFrame(rows, "app_name string, category_name string, price double,"
                                 " average_user_rating double, total_installs long, weight long")
    v = plans.FrameView(apps, spark.createDataFrame([("a", None, "Good", 2), ("b", "Unknown", None, 1)],
                        "app_name string, category_name string, review_sentiment string, weight long"))
    for c, row in {r[0]: tuple(r)[1:] for r in plans.kpis_by_category(v).collect()}.items():
        assert row == tuple(plans.kpis(v, c).first())
    assert {tuple(r) for r in plans.sentiment_by_category(v).collect()} == {
        (None, "Good", 2, 1.0), ("Unknown", "Good", 2, 1.0)}


def test_failed_refresh_leaves_the_old_table(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    land_table(spark.range(5), root, versioned=True)
    first = current_version(spark, root)
    bad = spark.range(1000).repartition(8).select(
        F.when(F.col("id") == 999, F.raise_error(F.lit("dies half-way"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="dies half-way"):
        land_table(bad, root, versioned=True)
    assert current_version(spark, root) == first
    assert sorted(r[0] for r in read_current(spark, root).collect()) == list(range(5))
    old = read_current(spark, root)  # a reader that resolved the table before the next refresh
    land_table(spark.range(3), root, versioned=True)
    assert old.count() == 5 and read_current(spark, root).count() == 3
    assert land_table(spark.range(0), root, versioned=True).count() == 0  # empty: no old rows
    assert read_current(spark, root).count() == 0
    kept = sorted(x for x in os.listdir(root) if x.startswith("v"))
    assert len(kept) == 2 and os.path.basename(current_path(spark, root)) == kept[-1]
    assert [x for x in os.listdir(root) if x.startswith(POINTER)] == [POINTER]
    with pytest.raises(ValueError):
        land_table(spark.range(1), root, versioned=True, options={"compression": "none"})


def test_plain_folder_is_its_own_version(spark, tmp_dir):
    land_table(spark.range(2), f"{tmp_dir}/plain")
    assert read_current(spark, f"{tmp_dir}/plain").count() == 2


def test_required_tables(spark):
    spark.range(1).createOrReplaceTempView("there")
    require_tables(spark, ["there"])
    with pytest.raises(LookupError, match="not_there"):
        require_tables(spark, ["there", "not_there"])


@pytest.mark.parametrize("rows", [
    [(1e40, 1), (1.0, 5)], [(1e-9, 3)], [(-1e300, 2), (1e300, 2), (2.5, 1)], [(4.125, 1), (4.135, 1)],
    [(1e15, 1), (-1.0, 7)], [(None, 3), (3.25, 2)], [(999999999999999.0, 10**12), (0.5, 1)]])
def test_rounded_mean_of_any_doubles(spark, rows):
    df = spark.createDataFrame(rows, "v double, w long")
    got = df.agg(rounded_mean("v", "w", 2).alias("m")).first()[0]
    some = [(Fraction(v), w) for v, w in rows if v is not None]
    mean = sum(v * w for v, w in some) / sum(w for _, w in some)
    assert got == pytest.approx(float(round(mean * 100) / 100), rel=1e-12, abs=0.0051 if abs(mean) < 1e12 else 1)


def test_exact_mean_equals_fractions(spark):
    """Any doubles, any signs and sizes, next to powers of two, in any order."""
    rng, rows = random.Random(5), []
    groups = {
        "huge": [(1e40, 1), (1.0, 5), (-3.5, 2)], "tiny": [(1e-9, 3), (5e-324, 1), (2.2250738585072014e-308, 2)],
        "cancel": [(-1.7976931348623157e308, 2), (1.7976931348623157e308, 2), (2.5, 1)],
        "same": [(0.1, 1)] * 10, "zero": [(0.0, 3), (-0.0, 1)], "heavy": [(0.1, 10**12), (0.3, 7)],
        "edges": [(x * 2.0**k, 1) for k in range(-1000, 1000, 37) for x in (1, -(1 - 2**-53), 1 + 2**-52)],
        "any": [(rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300), rng.randint(0, 9)) for _ in range(300)]}
    for g, values in groups.items():
        rows += [(g, v, w) for v, w in values]
    odd = [("none", None, 3), ("none", float("nan"), 1), ("tiny", float("inf"), 9), ("same", None, 4), ("light", 1.5, 0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows + odd, "g string, v double, w long").repartition(7)
    got = {r.g: (r.n, r["mean"]) for r in exact_mean(df, ["g"], "v", "w").collect()}
    assert got.pop("none") == got.pop("light") == (0, None)
    for g, values in groups.items():
        n = sum(w for _, w in values)
        assert got[g] == (n, float(sum(Fraction(v) * w for v, w in values) / n)), g
    assert exact_mean(df.limit(0), ["g"], "v", "w").collect() == []


def test_one_huge_rating_does_not_stop_the_kpis(spark):
    raw = {"App": "A", "Category": "C", "Rating": "1e40", "Reviews": "1", "Size": "1M", "Installs": "10+",
           "Type": "Free", "Price": "0", "Content_Rating": "x", "Genres": "g", "Last_Updated": "2018-01-01",
           "Current_Ver": "1", "Android_Ver": "2"}
    apps = plans.stg_apps(plans.clean_apps(spark.createDataFrame([raw, raw | {"App": "B", "Rating": "4.0"}])))
    reviews = spark.createDataFrame([("A", "t", "Positive")], "app_name string, review_text string, review_sentiment string")
    keyed = plans.fact_app_metrics_keyed(apps, reviews, 6)
    v = plans.view(plans.DashboardInputs(keyed, plans.dim_apps(apps), plans.dim_categories(apps), reviews))
    assert plans.kpis(v).first().avg_rating == pytest.approx(5e39)
    assert [r.app_name for r in plans.top_rated_apps(v, None, 10, 6).collect()] == ["A", "B"]


def test_first_price_in_file_order(spark, m):
    first = {r.app_name: r.price for r in QUERIES["rating_vs_installs_first_price"](spark, SF_SMALL).collect()}
    least = {r.app_name: r.price for r in QUERIES["rating_vs_installs"](spark, SF_SMALL).collect()}
    assert first.keys() == least.keys() and all(least[k] <= p for k, p in first.items() if p is not None)
    rows = [("x", 9.0, 0), ("x", 1.0, 1), ("y", None, 2), ("y", 3.0, 3), ("z", None, 4)]
    apps = spark.createDataFrame([(a, "c", p, 1.0, 1, 1, ("f", 0, n)) for a, p, n in reversed(rows)],
                                 "app_name string, category_name string, price double, average_user_rating double,"
                                 " total_installs long, weight long, _position struct<file string, block long, record long>")
    got = plans.rating_vs_installs(plans.FrameView(apps, apps), price="first").collect()
    assert {r.app_name: r.price for r in got} == {"x": 9.0, "y": 3.0, "z": None}
    with pytest.raises(ValueError):
        plans.rating_vs_installs(m.view(), price="first")


def test_suite_is_one_scan(spark, m):
    df = QUERIES["dq_suite"](spark, SF_SMALL)
    plan = run_plan(df)
    assert plan.count("FileScan") == 1
    rows = {(r.check, r.column): r.failures for r in df.collect()}
    assert rows["unique", "app_name"] == unique_violations(m.stg_apps, "app_name").count()
    assert rows["not_null", "last_updated_date"] == m.stg_apps.where("last_updated_date IS NULL").count()
    odd = spark.createDataFrame([(1, None), (1, "a"), (None, "a"), (None, "b")], "`k k` int, v string")
    assert {tuple(r) for r in suite(odd, ["k k", "v"], ["k k", "v"]).collect()} == {
        ("unique", "k k", 1, False), ("unique", "v", 1, False),
        ("not_null", "k k", 2, False), ("not_null", "v", 1, False)}
    with pytest.raises(ValueError):
        suite(odd)


def test_numbers_and_guards(spark):
    df = spark.createDataFrame([("1e400",), ("-1e400",), (" 2.5 ",), ("nan",), ("1e308",)], "x string")
    assert [r[0] for r in df.select(to_number("x")).collect()] == [None, None, 2.5, None, 1e308]
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in nan.select(nan_to_null("x")).collect()] == [None, 1.0]
    assert is_empty(nan.limit(0)) and has_columns(nan, ["x"]) and not has_columns(nan, ["y"])
