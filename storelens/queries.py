"""Registered queries: every dataset of the library run over the driver's
tables (``part`` -> app listings, ``lineitem`` ⋈ ``part`` -> reviews).

Comparison convention (same on the SQL side): averages are reported at 6
decimals, and the keyed fact's rating is rounded to 6 decimals before any
ranking.  Means over the dashboard frame are rounded exactly (integer
micro-units, half-up), so a mean that lies on a rounding half comes out the
same whatever the summation order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens import plans
from storelens.functions.sql import select_sql
from storelens.operators import ensure_columns, not_null_violations, suite, unique_violations
from storelens.session import remove_at_exit, scratch_path
from storelens.sinks import export_csv, land_table, materialize, read_current
from storelens.sources import (
    raw_apps_from_part,
    raw_reviews_from_lineitem,
    read_apps_csv,
    read_model,
    read_reviews_csv,
    read_seed_csv,
    read_table,
    require_tables,
)
from storelens.sources.schemas import APPS_CLEAN, APPS_COLUMNS, APPS_CSV_HEADER, REVIEWS_COLUMNS

DIGITS = 6
FILTER_CATEGORY = "PROMO"
REQUIRED_FRAME_COLUMNS = (
    "app_name", "category_name", "average_user_rating", "total_installs",
    "total_reviews", "price", "review_sentiment", "app_size_mb",
)


def _r(df: DataFrame, *cols: str) -> DataFrame:
    return select_sql(df, [f"round({c}, {DIGITS}) AS {c}" if c in cols else c for c in df.columns])


class Models:
    """The model graph over one input folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def part(self):
        return read_table(self.spark, self.sf_dir, "part")

    @cached_property
    def clean_apps(self):
        return plans.clean_apps(raw_apps_from_part(self.part))

    @cached_property
    def clean_reviews(self):
        lineitem = read_table(self.spark, self.sf_dir, "lineitem")
        return plans.clean_reviews(raw_reviews_from_lineitem(lineitem, self.part))

    @cached_property
    def stg_apps(self):
        return plans.stg_apps(self.clean_apps)

    @cached_property
    def stg_reviews(self):
        return plans.stg_reviews(self.clean_reviews)

    @cached_property
    def dim_apps(self):
        return plans.dim_apps(self.stg_apps)

    @cached_property
    def dim_categories(self):
        return plans.dim_categories(self.stg_apps)

    @cached_property
    def fact(self):
        return plans.fact_app_metrics(self.dim_apps, self.dim_categories, self.stg_reviews)

    @cached_property
    def keyed(self):
        return plans.fact_app_metrics_keyed(self.stg_apps, self.stg_reviews, DIGITS)

    @cached_property
    def inputs(self):
        return plans.DashboardInputs(self.keyed, self.dim_apps, self.dim_categories,
                                     self.stg_reviews)

    def view(self, weighting: str = "row"):
        return plans.view(self.inputs, weighting)


def _q(build: Callable[[Models], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Models(spark, sf_dir))
    run.__doc__ = build.__doc__
    return run


def _csv_roundtrip(m: Models) -> DataFrame:
    """Landed reviews exported as CSV (NULL token), read back as text, staged."""
    path = scratch_path(m.spark, "csv-roundtrip")
    export_csv(m.clean_reviews, path)
    remove_at_exit(m.spark, path)
    return plans.stg_reviews(read_seed_csv(m.spark, path, REVIEWS_COLUMNS))


def _csv_roundtrip_apps(m: Models) -> DataFrame:
    """Landed apps exported as CSV, read back as text, staged from the text."""
    path = scratch_path(m.spark, "csv-roundtrip-apps")
    export_csv(m.clean_apps, path)
    remove_at_exit(m.spark, path)
    return plans.stg_apps(read_seed_csv(m.spark, path, APPS_COLUMNS))


def _two_headers(m: Models, raw: DataFrame, header: Sequence[str], name: str) -> str:
    """Raw rows as a user's CSV folder: two sets of files, the columns of the
    second in reverse order, blanks around its names."""
    path = scratch_path(m.spark, name)
    half = raw.toDF(*header).withColumn("_half", F.expr("pmod(xxhash64(App), 2)"))
    for part, names, blank in ((0, list(header), ""), (1, list(header)[::-1], " ")):
        (half.where(f"_half = {part}").select(*[F.col(f"`{c}`").alias(f"{blank}{c}{blank}") for c in names])
         .write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                        ignoreTrailingWhiteSpace=False).mode("append").csv(path))
    remove_at_exit(m.spark, path)
    return path


def _raw_csv_apps(m: Models) -> DataFrame:
    """App listings from a folder of CSV files of different column order."""
    return read_apps_csv(m.spark, _two_headers(m, raw_apps_from_part(m.part), APPS_CSV_HEADER, "raw-apps"))


def _raw_csv_reviews(m: Models) -> DataFrame:
    """Reviews from such a folder, with a line break in every text."""
    lineitem = read_table(m.spark, m.sf_dir, "lineitem")
    raw = raw_reviews_from_lineitem(lineitem, m.part).withColumn(
        "Translated_Review", F.translate("Translated_Review", "-", "\n"))
    return read_reviews_csv(m.spark, _two_headers(m, raw, REVIEWS_COLUMNS, "raw-reviews"), multiline=True)


def _landing_refresh(m: Models) -> DataFrame:
    """Landed apps, refreshed over an empty earlier version."""
    path = scratch_path(m.spark, "landing")
    land_table(m.clean_apps.limit(0), path, schema=APPS_CLEAN, versioned=True)
    remove_at_exit(m.spark, path)
    land_table(m.clean_apps, path, schema=APPS_CLEAN, versioned=True)
    return read_current(m.spark, path)


WAREHOUSE_TABLES = ("dim_apps", "dim_categories", "fact_app_metrics", "fact_view")


def _warehouse_fact(m: Models) -> DataFrame:
    """Models as tables and a view of a database on shared storage; the
    required set is checked and the fact read back by name."""
    path = scratch_path(m.spark, "warehouse")
    db = "storelens_" + path[-12:]
    m.spark.sql(f"CREATE DATABASE {db} LOCATION '{path}'")
    dims = [materialize(df, f"{db}.{n}") for n, df in (("dim_apps", m.dim_apps),
                                                       ("dim_categories", m.dim_categories))]
    materialize(plans.fact_app_metrics(*dims, m.stg_reviews), f"{db}.fact_app_metrics")
    remove_at_exit(m.spark, path)
    m.spark.sql(f"CREATE OR REPLACE VIEW {db}.fact_view AS SELECT * FROM {db}.fact_app_metrics")
    require_tables(m.spark, WAREHOUSE_TABLES, db)
    return read_model(m.spark, f"{db}.fact_view")


def _first_price(m: Models) -> DataFrame:
    """Rating against installs with every app's first price in file order."""
    apps = plans.stg_apps(plans.clean_apps(raw_apps_from_part(m.part, position=True)))
    inputs = plans.DashboardInputs(plans.fact_app_metrics_keyed(apps, m.stg_reviews, DIGITS), m.dim_apps,
                                   m.dim_categories, m.stg_reviews)
    return _long_installs(plans.rating_vs_installs(plans.view(inputs), None, DIGITS, price="first"))


def _dq_suite(m: Models) -> DataFrame:
    return suite(m.stg_apps, unique=("source_unique_key", "app_name"),
                 not_null=("app_name", "app_size_bytes", "last_updated_date"))


def _pipeline_keyed(m: Models) -> DataFrame:
    """Full pipeline run with every model written to the shared folder; the
    keyed fact read back from its table."""
    out = scratch_path(m.spark, "pipeline")
    lineitem = read_table(m.spark, m.sf_dir, "lineitem")
    t = plans.run_pipeline(raw_apps_from_part(m.part), raw_reviews_from_lineitem(lineitem, m.part),
                           out, digits=DIGITS)
    remove_at_exit(m.spark, out)
    return _r(t["fact_app_metrics_keyed"], "avg_sentiment")


def _long_installs(df: DataFrame) -> DataFrame:
    """The library sums installs as DECIMAL(38, 0); the oracle compares BIGINT
    (the driver tables' sums fit, a larger one is an error, not a wrong number)."""
    return df.withColumn("total_installs", df["total_installs"].cast("bigint"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_apps": _q(lambda m: m.clean_apps),
    "clean_reviews": _q(lambda m: m.clean_reviews),
    "stg_apps": _q(lambda m: m.stg_apps),
    "stg_reviews": _q(lambda m: m.stg_reviews),
    "dim_apps": _q(lambda m: m.dim_apps),
    "dim_categories": _q(lambda m: m.dim_categories),
    "fact_app_metrics": _q(lambda m: _r(m.fact, "avg_sentiment")),
    "fact_app_metrics_keyed": _q(lambda m: _r(m.keyed, "avg_sentiment")),
    "top_rated": _q(lambda m: plans.top_rated(m.keyed, m.dim_apps, 5)),
    "dashboard_frame": _q(lambda m: plans.dashboard_frame(m.inputs)),
    "kpis_row": _q(lambda m: _long_installs(plans.kpis(m.view("row")))),
    "kpis_app": _q(lambda m: _long_installs(plans.kpis(m.view("app")))),
    "kpis_category": _q(lambda m: _long_installs(plans.kpis(m.view("row"), FILTER_CATEGORY))),
    "kpis_unknown": _q(lambda m: _long_installs(plans.kpis(m.view("row"), "Unknown"))),
    "top_rated_apps": _q(lambda m: plans.top_rated_apps(m.view("row"), None, 10, DIGITS)),
    "top_rated_apps_category": _q(
        lambda m: plans.top_rated_apps(m.view("row"), FILTER_CATEGORY, 10, DIGITS)),
    "rating_vs_installs": _q(
        lambda m: _long_installs(plans.rating_vs_installs(m.view("row"), None, DIGITS))),
    "rating_vs_installs_sample": _q(
        lambda m: _long_installs(plans.rating_vs_installs_sample(m.view("row"), None, 2000, digits=DIGITS))),
    "rating_vs_installs_sample_200": _q(
        lambda m: _long_installs(plans.rating_vs_installs_sample(m.view("row"), None, 200, digits=DIGITS))),
    "sentiment_distribution": _q(
        lambda m: _r(plans.sentiment_distribution(m.view("row")), "share")),
    "sentiment_distribution_category": _q(
        lambda m: _r(plans.sentiment_distribution(m.view("row"), FILTER_CATEGORY), "share")),
    "sentiment_histogram": _q(lambda m: plans.sentiment_histogram(m.fact)),
    "top_apps_by_reviews": _q(lambda m: plans.top_apps_by_reviews(m.fact, 10)),
    "top_categories_by_reviews": _q(lambda m: plans.top_categories_by_reviews(m.fact, 10)),
    "category_ratings": _q(lambda m: _r(plans.category_ratings(m.stg_apps), "average_rating")),
    "category_list": _q(lambda m: plans.category_list(m.view("row"))),
    "dq_unique_app_id": _q(lambda m: unique_violations(m.dim_apps, "app_id")),
    "dq_not_null_last_updated": _q(
        lambda m: not_null_violations(m.stg_apps, "last_updated_date")),
    "required_columns": _q(
        lambda m: ensure_columns(_r(m.fact, "avg_sentiment"), REQUIRED_FRAME_COLUMNS)
        .select(*REQUIRED_FRAME_COLUMNS)),
    "csv_roundtrip": _q(_csv_roundtrip),
    "pipeline_fact_keyed": _q(_pipeline_keyed),
    "raw_csv_apps": _q(_raw_csv_apps),
    "raw_csv_reviews": _q(_raw_csv_reviews),
    "csv_roundtrip_apps": _q(_csv_roundtrip_apps),
    "landing_refresh": _q(_landing_refresh),
    "warehouse_fact": _q(lambda m: _r(_warehouse_fact(m), "avg_sentiment")),
    "kpis_by_category": _q(lambda m: _long_installs(plans.kpis_by_category(m.view("row")))),
    "top_rated_by_category": _q(lambda m: plans.top_rated_by_category(m.view("row"), 10, DIGITS)),
    "sentiment_by_category": _q(lambda m: _r(plans.sentiment_by_category(m.view("row")), "share")),
    "sentiment_distribution_app": _q(lambda m: _r(plans.sentiment_distribution(m.view("app")), "share")),
    "top_rated_apps_app": _q(lambda m: plans.top_rated_apps(m.view("app"), None, 10, DIGITS)),
    "rating_vs_installs_app": _q(
        lambda m: _long_installs(plans.rating_vs_installs(m.view("app"), None, DIGITS))),
    "rating_vs_installs_first_price": _q(_first_price),
    "dq_suite": _q(_dq_suite),
}
