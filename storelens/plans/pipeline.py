"""The end-to-end batch run (M20): raw inputs -> landing -> staging -> marts.

Each model is written as a table under ``out_dir`` and read back before the
next layer, like a warehouse run: lineage is cut at every layer, and a lost
executor costs at most the layer being built (the finished ones sit on shared
storage).  Independent models of a layer are written concurrently.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation

from storelens.plans.ingest import clean_apps, clean_reviews
from storelens.plans.marts import (
    dim_apps,
    dim_categories,
    fact_app_metrics,
    fact_app_metrics_keyed,
    review_counts,
)
from storelens.plans.staging import stg_apps, stg_reviews
from storelens.sinks import land_table, materialize
from storelens.sources.schemas import APPS_CLEAN

MODEL_ORDER = (
    "apps_landed", "reviews_landed", "stg_apps", "stg_reviews", "review_counts",
    "dim_apps", "dim_categories", "fact_app_metrics", "fact_app_metrics_keyed",
)


def run_pipeline(raw_apps: DataFrame, raw_reviews: DataFrame, out_dir: str,
                 fmt: str = "parquet", report: dict[str, int] | None = None,
                 max_parallel: int = 4, digits: int | None = None) -> dict[str, DataFrame]:
    """Build every model; returns name -> DataFrame read from its table.

    Models of one layer do not depend on each other, so their writes are
    submitted as concurrent Spark jobs (up to ``max_parallel``), like the
    parallel ingest branches of the original DAG; layers run in order.
    ``report``, when given, receives the landed row counts, observed during
    the landing writes (no extra pass).  Every model is refreshed safely
    (``sinks.versions``): a run that dies leaves each table as it was or new.
    The staged reviews are read once, for ``review_counts``; both facts derive
    from that model.  ``digits`` rounds the keyed fact's
    mean rating exactly (``fact_app_metrics_keyed``)."""
    out = out_dir.rstrip("/")
    t: dict[str, DataFrame] = {}
    obs = {"apps_landed": Observation("apps_landed"),
           "reviews_landed": Observation("reviews_landed")}

    def layer(builders: dict[str, Callable[[], DataFrame]]) -> None:
        with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(builders)))) as pool:
            futures = {name: pool.submit(build) for name, build in builders.items()}
            for name, fut in futures.items():
                t[name] = fut.result()

    def model(name: str, df: DataFrame) -> Callable[[], DataFrame]:
        return lambda: materialize(df, name, "table", path=f"{out}/{name}", fmt=fmt, versioned=True)

    layer({
        "apps_landed": lambda: land_table(clean_apps(raw_apps), f"{out}/apps_landed",
                                          schema=APPS_CLEAN, fmt=fmt, versioned=True,
                                          observation=obs["apps_landed"]),
        "reviews_landed": lambda: land_table(clean_reviews(raw_reviews), f"{out}/reviews_landed",
                                             fmt=fmt, versioned=True,
                                             observation=obs["reviews_landed"]),
    })
    if report is not None:
        report.update({k: int(o.get["rows"]) for k, o in obs.items()})
    layer({"stg_apps": model("stg_apps", stg_apps(t["apps_landed"])),
           "stg_reviews": model("stg_reviews", stg_reviews(t["reviews_landed"]))})
    sa = t["stg_apps"]
    layer({"review_counts": model("review_counts", review_counts(t["stg_reviews"])),
           "dim_apps": model("dim_apps", dim_apps(sa)),
           "dim_categories": model("dim_categories", dim_categories(sa))})
    counts = t["review_counts"]
    layer({"fact_app_metrics_keyed": model("fact_app_metrics_keyed",
                                           fact_app_metrics_keyed(sa, None, digits, counts)),
           "fact_app_metrics": model("fact_app_metrics", fact_app_metrics(
               t["dim_apps"], t["dim_categories"], None, counts))})
    return {name: t[name] for name in MODEL_ORDER}
