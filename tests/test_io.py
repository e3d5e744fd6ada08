"""Sources, sinks, streaming landing, pipeline and catalog."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Observation

from storelens import plans
from storelens.sinks import export_csv, land_table, materialize
from storelens.sources import (
    list_tables,
    missing_tables,
    read_apps_csv,
    read_reviews_csv,
    read_seed_csv,
)
from storelens.sources.schemas import APPS_CLEAN, APPS_CSV_HEADER, REVIEWS_COLUMNS
from storelens.streaming import stream_landing
from tests.fixtures import APPS, REVIEWS, Golden, raw_apps, raw_reviews

APPS_HEADER = ('App, Category ,Rating,Reviews,Size,Installs,Type,Price,"Content Rating",Genres,'
               '"Last Updated","Current Ver","Android Ver"')


def _csv_field(v):
    if v is None:
        return ""
    if any(ch in v for ch in ',"\n') or v != v.strip():
        return '"' + v.replace('"', '""') + '"'
    return v


def write_apps_csv(path, header=APPS_HEADER):
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n")
        for row in APPS:
            f.write(",".join(_csv_field(v) for v in row) + "\n")


def write_reviews_csv(path):
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(REVIEWS_COLUMNS) + "\n")
        for row in REVIEWS:
            f.write(",".join(_csv_field(v) for v in row) + "\n")


def test_csv_sources_match_golden_frames(spark, tmp_dir):
    write_apps_csv(os.path.join(tmp_dir, "apps.csv"))
    write_reviews_csv(os.path.join(tmp_dir, "reviews.csv"))
    apps = read_apps_csv(spark, os.path.join(tmp_dir, "apps.csv"))
    assert apps.columns[:3] == ["App", "Category", "Rating"]
    assert "Content_Rating" in apps.columns and "Android_Ver" in apps.columns
    a = sorted(map(tuple, plans.clean_apps(apps).collect()), key=str)
    b = sorted(map(tuple, plans.clean_apps(raw_apps(spark)).collect()), key=str)
    assert a == b
    rev = read_reviews_csv(spark, os.path.join(tmp_dir, "reviews.csv"))
    a = sorted(map(tuple, plans.clean_reviews(rev).collect()), key=str)
    b = sorted(map(tuple, plans.clean_reviews(raw_reviews(spark)).collect()), key=str)
    assert a == b


def test_csv_export_roundtrip_and_empty_header(spark, tmp_dir):
    g = Golden(spark)
    path = os.path.join(tmp_dir, "seed")
    export_csv(g.clean_reviews, path)
    back = plans.stg_reviews(read_seed_csv(spark, path, REVIEWS_COLUMNS))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, g.stg_reviews.collect()), key=str)
    empty = os.path.join(tmp_dir, "empty")
    export_csv(g.clean_reviews.limit(0), empty)
    parts = [p for p in os.listdir(empty) if p.endswith(".csv")]
    assert len(parts) == 1
    with open(os.path.join(empty, parts[0])) as f:
        assert f.read().strip() == ",".join(REVIEWS_COLUMNS)


def test_land_table_full_refresh_and_observed_count(spark, tmp_dir):
    g = Golden(spark)
    target = os.path.join(tmp_dir, "apps_landed")
    obs = Observation("rows")
    landed = land_table(g.clean_apps, target, schema=APPS_CLEAN, observation=obs)
    assert obs.get["rows"] == 6 and landed.count() == 6
    assert landed.schema == APPS_CLEAN or [f.dataType for f in landed.schema] == [
        f.dataType for f in APPS_CLEAN]
    again = land_table(g.clean_apps, target, schema=APPS_CLEAN)
    assert again.count() == 6  # idempotent
    emptied = land_table(g.clean_apps.limit(0), target, schema=APPS_CLEAN)
    assert emptied.count() == 0  # an empty frame leaves an empty table


def test_materialize_view_and_catalog(spark):
    g = Golden(spark)
    v = materialize(g.dim_categories, "dim_categories_test", "view")
    assert v.count() == 3
    assert "dim_categories_test" in list_tables(spark)
    assert missing_tables(spark, {"dim_categories_test", "nope_table"}) == {"nope_table"}


def test_pipeline_writes_every_model(spark, tmp_dir):
    report = {}
    t = plans.run_pipeline(raw_apps(spark), raw_reviews(spark), os.path.join(tmp_dir, "wh"),
                           report=report)
    assert report == {"apps_landed": 6, "reviews_landed": 6}
    assert {k: t[k].count() for k in ("stg_apps", "stg_reviews", "dim_apps", "dim_categories",
                                      "fact_app_metrics", "fact_app_metrics_keyed")} == {
        "stg_apps": 6, "stg_reviews": 6, "dim_apps": 5, "dim_categories": 3,
        "fact_app_metrics": 5, "fact_app_metrics_keyed": 4}
    for name in plans.pipeline.MODEL_ORDER:
        assert os.path.isdir(os.path.join(tmp_dir, "wh", name))


def test_streaming_landing_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "drops")
    os.makedirs(src)
    header = ",".join(APPS_CSV_HEADER)  # a stream checks the header as it is
    write_apps_csv(os.path.join(src, "part-1.csv"), header)
    out, ckpt = os.path.join(tmp_dir, "landed"), os.path.join(tmp_dir, "ckpt")
    q = stream_landing(spark, src, "apps", out, ckpt)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 6
    # a second drop is picked up incrementally; the first is not re-read
    write_apps_csv(os.path.join(src, "part-2.csv"), header)
    stream_landing(spark, src, "apps", out, ckpt).awaitTermination(120)
    assert spark.read.parquet(out).count() == 12


def test_streaming_rejects_another_header(spark, tmp_dir):
    src = os.path.join(tmp_dir, "drops")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write(",".join(REVIEWS_COLUMNS[::-1]) + "\n0.5,0.5,Positive,txt2,A2\n")
    out = os.path.join(tmp_dir, "landed")
    with pytest.raises(StreamingQueryException):
        stream_landing(spark, src, "reviews", out, os.path.join(tmp_dir, "c")).awaitTermination(120)
    assert not [f for f in os.listdir(out) if f.endswith(".parquet")]  # nothing was landed


def test_multiline_quoted_fields(spark, tmp_dir):
    path = os.path.join(tmp_dir, "reviews_ml.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(REVIEWS_COLUMNS) + "\n")
        f.write('Alpha,"great app,\nworks ""fine""",Positive,0.5,0.5\n')
        f.write("Beta,ok,Neutral,0,0\n")
    rows = read_reviews_csv(spark, path, multiline=True).collect()
    assert [r.App for r in rows] == ["Alpha", "Beta"]
    assert rows[0].Translated_Review == 'great app,\nworks "fine"'
    # exported again and read back, the embedded newline and quotes survive
    out = os.path.join(tmp_dir, "ml_export")
    export_csv(plans.clean_reviews(read_reviews_csv(spark, path, multiline=True)), out)
    back = read_seed_csv(spark, out, REVIEWS_COLUMNS).orderBy("App").collect()
    assert back[0].Translated_Review == 'great app,\nworks "fine"'


def test_streaming_landing_reviews(spark, tmp_dir):
    src = os.path.join(tmp_dir, "review_drops")
    os.makedirs(src)
    write_reviews_csv(os.path.join(src, "part-1.csv"))
    out, ckpt = os.path.join(tmp_dir, "reviews_landed"), os.path.join(tmp_dir, "ckpt_r")
    stream_landing(spark, src, "reviews", out, ckpt).awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
    exp = sorted(map(tuple, plans.clean_reviews(raw_reviews(spark)).collect()), key=str)
    assert got == exp


def test_command_line_pipeline_and_reports(spark, tmp_dir, capsys):
    from storelens.__main__ import main
    write_apps_csv(os.path.join(tmp_dir, "apps.csv"))
    write_reviews_csv(os.path.join(tmp_dir, "reviews.csv"))
    wh = os.path.join(tmp_dir, "warehouse")
    assert main(["pipeline", "--apps", os.path.join(tmp_dir, "apps.csv"),
                 "--reviews", os.path.join(tmp_dir, "reviews.csv"), "--out", wh]) == 0
    assert main(["top-rated", "--warehouse", wh]) == 0
    assert main(["report", "--warehouse", wh, "--category", "GAME"]) == 0
    out = capsys.readouterr().out
    assert "landed 6 apps and 6 reviews" in out
    assert "Alpha" in out and "== kpis" in out and "== sentiment_distribution" in out


def test_apps_csv_is_read_by_header_name(spark, tmp_dir):
    # same rows, columns in another order: the result must not change
    import csv
    src = os.path.join(tmp_dir, "apps.csv")
    write_apps_csv(src)
    with open(src, newline="", encoding="utf-8") as f:
        rows = list(csv.reader(f))
    order = list(reversed(range(len(rows[0]))))
    shuffled = os.path.join(tmp_dir, "apps_reordered.csv")
    with open(shuffled, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        for r in rows:
            w.writerow([r[i] for i in order])
    a = sorted(map(tuple, plans.clean_apps(read_apps_csv(spark, src)).collect()), key=str)
    b = sorted(map(tuple, plans.clean_apps(read_apps_csv(spark, shuffled)).collect()), key=str)
    assert a == b


def test_export_keeps_blanks_and_column_order_is_free(spark, tmp_dir):
    from storelens.sinks import export_csv
    from storelens.sources import read_seed_csv
    from storelens.sources.csv import read_apps_csv
    from storelens.sources.schemas import APPS_COLUMNS

    rows = [(" lead", "  text  "), ("\tq", 'a "b"\nc')]
    export_csv(spark.createDataFrame(rows, "a string, b string"), f"{tmp_dir}/x")
    assert sorted(map(tuple, read_seed_csv(spark, f"{tmp_dir}/x", ["a", "b"]).collect())) == sorted(rows)
    for n, cols in (("1", APPS_COLUMNS), ("2", APPS_COLUMNS[::-1])):
        with open(f"{tmp_dir}/{n}.csv", "w") as f:
            f.write(",".join(cols) + "\n" + ",".join(f"v{c}" for c in cols) + "\n")
    rows = read_apps_csv(spark, f"{tmp_dir}/*.csv").collect()
    assert [tuple(r) for r in rows] == [tuple(f"v{c}" for c in APPS_COLUMNS)] * 2
