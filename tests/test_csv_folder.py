"""CSV folders: files of different headers united by name, and records that
span lines read by several tasks, equal to Spark's own multi-line reader."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from storelens import plans
from storelens.sources import read_apps_csv, read_reviews_csv, read_seed_csv
from storelens.sources.csv import POSITION, header_catalogue, read_csv
from storelens.sources.schemas import APPS_COLUMNS, REVIEWS_COLUMNS
from tests.fixtures import REVIEWS


def write(path, header, rows, **kw):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, **kw)
        w.writerow(header)
        w.writerows(rows)


def test_files_of_different_headers(spark, tmp_dir):
    order = [3, 0, 4, 2, 1]
    write(f"{tmp_dir}/a.csv", REVIEWS_COLUMNS, REVIEWS[:3])
    write(f"{tmp_dir}/b.csv", [f" {REVIEWS_COLUMNS[i]} " for i in order] + ["Extra"],
          [[r[i] for i in order] + ["x"] for r in REVIEWS[3:]])
    open(f"{tmp_dir}/empty.csv", "w").close()
    write(f"{tmp_dir}/none.csv", REVIEWS_COLUMNS[::-1], [])
    assert len(header_catalogue(spark, f"{tmp_dir}/*.csv")) == 3
    got = read_reviews_csv(spark, tmp_dir)
    assert got.columns == [*REVIEWS_COLUMNS, "Extra"]
    write(f"{tmp_dir}-one.csv", REVIEWS_COLUMNS, REVIEWS)
    want = read_reviews_csv(spark, f"{tmp_dir}-one.csv")
    key = lambda df: sorted(map(tuple, df.select(*REVIEWS_COLUMNS).collect()), key=str)
    assert key(got) == key(want)
    assert got.where("Extra = 'x'").count() == len(REVIEWS) - 3


def test_missing_column(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", APPS_COLUMNS, [["v"] * 13])
    write(f"{tmp_dir}/b.csv", APPS_COLUMNS[:-1], [["w"] * 12])
    with pytest.raises(ValueError, match="b.csv.*Android_Ver"):
        read_apps_csv(spark, tmp_dir)
    rows = read_apps_csv(spark, tmp_dir, missing="null").collect()
    assert {(r.App, r.Android_Ver) for r in rows} == {("v", "v"), ("w", None)}
    with pytest.raises(ValueError):
        read_apps_csv(spark, tmp_dir, missing="maybe")
    os.makedirs(f"{tmp_dir}/no")
    open(f"{tmp_dir}/no/x.csv", "w").close()
    assert read_apps_csv(spark, f"{tmp_dir}/no", position=True).count() == 0


def odd_rows(n, seed=5):
    rng = random.Random(seed)
    parts = ["a", "b c", '"', '""', "\n", "\r\n", ",", "é🙂", "", " ", "\n\n", "x" * 50, "\\"]
    return [[f"row {i}", "".join(rng.choices(parts, k=rng.randrange(0, 9))),
             "".join(rng.choices(parts, k=3)), str(i), ""] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_spanning_records_in_many_tasks(spark, tmp_dir, end):
    write(f"{tmp_dir}/a.csv", REVIEWS_COLUMNS, odd_rows(4000), lineterminator=end)
    long = [["start", "y\n" * 40_000, "z", "1", ""], ["end", 'q "\n" q', "z", "2", ""]]
    write(f"{tmp_dir}/b.csv", REVIEWS_COLUMNS[::-1], [r[::-1] for r in odd_rows(300, 6) + long], lineterminator=end)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_reviews_csv(spark, tmp_dir, multiline=True, position=True)
        tasks = df.select(F.spark_partition_id().alias("p"), POSITION).groupBy(f"{POSITION}.file").agg(
            F.countDistinct("p").alias("n")).collect()
        got = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert max(r.n for r in tasks) > 5  # one file, several tasks
    rows = [r for _, r in sorted((tuple(r[POSITION]), tuple(r)[:5]) for r in got)]
    want = []  # as written: what pandas and Python's reader give
    for name, step in (("a", 1), ("b", -1)):
        with open(f"{tmp_dir}/{name}.csv", newline="", encoding="utf-8") as f:
            want += [tuple(x or None for x in r[::step]) for r in list(csv.reader(f))[1:]]
    assert rows == want  # in file order, too
    if end == "\n":  # Spark's own reader rewrites line ends inside quotes otherwise
        own = [spark.read.options(header=True, quote='"', escape='"', multiLine=True,
                                  ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
               .csv(f"{tmp_dir}/{f}.csv").select(*REVIEWS_COLUMNS).collect() for f in "ab"]
        assert rows == [tuple(r) for part in own for r in part]


def test_plain_files_take_the_plain_reader(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", ["a", "b"], [["1", 'say "x"'], ["2", "NULL"]])
    df = read_seed_csv(spark, f"{tmp_dir}/a.csv", ["a", "b"])
    assert "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, df.collect())) == [("1", 'say "x"'), ("2", None)]


def test_position_orders_rows_as_written(spark, tmp_dir):
    write(f"{tmp_dir}/b.csv", ["a"], [[str(i)] for i in range(5000)])
    write(f"{tmp_dir}/c.csv", ["a"], [[str(i)] for i in range(5000, 5010)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        df = read_csv(spark, tmp_dir, ["a"], position=True)
        assert [r.a for r in df.orderBy(POSITION).collect()] == [str(i) for i in range(5010)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_clean_reads_position_free(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", REVIEWS_COLUMNS, REVIEWS)
    assert plans.clean_reviews(read_reviews_csv(spark, tmp_dir, multiline=True)).count() == 6
