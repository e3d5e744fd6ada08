"""Operators: expansion, top-k, sampling, histograms, quality checks."""

from pyspark.sql import functions as F

from storelens import operators as op
from storelens.plans import example_filtered, example_union


def test_expand_rows_exact_counts_with_chunking(spark):
    df = spark.createDataFrame([("hot", 2503), ("cold", 1), ("none", 0), ("neg", -2)],
                               "k string, n bigint")
    out = op.expand_rows(df, "n", chunk_rows=100, partitions=7)
    counts = {r.k: r["count"] for r in out.groupBy("k").count().collect()}
    assert counts == {"hot": 2503, "cold": 1}
    assert out.columns == ["k"]
    assert out.rdd.getNumPartitions() == 7


def test_expand_rows_spreads_hot_group(spark):
    df = spark.createDataFrame([("hot", 4000)], "k string, n bigint")
    out = op.expand_rows(df, "n", chunk_rows=500, partitions=8)
    sizes = out.rdd.glom().map(len).collect()
    assert sum(sizes) == 4000
    assert max(sizes) <= 4000 - 500  # more than one task did the work


def test_top_k_total_order(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "k string, v double")
    got = [r.k for r in op.top_k(df, 3, [F.col("v").desc_nulls_last()], ["k"]).collect()]
    assert got == ["d", "a", "b"]
    got = [r.k for r in op.top_k(df, 10, [F.col("v").desc_nulls_last()], ["k"]).collect()]
    assert got == ["d", "a", "b", "c"]


def test_exact_sample_size_and_determinism(spark):
    df = spark.range(5000).withColumn("k", F.col("id").cast("string"))
    a = op.exact_sample(df, 200, ["k"], seed=7)
    b = op.exact_sample(df.repartition(13), 200, ["k"], seed=7)
    ka = sorted(r.k for r in a.collect())
    assert len(ka) == 200 and len(set(ka)) == 200
    assert ka == sorted(r.k for r in b.collect())
    assert op.exact_sample(df.limit(50), 200, ["k"]).count() == 50


def test_histogram_edges_and_clamp(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.14,), (1.0,), (0.999,), (None,), (1.5,)], "x double")
    # 0.14 * 20 < 3 -> bin 2 (note 0.15 * 20 = 3.0000000000000004 -> bin 3 in IEEE doubles)
    got = sorted((r.bin, r.bin_start, r.bin_end, r.n)
                 for r in op.equal_width_histogram(df, "x", 20).collect())
    assert got == [(0, 0.0, 0.05, 1), (1, 0.05, 0.1, 1), (2, 0.1, 0.15, 1), (19, 0.95, 1.0, 3)]


def test_value_counts_and_share(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    vc = op.value_counts(df, "s")
    assert [(r.s, r.n) for r in vc.collect()] == [("a", 2), ("b", 1)]
    shares = {r.s: r.share for r in op.with_share(vc).collect()}
    assert abs(sum(shares.values()) - 1.0) < 1e-12


def test_weighted_mean_and_sum(spark):
    df = spark.createDataFrame([(1.0, 3), (4.0, 1), (None, 5)], "v double, w bigint")
    r = df.agg(op.weighted_mean("v", "w").alias("m"), op.weighted_sum("v", "w").alias("s")).first()
    assert r.m == 7.0 / 4 and r.s == 7.0
    empty = df.where("w > 100").agg(op.weighted_mean("v", "w").alias("m"),
                                     op.weighted_sum("v", "w").alias("s")).first()
    assert empty.m is None and empty.s == 0


def test_unique_and_not_null_on_starter_rows(spark):
    rows = example_union(spark)
    assert sorted(r.id for r in rows.collect() if r.id is not None) == [1]
    assert op.unique_violations(rows, "id").count() == 0
    assert op.not_null_violations(rows, "id").count() == 1
    filtered = example_filtered(rows)
    assert [r.id for r in filtered.collect()] == [1]
    assert op.not_null_violations(filtered, "id").count() == 0
    dup = rows.unionByName(rows)
    assert [(r.unique_field, r.n_records) for r in op.unique_violations(dup, "id").collect()] == [(1, 2)]


def test_ensure_columns_defaults(spark):
    df = spark.createDataFrame([("x", 3)], "app_name string, total_reviews bigint")
    req = ["app_name", "category_name", "average_user_rating", "total_installs",
           "total_reviews", "price", "review_sentiment", "app_size_mb"]
    out = op.ensure_columns(df, req).select(*req).first()
    assert tuple(out) == ("x", "Unknown", 0.0, 0, 3, 0.0, None, 0.0)
    assert op.has_columns(df, ["app_name"]) and not op.has_columns(df, ["price"])


def test_is_empty(spark):
    assert op.is_empty(spark.range(0))
    assert not op.is_empty(spark.range(3))


def test_distinct_on_groups_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", 1)], "k string, v int")
    assert op.distinct_on(df, ["k", "v"]).count() == 2


def test_exact_sample_matches_md5_ranking_in_duckdb(spark):
    import duckdb
    names = [f"app {i}" for i in range(400)]
    df = spark.createDataFrame([(n,) for n in names], "app_name string")
    got = sorted(r.app_name for r in op.exact_sample(df, 50, ["app_name"], seed=0).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE t(app_name VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(n,) for n in names])
    exp = sorted(r[0] for r in con.execute(
        "SELECT app_name FROM t ORDER BY md5(concat_ws('|', '0', app_name)), app_name LIMIT 50"
    ).fetchall())
    assert got == exp


def test_rounded_mean_is_exact_on_halves(spark):
    # the mean is exactly 2.8203125: half-up gives 2.820313 whatever the row order
    rows = [(2.820312, 1), (2.820313, 1)] * 3 + [(None, 7)]
    for part in (1, 3, 8):
        df = spark.createDataFrame(rows, "v double, w bigint").repartition(part)
        r = df.agg(op.rounded_mean("v", "w", 6).alias("m"),
                   op.rounded_mean("v", "w", 2).alias("m2")).first()
        assert (r.m, r.m2) == (2.820313, 2.82)
    neg = spark.createDataFrame([(-0.125, 1), (-0.135, 1)], "v double, w bigint")
    assert neg.agg(op.rounded_mean("v", "w", 2)).first()[0] == -0.13
    empty = spark.createDataFrame([(None, 1)], "v double, w bigint")
    assert empty.agg(op.rounded_mean("v", "w", 2)).first()[0] is None


def test_installs_beyond_bigint_are_summed_and_shown(spark):
    from storelens import plans

    rows = [("a", "G", 0.0, 4.0, 5_000_000_000, 2_000_000_000),
            ("b", "G", 0.0, 2.0, 5_000_000_000, 2_000_000_000)]
    apps = spark.createDataFrame(rows, "app_name string, category_name string, price double,"
                                       " average_user_rating double, total_installs bigint, weight bigint")
    sentiments = spark.createDataFrame([], "app_name string, category_name string,"
                                           " review_sentiment string, weight bigint")
    v = plans.FrameView(apps, sentiments)
    k = plans.kpis(v).first()
    assert int(k.total_installs) == 2 * 10 ** 19
    assert k.installs_display == "20000000000.0B"
    assert {int(r.total_installs) for r in plans.rating_vs_installs(v).collect()} == {10 ** 19}
