import random

import numpy as np
from pyspark.sql import functions as F

from paperloom.operators import ranking


def average_ranks(values):
    order = sorted(values)
    return [(order.index(v) + 1 + len(order) - order[::-1].index(v)) / 2 for v in values]


def test_avg_rank_with_ties_and_nulls(spark):
    rnd = random.Random(1)
    rows = [(i, "ab"[i % 2], None if i % 17 == 0 else float(rnd.choice([1, 1, 1, 2, 3.5, rnd.random()]))) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, g string, v double")
    for by in ([], ["g"]):
        got = {r.i: r["rank"] for r in ranking.avg_rank(df, by, "v").collect()}
        assert len(got) == 400
        for g in ("a", "b") if by else (None,):
            part = [r for r in rows if r[2] is not None and (g is None or r[1] == g)]
            assert [got[r[0]] for r in part] == average_ranks([r[2] for r in part])
        assert got[0] is None


def test_avg_rank_null_group_and_constant(spark):
    df = spark.createDataFrame([(None, 2.0), (None, 2.0), ("x", 2.0)], "g string, v double")
    assert sorted((r.g or "", r["rank"]) for r in ranking.avg_rank(df, ["g"], "v").collect()) == [("", 1.5), ("", 1.5), ("x", 1.0)]


def test_number_rows_sparse_sequence(spark):
    rnd = random.Random(2)
    seqs = rnd.sample(range(-5, 1 << 45), 300) + list(range(1 << 46, (1 << 46) + 50))
    rows = [(s, rnd.choice(["a", None])) for s in seqs]
    df = spark.createDataFrame(rows, "seq bigint, g string")
    for bits in (3, 20):
        got = {r.seq: r.row_no for r in ranking.number_rows(df, "seq", ["g"], chunk_bits=bits).collect()}
        for g in ("a", None):
            for i, s in enumerate(sorted(s for s, k in rows if k == g), 1):
                assert got[s] == i


def test_number_in_order(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), "id")
    got = [tuple(r) for r in ranking.number_in_order(df.repartition(5), ["a", "id"]).collect()]
    assert sorted(got) == [(a, i, n) for n, (a, i) in enumerate(sorted((i % 7, i) for i in range(1000)), 1)]
    large = spark.createDataFrame([(1 << 62, 1), (-(1 << 62), 5), (1 << 62, 0), (None, 2)], "s bigint, p int")
    assert sorted((r["row_no"], r.p) for r in ranking.number_in_order(large, ["s", "p"]).collect()) == [(1, 2), (2, 5), (3, 0), (4, 1)]


def test_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), (None, 5, "z"), (None, 6, "w")], "k string, seq int, v string")
    assert sorted(map(str, ranking.first_by(df, ["k"], "seq").collect())) == sorted(map(str, [df.collect()[1], df.collect()[2]]))
    assert {r.v for r in ranking.last_by(df, ["k"], "seq").collect()} == {"x", "w"}


def test_ranges_come_from_the_data(spark):
    """No split points are taken on the driver, and equal values share a range."""
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data fills one range
    try:
        ranged = ranking.in_ranges(df, ["v"])
        assert ranking.avg_rank(df, [], "v").agg(F.sum("rank")).first()[0] == 4000 * 4001 / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranged.select("range").distinct().count() > 1
    assert ranged.groupBy("v").agg(F.countDistinct("range").alias("n")).where("n > 1").count() == 0
    plan = ranking.avg_rank(df, [], "v")._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "SinglePartition" in plan  # the sizes of ranges are added up, nothing else


def test_cumulative_equals_numpy(spark):
    values = np.round(np.random.default_rng(0).normal(size=500), 1)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    hist = ranking.in_ranges(df.groupBy("v").agg(F.count("*").alias("n")), ["v"])
    for r in ranking.cumulative(hist, [], "v", "range").collect():
        assert r.below == int((values < r.v).sum())
