import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.functions.tails import chi2_tail, deviate_of_p, two_sided_p
from paperloom.operators import fidelity, meta, profile


def effects(spark, entity_rows):
    rows = [(e, float(y) if y is not None else None, float(v) if v is not None else None) for e, pairs in entity_rows.items() for y, v in pairs]
    return spark.createDataFrame(rows, "entity string, yi double, vi double")


PAIRS = {
    "four": [(1.0, 0.05), (1.2, 0.06), (0.8, 0.07), (1.1, 0.05)], "one": [(0.4, 0.1)], "bad": [(1.0, 0.0), (2.0, None), (float("nan"), 1.0), (1.0, float("inf"))],
    "null": [(None, 0.1), (1.0, 0.1)], "same": [(0.5, 0.2), (0.5, 0.2)], "wide": [(5.0, 0.01), (-5.0, 0.02), (1.0, 0.03)],
}


def reference(pairs):
    y, v = (np.array(x, float) for x in zip(*pairs))
    w = 1 / v
    theta = (w * y).sum() / w.sum()
    q, df, c = (w * (y - theta) ** 2).sum(), len(y) - 1, w.sum() - (w**2).sum() / w.sum()
    tau2 = max(0.0, (q - df) / c) if c > 0 else 0.0
    wr = 1 / (v + tau2)
    return theta, (wr * y).sum() / wr.sum(), q, tau2, math.sqrt(1 / wr.sum())


def test_meta_analysis(spark):
    got = {r.entity: r for r in meta.meta_analyze(effects(spark, PAIRS)).collect()}
    assert set(got) == set(PAIRS)
    four = got["four"]
    assert four.k == 4 and round(four.random_estimate, 3) == 1.035 and four.p < 0.001 and four.error is None
    for name in ("four", "wide", "same"):
        theta, random_, q, tau2, se = reference(PAIRS[name])
        r = got[name]
        assert np.allclose([r.fixed_estimate, r.random_estimate, r.q, r.tau2, r.random_se], [theta, random_, q, tau2, se], rtol=1e-12)
        assert np.isclose(r.p, math.erfc(abs(random_ / se) / math.sqrt(2)), rtol=1e-10)
    assert np.isclose(got["wide"].q_p, math.exp(-got["wide"].q / 2), rtol=1e-9)  # two degrees of freedom
    assert got["one"].q_p is None and got["one"].tau2 == 0.0 and got["one"].i2 == 0.0
    assert got["bad"].k == 0 and got["bad"].error == meta.NO_STUDY and got["bad"].fixed_estimate is None
    assert got["null"].error == meta.MISSING_EFFECT and got["null"].k == 0
    assert meta.meta_summary(meta.meta_analyze(effects(spark, PAIRS), tails=False)).first().asDict() == {"n_entities": 6, "n_succeeded": 4, "n_failed": 2}


def test_variance_sources(spark):
    rows = [("a", 0.5, None, 0.2, None), ("b", 0.5, None, None, 0.01), ("c", 0.5, 0.3, 9.0, 0.5), ("d", 0.5, None, None, 0.0), ("e", 0.5, None, None, 1.0), ("f", 1.0, None, None, None)]
    df = spark.createDataFrame(rows, "entity string, yi double, vi double, se double, p double")
    c = F.col
    got = {r[0]: r[1] for r in df.select("entity", meta.resolve_variance(c("yi"), c("vi"), c("se"), c("p"))).collect()}
    z = NormalDist().inv_cdf(1 - 0.005)
    assert np.isclose(got["a"], 0.04) and np.isclose(got["b"], (0.5 / z) ** 2, rtol=1e-9) and got["c"] == 0.3 and got["f"] is None
    assert np.isclose(math.erfc(0.5 / math.sqrt(got["d"]) / math.sqrt(2)), 1e-300, rtol=1e-8) and got["e"] > 1e10


def test_alias_columns(spark):
    df = spark.createDataFrame([("g", 1.0, None, 0.2), ("g", None, 0.3, None)], "gene string, log2fc double, effect double, standard_error double")
    assert [tuple(r) for r in meta.with_aliases(df, "gene").collect()] == [("g", 1.0, None, 0.2, None), ("g", 0.3, None, None, None)]


def chi_square_by_hand(q, df):
    """The finite sum, with exact fractions of factorials from lgamma."""
    x = q / 2
    if q <= 0:
        return 1.0
    half = df % 2 / 2
    total = math.fsum(math.exp((i + half) * math.log(x) - x - math.lgamma(i + 1 + half)) for i in range(df // 2))
    return total + (math.erfc(math.sqrt(x)) if df % 2 else 0.0)


def test_chi_square_tail(spark):
    rows = [(float(q), df) for df in (1, 2, 3, 4, 7, 10, 11, 31, 100, 101, 1000, 4001) for q in (0.0, 1e-6, 0.3, 1.0, df * 0.5, df * 0.9, float(df), df * 1.1, df * 1.5, df + 40.0, 3000.0)]
    points = [(3.841459, 1), (5.991465, 2), (7.814728, 3), (18.307038, 10), (19.675138, 11), (124.342113, 100), (1074.679449, 1000)]
    df = spark.createDataFrame(rows + points, "q double, df bigint").withColumn("t", chi2_tail(F.col("q"), F.col("df")))
    got = df.collect()
    for r in got[: len(rows)]:
        assert abs(r.t - chi_square_by_hand(r.q, r.df)) < 1e-11, r
    assert all(abs(r.t - 0.05) < 1e-6 for r in got[len(rows) :])
    far = spark.createDataFrame([(900.0, 5.0), (1e6, 1e6), (4.0, 0.0), (None, 3.0), (float("nan"), 2.0)], "q double, df double").withColumn("df", F.col("df").cast("bigint"))
    out = [r[0] for r in far.select(chi2_tail(F.col("q"), F.col("df"))).collect()]
    assert 0 <= out[0] < 1e-180 and abs(out[1] - 0.5) < 1e-3 and out[2:] == [None, None, None]


def test_normal_tail_and_deviate(spark):
    z = [0.0, 1e-9, 0.1, -0.7, 1.0, 1.96, 2.49, 2.5, 2.51, -3.3, 5.0, 8.0, 20.0, 37.0, 45.0]
    df = spark.createDataFrame([(v,) for v in z] + [(None,), (float("nan"),)], "z double").select(two_sided_p("z"))
    got = [r[0] for r in df.collect()]
    assert all(abs(g - math.erfc(abs(v) / math.sqrt(2))) <= 1e-12 * math.erfc(abs(v) / math.sqrt(2)) + 1e-300 for g, v in zip(got, z)) and got[-2:] == [None, None]
    p = [1.0, 0.999, 0.5, 0.15, 0.05, 1e-3, 1e-10, 1e-11, 1e-50, 1e-299, 0.0, 2.0]
    df = spark.createDataFrame([(v,) for v in p] + [(None,), (float("nan"),)], "p double").select(deviate_of_p(F.col("p")))
    got = [r[0] for r in df.collect()]
    want = [-NormalDist().inv_cdf(min(max(v, 1e-300), 1 - 1e-12) / 2) for v in p]
    assert np.allclose(got[:-2], want, rtol=1e-12, atol=1e-15) and got[-2:] == [None, None]


def matrix(spark, rows, extra=""):
    return spark.createDataFrame(rows, "feature_id string, sample string, value double" + extra)


def ranks(v):
    s = sorted(v)
    return np.array([(s.index(x) + 1 + len(s) - s[::-1].index(x)) / 2 for x in v])


def test_quantitative_agreement(spark):
    rnd = random.Random(0)
    a = [(f"f{i}", s, rnd.choice([None, 0.0, 2.0 ** rnd.randrange(8)])) for i in range(60) for s in ("s1", "s2", "only_a")]
    b = [(f"f{i}", s, rnd.choice([None, 2.0 ** rnd.randrange(8), rnd.random() * 50])) for i in range(20, 80) for s in ("s1", "s2")]
    got = {r.reproduced_sample: r for r in fidelity.compare_quantitative(matrix(spark, a), matrix(spark, b), seq="feature_id").collect()}
    assert set(got) == {"s1", "s2", None}
    right = {(f, s): v for f, s, v in b}
    for sample in got:
        pairs = [(math.log2(v), math.log2(right[f, s])) for f, s, v in a if (sample is None or s == sample) and v and right.get((f, s))]
        x, y = map(np.array, zip(*pairs))
        assert got[sample].n == len(pairs)
        assert np.isclose(got[sample].pearson, np.corrcoef(x, y)[0, 1], rtol=1e-10)
        assert np.isclose(got[sample].spearman, np.corrcoef(ranks(list(x)), ranks(list(y)))[0, 1], rtol=1e-10)


def test_quantitative_edge_cases(spark):
    a = matrix(spark, [("f1", "s", 1.0), ("f2", "s", 1.0), ("f1", "t", 4.0), ("f1", "u", -1.0)])
    got = {r.reproduced_sample: r for r in fidelity.compare_quantitative(a, a, seq="feature_id").collect()}
    assert got["s"].n == 2 and got["s"].pearson is None and got["s"].spearman is None
    assert got["t"].n == 1 and got["t"].pearson is None and got["u"].n == 0
    twice = matrix(spark, [("f1", "s", 1.0, 1), ("f1", "s", 8.0, 2), ("f2", "s", 2.0, 3)], ", seq int")
    kept = {r.feature_id: r.x for r in fidelity.sample_pairs(twice, twice, seq="seq").collect()}
    assert kept == {"f1": 3.0, "f2": 1.0}
    mapped = fidelity.sample_pairs(a, a, {"s": "t"}, log=False, seq="feature_id").collect()
    assert [(r.feature_id, r.x, r.y) for r in mapped] == [("f1", 1.0, 4.0)]


def deps(spark, rows):
    return spark.createDataFrame(rows, "feature_id string, log2fc double, pvalue double, padj double, significant boolean, seq int")


def test_dep_decomposition(spark):
    rep = deps(spark, [("a", 1.0, 0.9, 0.9, True, 1), ("a", -1.0, 0.9, 0.9, False, 2), ("b", -1.0, 0.01, None, None, 3), ("c", 1.0, 0.5, 0.5, None, 4), ("z", 0.0, 0.01, 0.01, None, 5)])
    pub = deps(spark, [("a", 2.0, 0.01, 0.01, None, 1), ("b", 1.0, 0.01, 0.01, None, 2), ("c", 1.0, 0.01, 0.01, None, 3), ("d", 1.0, 0.01, 0.01, None, 4),
                       ("e", 1.0, 0.01, 0.01, None, 5), ("z", 0.0, None, 0.01, None, 6), ("n", 1.0, 0.9, 0.9, None, 7)])
    quantified = spark.createDataFrame([("e",), ("zz",)], "feature_id string")
    buckets = {r.feature_id: r.bucket for r in fidelity.dep_buckets(rep, pub, quantified, seq="seq").collect()}
    assert buckets == {"a": "concordant", "b": "significant_different_direction", "c": "quantified_not_significant", "d": "not_quantified",
                       "e": "quantified_not_significant", "z": "significant_different_direction", "n": None, "zz": None}
    row = fidelity.compare_dep(rep, pub, quantified, seq="seq").first()
    assert (row.n_shared_significant, row.n_direction_agree, row.n_direction_disagree, row.not_quantified) == (3, 1, 2, 1)
    assert row.overlap_pct_of_published == 50.0
    strict = fidelity.compare_dep(rep, pub, lfc=1.5, seq="seq").first()
    assert strict.n_published_significant == 1
    none = fidelity.compare_dep(rep.limit(0), pub.limit(0), seq="seq").first()
    assert none.jaccard_significant == 0.0 and none.overlap_pct_of_published == 0.0


def test_report_sections(spark):
    a = matrix(spark, [("f1", "s", 1.0), ("f2", "s", 2.0), ("f3", "s", 5.0)])
    d = deps(spark, [("f1", 1.0, 0.01, 0.01, None, 1)])
    sections, notes = fidelity.fidelity_report(a, a, d, None, a, a, matrix_seq="feature_id")
    assert set(sections) == {"identification", "quantitative", "version"} and len(notes) == 1
    assert sections["version"].first().asDict() == {"label_a": "version_a", "label_b": "version_b", "n_a": 3, "n_b": 3, "n_shared": 3, "n_gained": 0, "n_lost": 0, "jaccard": 1.0}
    row = fidelity.report_row(sections).first()
    assert row.analysis_type == "fidelity" and '"identification":{"jaccard":1.0,"n_shared":3}' in row.parameters_json.replace("1.0E0", "1.0").replace(":1,", ":1.0,")
    assert fidelity.report_row({}) is None
    empty = fidelity.compare_identifications(a.limit(0), a.limit(0)).first()
    assert empty.jaccard == 0.0


def test_profile(spark):
    rows = [(i, float(i) if i % 5 else None, float("nan") if i % 7 == 0 else 1.5, "treated" if i % 2 else "control", i % 3 == 0, [i], "x" * 200 + str(i % 2)) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, v double, n double, grp string, flag boolean, arr array<bigint>, long string")
    got = {r.name: r for r in profile.profile_table(df).collect()}
    v = [float(i) for i in range(100) if i % 5]
    assert (got["v"].non_null, got["v"].null_count, got["v"].n_unique, got["v"].min, got["v"].max) == (80, 20, 80, 1.0, 99.0)
    assert np.isclose(got["v"].median, np.median(v)) and np.isclose(got["v"].std, np.std(v, ddof=1)) and np.isclose(got["v"].mean, np.mean(v))
    assert (got["n"].non_null, got["n"].n_unique, got["n"].max) == (85, 1, 1.5)
    assert got["flag"].is_numeric and got["flag"].mean == 0.34 and got["flag"].median == 0.0 and not got["flag"].top_values
    assert [(t.value, t["count"]) for t in got["grp"].top_values] == [("control", 50), ("treated", 50)]
    assert got["arr"].n_unique == -1 and got["arr"].top_values == []
    assert got["long"].n_unique == 2 and all(len(t.value) == 80 and t.value.endswith("…") for t in got["long"].top_values)


def test_profile_caps_and_infinite(spark):
    df = spark.createDataFrame([(1, float("inf"), "a"), (2, 1.0, "b")], "a int, b double, c string")
    got = {r.name: r for r in profile.profile_table(df, max_columns=2).collect()}
    assert set(got) == {"a", "b"} and got["b"].max is None and got["b"].min == 1.0 and got["b"].mean is None
    head = profile.table_header(df, max_columns=2, max_scan_rows=2).first()
    assert head.rows_truncated and head.n_columns_described == 2 and "first 2 of 3" in head.notes[1]
    assert not profile.table_header(df, max_scan_rows=3).first().rows_truncated
    assert profile.example_rows(df, max_example_rows=1, max_cell_chars=10).count() == 1
    empty = profile.profile_table(df.limit(0)).collect()
    assert [r.n_unique for r in empty] == [0, 0, 0] and empty[0].min is None


def test_profile_counts_decimals_and_wide_tables(spark):
    df = spark.sql("SELECT CAST(x AS DECIMAL(38,20)) AS d FROM VALUES ('1.00000000000000000001'), ('1.00000000000000000002'), ('1.00000000000000000003'), ('1.00000000000000000003') AS t(x)")
    assert profile.profile_table(df).first().n_unique == 3
    wide = spark.range(3).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(120)])
    assert profile.profile_table(wide).count() == 120
    assert profile.table_header(wide).first().n_columns_described == 120 and len(profile.example_rows(wide).columns) == 120


def test_profile_keeps_all_digits(spark):
    rows = [("12345678901234567890.00000001", 9007199254740993), ("12345678901234567890.00000002", 9007199254740992), ("12345678901234567890.00000003", 1),
            ("-0.50000000", None), (None, -9007199254740995)]
    df = spark.createDataFrame(rows, "d string, b bigint").select(F.col("d").cast("decimal(38,8)").alias("d"), "b", F.col("b").cast("double").alias("f"))
    got = {r.name: r for r in profile.profile_table(df).collect()}
    assert (got["d"].min_exact, got["d"].max_exact, got["d"].median_exact, got["d"].n_unique) == ("-0.50000000", rows[2][0], rows[0][0], 4)
    assert (got["b"].min_exact, got["b"].max_exact, got["b"].median_exact) == ("-9007199254740995", "9007199254740993", "1")
    assert (got["f"].min_exact, got["f"].median_exact) == (None, None) and got["f"].max == 9007199254740992.0
    assert got["b"].min == -9007199254740996.0 and got["d"].max == 1.2345678901234567e19
