"""Queries over result tables: profiles, meta-analysis, fidelity, ranks, numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cells
from ..operators import fidelity, meta, profile, ranking
from .derived import oracle
from .registry import query


def _profile_sql(table: str, numeric: tuple[str, ...], text: tuple[str, ...], columns: tuple[str, ...]) -> str:
    parts = []
    for i, c in enumerate(columns):
        if c in numeric:
            v = f"CAST({c} AS DOUBLE)"
            stats = (f"min({v}) AS min, max({v}) AS max, round(avg({v}), 8) AS mean, round(median({v}), 8) AS median, "
                     f"round(stddev_samp({v}), 8) AS std")
            top = "''"
        else:
            stats = "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS std"
            top = (f"CASE WHEN count(DISTINCT {c}) <= 50 THEN (SELECT string_agg(v || '=' || n, ';' ORDER BY n DESC, v) FROM "
                   f"(SELECT CAST({c} AS STRING) AS v, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 5)) ELSE '' END")
        parts.append(
            f"SELECT {i} AS column_no, '{c}' AS name, count({c}) AS non_null, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS n_unique, "
            f"{str(c in numeric).lower()} AS is_numeric, {stats}, {top} AS top_values FROM {table}"
        )
    return " UNION ALL ".join(parts)


def _profile(df):
    p = profile.profile_table(df)
    shown = F.array_join(F.transform("top_values", lambda v: F.concat(v["value"], F.lit("="), v["count"].cast("string"))), ";")
    return p.select(
        "column_no", "name", "non_null", "null_count", "n_unique", "is_numeric", "min", "max",
        *[F.round(c, 8).alias(c) for c in ("mean", "median", "std")], shown.alias("top_values"),
    )


_LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
         "l_linestatus", "l_shipdate")


@query("profile_lineitem", _profile_sql("lineitem", _LINE[:8], _LINE[8:], _LINE))
def profile_lineitem(t):
    return _profile(t["lineitem"])


_DOC = ("doc_id", "text", "lang", "source", "n_chars")


@query("profile_documents", _profile_sql("documents", ("doc_id", "n_chars"), ("text", "lang", "source"), _DOC))
def profile_documents(t):
    return _profile(t["documents"])


_DEP = ("feature_id", "log2fc", "pvalue", "padj", "significant")


@query("profile_dep", oracle(_profile_sql("dep_reproduced", _DEP[1:], _DEP[:1], _DEP), "dep_reproduced"))
def profile_dep(t):
    return _profile(t["dep_reproduced"])


# Values that differ in digits a double does not have.
_WIDE = """SELECT CAST('1234567890123456789.' || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING), 8, '0') AS DECIMAL(38, 8)) AS d,
    CASE WHEN l_linenumber % 2 = 0 THEN 9007199254740993 ELSE -9007199254740993 END + l_partkey AS b,
    CAST(CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_discount - 0.05 END AS DECIMAL(10, 4)) AS s FROM lineitem"""


@query("profile_decimals", " UNION ALL ".join(
    f"SELECT '{c}' AS name, count({c}) AS non_null, count(DISTINCT {c}) AS n_unique, CAST(min({c}) AS STRING) AS min_exact, CAST(max({c}) AS STRING) AS max_exact, "
    f"CAST(quantile_disc({c}, 0.5) AS STRING) AS median_exact FROM ({_WIDE}) w" for c in "dbs"))
def profile_decimals(t):
    return profile.profile_table(t.sql(_WIDE)).select("name", "non_null", "n_unique", "min_exact", "max_exact", "median_exact")


@query("profile_header", "SELECT 'lineitem' AS source, count(*) AS n_rows, 11 AS n_cols, 4 AS n_columns_described, 'Described the first 4 of 11 columns.' AS notes FROM lineitem")
def profile_header(t):
    h = profile.table_header(t["lineitem"], "lineitem", max_columns=4)
    return h.select("source", "n_rows", "n_cols", "n_columns_described", F.array_join("notes", " ").alias("notes"))


_META = """kept AS (SELECT entity, yi AS y, vi AS v, 1.0 / vi AS w FROM effects WHERE isfinite(yi) AND isfinite(vi) AND vi > 0),
  f AS (SELECT entity, count(*) AS k, sum(w) AS sw, sum(w * y) / sum(w) AS theta, sum(w * w) AS sww FROM kept GROUP BY entity),
  q AS (SELECT f.entity, k, sw, theta, sww, sum(w * (y - theta) * (y - theta)) AS q FROM f JOIN kept ON kept.entity = f.entity GROUP BY f.entity, k, sw, theta, sww),
  t AS (SELECT *, CASE WHEN sw - sww / sw > 0 THEN greatest(0.0, (q - (k - 1)) / (sw - sww / sw)) ELSE 0.0 END AS tau2 FROM q),
  r AS (SELECT t.entity, t.k, sw, theta, q, tau2, sum(1 / (v + tau2)) AS swr, sum(y / (v + tau2)) / sum(1 / (v + tau2)) AS theta_r
    FROM t JOIN kept ON kept.entity = t.entity GROUP BY t.entity, t.k, sw, theta, q, tau2),
  e AS (SELECT DISTINCT entity FROM effects)"""


# Estimates agree to about 12 digits; heterogeneity of nearly equal studies is a difference of
# nearly equal numbers, so it is compared to fewer.
@query("meta_analysis", oracle(
    """SELECT e.entity, coalesce(k, 0) AS k, round(theta, 8) AS fixed_estimate, round(1 / sqrt(sw), 8) AS fixed_se,
      round(theta - 1.96 / sqrt(sw), 8) AS fixed_ci_low, round(theta_r, 8) AS random_estimate, round(1 / sqrt(swr), 8) AS random_se,
      round(theta_r + 1.96 / sqrt(swr), 8) AS random_ci_high, round(q, 6) AS q, k - 1 AS df, round(tau2, 8) AS tau2,
      round(CASE WHEN q > 1e-9 THEN greatest(0.0, (q - (k - 1)) / q) * 100 ELSE 0.0 END, 4) AS i2,
      CASE WHEN k IS NULL THEN 'no valid studies: need at least one study with a finite effect and a positive variance' END AS error
    FROM e LEFT JOIN r ON r.entity = e.entity""", "effects", extra=_META))
def meta_analysis(t):
    m = meta.meta_analyze(t["effects"], tails=False)
    return m.select(
        "entity", "k", *[F.round(c, 8).alias(c) for c in ("fixed_estimate", "fixed_se", "fixed_ci_low", "random_estimate", "random_se", "random_ci_high", "tau2")],
        F.round("q", 6).alias("q"), "df", F.round("i2", 4).alias("i2"), "error",
    )


def _normal_tail(z: str) -> str:
    """P(|normal| > z) in SQL: z + z^3/3 + z^5/15 + ... below 2, Laplace's continued fraction from there."""
    density = f"2 * exp(-{z} * {z} / 2) / sqrt(2 * pi())"
    series = f"list_reduce(list_concat([0.0::DOUBLE], list_transform(range(60), lambda i: 121.0::DOUBLE - 2 * i)), lambda s, k: (1 + s) * {z} * {z} / k)"
    fraction = f"list_reduce(list_concat([{z}], list_transform(range(150), lambda i: 150.0::DOUBLE - i)), lambda f, k: {z} + k / f)"
    return f"CASE WHEN {z} < 2 THEN 1 - {density} * {z} * (1 + {series}) ELSE {density} / {fraction} END"


# The chi-square tail of whole degrees of freedom is a finite sum, with the normal tail where they are odd.
_TAILED = f"""SELECT entity, k, q, df, z, abs(z) AS az, sqrt(greatest(q, 0)) AS rq, q / 2 AS x FROM (SELECT e.entity, coalesce(k, 0) AS k, q, k - 1 AS df, theta_r * sqrt(swr) AS z
    FROM e LEFT JOIN r ON r.entity IS NOT DISTINCT FROM e.entity)"""
_TAILS = f"""SELECT entity, k, round(z, 6) AS z, round({_normal_tail("az")}, 9) AS p, round(CASE WHEN df = 0 THEN NULL WHEN x <= 0 THEN 1 WHEN df % 2 = 0
      THEN list_sum(list_transform(range(df // 2), lambda i: exp(i * ln(x) - x - lgamma(i + 1))))
      ELSE {_normal_tail("rq")} + coalesce(list_sum(list_transform(range(df // 2), lambda i: exp((i + 0.5) * ln(x) - x - lgamma(i + 1.5)))), 0) END, 9) AS q_p
    FROM ({_TAILED})"""


def _tails(m):
    return m.select("entity", "k", F.round("z", 6).alias("z"), F.round("p", 9).alias("p"), F.round("q_p", 9).alias("q_p"))


@query("meta_analysis_tails", oracle(_TAILS, "effects", extra=_META))
def meta_analysis_tails(t):
    return _tails(meta.meta_analyze(t["effects"]))


# Every line is a study of its supplier; every seventh line has no supplier, which makes NULL the largest entity.
_MANY_STUDIES = """SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE 'S' || CAST(l_suppkey AS STRING) END AS entity,
    l_discount - 0.05E0 AS yi, (l_tax + 0.02E0) * (l_quantity + 1) / 500 AS vi FROM lineitem"""


@query("meta_analysis_many_studies", f"WITH effects AS ({_MANY_STUDIES}), {_META.replace('f.entity = kept', 'f.entity IS NOT DISTINCT FROM kept').replace('ON kept.entity = f.entity', 'ON kept.entity IS NOT DISTINCT FROM f.entity').replace('ON kept.entity = t.entity', 'ON kept.entity IS NOT DISTINCT FROM t.entity')} {_TAILS}")
def meta_analysis_many_studies(t):
    return _tails(meta.meta_analyze(t.sql(_MANY_STUDIES)))


# |z| of each distinct p-value by Newton's method; the tail is convex, so steps from 0 never overshoot.
_P_ROWS = "SELECT 'P' || CAST(p_size AS STRING) AS entity, p_partkey, p_partkey % 7 - 3.5E0 AS yi, (p_partkey * 53 % 1000 + 1) / 1001.0E0 AS p FROM part"
_DEVIATES = f"""WITH RECURSIVE rows AS ({_P_ROWS}),
  newton AS (SELECT DISTINCT p, 0.0::DOUBLE AS z, 0 AS i FROM rows
    UNION ALL SELECT p, z + ({_normal_tail("z")} - p) / (2 * exp(-z * z / 2) / sqrt(2 * pi())), i + 1 FROM newton WHERE i < 40),
  deviate AS (SELECT p, z FROM newton WHERE i = 40)"""


@query("meta_analysis_from_p_values", f"""{_DEVIATES}, effects AS (SELECT entity, yi, pow(yi / z, 2) AS vi FROM rows JOIN deviate USING (p)), {_META}
    SELECT e.entity, coalesce(k, 0) AS k, round(theta_r, 6) AS random_estimate, round(tau2, 6) AS tau2 FROM e LEFT JOIN r ON r.entity = e.entity""")
def meta_analysis_from_p_values(t):
    m = meta.meta_analyze(t.sql(_P_ROWS), vi=None, p="p", tails=False)
    return m.select("entity", "k", F.round("random_estimate", 6).alias("random_estimate"), F.round("tau2", 6).alias("tau2"))


@query("resolve_variance", f"""{_DEVIATES} SELECT p_partkey, round(1 / CASE p_partkey % 4 WHEN 0 THEN p WHEN 1 THEN p * p ELSE pow(yi / z, 2) END, 6) AS weight FROM rows JOIN deviate USING (p)""")
def resolve_variance(t):
    """A variance where there is one, else a squared standard error, else what a p-value implies."""
    k, p = F.col("p_partkey") % 4, F.col("p")
    v = meta.resolve_variance(F.col("yi"), F.when(k == 0, p), F.when(k == 1, p), p)
    return t.sql(_P_ROWS).select("p_partkey", F.round(1 / v, 6).alias("weight"))


_NAMED = """SELECT 'P' || CAST(p_size AS STRING) AS gene, CASE WHEN p_partkey % 50 = 7 THEN NULL ELSE p_partkey % 7 - 3.5E0 END AS effect,
    (p_partkey % 5 + 1) / 10.0E0 AS std_error FROM part"""


@query("meta_summary", f"""SELECT count(*) AS n_entities, count(*) FILTER (NOT bad) AS n_succeeded, count(*) FILTER (bad) AS n_failed
    FROM (SELECT gene, bool_or(effect IS NULL) AS bad FROM ({_NAMED}) n GROUP BY gene)""")
def meta_summary(t):
    rows = meta.with_aliases(t.sql(_NAMED), "gene")
    return meta.meta_summary(meta.meta_analyze(rows, se="se", p=None, tails=False))


_M = ("matrix_reproduced", "matrix_published")


@query("compare_identifications", oracle(
    """SELECT count(*) FILTER (a) AS n_reproduced, count(*) FILTER (b) AS n_published, count(*) FILTER (a AND b) AS n_shared,
      count(*) FILTER (a AND NOT b) AS n_reproduced_only, count(*) FILTER (b AND NOT a) AS n_published_only,
      CAST(count(*) FILTER (a AND b) AS DOUBLE) / count(*) AS jaccard
    FROM (SELECT coalesce(x.feature_id, y.feature_id), x.feature_id IS NOT NULL AS a, y.feature_id IS NOT NULL AS b
      FROM (SELECT DISTINCT feature_id FROM matrix_reproduced) x FULL JOIN (SELECT DISTINCT feature_id FROM matrix_published) y ON x.feature_id = y.feature_id)""", *_M))
def compare_identifications(t):
    return fidelity.compare_identifications(t[_M[0]], t[_M[1]])


@query("membership", oracle(
    """SELECT coalesce(x.feature_id, y.feature_id) AS feature_id, CASE WHEN x.feature_id IS NULL THEN 'published_only' WHEN y.feature_id IS NULL
      THEN 'reproduced_only' ELSE 'shared' END AS membership FROM (SELECT DISTINCT feature_id FROM matrix_reproduced) x
    FULL JOIN (SELECT DISTINCT feature_id FROM matrix_published) y ON x.feature_id = y.feature_id""", *_M))
def membership(t):
    return fidelity.compare_identifications(t[_M[0]], t[_M[1]], lists=True)[1]


@query("compare_versions", oracle(
    """SELECT 'old' AS label_a, 'new' AS label_b, count(DISTINCT x) AS n_a, count(DISTINCT y) AS n_b, count(*) FILTER (x = y) AS n_shared,
      count(*) FILTER (x IS NULL) AS n_gained, count(*) FILTER (y IS NULL) AS n_lost, CAST(count(*) FILTER (x = y) AS DOUBLE) / count(*) AS jaccard
    FROM (SELECT a.feature_id AS x, b.feature_id AS y FROM (SELECT DISTINCT feature_id FROM matrix_reproduced) a
      FULL JOIN (SELECT DISTINCT feature_id FROM matrix_published) b ON a.feature_id = b.feature_id)""", *_M))
def compare_versions(t):
    return fidelity.compare_versions(t[_M[0]], t[_M[1]], "old", "new")


_Q = """pairs AS (SELECT r.sample, log2(r.value) AS x, log2(p.value) AS y FROM matrix_reproduced r JOIN matrix_published p
    ON p.feature_id = r.feature_id AND p.sample = r.sample WHERE r.value > 0 AND p.value > 0),
  ranks AS (SELECT *, rank() OVER (PARTITION BY sample ORDER BY x) + (count(*) OVER (PARTITION BY sample, x) - 1) / 2.0 AS rx,
      rank() OVER (PARTITION BY sample ORDER BY y) + (count(*) OVER (PARTITION BY sample, y) - 1) / 2.0 AS ry,
      rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS px, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS py
    FROM pairs)"""


@query("compare_quantitative", oracle(
    """SELECT sample AS reproduced_sample, sample AS published_sample, count(*) AS n, round(corr(x, y), 8) AS pearson, round(corr(rx, ry), 8) AS spearman
      FROM ranks GROUP BY sample
    UNION ALL SELECT NULL, NULL, count(*), round(corr(x, y), 8), round(corr(px, py), 8) FROM ranks""", *_M, extra=_Q))
def compare_quantitative(t):
    q = fidelity.compare_quantitative(t[_M[0]], t[_M[1]], seq="feature_id")
    return q.select("reproduced_sample", "published_sample", "n", F.round("pearson", 8).alias("pearson"), F.round("spearman", 8).alias("spearman"))


@query("compare_quantitative_mapped", oracle(
    """SELECT r.sample AS reproduced_sample, p.sample AS published_sample, count(*) AS n, round(corr(r.value, p.value), 8) AS pearson
      FROM matrix_reproduced r JOIN matrix_published p ON p.feature_id = r.feature_id
        AND ((r.sample = 's0' AND p.sample = 's3') OR (r.sample = 's1' AND p.sample = 's1')) GROUP BY 1, 2
    UNION ALL SELECT NULL, NULL, count(*), round(corr(r.value, p.value), 8) FROM matrix_reproduced r JOIN matrix_published p
      ON p.feature_id = r.feature_id AND ((r.sample = 's0' AND p.sample = 's3') OR (r.sample = 's1' AND p.sample = 's1'))""", *_M))
def compare_quantitative_mapped(t):
    q = fidelity.compare_quantitative(t[_M[0]], t[_M[1]], {"s0": "s3", "s1": "s1"}, log=False, seq="feature_id")
    return q.select("reproduced_sample", "published_sample", "n", F.round("pearson", 8).alias("pearson"))


_D = ("dep_reproduced", "dep_published")
_SIG = "coalesce({0}.significant, coalesce({0}.padj, {0}.pvalue) <= 0.05, false)"
_DEPS = f"""b AS (SELECT coalesce(r.feature_id, p.feature_id) AS feature_id, {_SIG.format('r')} AS rep, {_SIG.format('p')} AS pub,
    coalesce(sign(r.log2fc) = sign(p.log2fc) AND sign(r.log2fc) <> 0, false) AS same, r.feature_id IS NOT NULL OR m.feature_id IS NOT NULL AS quantified
  FROM dep_reproduced r FULL JOIN dep_published p ON p.feature_id = r.feature_id
  LEFT JOIN (SELECT DISTINCT feature_id FROM matrix_reproduced) m ON m.feature_id = coalesce(r.feature_id, p.feature_id)),
  c AS (SELECT *, CASE WHEN NOT pub THEN NULL WHEN NOT quantified THEN 'not_quantified' WHEN rep AND same THEN 'concordant'
    WHEN rep THEN 'significant_different_direction' ELSE 'quantified_not_significant' END AS bucket FROM b)"""


@query("compare_dep", oracle(
    """SELECT count(*) FILTER (rep) AS n_reproduced_significant, count(*) FILTER (pub) AS n_published_significant, count(*) FILTER (rep AND pub) AS n_shared_significant,
      CAST(count(*) FILTER (rep AND pub) AS DOUBLE) / count(*) FILTER (rep OR pub) AS jaccard_significant,
      100.0 * count(*) FILTER (rep AND pub) / count(*) FILTER (pub) AS overlap_pct_of_published,
      count(*) FILTER (rep AND pub AND same) AS n_direction_agree, count(*) FILTER (rep AND pub AND NOT same) AS n_direction_disagree,
      count(*) FILTER (bucket = 'concordant') AS n_reproduced_concordant, count(*) FILTER (bucket = 'not_quantified') AS not_quantified,
      count(*) FILTER (bucket = 'quantified_not_significant') AS quantified_not_significant,
      count(*) FILTER (bucket = 'significant_different_direction') AS significant_different_direction FROM c""", *_D, "matrix_reproduced", extra=_DEPS))
def compare_dep(t):
    return fidelity.compare_dep(t[_D[0]], t[_D[1]], t["matrix_reproduced"], seq="feature_id")


@query("dep_buckets", oracle("SELECT feature_id, rep AS rep_significant, pub AS pub_significant, bucket FROM c", *_D, "matrix_reproduced", extra=_DEPS))
def dep_buckets(t):
    b = fidelity.dep_buckets(t[_D[0]], t[_D[1]], t["matrix_reproduced"], seq="feature_id")
    return b.where("feature_id IS NOT NULL").join(
        t[_D[0]].select("feature_id").union(t[_D[1]].select("feature_id")).distinct(), "feature_id", "left_semi"
    ).select("feature_id", "rep_significant", "pub_significant", "bucket")


_SECTIONS = """SELECT 'identification' AS section, 'n_shared' AS name, CAST(count(*) FILTER (a AND b) AS DOUBLE) AS value FROM members
    UNION ALL SELECT 'identification', 'jaccard', round(CAST(count(*) FILTER (a AND b) AS DOUBLE) / count(*), 8) FROM members
    UNION ALL SELECT 'quantitative', sample || ' n', count(*) FROM ranks GROUP BY sample
    UNION ALL SELECT 'quantitative', sample || ' pearson', round(corr(x, y), 8) FROM ranks GROUP BY sample
    UNION ALL SELECT 'quantitative', sample || ' spearman', round(corr(rx, ry), 8) FROM ranks GROUP BY sample
    UNION ALL SELECT 'quantitative', 'pooled n', count(*) FROM ranks
    UNION ALL SELECT 'quantitative', 'pooled pearson', round(corr(x, y), 8) FROM ranks
    UNION ALL SELECT 'quantitative', 'pooled spearman', round(corr(px, py), 8) FROM ranks
    UNION ALL SELECT 'dep', 'overlap_pct_of_published', round(100.0 * count(*) FILTER (rep AND pub) / count(*) FILTER (pub), 8) FROM c
    UNION ALL SELECT 'dep', 'not_quantified', count(*) FILTER (bucket = 'not_quantified') FROM c
    UNION ALL SELECT 'dep', 'quantified_not_significant', count(*) FILTER (bucket = 'quantified_not_significant') FROM c
    UNION ALL SELECT 'version', 'n_gained', count(*) FILTER (b AND NOT a) FROM members
    UNION ALL SELECT 'version', 'n_lost', count(*) FILTER (a AND NOT b) FROM members"""
_MEMBERS = """members AS (SELECT x.feature_id IS NOT NULL AS a, y.feature_id IS NOT NULL AS b
    FROM (SELECT DISTINCT feature_id FROM matrix_reproduced) x FULL JOIN (SELECT DISTINCT feature_id FROM matrix_published) y ON x.feature_id = y.feature_id)"""


@query("fidelity_report", oracle(_SECTIONS, *_M, *_D, extra=f"{_MEMBERS}, {_Q}, {_DEPS}"))
def fidelity_report(t):
    """Every section of a report, one row a number."""
    m, d = [t[n] for n in _M], [t[n] for n in _D]
    sections, _ = fidelity.fidelity_report(*m, *d, *m, matrix_seq="feature_id", dep_seq="feature_id")
    sample = F.coalesce("reproduced_sample", F.lit("pooled"))
    wanted = {"identification": ("n_shared", "jaccard"), "quantitative": ("n", "pearson", "spearman"),
              "dep": ("overlap_pct_of_published", "not_quantified", "quantified_not_significant"), "version": ("n_gained", "n_lost")}
    rows = None
    for section, names in wanted.items():
        named = lambda n: F.concat_ws(" ", sample, F.lit(n)) if section == "quantitative" else F.lit(n)  # noqa: E731, B023
        cells = F.array(*[F.struct(named(n).alias("name"), F.round(F.col(n).cast("double"), 8).alias("value")) for n in names])
        part = sections[section].select(F.lit(section).alias("section"), F.inline(cells))
        rows = part if rows is None else rows.unionByName(part)
    return rows


# Lines as they come: a feature has many rows in each sample, of which the last counts.
_LINES = """SELECT 'P' || CAST(l_partkey AS STRING) AS feature_id, 's' || CAST(l_suppkey % 3 AS STRING) AS sample,
    {0} AS value, (l_orderkey * 8 + l_linenumber) * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS place FROM lineitem WHERE {1}"""
_REPEATED = (_LINES.format("l_extendedprice", "l_returnflag <> 'A'"), _LINES.format("l_extendedprice * (1 + l_discount)", "l_returnflag <> 'R'"))
_LAST = "SELECT * FROM ({0}) l QUALIFY row_number() OVER (PARTITION BY feature_id, sample ORDER BY place DESC) = 1"


@query("compare_quantitative_repeated", f"""WITH matrix_reproduced AS ({_LAST.format(_REPEATED[0])}), matrix_published AS ({_LAST.format(_REPEATED[1])}), {_Q}
    SELECT sample AS reproduced_sample, sample AS published_sample, count(*) AS n, round(corr(x, y), 8) AS pearson, round(corr(rx, ry), 8) AS spearman
      FROM ranks GROUP BY sample
    UNION ALL SELECT NULL, NULL, count(*), round(corr(x, y), 8), round(corr(px, py), 8) FROM ranks""")
def compare_quantitative_repeated(t):
    q = fidelity.compare_quantitative(t.sql(_REPEATED[0]), t.sql(_REPEATED[1]), seq="place")
    return q.select("reproduced_sample", "published_sample", "n", F.round("pearson", 8).alias("pearson"), F.round("spearman", 8).alias("spearman"))


_DEP_LINES = """SELECT 'P' || CAST(l_partkey AS STRING) AS feature_id, CASE WHEN l_linenumber = 6 THEN NULL ELSE l_discount - 0.05E0 END AS log2fc,
    l_tax AS pvalue, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_tax * 1.5E0 END AS padj, CAST(NULL AS BOOLEAN) AS significant,
    (l_orderkey * 8 + l_linenumber) * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS place FROM lineitem WHERE {0}"""
_DEP_REPEATED = (_DEP_LINES.format("l_returnflag <> 'A'"), _DEP_LINES.format("l_returnflag <> 'R'"))
_FIRST = "SELECT * FROM ({0}) l QUALIFY row_number() OVER (PARTITION BY feature_id ORDER BY place) = 1"


@query("compare_dep_repeated", f"""WITH dep_reproduced AS ({_FIRST.format(_DEP_REPEATED[0])}), dep_published AS ({_FIRST.format(_DEP_REPEATED[1])}),
    matrix_reproduced AS (SELECT NULL::VARCHAR AS feature_id WHERE false), {_DEPS}
    SELECT feature_id, rep AS rep_significant, pub AS pub_significant, bucket FROM c""")
def compare_dep_repeated(t):
    return fidelity.dep_buckets(t.sql(_DEP_REPEATED[0]), t.sql(_DEP_REPEATED[1]), seq="place").select("feature_id", "rep_significant", "pub_significant", "bucket")


@query("dep_significance", oracle(
    """SELECT feature_id, CASE WHEN log2fc > 0 THEN 1 WHEN log2fc < 0 THEN -1 END AS direction,
      coalesce(significant, pvalue <= 0.05 AND abs(log2fc) >= 0.5, false) AS significant FROM dep_published""", "dep_published"))
def dep_significance(t):
    c = F.col
    flag = cells.is_significant(c("significant"), c("padj"), c("pvalue"), c("log2fc"), 0.05, 0.5, use_padj=False)
    return t["dep_published"].select("feature_id", cells.sign(c("log2fc")).alias("direction"), flag.alias("significant"))


@query("log_values", oracle("SELECT feature_id, sample, round(log10(value + 1), 8) AS logged FROM matrix_published", "matrix_published"))
def log_values(t):
    return t["matrix_published"].select("feature_id", "sample", F.round(cells.log_value(F.col("value"), 10, 1), 8).alias("logged"))


@query("average_rank", """SELECT l_orderkey, l_linenumber, l_returnflag, CAST(rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity)
    + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS DOUBLE) AS quantity_rank FROM lineitem""")
def average_rank(t):
    ranked = ranking.avg_rank(t["lineitem"], ["l_returnflag"], "l_quantity", "quantity_rank")
    return ranked.select("l_orderkey", "l_linenumber", "l_returnflag", "quantity_rank")


@query("average_rank_pooled", """SELECT l_orderkey, l_linenumber, CAST(rank() OVER (ORDER BY l_extendedprice)
    + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS DOUBLE) AS price_rank FROM lineitem""")
def average_rank_pooled(t):
    return ranking.avg_rank(t["lineitem"], [], "l_extendedprice", "price_rank").select("l_orderkey", "l_linenumber", "price_rank")


@query("first_by", """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) e WHERE r = 1""")
def first_by(t):
    return ranking.first_by(t["events"].select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("last_by", """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) e WHERE r = 1""")
def last_by(t):
    return ranking.last_by(t["events"].select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("number_rows", "SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS row_no FROM events")
def number_rows(t):
    return ranking.number_rows(t["events"].select("event_id", "event_type"), "event_id", ["event_type"], chunk_bits=6)
