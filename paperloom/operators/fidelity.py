"""Comparison of reproduced with published abundance matrices and differential-expression tables.

Matrices are long: ``feature_id, sample, value`` with NULL for missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import finite, is_significant, log_value, sign
from ..session import materialize
from .ranking import first_by, join_same, last_by, value_ranks


def membership(a: DataFrame, b: DataFrame, key: str = "feature_id") -> DataFrame:
    """One row per distinct key with ``in_a`` and ``in_b``, in one exchange."""
    rows = a.select(F.col(key), F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(F.col(key), F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        (F.max("_a") == 1).alias("in_a"), (F.max("_b") == 1).alias("in_b")
    )


def shared(a: DataFrame, b: DataFrame, key: str = "feature_id") -> DataFrame:
    return membership(a, b, key).where("in_a AND in_b").select(key)


def only(a: DataFrame, b: DataFrame, key: str = "feature_id") -> DataFrame:
    return membership(a, b, key).where("in_a AND NOT in_b").select(key)


def _jaccard(both: Column, union: Column) -> Column:
    return F.when(union == 0, 0.0).otherwise(both / union)


def compare_identifications(a: DataFrame, b: DataFrame, key: str = "feature_id", lists: bool = False):
    """Counts and Jaccard index of reproduced (``a``) and published (``b``) features.

    With ``lists`` also the membership per feature, as rows.
    """
    m = membership(a, b, key)
    in_a, in_b = F.col("in_a"), F.col("in_b")
    both = F.count_if(in_a & in_b)
    summary = m.agg(
        F.count_if(in_a).alias("n_reproduced"), F.count_if(in_b).alias("n_published"), both.alias("n_shared"),
        F.count_if(in_a & ~in_b).alias("n_reproduced_only"), F.count_if(in_b & ~in_a).alias("n_published_only"),
        _jaccard(both, F.count("*")).alias("jaccard"),
    )
    if not lists:
        return summary
    kind = F.when(in_a & in_b, "shared").when(in_a, "reproduced_only").otherwise("published_only")
    return summary, m.select(key, kind.alias("membership"))


def compare_versions(a: DataFrame, b: DataFrame, label_a="version_a", label_b="version_b", key="feature_id", lists=False):
    """Features gained in ``b`` and lost from ``a``."""
    m = membership(a, b, key)
    in_a, in_b = F.col("in_a"), F.col("in_b")
    both = F.count_if(in_a & in_b)
    summary = m.agg(
        F.lit(label_a).alias("label_a"), F.lit(label_b).alias("label_b"),
        F.count_if(in_a).alias("n_a"), F.count_if(in_b).alias("n_b"), both.alias("n_shared"),
        F.count_if(in_b & ~in_a).alias("n_gained"), F.count_if(in_a & ~in_b).alias("n_lost"),
        _jaccard(both, F.count("*")).alias("jaccard"),
    )
    if not lists:
        return summary
    kind = F.when(in_a & in_b, "shared").when(in_a, "lost").otherwise("gained")
    return summary, m.select(key, kind.alias("membership"))


def _correlation(x: Column, y: Column) -> Column:
    """Pearson correlation, NULL for fewer than two pairs or no variance, within [-1, 1]."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when((F.count(x) >= 2) & r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def correlate(pairs: DataFrame, by: list[str], pooled: bool = False) -> DataFrame:
    """``n``, ``pearson`` and ``spearman`` of the finite ``(x, y)`` pairs of each group.

    With ``pooled`` one more row for all pairs together, marked by the column ``pooled``. Both
    axes and both groupings go through one histogram of values, from which average ranks are
    read by running counts; no group is sorted as a whole.
    """
    finite_pairs = pairs.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(*by, "x", "y")
    levels = F.array(F.lit(False), F.lit(True)) if pooled else F.array(F.lit(False))
    rows = finite_pairs.withColumn("pooled", F.explode(levels))
    rows = rows.select("pooled", *[F.when(~F.col("pooled"), F.col(c)).alias(c) for c in by], "x", "y")
    keys = ["pooled", *by]
    axes = [F.struct(F.lit(a).alias("axis"), F.col(a).alias("value")) for a in ("x", "y")]
    ranks = value_ranks(rows.select(*keys, F.inline(F.array(*axes))), [*keys, "axis"], "value", "_rank")
    ranked = rows
    for axis in ("x", "y"):
        of_axis = ranks.where(F.col("axis") == axis).select(*keys, F.col("value").alias(axis), F.col("_rank").alias(f"_r{axis}"))
        ranked = join_same(ranked, of_axis, keys, exact=[axis])
    return ranked.groupBy(*keys).agg(
        F.count("*").alias("n"), _correlation(F.col("x"), F.col("y")).alias("pearson"),
        _correlation(F.col("_rx"), F.col("_ry")).alias("spearman"),
    )


def sample_pairs(a: DataFrame, b: DataFrame, sample_map: dict[str, str] | None = None, log: bool = True,
                 base: float = 2.0, pseudocount: float = 0.0, *, seq: str) -> DataFrame:
    """``feature_id, reproduced_sample, published_sample, x, y`` for shared features and paired samples.

    Of a repeated feature the last row counts, by the column ``seq`` of both matrices, which is not NULL.
    """

    def prepared(m, value):
        m = m.select("feature_id", "sample", "value", F.col(seq).alias("_seq"))
        m = last_by(m, ["feature_id", "sample"], "_seq")
        v = log_value(F.col("value"), base, pseudocount) if log else finite(F.col("value"))
        return m.select("feature_id", "sample", v.alias(value))

    left = prepared(a, "x").withColumnRenamed("sample", "reproduced_sample")
    right = prepared(b, "y").withColumnRenamed("sample", "published_sample")
    if sample_map:
        pairs = [F.lit(str(v)) for kv in sample_map.items() for v in kv]
        left = left.withColumn("_to", F.try_element_at(F.create_map(*pairs), F.col("reproduced_sample")))
        left = left.where(F.col("_to").isNotNull())
    else:
        left = left.withColumn("_to", F.col("reproduced_sample"))
    joined = left.join(
        right.withColumnRenamed("feature_id", "_f"),
        (F.col("feature_id") == F.col("_f")) & (F.col("_to") == F.col("published_sample")),
    )
    return joined.select("feature_id", "reproduced_sample", "published_sample", "x", "y")


def compare_quantitative(a: DataFrame, b: DataFrame, sample_map: dict[str, str] | None = None, log: bool = True,
                         base: float = 2.0, pseudocount: float = 0.0, *, seq: str) -> DataFrame:
    """Correlations per sample pair and pooled; the pooled row has NULL samples.

    Pairs without any finite value are listed with ``n`` 0. ``seq`` orders the rows of both matrices, see
    :func:`sample_pairs`.
    """
    names = ["reproduced_sample", "published_sample"]
    # Ranks, splits and sums all read the joined pairs, so the join is done and written once.
    pairs = materialize(sample_pairs(a, b, sample_map, log, base, pseudocount, seq=seq).select(*names, "x", "y"))
    found = correlate(pairs, names, pooled=True)
    # Sample pairs are few; those without finite values still get a row.
    every = pairs.select(*names).distinct()
    per_sample = every.join(found.where("NOT pooled").drop("pooled"), names, "left")
    pooled = found.where("pooled").agg(F.max("n").alias("n"), F.max("pearson").alias("pearson"), F.max("spearman").alias("spearman"))
    pooled = pooled.select(*[F.lit(None).cast("string").alias(c) for c in names], "n", "pearson", "spearman")
    count = F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    return per_sample.unionByName(pooled).select(*names, count, "pearson", "spearman")


def dep_buckets(rep: DataFrame, pub: DataFrame, quantified: DataFrame | None = None, alpha: float = 0.05,
                lfc: float = 0.0, use_padj: bool = True, *, seq: str) -> DataFrame:
    """One row per feature: significance on both sides, directions, and the bucket of published hits.

    Of a repeated feature the first row counts, by the column ``seq`` of both tables, which is not NULL.
    """
    metrics = ["log2fc", "pvalue", "padj", "significant"]

    def side(t, name):
        t = first_by(t.select("feature_id", *metrics, F.col(seq).alias("_seq")), ["feature_id"], "_seq")
        significant = is_significant(*[F.col(c) for c in ("significant", "padj", "pvalue", "log2fc")], alpha, lfc, use_padj)
        return t.select("feature_id", F.lit(name).alias("_side"), significant.alias("_sig"), sign(F.col("log2fc")).alias("_dir"))

    rows = side(rep, "rep").unionByName(side(pub, "pub"))
    if quantified is not None:
        none = F.lit(None)
        extra = quantified.select("feature_id").distinct()
        rows = rows.unionByName(extra.select("feature_id", F.lit("quant").alias("_side"), none.cast("boolean").alias("_sig"), none.cast("int").alias("_dir")))

    def pick(name, value):
        return F.max(F.when(F.col("_side") == name, F.col(value)))

    wide = rows.groupBy("feature_id").agg(
        F.coalesce(pick("rep", "_sig"), F.lit(False)).alias("rep_significant"),
        F.coalesce(pick("pub", "_sig"), F.lit(False)).alias("pub_significant"),
        pick("rep", "_dir").alias("rep_direction"), pick("pub", "_dir").alias("pub_direction"),
        F.max(F.col("_side").isin("rep", "quant")).alias("quantified"),
    )
    same = F.coalesce(F.col("rep_direction") == F.col("pub_direction"), F.lit(False))
    bucket = F.when(
        F.col("pub_significant"),
        F.when(~F.col("quantified"), "not_quantified")
        .when(F.col("rep_significant") & same, "concordant")
        .when(F.col("rep_significant"), "significant_different_direction")
        .otherwise("quantified_not_significant"),
    )
    return wide.select("*", bucket.alias("bucket"))


def summarize_buckets(buckets: DataFrame) -> DataFrame:
    rep, pub = F.col("rep_significant"), F.col("pub_significant")
    agree = F.coalesce(F.col("rep_direction") == F.col("pub_direction"), F.lit(False))
    both, published = F.count_if(rep & pub), F.count_if(pub)
    return buckets.agg(
        F.count_if(rep).alias("n_reproduced_significant"), published.alias("n_published_significant"),
        both.alias("n_shared_significant"), _jaccard(both, F.count_if(rep | pub)).alias("jaccard_significant"),
        F.when(published > 0, 100.0 * both / published).otherwise(0.0).alias("overlap_pct_of_published"),
        F.count_if(rep & pub & agree).alias("n_direction_agree"), F.count_if(rep & pub & ~agree).alias("n_direction_disagree"),
        *[F.count_if(F.col("bucket") == b).alias(n) for b, n in (
            ("concordant", "n_reproduced_concordant"), ("not_quantified", "not_quantified"),
            ("quantified_not_significant", "quantified_not_significant"),
            ("significant_different_direction", "significant_different_direction"))],
    )


def compare_dep(rep, pub, quantified=None, alpha=0.05, lfc=0.0, use_padj=True, *, seq: str) -> DataFrame:
    """Overlap, direction agreement and the four-way split of published hits, as one row."""
    return summarize_buckets(dep_buckets(rep, pub, quantified, alpha, lfc, use_padj, seq=seq))


def fidelity_report(
    rep_matrix=None, pub_matrix=None, rep_dep=None, pub_dep=None, version_a=None, version_b=None,
    sample_map=None, log=True, base=2.0, pseudocount=0.0, alpha=0.05, lfc=0.0, use_padj=True,
    label_a="version_a", label_b="version_b", matrix_seq=None, dep_seq=None,
) -> tuple[dict[str, DataFrame], list[str]]:
    """The comparisons whose two inputs are given, and a note for each that has only one.

    Matrices need ``matrix_seq`` and differential-expression tables ``dep_seq``, the columns that order their rows.
    """
    if rep_matrix is not None and pub_matrix is not None and matrix_seq is None:
        raise ValueError("matrix_seq has to name the column that orders the rows of both matrices")
    if rep_dep is not None and pub_dep is not None and dep_seq is None:
        raise ValueError("dep_seq has to name the column that orders the rows of both tables")
    sections, notes = {}, []
    if rep_matrix is not None and pub_matrix is not None:
        sections["identification"] = compare_identifications(rep_matrix, pub_matrix)
        sections["quantitative"] = compare_quantitative(rep_matrix, pub_matrix, sample_map, log, base, pseudocount, seq=matrix_seq)
    elif rep_matrix is not None or pub_matrix is not None:
        notes.append("Both matrices are required for identification/quantitative comparison; skipping those sections.")
    if rep_dep is not None and pub_dep is not None:
        # As in the matrix sections, both matrices must be present for the quantified features to count.
        quantified = rep_matrix if rep_matrix is not None and pub_matrix is not None else None
        sections["dep"] = compare_dep(rep_dep, pub_dep, quantified, alpha, lfc, use_padj, seq=dep_seq)
    elif rep_dep is not None or pub_dep is not None:
        notes.append("Both DEP tables are required for the DEP decomposition; skipping that section.")
    if version_a is not None and version_b is not None:
        sections["version"] = compare_versions(version_a, version_b, label_a, label_b)
    elif version_a is not None or version_b is not None:
        notes.append("Both versions are required for the version comparison; skipping that section.")
    return sections, notes


def report_row(sections: dict[str, DataFrame]) -> DataFrame | None:
    """One row of summary JSON for the analysis-run table, from the sections present."""
    wanted = {
        "identification": ("n_shared", "jaccard"),
        "quantitative": ("pooled_pearson", "pooled_spearman"),
        "dep": ("overlap_pct_of_published", "not_quantified", "quantified_not_significant", "significant_different_direction"),
        "version": ("n_gained", "n_lost"),
    }
    parts = None
    for name, fields in wanted.items():
        if name not in sections:
            continue
        section = sections[name]
        if name == "quantitative":
            section = section.where(F.col("reproduced_sample").isNull()).select(
                F.col("pearson").alias("pooled_pearson"), F.col("spearman").alias("pooled_spearman")
            )
        row = section.select(F.lit(name).alias("section"), F.to_json(F.struct(*fields)).alias("json"))
        parts = row if parts is None else parts.unionByName(row)
    if parts is None:
        return None
    merged = F.map_from_entries(F.array_sort(F.collect_list(F.struct("section", "json"))))
    parsed = F.transform_values(merged, lambda _, v: F.parse_json(v))
    return parts.agg(
        F.lit("fidelity").alias("analysis_type"), F.lit("fidelity_report").alias("method"),
        F.to_json(parsed).alias("parameters_json"),
    )
