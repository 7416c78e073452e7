"""The plans that matter at scale: no pair comparison, no Python where columns do, pruned scans."""

import tempfile

import pytest
from pyspark.sql import functions as F

from paperloom.operators import fidelity, graph, idjoin, meta, profile, scan, search
from paperloom.plans import literature


@pytest.fixture(scope="module")
def stored(spark, tables):
    """Derived tables written once, so that plans show the operators alone."""
    folder = tempfile.mkdtemp(prefix="run-")
    names = ("articles", "journals", "author_info", "article_authors", "keywords", "article_keywords", "mesh_terms", "article_mesh_terms", "llm_raw_data",
             "llm_processed_data", "datasets", "descriptors", "matrix_reproduced", "matrix_published", "dep_reproduced", "dep_published", "effects",
             "article_embeddings", "scan_texts")
    for n in names:
        tables[n].write.parquet(f"{folder}/{n}")
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def no_pairs(df):
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    return text


def no_python(df):
    text = plan(df)
    assert not any(w in text for w in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonMapInArrow"))
    return text


def test_id_joins(stored):
    for how in ("inner", "left", "semi", "anti"):
        no_pairs(idjoin.id_join(stored["articles"], stored["llm_raw_data"], how))
    no_pairs(idjoin.pending_extraction(stored["articles"], [stored["llm_raw_data"], stored["llm_processed_data"]], "m1"))
    no_pairs(idjoin.id_conflicts(stored["articles"], stored["articles"]))


def test_graphs(stored):
    for part in graph.literature_graph(stored, seq="row_id"):
        no_python(part), no_pairs(part)
    for part in graph.article_dataset_graph(stored):
        no_pairs(part)


def test_search(stored):
    tables = {**stored, "embeddings": stored["article_embeddings"]}
    text = no_python(search.search_filtered(tables, [0.1] * 64, language="en", keywords=["x"], date_from="2020-01-01"))
    no_pairs(search.search_filtered(tables, [0.1] * 64, has_dataset=False, journal="1"))
    assert "TakeOrderedAndProject" in text and "EqualTo(language,en)" in text and "GreaterThanOrEqual(publication_date" in text
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert not any("abstract" in line for line in scans)


def test_statistics_stay_in_the_jvm(stored):
    no_python(scan.scan_signal(stored["scan_texts"]))
    no_python(scan.flagged_items(scan.scan_signal(stored["scan_texts"]), "doc_id"))
    for df in (
        profile.profile_table(stored["dep_reproduced"]),
        meta.meta_analyze(stored["effects"]),
        fidelity.compare_identifications(stored["matrix_reproduced"], stored["matrix_published"]),
        fidelity.compare_quantitative(stored["matrix_reproduced"], stored["matrix_published"], seq="feature_id"),
        fidelity.compare_dep(stored["dep_reproduced"], stored["dep_published"], stored["matrix_reproduced"], seq="feature_id"),
    ):
        no_python(df), no_pairs(df)


def test_scan_runs_each_pattern_once(stored):
    conf = stored["scan_texts"].sparkSession.conf
    conf.set("spark.sql.debug.maxToStringFields", "1000")
    text = plan(scan.flagged_items(scan.scan_signal(stored["scan_texts"]), "doc_id"))
    conf.unset("spark.sql.debug.maxToStringFields")
    assert text.count("jailbreak\\b") == 1


def test_membership_is_one_exchange(stored):
    text = plan(fidelity.membership(stored["matrix_reproduced"], stored["matrix_published"]))
    assert text.count("Exchange") == 1 and "feature_id" in text


def test_windows_are_partitioned(stored):
    """No window over all rows: the only unpartitioned ones run over per-chunk sums."""
    text = plan(fidelity.correlate(stored["matrix_reproduced"].select(F.col("value").alias("x"), (F.col("value") * 2).alias("y")), [], pooled=True))
    for line in text.splitlines():
        if "Window [" in line:
            assert "range" in line or "_size" in line, line


def test_missing_keys_are_spread(spark):
    """Rows whose key is NULL do not meet in one task, even without adaptive execution or broadcasts."""
    from paperloom.operators import merge
    from paperloom.operators.ranking import lookup

    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        left = spark.range(20000).select(F.col("id").alias("pmid0"), F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("k"))
        right = spark.range(0, 20000, 10).select(F.col("id").cast("string").alias("r"), F.lit(1).alias("found"))
        rows = lookup(left, right, F.col("k"), "r")
        sizes = [r[0] for r in rows.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(sizes) == 16 and max(sizes) < 2 * 20000 / 16
        assert rows.where("found = 1").count() == 2000 and rows.count() == 20000 and rows.columns == ["pmid0", "k", "found"]
        articles = spark.range(20000).select(
            F.lit(None).cast("string").alias("doi"), F.col("id").cast("string").alias("pmid"), F.lit(None).cast("string").alias("pmcid"),
            F.when(F.col("id") % 10 != 0, F.lit("2020-01-01").cast("date")).alias("publication_date"))
        snapshot = right.select(F.col("r").alias("pmid"), F.lit("2021-01-01").cast("date").alias("publication_date"), F.lit(None).cast("string").alias("error"))
        out, counters = merge.backfill_dates(articles, snapshot)
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(sizes) < 2 * 20000 / 16 and counters.first().updated == 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_left_join_shares_the_inner_joins_exchanges(stored):
    """One exchange a side, and one by left row that tells which met nothing."""
    from paperloom.operators.idjoin import id_join

    left = stored["article_embeddings"].select("doi", "pmid", "pmcid", "vec_id")
    right = stored["articles"].select("doi", "pmid", "pmcid", "row_id")
    conf = left.sparkSession.conf
    conf.set("spark.sql.adaptive.enabled", "false")
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(id_join(left, right, "left"))
    finally:
        conf.unset("spark.sql.adaptive.enabled")
        conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 3 and text.count("SortMergeJoin") == 1


def test_graph_reads_its_links(stored):
    """Nodes, edges and counts plan no join of articles and links again."""
    for part in graph.literature_graph(stored, include=("journals", "authors", "keywords")):
        text = plan(part)
        assert "article_authors" not in text and "article_keywords" not in text
