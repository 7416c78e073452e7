"""Readers and gates at size: narrow rows before wide sorts, lists read once, rows dealt out."""

import os
import tempfile

from pyspark.sql import functions as F

from paperloom.operators import ranking, relevance, replay
from paperloom.plans import changes
from paperloom.sources import matrices, repositories


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def matrix():
    folder = tempfile.mkdtemp()
    for name, rows in (("a.tsv", "P1\t1\tNA\nP2\t5\t6"), ("b.tsv", "P1\t2\t3\nP1\tNA\t4")):
        with open(os.path.join(folder, name), "w") as f:
            f.write(f"id\ts1\ts2\n{rows}\n")
    return folder


def test_last_rows_are_taken_while_they_are_wide(spark):
    folder = matrix()
    m = matrices.read_matrix(spark, folder, sep="\t", position="at", last_rows=True)
    text = plan(m)
    assert text.index("Generate") < text.index("Aggregate")  # the aggregate is below
    got = {(r.feature_id, r.sample): r.value for r in m.collect()}
    assert got == {("P1", "s1"): None, ("P1", "s2"): 4.0, ("P2", "s1"): 5.0, ("P2", "s2"): 6.0}
    every = matrices.read_matrix(spark, folder, sep="\t", position="at")
    assert {(r.feature_id, r.sample): r.value for r in ranking.last_by(every, ["feature_id", "sample"], "at").collect()} == got


def test_positions_hold_numbers_only(spark):
    dep = matrices.read_dep(spark, matrix(), "\t", position="at", id_col="id", log2fc_col="s1")
    assert "string" not in dict(dep.dtypes)["at"]
    assert {r.feature_id: r.log2fc for r in ranking.first_by(dep, ["feature_id"], "at").collect()} == {"P1": 1.0, "P2": 5.0}


def test_archives_are_packed_and_read(spark, tables):
    contents = changes.archive_contents(tables)
    assert "MapInPandas" in plan(contents) and contents.columns == ["archive_path", "total_files", "total_size", "broken"]
    assert contents.count() == tables["documents"].count() and contents.where("broken").count() > 0


def test_studies_are_dealt_out(spark):
    def scorer(question, context, level):
        return F.struct(F.lit(0.9).alias("score"), F.lit(True).alias("directly_measures"), F.spark_partition_id().cast("string").alias("reason"), F.lit(None).cast("string").alias("error"))

    contexts = spark.range(0, 40, 1, 1).select("id", F.lit("text").alias("context"), F.lit("excerpt").alias("context_level"), F.lit("text").alias("full_context"))
    scored = relevance.score_studies(contexts, "Q?", scorer, partitions=4)
    assert scored.count() == 40 and scored.select("reason").distinct().count() == 4


def test_proxi_lists_are_read_once_in_many_tasks(spark):
    json = '{"title":"t","publications":[{"pmid":5},{"doi":"10.1/x"}],"instruments":["a",""]}'
    df = spark.range(0, 8, 1, 1).select(F.col("id").cast("string").alias("dataset_id"), F.lit(json).alias("json"), F.rand(1).alias("r")).drop("r")
    df = df.withColumn("json", F.concat("json", F.lit(" ")))
    p = repositories.proxi_datasets(df, "json", partitions=4)
    assert p.rdd.getNumPartitions() == 4
    assert plan(repositories.proxi_datasets(df.select("dataset_id", F.concat("json", "dataset_id").alias("json")), "json")).count("$.publications") == 1
    row = p.first()
    assert (row.pmid, row.doi, row.instruments, row.species) == ("5", "10.1/x", ["a"], [])


def test_link_groups_are_short_and_heads_are_joined_once(spark):
    rows = [(s, [s % 7, 10 + s % 5] if s % 3 else [s]) for s in range(60)]
    groups = spark.createDataFrame([(s, str(g)) for s, gs in rows for g in gs], "seq bigint, g string")
    taken, expected = set(), []
    for s, gs in rows:
        if taken.isdisjoint(gs):
            taken.update(gs)
            expected.append(s)
    assert sorted(r.seq for r in replay.first_come(groups).collect()) == expected
    links = spark.createDataFrame([("d", None, "c", 1, 5)], "doi string, pmid string, pmcid string, keyword_id int, seq bigint")
    made = replay.groups_of(links, ["doi", "pmid", "pmcid"], ["keyword_id"], "seq")
    assert [len(r.g) for r in made.collect()] == [16, 16]
