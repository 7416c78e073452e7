import subprocess
import sys
import textwrap

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

import paperloom  # noqa: F401
from paperloom.operators import fidelity, meta, ranking
from paperloom.session import materialize


def test_functions_travel_with_tasks():
    assert "paperloom" in cloudpickle.list_registry_pickle_by_value()


def test_checkpoint_folder_is_the_sessions(tmp_path):
    """A configured folder is used as it is; run apart, because a session keeps its folder."""
    code = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {sys.path[0]!r}); sys.path.insert(0, {__file__.rsplit('/tests/', 1)[0]!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
        from paperloom.session import materialize
        assert materialize(spark.range(5)).count() == 5
        assert os.listdir({str(tmp_path)!r})
        print("used")
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    assert "used" in out.stdout, out.stderr[-2000:]


def test_materialize(spark):
    df = materialize(spark.range(10).withColumns({"r": F.rand(), "s": F.lit("x")}))
    assert df.collect() == df.collect()
    plan = df.where("id > 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and "GreaterThan(id,3)" in plan


def test_cluster_needs_a_shared_folder():
    """Without the setting only local sessions get a folder of their own."""
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {__file__.rsplit('/tests/', 1)[0]!r})
        from types import SimpleNamespace as Some
        from paperloom.session import materialize
        context = Some(getCheckpointDir=lambda: None, master="spark://host:7077")
        df = Some(sparkSession=Some(conf=Some(get=lambda name, default: None), sparkContext=context))
        try:
            materialize(df)
        except ValueError as e:
            print(e)
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=60)
    assert "spark.checkpoint.dir" in out.stdout, out.stderr[-2000:]


def test_one_entity_with_a_third_of_all_rows(spark):
    """Its sums, and those of the entity NULL, are those of numpy, and no window takes an entity as a whole."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("e"), F.col("id") % 100)).alias("entity"),
        (F.sin("id") + 1e6).alias("yi"), (F.pmod(F.col("id"), F.lit(7)) + 1.0).alias("vi"))
    result = meta.meta_analyze(rows)
    assert "Window" not in result._jdf.queryExecution().executedPlan().toString()
    got = {r.entity: r for r in result.collect()}
    studies = {}
    for r in rows.collect():
        studies.setdefault(r.entity, []).append((r.yi, r.vi))
    assert set(got) == set(studies) and got["hot"].k == got[None].k == 2000
    for e, pairs in studies.items():
        y, v = np.array(pairs).T
        w = 1 / v
        theta = (w * y).sum() / w.sum()
        q = (w * (y - theta) ** 2).sum()
        assert abs(got[e].fixed_estimate - theta) < 1e-9 * theta and abs(got[e].q - q) < 1e-6 * q


def test_one_value_with_a_third_of_all_rows(spark):
    rows = spark.range(3000).select(
        F.lit("s").alias("sample"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("x"), F.col("id").cast("double").alias("y"))
    got = fidelity.correlate(rows, ["sample"], pooled=True).collect()
    assert len(got) == 2 and got[0].n == 3000 and abs(got[0].spearman - got[1].spearman) < 1e-12
    ranked = ranking.avg_rank(rows, [], "x", "r")
    assert ranked.where("x = 5.0").select("r").distinct().count() == 1
    assert ranked.agg(F.sum("r")).first()[0] == 3000 * 3001 / 2
