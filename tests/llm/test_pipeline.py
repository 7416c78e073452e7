import re
from collections import Counter

import pytest
from conftest import DATA
from pyspark.sql import functions as F
from test_hilbert import laid_out
from test_minhash import brute
from test_mixing import wanted

import corpus_pipeline as pipeline
from llm.common import materialize
from llm.toxicity import toxicity


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first and after each stage."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], DATA), name))
    return [[r.asDict() for r in df.collect()] for df in out]


def test_columns(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(list(rows[0]) == columns for rows in stages[:-1])
    assert {*columns, "shard", "slot"} <= set(stages[-1][0])


def test_toxic_documents_go(spark, stages):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    toxic = {r.doc_id for r in toxicity(docs, spark.read.parquet(f"{DATA}/labels.parquet")).collect() if r.predicted}
    assert {r["doc_id"] for r in stages[1]} == {r["doc_id"] for r in stages[0]} - toxic


def test_one_of_each_group_stays(stages):
    kept = {i for i, _, _, k in brute([(r["doc_id"], r["text"]) for r in stages[1]], 5) if k}
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(kept)


def test_leaks_go_and_others_stay(spark, stages):
    words = lambda t: f" {' '.join(re.findall(r'[^_\W]+', t.lower()))} "
    tests = [words(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert {r["doc_id"] for r in stages[3]} == {r["doc_id"] for r in stages[2] if not any(t in words(r["text"]) for t in tests)}


def test_mix(stages):
    size = {r["doc_id"]: len(r["text"].encode().split()) for r in stages[3]}
    source = {r["doc_id"]: r["source"] for r in stages[3]}
    copies = Counter(r["doc_id"] for r in stages[4])
    assert set(copies) <= set(size) and max(copies.values()) <= 2
    total, taken = Counter(), Counter()
    for i, n in size.items():
        total[source[i]] += n
        taken[source[i]] += n * copies[i]
    for s, target in wanted(dict(total)).items():
        assert abs(taken[s] - target) <= max(n for i, n in size.items() if source[i] == s)


def test_shards(spark, stages):
    from pyspark.sql import Row

    laid_out([Row(**r) for r in stages[5]])
    assert sorted(r["doc_id"] for r in stages[5]) == sorted(r["doc_id"] for r in stages[4])


def test_awkward_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "x y z", "en", "a", 5), (3, "x y z", None, "a", 5), (3, "x y z", None, "a", 5), (4, "w " * 30000, "de", None, 60000)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long")
        for name, stage in pipeline.STAGES:
            docs = materialize(stage(spark, docs, DATA), name)
        assert {r.doc_id for r in docs.collect()} == ({None, 3, 4} if some else set())


CLASHES = ["values", "score", "raw", "features", "prediction", "probability", "__text", "spot", "size", "target", "copies", "source_size", "__key", "__rest", "__copy", "kept", "component_id", "a.b"]


def test_columns_of_any_name_stay(spark):
    """No column is lost, changed or mistaken for one that a stage makes itself."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    plain = {}
    for extra in ([], CLASHES):
        rows = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in extra})
        for name, stage in pipeline.STAGES[:-1]:
            rows = materialize(stage(spark, rows, DATA), name)
            assert rows.columns == docs.columns + extra
            ids = sorted(r[0] for r in rows.select("doc_id").collect())
            assert plain.setdefault(name, ids) == ids
        for r in rows.collect() if extra else []:
            assert all(r[c] == f"{c} of {r['doc_id']}" for c in extra)


def test_rows_that_share_id_and_text(spark):
    rows = [(1, "x y z", "en", "b", 5, 1), (1, "x y z", "de", "c", 5, 2), (1, "x y z", "de", "a", 5, 3), (1, "x y z", None, None, 5, 4), (1, "other", "en", "b", 5, 5), (None, "x y z", "en", "b", 5, 6), (None, "x y z", "en", "b", 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int")
    for n in (1, 5):
        got = pipeline.deduplicated(spark, docs.repartition(n), DATA).collect()
        assert sorted(r["row"] for r in got) == [4, 5, 6, 6]
