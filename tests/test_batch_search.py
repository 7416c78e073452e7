import random

import numpy as np
import pytest

from paperloom.functions.vectors import decode_embedding, encode_embedding, matrix
from paperloom.operators import batch_search
from paperloom.operators.batch_search import Bests, search_many

KINDS = "id long, embedding array<float>, score double, rank int"


def by_hand(rows, queries, k):
    out = []
    asked = {}
    for q, v in queries:
        asked.setdefault(q, []).append(v)
    for q, vectors in asked.items():
        found = []
        for v in vectors:
            for i, e in rows:
                if i is None or not e or len(e) != len(v) or any(x is None or not np.isfinite(x) for x in e):
                    continue
                total = 0.0
                for a, b in zip(v, e):
                    total += float(np.float32(a)) * float(np.float32(b))
                found.append((-total, i))
        out += [(q, i, -s, n) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, rows, queries, k=4, kinds=KINDS):
    e = spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], kinds).repartition(5)
    q = spark.createDataFrame(queries, "query_id string, embedding array<float>")
    return sorted(((r.query_id, r.id, r.score, r["rank"]) for r in search_many(e, q, k).collect()), key=repr)


def vectors(seed, n, length=6):
    rng = random.Random(seed)
    return [[rng.choice([-1.0, 0.0, 0.5, 0.1, 3.0]) for _ in range(length)] for _ in range(n)]


def test_ties_go_to_the_smaller_id(spark):
    rows = list(enumerate(vectors(1, 300)))
    queries = [(f"q{i}", v) for i, v in enumerate(vectors(2, 20))]
    assert found(spark, rows, queries) == by_hand(rows, queries, 4)
    same = [(i, [1.0, 2.0, 0.1, 0.3, 0.7, 0.9]) for i in range(500)]  # one vector in all rows
    assert found(spark, same, queries[:3]) == by_hand(same, queries[:3], 4)


def test_awkward_rows(spark):
    rows = list(enumerate(vectors(3, 30))) + [(900, None), (901, []), (902, [1.0] * 5), (903, [None] * 6), (904, [float("nan")] * 6), (905, [float("inf")] * 6), (None, [9.0] * 6), (7, [2.0] * 6)]
    queries = [("a", [1.0] * 6), ("a", [-1.0] * 6), (None, [0.5] * 6), ("b", None), ("c", [float("nan")] * 6), ("d", []), ("e", [1.0] * 5)]
    want = [(q, v) for q, v in queries if v and all(np.isfinite(v))]
    assert found(spark, rows, queries) == by_hand(rows, want, 4)
    assert found(spark, rows[:2], queries[:1], 50) == by_hand(rows[:2], queries[:1], 50)
    assert found(spark, [], queries) == [] and found(spark, rows, []) == []


def test_text_ids_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(batch_search, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(batch_search, "FAN", 2)
    rows = [(f"é{i:03d}", v) for i, v in enumerate(vectors(4, 80))]
    queries = [(f"q{i}", v) for i, v in enumerate(vectors(5, 12))]
    assert found(spark, rows, queries, 3, KINDS.replace("id long", "id string")) == by_hand(rows, queries, 3)


def test_bests_do_not_depend_on_how_rows_are_cut():
    rng = np.random.default_rng(6)
    rows, queries = rng.normal(size=(400, 8)), rng.normal(size=(7, 8))
    rows[50:90] = rows[3]
    ids = rng.permutation(400)
    whole = Bests(queries, 9)
    whole.take(rows, ids)
    parts = Bests(queries, 9)
    for at in range(0, 400, 13):
        parts.take(rows[at : at + 13], ids[at : at + 13])
    assert (whole.score == parts.score).all() and (whole.id == parts.id).all()


def test_no_vector_is_exchanged_and_no_rows_are_crossed(spark):
    e = spark.createDataFrame([(i, v, 1.0, 2) for i, v in enumerate(vectors(7, 10))], KINDS)
    plan = search_many(e, spark.createDataFrame([("q", [1.0] * 6)], "query_id string, embedding array<float>"))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan
    assert all("vector" not in line and "embedding" not in line for line in plan.splitlines() if "Exchange" in line)


def test_decode_views_the_batch(spark):
    rows = [(1, np.arange(3, dtype="<f4").tobytes()), (2, None), (3, b""), (4, np.array([np.nan, -1.5], "<f4").tobytes())]
    df = spark.createDataFrame(rows, "i int, b binary").coalesce(1)
    got = {r.i: r.v for r in df.select("i", decode_embedding("b").alias("v")).collect()}
    assert got[1] == [0, 1, 2] and got[2] is None and got[3] == [] and np.isnan(got[4][0]) and got[4][1] == -1.5
    back = {r.i: r.e for r in df.select("i", encode_embedding(decode_embedding("b")).alias("e")).collect()}
    assert back == dict(rows)
    with pytest.raises(Exception, match="multiple of 4"):
        spark.createDataFrame([(b"abc",)], "b binary").select(decode_embedding("b")).collect()


def test_matrix():
    import pyarrow as pa

    usable, values = matrix(pa.array([[1, 2], None, [3], [4, None], [5, 6]], pa.list_(pa.float64())).slice(1), 2)
    assert usable.tolist() == [False, False, False, True] and values.tolist() == [[5, 6]]
