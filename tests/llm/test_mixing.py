from collections import defaultdict

import numpy as np
import pytest
from conftest import DATA
from frames import documents, sentence

from llm.mixing import flight, mix, targets
from llm.queries import QUERIES


def wanted(sizes, weights=(3, 1, 2)):
    """Targets by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        free -= above


def test_targets(spark):
    sizes = {"b": 1000, "a": 10, "é": 400, "z": 0, None: 77, "A": 5000, "aa": 300}
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, documents long")
    got = {r.source: r.target for r in targets(rows).collect()}
    assert got == pytest.approx(wanted(sizes))


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 50, 400):
        size, chance = rng.integers(1, 900, n), rng.random(n)
        out = flight(size, chance, rng.random(n))
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(chance.sum()) and size @ out == pytest.approx(size @ chance)
    equal = flight(np.full(9, 5), np.full(9, 1 / 3), rng.random(9))
    assert sorted(equal) == pytest.approx([0] * 6 + [1] * 3)


def test_flight_keeps_probabilities():
    rng = np.random.default_rng(4)
    size, chance = np.array([3, 8, 5, 9, 2, 7]), np.array([0.2, 0.5, 0.7, 0.4, 0.9, 0.3])
    mean = np.mean([flight(size, chance, rng.random(6)) for _ in range(4000)], axis=0)
    assert mean == pytest.approx(chance, abs=0.03)


def check(rows, got, slack):
    size, taken, source = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        source[r["source"]] = (r["source_size"], r["target"])
    want = wanted(dict(size))
    for s, (whole, target) in source.items():
        assert whole == size[s] and target == pytest.approx(want[s])
        assert abs(taken[s] - target) <= slack, s


def test_mix(spark):
    rows = [(i, " ".join(sentence(i, 20 + i * 7 % 90)), ["big", "b", "c", None][i % 11 % 4 if i % 3 else 0]) for i in range(1500)]
    rows += [(9001, None, "c"), (9002, "", "c"), (9003, " ", "nothing"), (9004, "x y", "c"), (9004, "x y", "c"), (None, "a b c", "b")]
    run = lambda: [r.asDict() | {"taken": r["size"] * r.copies} for r in mix(documents(spark, rows)).collect()]
    got = run()
    assert len(got) == len(rows)
    check(rows, got, 12)
    key = lambda r: (repr(r["doc_id"]), repr(r["text"]), r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, run()))


def test_empty(spark):
    assert mix(documents(spark, [])).collect() == []


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = [r.asDict() | {"source": docs[r.doc_id].source} for r in QUERIES["op3_cube_mixing"](spark, DATA).collect()]
    assert all(r["size"] == len(docs[r["doc_id"]].text.encode().split()) for r in got) and len(got) == len(docs)
    check(docs, got, 400)  # ten documents a source here
