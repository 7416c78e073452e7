import math
import random

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from llm import quantise
from llm.queries import ORACLES, QUERIES
from llm.quantise import above, closest, digest, distances, integers, narrowed, product_codes, reassign, with_label_errors

ROW = "vec_id long, embedding array<float>, label string, code string, error int, x int, near string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", 5, 6, "n") for i, v, lab in rows], ROW)


def by_hand(rows, parts, entries, rounds):
    """All distances in every round, with Python's integers."""
    kept = sorted(
        ((i is None, i or 0, v, lab) for i, v, lab in rows if v and all(c is not None and math.isfinite(c) for c in v) and len(v) % parts == 0),
        key=lambda r: r[:3],
    )
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    length = len(kept[0][2]) // parts
    cut = [[[math.floor(256 * c) for c in v[p * length : (p + 1) * length]] for p in range(parts)] for _, _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(entries, len(cut)))] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for done in range(rounds + 1):
        codes = [[min(range(len(books[p])), key=lambda e: (far(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]
        if done == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, code in zip(cut, codes) if code[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    out = []
    for (missing, i, _, lab), c, code in zip(kept, cut, codes):
        out.append((None if missing else i, "".join(f"{e:02x}" for e in code), sum(far(c[p], books[p][code[p]]) for p in range(parts)), lab))
    return out, books


def check(spark, rows, parts=4, entries=16, rounds=3):
    codes, books = product_codes(frame(spark, rows), parts=parts, entries=entries, rounds=rounds)
    want, by = by_hand(rows, parts, entries, rounds)
    got = [(r.id, r.code, r.error, r.label, r.label_error) for r in with_label_errors(codes).collect()]
    total = {}
    for _, _, error, lab in want:
        total[lab] = total.get(lab, 0) + error
    assert books.tolist() == by
    assert sorted(got, key=repr) == sorted([(*w, total[w[3]]) for w in want], key=repr)


def single(x):
    return float(np.float32(x))


def test_against_all_distances(spark):
    rng = random.Random(11)
    centre = [[rng.gauss(0, 0.3) for _ in range(8)] for _ in range(9)]
    rows = [(i, [single(c + rng.gauss(0, 0.05)) for c in rng.choice(centre)], rng.choice("ab")) for i in range(600)]
    check(spark, rows)
    check(spark, rows, parts=8, entries=5, rounds=1)
    check(spark, rows, parts=2, entries=100, rounds=2)


def test_ties_repeats_and_gaps(spark):
    rng = random.Random(12)
    rows = [(i, [single(rng.randrange(-2, 3) / 64) for _ in range(8)], rng.choice(["a", None])) for i in range(300)]
    rows += [(500 + i, [0.0, -0.0] * 4, None) for i in range(200)]  # one vector many times
    rows += [(3, rows[3][1], "a"), (3, rows[4][1], "z"), (None, rows[5][1], None)]
    rows += [(900, None, "a"), (901, [None] * 8, "a"), (902, [float("nan")] * 8, "a"), (903, [0.0] * 7 + [float("-inf")], "a"), (904, [], "a"), (905, [1.0] * 4, "a"), (906, [1.0] * 7, "b")]
    check(spark, rows)


def test_few_rows_and_none(spark):
    check(spark, [(1, [0.5] * 8, None)])
    check(spark, [(2, [0.5] * 8, "a"), (1, [single(-0.7)] * 8, "a")])
    codes, books = product_codes(frame(spark, [(1, None, "a")]))
    assert with_label_errors(codes).collect() == [] and books.size == 0
    assert digest(books) == digest(np.zeros((0,), np.int64))
    with pytest.raises(ValueError):
        product_codes(frame(spark, []), entries=300)


def test_large_components_are_held_at_the_limit(spark):
    codes, books = product_codes(frame(spark, [(1, [3e38] * 8, "a"), (2, [-3e38] * 8, "a"), (3, [1.0] * 8, "a")]), parts=4, entries=2)
    assert np.abs(books).max() <= quantise.largest(8) and with_label_errors(codes).count() == 3


def test_bounds_hold_and_save_distances():
    """After each move every bound is true, the entry is the nearest, and few distances were taken."""
    rng = np.random.default_rng(13)
    parts, k, length, b = 3, 32, 4, 8
    centre = rng.normal(0, 60, (parts, k, length))
    n = 500
    part = np.tile(np.arange(parts), n)
    x = np.rint(centre[part, rng.integers(0, k, n * parts)] + rng.normal(0, 6, (n * parts, length))).astype(np.int64)
    book = x.reshape(n, parts, length)[:k].transpose(1, 0, 2).copy()
    near, bound = closest(x, part, book, b)
    asked = []
    for _ in range(12):
        d = distances(x, book[part])
        new = book.copy()
        for p in range(parts):
            for e in range(k):
                mine = x[(part == p) & (near[:, 0] == e)]
                if len(mine):
                    new[p, e] = mine.sum(axis=0) // len(mine)
        moved = above(((new - book) ** 2).sum(axis=2))
        book = new
        need, taken = reassign(x, near, bound, part, book, moved, moved.max(axis=1))
        near, bound = narrowed(near, bound, need, 4)
        asked.append(taken / (len(x) * k))
        d = distances(x, book[part])
        assert (near[:, 0] == d.argmin(axis=1)).all()
        true = np.sqrt(d) * quantise.SCALE
        rows = np.arange(len(x))[:, None]
        assert (bound[:, 0] >= true[rows[:, 0], near[:, 0]]).all()
        assert (bound[:, 1:-1] <= true[rows, near[:, 1:]]).all()
        rest = true.copy()
        rest[rows, near] = np.inf
        assert (bound[:, -1] <= rest.min(axis=1)).all()
    assert asked[-1] < 0.1 and near.shape[1] <= b


def test_floor_goes_down():
    assert integers(np.array([-0.001, 0.001, -1.0, 0.5]), 1000).tolist() == [-1, 0, -256, 128]


def test_query(spark, duck):
    from compare import differences

    assert differences(QUERIES["op11_vector_codes"](spark, DATA), duck, ORACLES["op11_vector_codes"]) is None
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert product_codes(rows)[0].count() == rows.count()
