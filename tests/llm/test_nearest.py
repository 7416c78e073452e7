import random

from conftest import DATA
from compare import differences
from pyspark.sql import functions as F

from llm.nearest import binary_code, nearest
from llm.queries import ORACLES, QUERIES


def rows(spark, codes):
    return spark.createDataFrame([(i, c, 1) for i, c in codes], "id long, code long, distance int")


def brute(queries, codes, k):
    out = set()
    for q, c in {(q, c) for q, c in queries if q is not None and c is not None}:
        near = sorted({((c ^ d) % 2**64).bit_count() * 10**6 + i for i, d in codes if i is not None and d is not None and i != q})[:k]
        out |= {(q, n % 10**6, n // 10**6, r) for r, n in enumerate(near, 1)}
    return out


def test_cases(spark):
    rng = random.Random(2)
    word = lambda: rng.getrandbits(64) - 2**63
    hot = word()
    codes = [(i, hot) for i in range(40)] + [(100 + i, hot ^ (1 << i % 63)) for i in range(60)] + [(200 + i, word()) for i in range(150)]
    codes += [(500, None), (None, 5), (501, 0), (502, -1), (501, 0), (503, hot ^ 0b111)]
    asked = [codes[0], codes[50], codes[120], (9000, word()), (9001, hot), (500, None), (None, 7), (501, 0), (501, 0)]
    for k in (1, 5, 45):
        got = nearest(rows(spark, asked), rows(spark, codes), k).collect()
        assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute(asked, codes, k)


def test_few_rows_and_none(spark):
    assert nearest(rows(spark, [(1, 2)]), rows(spark, []), 3).collect() == []
    assert nearest(rows(spark, []), rows(spark, [(1, 2)]), 3).collect() == []
    assert {tuple(r) for r in nearest(rows(spark, [(1, 0)]), rows(spark, [(1, 0), (2, -1)]), 3).collect()} == {(1, 2, 64, 1)}


def test_code(spark):
    vectors = [([1.0, -1.0, 0.0, 2.0],), ([float("nan"), None, 1.0],), ([],), (None,), ([-1.0] * 63 + [1.0],), ([1.0] * 64,)]
    got = [r[0] for r in spark.createDataFrame(vectors, "v array<float>").select(binary_code(F.col("v"))).collect()]
    assert got == [9, 4, 0, None, -(2**63), -1]


def test_query(spark, duck):
    name = "op7_multi_index_hashing"
    assert differences(QUERIES[name](spark, DATA), duck, ORACLES[name]) is None
