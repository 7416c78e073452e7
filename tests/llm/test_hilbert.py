import zlib

from conftest import DATA
from frames import documents
from pyspark.sql import functions as F

from llm.hilbert import hilbert_index, shard
from llm.queries import QUERIES


def test_curve_visits_each_cell_by_unit_steps(spark):
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        side = 1 << bits
        cols = [(F.floor(F.col("id") / side**i) % side).cast("int").alias(f"x{i}") for i in range(dims)]
        rows = sorted(map(tuple, spark.range(side**dims).select(*cols).select(hilbert_index([F.col(f"x{i}") for i in range(dims)], bits), "*").collect()))
        assert [r[0] for r in rows] == list(range(side**dims))
        assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:])) == 1 for p, q in zip(rows, rows[1:]))


def laid_out(got, shards=16):
    counts = [sorted(r.slot for r in got if r["shard"] == s) for s in range(shards)]
    assert all(c == list(range(len(c))) for c in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    assert sum(map(len, counts)) == len(got)


def test_shards(spark):
    rows = [(i, "x" * (i * i % 5000), ["hot", "a", "b", None][max(0, i % 6 - 2)]) for i in range(501)] + [(600, None), (601, ""), (None, "é"), (1, "x"), (1, "x")]
    got = shard(documents(spark, rows)).collect()
    laid_out(got)
    assert sorted((repr(r.doc_id), repr(r.text), r["size"], r.text_crc32) for r in got) == sorted((repr(i), repr(t), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    # A shard holds a narrow range of the curve.
    ends = sorted((min(r.curve for r in got if r["shard"] == s), max(r.curve for r in got if r["shard"] == s)) for s in range(16))
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert sorted((repr(r.doc_id), r["shard"], r.slot) for r in got if r.doc_id != 1) == sorted((repr(r.doc_id), r["shard"], r.slot) for r in shard(documents(spark, rows)).collect() if r.doc_id != 1)


def test_few_rows_and_none(spark):
    for n in (0, 1, 5, 17):
        got = shard(documents(spark, [(i, "t") for i in range(n)])).collect()
        assert len(got) == n
        laid_out(got)


def test_query(spark):
    got = QUERIES["op5_hilbert_sharding"](spark, DATA).collect()
    laid_out(got)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs.items()}
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
