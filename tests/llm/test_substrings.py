from frames import documents, sentence
from pyspark.sql import functions as F

from llm.queries import QUERIES
from llm.substrings import remove_repeats


def brute(rows, size=50):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for j in range(len(w) - size + 1):
            if i is not None:
                key = tuple(w[j : j + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - size + 1):
            if i is not None and first[tuple(w[j : j + size])] < i:
                gone[j : j + size] = [True] * size
        out.append((i, len(w), sum(gone), " ".join(x.decode() for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def run(spark, rows, size=50):
    return sorted((tuple(r) for r in remove_repeats(documents(spark, rows), size).collect()), key=repr)


def test_cases(spark):
    a, b = sentence(1, 120), sentence(2, 300)
    edited = a[:60] + ["x"] + a[61:]
    rows = [
        (5, " ".join(a)), (2, "\t\n " + "  ".join(a) + "\r"), (9, " ".join(b[:40] + a[10:70] + b[40:])), (11, " ".join(edited)), (12, " ".join(a[:49])),
        (13, " ".join(a[30:80])), (14, None), (15, ""), (None, " ".join(a)), (2, " ".join(b)), (2, " ".join(b)), (20, "na " * 500), (21, "na " * 70), (22, " ".join(b + a)),
    ]
    assert run(spark, rows) == brute(rows)


def test_other_spaces_are_word_parts(spark):
    words = sentence(3, 60)
    rows = [(1, " ".join(words)), (2, " ".join(words[:30]) + " " + " ".join(words[30:])), (3, " ".join(words))]
    assert run(spark, rows) == brute(rows)


def test_small_windows_in_random_text(spark):
    rows = [(i, " ".join(f"w{(i * 31 + j * j * (i % 3 + 1)) % 7}" for j in range(5 + i * 3 % 40))) for i in range(40)]
    assert run(spark, rows, 6) == brute(rows, 6)


def test_empty(spark):
    assert run(spark, []) == []


def test_query(spark, tables):
    from conftest import DATA

    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op1_substring_dedup"](spark, DATA).collect()
    want = [(i, n, r, t) for i, n, r, t in brute([tuple(d) for d in docs])]
    digests = spark.createDataFrame(want, "doc_id long, n_words long, n_removed long, kept string").withColumn("kept", F.sha2("kept", 256))
    assert sorted(map(tuple, got)) == sorted(map(tuple, digests.collect()))

