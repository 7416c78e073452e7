import random
import re

import numpy as np
import pyarrow as pa
from conftest import DATA
from frames import documents, sentence

from llm import contamination
from llm.common import Words
from llm.contamination import Items, Places, _hashed, _passages, contaminated, item_blocks, smith_waterman
from llm.queries import QUERIES


def plain_score(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = max(0, rows[i][j] + (2 if x == y else -1), rows[i][j + 1] - 1, rows[i + 1][j] - 1)
    return max(map(max, rows))


def test_alignment():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(n))] for n in (15, 25))
        score, start, end = smith_waterman(a, b)
        assert score == plain_score(a, b)
        assert not score or plain_score(a, b[start:end]) == score


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, words string, number int").select("item_id", "text", "words", "number")


def test_cases(spark):
    item = sentence(1, 40)
    edited = [w if i % 9 else "changed" for i, w in enumerate(item)]
    gaps = item[:12] + ["put", "in", "here"] + item[12:30] + item[33:]
    filler = lambda n: " ".join(sentence(50 + n, 80))
    rows = [(n, f"{filler(n)} {' '.join(words)} {filler(n + 1)}") for n, words in enumerate((item, edited, gaps, item[:10], [w.upper() + "," for w in item]), 1)]
    rows += [(i, f"{filler(i)} {' '.join(item)}") for i in range(100, 160)]  # so frequent that no seed of the item is rare
    rows += [(6, None), (7, ""), (None, " ".join(item)), (8, filler(8)), (1, " ".join(item)), (9, " ".join(item[20:] + item[:20])), (10, "one two three"), (11, "x A, B a b")]
    tests = items(spark, [(1, " ".join(item), "x", 1), (2, None, "x", 1), (3, "", "x", 1), (4, "a b", "x", 1), (None, " ".join(item), "x", 1), (5, "One, two: three!", "x", 1), (1, " ".join(item), "x", 1)])
    got = {(r.doc_id, r.item_id): r for r in contaminated(documents(spark, rows), tests).collect()}
    assert set(got) == {(i, 1) for i in (1, 2, 3, 5, 9, *range(100, 160))} | {(10, 5), (11, 4)}
    assert (got[11, 4].score, got[11, 4].first_word, got[11, 4].end_word) == (1, 1, 3)
    assert got[1, 1].score == got[5, 1].score == 1
    docs = {i: re.findall(r"\w+", (t or "").lower()) for i, t in rows if i != 1}
    for (i, j), r in got.items():
        if i in docs and j == 1:
            assert r.score == plain_score(item, docs[i]) / 80
            assert plain_score(item, docs[i][r.first_word : r.end_word]) / 80 == r.score


def test_edited_copies_against_brute_force(spark):
    """No copy is lost that shares a trigram with its item, with one word in four, five or six changed."""
    tests = {n: sentence(n, 20 + n) for n in range(40)}
    rows = []
    for n, words in tests.items():
        for every in (4, 5, 6):
            copy = [w if (i + n) % every else f"changed{n}x{every}x{i}" for i, w in enumerate(words)]
            rows.append((10 * n + every, " ".join(sentence(500 + n, 30) + copy + sentence(600 + n, 30))))
    rows += [(1000 + n, " ".join(words)) for n, words in tests.items() if n % 2]  # whole copies, so some trigrams are frequent
    want = {(i, n): plain_score(words, text.split()) / (2 * len(words)) for i, text in rows for n, words in tests.items()}
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(documents(spark, rows), items(spark, [(n, " ".join(words), "x", 1) for n, words in tests.items()])).collect()}
    assert got == {pair: score for pair, score in want.items() if score >= 0.5}
    assert len(got) == 140


def test_empty(spark):
    docs, tests = documents(spark, [(1, "a b c d e")]), items(spark, [(1, "a b c d", "x", 1)])
    assert contaminated(documents(spark, []), tests).collect() == []
    assert contaminated(docs, items(spark, [])).collect() == []
    assert [r.doc_id for r in contaminated(docs, tests).collect()] == [1]


def test_blocks_cover_all_items(spark):
    tests = items(spark, [(i, " ".join(sentence(i, 10)), "x", 1) for i in range(50)])
    blocks = item_blocks(tests, 1000)
    assert len(blocks) > 3
    assert sorted(r.item_id for b in blocks for r in b.collect()) == list(range(50))


def test_query(spark):
    """All whole copies are found, and what else is found scores as brute force says."""
    docs = {r.doc_id: re.findall(r"[\w]+", r.text.lower()) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    tests = {r.item_id: re.findall(r"[\w]+", r.text.lower()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    whole = {(i, j) for i, d in docs.items() for j, t in tests.items() if f" {' '.join(t)} " in f" {' '.join(d)} "}
    got = {(r.doc_id, r.item_id): r.score for r in QUERIES["op9_decontamination"](spark, DATA).collect()}
    assert whole <= set(got)
    for (i, j), score in got.items():
        assert score == plain_score(tests[j], docs[i]) / (2 * len(tests[j]))


def block_of(tests):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(tests)), pa.int64()), pa.array([" ".join(t) for t in tests])], names=["number", "words"])
    return Items(next(_hashed(iter([batch]))), 0.5)


def test_stock_phrases_make_no_pairs(spark):
    """As many items as documents, all with one phrase: what leaves the tasks grows with their number, not its square."""
    phrase = "all rights reserved by the holder of this".split()
    n = 400
    tests = [sentence(n, 12) + phrase + sentence(n + 5000, 12) for n in range(n)]
    docs = [sentence(9000 + i, 30) + phrase + sentence(20000 + i, 30) for i in range(n)]
    docs += [sentence(40000 + i, 30) + tests[i] + sentence(50000 + i, 30) for i in range(0, n, 4)]  # real copies among them
    known = block_of(tests)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs))), pa.array([" ".join(d) for d in docs])], names=["doc_id", "words"])
    left = [(d, i) for out in _passages(known)(iter([batch])) for d, i in zip(out.column(0).to_pylist(), out.column(3).to_pylist())]
    assert sorted(left) == [(n + k, 4 * k) for k in range(n // 4)]


def test_passages_in_slices(monkeypatch):
    """The same pairs come out however many are looked at together."""
    rng = random.Random(3)
    tests = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(3, 25))] for _ in range(60)]
    docs = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(200))] + rng.choice(tests) for _ in range(40)]
    known = block_of(tests)
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array([" ".join(d) for d in docs])], names=["doc_id", "words"])
    run = lambda: {(d, f, p, i) for out in _passages(known)(iter([batch])) for d, f, p, i in zip(*[c.to_pylist() for c in out.columns])}
    whole = run()
    monkeypatch.setattr(contamination, "LOOKUPS", 50)
    assert run() == whole and len(whole) > 40
    for d, first, passage, i in whole:
        assert passage.split() == docs[d][first : first + len(passage.split())]
        assert 2 * sum(w in passage.split() for w in tests[i]) >= len(tests[i])


def test_places():
    words = Words(np.frombuffer(b"a b c ab b", np.uint8), np.array([0, 7, 7, 10]))
    assert list(words.count) == [4, 0, 2]
    place = Places(words)
    h = words.hash
    spans = [(0, 0, 4, True), (0, 1, 3, False), (0, 3, 4, True), (1, 2, 4, False), (1, 4, 6, True), (2, 2, 3, True), (2, 0, 2, False)]
    assert place.within(h[[s[0] for s in spans]], np.array([s[1] for s in spans]), np.array([s[2] for s in spans])).tolist() == [s[3] for s in spans]


def test_tasks_carry_no_tables_of_powers(spark, monkeypatch):
    """What hashing needs is made by each worker; on the driver it would be pickled with every later task."""
    from llm import common

    monkeypatch.setattr(common, "_POWERS", {})
    docs, tests = documents(spark, [(1, "a b c d e")]), items(spark, [(1, "a b c d", "x", 1)])
    assert [r.doc_id for r in contaminated(docs, tests).collect()] == [1]
    assert not common._POWERS
