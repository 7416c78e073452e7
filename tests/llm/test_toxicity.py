import zlib

import numpy as np
from conftest import DATA
from frames import documents, sentence

from llm.queries import QUERIES
from llm.toxicity import FEATURES, _features, fold, toxicity


def labels(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, toxic int, text string")


def corpus(n):
    rows = []
    for i in range(n):
        words = sentence(i, 30 + i % 40)
        if i % 5 == 0:
            words[3 + i % 20] = ["idiot", "MORON!", "zorgly%d" % (i % 7), "1d10t", "scum"][i // 5 % 5]
            words.insert(2, "you")
        rows.append((i, " ".join(words)))
    return rows


def test_learns_and_holds_out(spark):
    rows = corpus(1500) + [(5000, None), (5001, ""), (5002, "!!! ???"), (None, "you idiot"), (5003, "idiot " * 3000), (5003, "idiot " * 3000)]
    truth = [(i, int(i % 5 == 0)) for i, _ in rows[:1500]] + [(5000, None), (7777, 1), (None, 1), (0, 0)]
    got = toxicity(documents(spark, rows), labels(spark, truth)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [(r.score, r.doc_id % 5 == 0) for r in got if r.held_out and r.doc_id < 1500]
    right = np.mean([(s >= 0.5) == t for s, t in held])
    assert len(held) > 200 and right > 0.97
    again = toxicity(documents(spark, rows), labels(spark, truth)).collect()
    key = lambda r: (repr(r.doc_id), r.score)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_held_out_labels_are_not_read(spark):
    rows = corpus(400)
    truth = [(i, int(i % 5 == 0)) for i, _ in rows]
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in truth]
    run = lambda t: {r.doc_id: r.score for r in toxicity(documents(spark, rows), labels(spark, t)).collect()}
    assert run(truth) == run(turned)


def test_one_label_or_none(spark):
    docs = documents(spark, corpus(20))
    assert {r.score for r in toxicity(docs, labels(spark, [])).collect()} == {0.0}
    assert {r.score for r in toxicity(docs, labels(spark, [(i, 0) for i in range(20)])).collect()} == {0.0}
    assert {r.score for r in toxicity(docs, labels(spark, [(i, 1) for i in range(20)])).collect()} == {1.0}
    assert toxicity(documents(spark, []), labels(spark, [(1, 1)])).collect() == []


def test_labels_without_a_document_take_no_place_in_the_sample(spark):
    rows = corpus(300)
    truth = [(i, int(i % 5 == 0)) for i, _ in rows]
    run = lambda t: {r.doc_id: r.score for r in toxicity(documents(spark, rows), labels(spark, t), 200).collect()}
    alone = run(truth)
    assert len(set(alone.values())) > 1 and run(truth + [(i, i % 2) for i in range(1000, 21000)]) == alone


def test_features(spark):
    rows = [(1, "You are an Idiot, really"), (2, "an 1d1ot"), (3, "ABC def!"), (4, None), (5, "loooser lowly")]
    made = documents(spark, rows).select("doc_id", "text").mapInArrow(_features({"=idiot": 3.0, "^lowl": 2.0}), "doc_id long, values array<double>")
    got = {r.doc_id: dict(zip(FEATURES, r[1])) for r in made.collect()}
    assert got[1]["word_density"] == 0.2 and got[1]["word_weight"] == 3 and got[1]["near_second_person"] == 0.2 and got[1]["second_person"] == 0.2
    assert got[2]["word_density"] == 0 and got[2]["hidden_density"] == 0.5 and got[2]["obfuscation"] == 0.5
    assert got[3]["capitals"] == 0.5 and got[3]["shouted_words"] == 0.5 and got[3]["exclamations"] == 1 / 8
    assert set(got[4].values()) == {0.0}
    assert got[5]["stretched"] == 0.5 and got[5]["prefix_weight"] == 2


def test_query(spark):
    got = QUERIES["op8_toxicity"](spark, DATA).collect()
    assert len(got) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert spark.range(3).select(fold("id")).collect()[1][0] == zlib.crc32(b"1") % 5
