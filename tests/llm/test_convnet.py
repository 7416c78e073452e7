import zlib

import numpy as np
from conftest import DATA
from frames import documents, sentence

from llm import convnet
from llm.convnet import CHUNK, STEP, STRIDE, TAPS, WIDTH, WINDOWS, Network, cut, fit, fold, n_chunks, quality, score, train
from llm.queries import QUERIES


def labels(spark, rows):
    return spark.createDataFrame([(i, q, "x", 0.5) for i, q in rows], "doc_id long, quality int, text string, score double")


def corpus(n):
    """Every third text is junk: marks behind its words, or one word again and again."""
    rows = []
    for i in range(n):
        words = sentence(i, 10 + i * 7 % 200)
        if i % 6 == 0:
            words = [w + "&&&" for w in words]
        elif i % 6 == 3:
            words = words[:1] * len(words) + words[1:3]
        rows.append((i, " ".join(words)))
    return rows


def by_hand(net, text):
    """The network byte by byte, window by window."""
    w, data = net.weights, text.encode()
    starts = [0]
    while starts[-1] + CHUNK < len(data):
        starts.append(starts[-1] + STEP)
    deep = []
    for s in starts:
        chunk = data[s : s + CHUNK].ljust(CHUNK, b"\0")
        x = w["bytes"][list(chunk)]
        filters = w["filters"].reshape(TAPS * STRIDE * x.shape[1], -1)
        best = np.max([x[a * STRIDE : a * STRIDE + WIDTH].ravel() @ filters for a in range(WINDOWS)], axis=0) + w["offsets"]
        deep.append(np.tanh(np.maximum(best, 0) @ w["dense"] + w["shift"]))
    return float(1 / (1 + np.exp(-(np.mean(deep, axis=0) @ w["out"] + w["bias"][0]))))


def test_chunks_cover_all_bytes_and_windows():
    for n in [0, 1, 7, 511, 512, 513, 959, 960, 961, 10_000]:
        k = int(n_chunks(np.array([n]))[0])
        data = np.arange(n, dtype=np.int64) % 251 + 1
        got = cut(data.astype(np.uint8), np.arange(k) * STEP, np.full(k, n))
        assert got.shape == (k, CHUNK)
        covered = {a * STEP + o for a in range(k) for o in range(CHUNK) if a * STEP + o < n}
        assert covered == set(range(n)) and (got.ravel() > 0).sum() == sum(min(CHUNK, n - a * STEP) for a in range(k) if n)
        windows = {a * STEP + o for a in range(k) for o in range(0, CHUNK - WIDTH + 1, STRIDE)}
        assert all(o in windows for o in range(0, max(0, n - WIDTH + 1), STRIDE))


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(4)
    net = Network.start(5)
    net.weights = {n: v.astype(np.float64) for n, v in net.weights.items()}
    chunks, counts, truth = rng.integers(0, 256, (5, CHUNK)).astype(np.uint8), np.array([2, 1, 2]), np.array([1.0, 0.0, 1.0])

    def loss():
        text = np.repeat(np.arange(3), counts)
        deep = net.features(chunks)
        p = net.probability(np.stack([deep[text == i].mean(axis=0) for i in range(3)]))
        return float(-np.mean(truth * np.log(p) + (1 - truth) * np.log(1 - p)))

    g = net.gradient(chunks, counts, truth)
    for name, value in net.weights.items():
        flat = value.reshape(-1)
        for at in rng.choice(flat.size, min(6, flat.size), replace=False):
            old, step = flat[at], 1e-5
            flat[at] = old + step
            up = loss()
            flat[at] = old - step
            down = loss()
            flat[at] = old
            assert abs((up - down) / (2 * step) - g[name].reshape(-1)[at]) < 1e-4, name


def test_scores_are_those_of_the_whole_text(spark, monkeypatch):
    net = Network.start(6)
    rows = [(1, None), (2, ""), (3, "é😀 x"), (4, "word " * 3000), (4, "word " * 3000), (None, "a" * 513), (5, " ".join(sentence(1, 700)))] + corpus(40)
    got = score(documents(spark, rows), net, "doc_id", "key").collect()
    assert len(got) == len(rows)
    want = sorted(((repr(i), round(by_hand(net, t or ""), 4)) for i, t in rows))
    assert all(a == c and abs(b - d) < 2e-4 for (a, b), (c, d) in zip(sorted((repr(r.doc_id), round(r.score, 4)) for r in got), want))
    # A change in the last bytes of a long text changes its score.
    end = [(1, "word " * 3000), (2, "word " * 2999 + "&&&&&&&&&&")]
    a, b = (r.score for r in score(documents(spark, end), net, "doc_id").orderBy("doc_id").collect())
    assert a != b


def test_learns_and_holds_out(spark):
    rows = corpus(900) + [(5000, None), (5001, ""), (None, "x")]
    truth = [(i, int(i % 3 != 0)) for i, _ in rows[:900]] + [(5000, None), (7777, 0), (None, 1)]
    got = quality(documents(spark, rows), labels(spark, truth)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [(r.predicted, r.doc_id % 3 != 0) for r in got if r.held_out and r.doc_id < 900]
    assert len(held) > 150 and np.mean([p == q for p, q in held]) > 0.95
    # Labels of held-out documents, and columns other than the text, change nothing.
    turned = [(i, q if q is None or i is None or zlib.crc32(str(i).encode()) % 4 != 2 else 1 - q) for i, q in truth]
    again = quality(documents(spark, [(i, t, "other") for i, t in rows]), labels(spark, turned)).collect()
    key = lambda r: (repr(r.doc_id), r.score)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_same_texts_give_the_same_network():
    texts = [(np.frombuffer(t.encode()[:CHUNK].ljust(CHUNK, b"\0"), np.uint8)[None], i % 2) for i, t in corpus(40)]
    a, b = fit(texts, epochs=2), fit(texts, epochs=2)
    assert all((a.weights[n] == b.weights[n]).all() for n in a.weights)


def test_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(convnet, "fit", lambda texts, epochs: seen.append(texts) or Network.start(1))
    rows = [(i, "ab " * 5000) for i in range(100)] + [(1, "cd " * 5000)]
    train(documents(spark, rows), labels(spark, [(i, i % 2) for i in range(100)] + [(1000 + i, 1) for i in range(500)]), sample=50, chunks=4)
    assert len(seen[0]) == 50 and all(len(c) == 4 for c, _ in seen[0])


def test_one_label_or_none(spark):
    docs = documents(spark, corpus(20))
    assert {r.score for r in quality(docs, labels(spark, [])).collect()} == {0.5}
    assert {r.score for r in quality(docs, labels(spark, [(i, 0) for i in range(20)])).collect()} == {0.0}
    assert {r.score for r in quality(docs, labels(spark, [(i, 1) for i in range(20)])).collect()} == {1.0}
    assert quality(documents(spark, []), labels(spark, [(1, 1)])).collect() == []


def test_query(spark):
    got = QUERIES["op13_byte_convnet"](spark, DATA).collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]) > 0.7
    assert spark.range(3).select(fold("id")).collect()[1][0] == zlib.crc32(b"1") % 4
