import random
from hashlib import sha256

from llm.conversations import CONTROL, END, MIDDLE, START, chained, digest, escape, format_conversations, leaf_paths, read_back, unescape
from pyspark.sql import functions as F

NODES = "tree long, node long, parent long, role string, text string, score double, depth int"


def nodes(spark, rows):
    return spark.createDataFrame([(t, n, p, "user", f"t{n}", s, 1) for t, n, p, s in rows], NODES)


def best(rows, top):
    """Root-to-leaf paths by hand."""
    kept = {}
    for t, n, p, s in rows:
        if t is not None and n is not None:
            kept.setdefault((t, n), (p, s or 0.0))
    parents = {(t, p) for (t, _), (p, _) in kept.items()}
    out = {}
    for t, n in kept:
        if (t, n) in parents:
            continue
        way, at = [], n
        while at is not None and (t, at) in kept and at not in way:
            way.append(at)
            at = kept[t, at][0]
        if at is None or (t, at) not in kept:
            out.setdefault(t, []).append((-sum(kept[t, x][1] for x in way), n, way[::-1]))
    return {(t, b): way for t, paths in out.items() for b, (_, _, way) in enumerate(sorted(paths)[:top], 1)}


def test_paths(spark):
    rng = random.Random(5)
    rows = [(1, i, i - 1 if i else None, 1.0) for i in range(37)]  # a chain
    rows += [(2, i, rng.randrange(i) if i else None, float(rng.randrange(4))) for i in range(60)]  # a tree
    rows += [(3, i, 0 if i else None, float(i % 3)) for i in range(30)]  # a star
    rows += [(4, 1, 2, 1.0), (4, 2, 1, 1.0), (4, 3, 2, 1.0), (4, 9, 77, None), (5, 1, None, None), (None, 1, None, 1.0), (6, None, 1, 1.0), (7, 1, 1, 2.0)]
    for top in (1, 3):
        got = {}
        for r in leaf_paths(nodes(spark, rows), top).collect():
            got.setdefault((r.tree, r.branch), []).append((r.depth, r.node))
        assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == best(rows, top)
        assert all([d for d, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in got.values())


def test_branches_become_conversations(spark):
    rows = [(1, 0, None, "user", "hi", 1.0, 0), (1, 1, 0, "assistant", "good", 5.0, 0), (1, 2, 0, "assistant", "bad", 1.0, 0), (1, 3, 1, "user", None, 0.0, 0)]
    got = {r.branch: r for r in format_conversations(spark.createDataFrame(rows, NODES), 2).collect()}
    turn = lambda role, text: START + role + MIDDLE + text + END
    assert got[1].formatted == turn("user", "hi") + turn("assistant", "good") + turn("user", "")
    assert got[2].formatted == turn("user", "hi") + turn("assistant", "bad")
    assert [got[1].formatted[s.begin : s.end] for s in got[1].loss] == ["good"] and [got[2].formatted[s.begin : s.end] for s in got[2].loss] == ["bad"]


def test_escaping_is_reversible(spark):
    rng = random.Random(6)
    parts = [*CONTROL, "\\", "<", "[", "\\\\", "a", "é😀", "\n", "|>", "/", "s>", "<|im", "_end|>", "<\\s>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(400)] + ["", *CONTROL]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", escape(F.col("t"))).withColumn("u", unescape(F.col("e")))
    for r in df.collect():
        assert r.u == r.t and not any(c in r.e for c in CONTROL)


def test_chains(spark):
    rows = [(1, 0, "user", "a</s>"), (1, 1, "assistant", "b[INST]\\"), (1, 1, "assistant", "b[INST]\\"), (1, 2, None, None), (2, 5, "assistant", ""), (2, None, "system", "x" * 20000), (3, 0, "a" + END, END), (None, 0, "user", "x")]
    rows += [(4, i, ("user", "assistant")[i % 2], f"é{i}") for i in range(70)]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "conv_id long, turn long, role string, text string, node int, tree string")
    got = {r.conv_id: r for r in digest(format_conversations(chained(df))).collect()}
    for conv in (1, 2, 3, 4):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own)
        learned = "".join(text or "" for _, _, role, text in own if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), sha256(said.encode()).hexdigest(), len(learned), sha256(learned.encode()).hexdigest())
    assert set(got) == {1, 2, 3, 4}
    assert digest(format_conversations(chained(df.where("false")))).collect() == []


def test_read_back(spark):
    rows = [(1, 0, None, "assistant", "one", 0.0, 0), (1, 1, 0, "assistant", "</s>two", 0.0, 0)]
    r = read_back(format_conversations(spark.createDataFrame(rows, NODES))).first()
    assert r.learned == ["one", "</s>two"] and [tuple(t) for t in r.turns] == [("assistant", "one"), ("assistant", "</s>two")]
