import random
import zlib
from hashlib import sha256

from compare import differences
from conftest import DATA

from llm import trie
from llm.queries import ORACLES, QUERIES
from llm.radix import Direct, Indexed, Sorted, insert, shared, walk
from llm.trie import borrowed_openings, prefix_trie, turn_lists

ROW = "conv_id long, turn long, role string, text string, block long, h int, turns string, seq string, pid int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "t", "s", 3) for r in rows], ROW)


def nodes_by_hand(lists):
    """lists: conv_id -> [(role, text), ...]"""
    members = {}
    for conv, turns in lists.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    kids = {}
    for key in members:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    out, leaves, saved = [], {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = kids.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) if below else 1
        saved[key] = sum(saved[k] for k in below) + (len(members[key]) - 1) * (len(key[-1][1]) if key else 0)
        stop = ",".join(map(str, sorted(c for c in members[key] if len(lists[c]) == len(key))))
        out.append((min(members[key]), len(key), min(members[key[:-1]]) if key else None, len(members[key]), len(below), leaves[key], saved[key], sha256(stop.encode()).hexdigest()))
    return out


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def found(nodes):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in nodes.collect()), key=repr)


def same(spark, rows, **how):
    assert found(prefix_trie(turn_lists(frame(spark, rows)), **how)) == sorted(nodes_by_hand({c: t for c, t in plain(rows).items()}), key=repr)


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}


def conversations(seed, n, words=3, most=6):
    rng = random.Random(seed)
    return [(c, t, ("user", "assistant")[t % 2], "é" * rng.randrange(words)) for c in range(n) for t in range(1 + rng.randrange(most))]


def test_layouts_grow():
    node = Sorted()
    kinds = set()
    for b in random.Random(1).sample(range(256), 256):
        node = node.put(b, ("kid", b))
        kinds.add((type(node).__name__, getattr(node, "room", None)))
        assert node.find(b) == ("kid", b)
    assert kinds == {("Sorted", 4), ("Sorted", 16), ("Indexed", None), ("Direct", None)}
    assert [b for b, _ in node.children()] == list(range(256)) and all(node.put(b, b) is node for b in range(256))
    small = Indexed()
    assert small.find(3) is None and Sorted().find(3) is None and Direct().find(3) is None


def test_shared():
    rng = random.Random(2)
    for _ in range(500):
        a, b = (bytes(rng.randrange(2) for _ in range(rng.randrange(12))) for _ in range(2))
        want = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert shared(a, b) == want


def test_tree_keeps_every_key_and_aligned_prefix():
    rng = random.Random(3)
    for alphabet, width in ((2, 1), (3, 2), (256, 1), (5, 4)):
        keys = sorted({bytes(rng.randrange(alphabet) for _ in range(width * rng.randrange(6))) for _ in range(300)})
        root = None
        for i in rng.sample(range(len(keys)), len(keys)):
            root = insert(root, keys[i], i)
        positions, values, aboves, numbers = 0, [], {}, []
        for mine, value, above, position, top in walk(root, width):
            aboves[mine] = above
            numbers.append(mine)
            assert above < mine
            if value is not None:
                assert position == len(keys[value])
                values.append(value)
            positions += max(0, (position - top) // width + 1)
        assert sorted(values) == list(range(len(keys))) and numbers == sorted(numbers, reverse=True)
        prefixes = {k[:p] for k in keys for p in range(0, len(k) + 1, width)}
        assert positions == len(prefixes | {b""}) or (b"" not in prefixes)


def test_against_all_prefixes(spark):
    same(spark, conversations(4, 150))
    same(spark, conversations(5, 60, words=40, most=3))


def test_runs_and_merges(spark, monkeypatch):
    """Many small runs, and merges on several levels, give the same trie."""
    rows = conversations(6, 120, words=2, most=9)
    for keys in (1, 2, 7):
        same(spark, rows, most_keys=keys)
    same(spark, rows, most_bytes=1)
    monkeypatch.setattr(trie, "FAN", 2)
    same(spark, rows, most_keys=3)


def test_copies_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 3)
    rows = [(c, t, "user", "hi" * t) for c in range(0, 400, 7) for t in range(3)] + [(9999, 0, "user", ""), (10000, 0, "user", "x" * 50_000), (12, 0, "user", "hi")]
    same(spark, rows)


def test_awkward_rows(spark):
    rows = [(1, None, "user", None), (1, 0, None, "a"), (1, 0, "a", None), (1, 0, "a", ""), (2, None, None, None), (3, None, "", ""), (None, 1, "user", "x"), (-5, 3, "u", "é😀"), (4, 1, "us", "er"), (5, 1, "user", "")]
    rows += [(6, 1, "u", "same"), (6, 1, "u", "same"), (7, 2, "u", "same")]
    # Conversation 1 has a tie of turns, which the ids settle: two turns of it may change places.
    one = turn_lists(frame(spark, rows)).where("conv_id = 1").first().turns
    assert [t.chars for t in one][:1] == [0] and sorted(t.chars for t in one) == [0, 0, 0, 1]
    rows = [r for r in rows if r[0] != 1]
    same(spark, rows)
    assert found(prefix_trie(turn_lists(frame(spark, [])))) == []


def test_borrowed_openings(spark):
    rows = conversations(7, 260) + [(c, t, "user", f"{c} {t}") for c in (1000, 1001, 1003, 1050, 1201, 1202, 1203, -7, -100, -101) for t in range(4)]
    rows += [(1300, None, "system", "s"), (1300, 0, None, None), (1301, 0, "user", "x"), (1302, 0, "user", "x"), (None, 0, "user", "x")]
    rows = [r for r in rows if r[0] is None or r[0] >= 0]
    lists = borrowed_openings(frame(spark, rows))
    want = rebuilt(rows)
    assert {r.conv_id: len(r.turns) for r in lists.collect()} == {c: len(t) for c, t in want.items()} and any(not t for t in want.values())
    assert found(prefix_trie(lists)) == sorted(nodes_by_hand(want), key=repr)


def test_query(spark, duck):
    assert differences(QUERIES["op12_conversation_trie"](spark, DATA), duck, ORACLES["op12_conversation_trie"]) is None


def test_one_exchange_serves_the_openings(spark):
    plan = borrowed_openings(spark.read.parquet(f"{DATA}/conversations.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
