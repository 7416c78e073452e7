from collections import Counter, defaultdict

from conftest import DATA
from frames import documents, sentence

from llm.components import connected
from llm.minhash import near_duplicates
from llm.queries import QUERIES


def shingles(text, size=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) or (frozenset([tuple(words)]) if words else frozenset())


def brute(rows, size=4):
    sets = [(i, shingles(t, size)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for n, (i, s) in enumerate(sets):
        common = Counter(m for g in s for m in holders[g])
        for m, c in common.items():
            j, t = sets[m]
            if 100 * c >= 80 * (len(s) + len(t) - c):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
        for g in s:
            holders[g].append(n)
    return sorted((i, len(s), top(i), top(i) == i) for i, s in sets)


def test_cases(spark):
    base = sentence(5, 200)
    rows = [(100, " ".join(base)), (7, " ".join(base).upper()), (8, None), (9, ""), (10, " \t "), (11, "one two"), (12, "One  two"), (13, "one"), (14, "one two three four"), (15, "one two three four one two three four")]
    for k in range(30):  # copies with edits, chains among them
        words = list(base)
        for e in range(k % 9):
            words[(k * 37 + e * 53) % 200] = f"edit{k}x{e}"
        rows.append((200 - k, " ".join(words)))
    rows += [(300, " ".join(sentence(6, 150))), (301, " ".join(sentence(6, 150)[:130])), (302, " ".join(sentence(6, 150)[:110])), (303, " ".join(sentence(6, 150)[:90]))]
    rows += [(11, "one two")]
    got = near_duplicates(documents(spark, rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_threshold_is_reached_exactly(spark):
    words = sentence(8, 103)  # 100 shingles
    rows = [(1, " ".join(words)), (2, " ".join(words[:83])), (3, " ".join(words[:82]))]
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1}
    rows = [(1, " ".join(words)), (3, " ".join(words[:82]))]
    assert {r.component_id for r in near_duplicates(documents(spark, rows)).collect()} == {1, 3}


def test_empty_and_null_ids(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    got = near_duplicates(documents(spark, [(None, "a b c d e"), (4, "a b c d e"), (None, "x y"), (None, None)])).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, 2, 4, False), (4, 2, 4, True), (None, 1, None, True), (None, 0, None, True)], key=repr)


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(200, 100), (100, 300), (5, 5), (None, 3), (200, 300)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 200: 100, 300: 100}


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op6_minhash_near_dedup"](spark, DATA).collect())) == brute(docs)
