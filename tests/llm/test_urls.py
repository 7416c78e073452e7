from itertools import combinations

from conftest import DATA

from llm.queries import QUERIES, URL_RULES
from llm.urls import judge, mine


def by_hand(url):
    """host, path, rule and listed verdict."""
    h = p = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        h, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
        p = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(a + b), a + b, v) for v, a, b in URL_RULES if (h == a or h.endswith("." + a)) and p.startswith(b)]
    return (h, p, *(max(fits)[1:] if fits else (None, None)))


URLS = [
    None, "", "nothing", "http://", "http://a.com", "http://a.com/x", "http://A.EXAMPLE.com/en/1?q=/fr/#z", "http://www.example.com/en/1", "http://x.www.example.com/en/", "http://notexample.com/en/1",
    "http://net/es/", "http://a.net/fr/x://y/", "http://a.net#/es/", "http://a.net/de/1", "x://y.net/es", "http://Éa.net/es/1", "http://a.com?x=http://b.net/es/", "/a://b.net/fr/?", "http://a.b.org/" + "x" * 5000,
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")


def labelled(spark, rows):
    return spark.createDataFrame(rows, "url string, bad int")


def test_rules(spark):
    got = {r.page_id: r for r in judge(pages(spark, URLS + URLS), labelled(spark, []), URL_RULES).collect()}
    assert len(got) == 2 * len(URLS)
    for i, u in enumerate(URLS + URLS):
        h, p, rule, verdict = by_hand(u)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (h, p, rule, verdict or "allow"), u


def test_mined(spark):
    known = [(f"http://free-bets.x{i % 3}.org/en/{i}", 1) for i in range(40)] + [(f"http://news.x{i % 3}.org/en/{i}", int(i % 10 == 0)) for i in range(200)] + [(None, 1), ("http://q.org/", None)]
    urls = ["http://free-bets.other.org/zz", "http://bets.x1.org/en/5", "http://news.x1.org/en/7", "http://free.tv/", None, "http://free-bets.x.net/es/"]
    got = {r.page_id: r for r in judge(pages(spark, urls), labelled(spark, known), URL_RULES).collect()}
    assert [got[i].verdict for i in range(6)] == ["block", "block", "allow", "block", "allow", "block"]
    assert got[1].antecedent == ["host=bets"] and got[2].antecedent is None and got[5].antecedent is None


def test_mining_against_brute_force(spark):
    rows = [([t for j, t in enumerate("abcde") if i >> j & 1], int(i % 8 == 3 or i % 11 == 0)) for i in range(1, 96)]
    got = {tuple(r.antecedent): (round(r.confidence, 9), round(r.support, 9)) for r in mine(spark.createDataFrame(rows, "tokens array<string>, bad int"), 0.02, 0.3, 1.2).collect()}
    base, want = sum(b for _, b in rows) / len(rows), {}
    for n in range(1, 6):
        for s in combinations("abcde", n):
            covered = [b for t, b in rows if set(s) <= set(t)]
            if sum(covered) / len(rows) >= 0.02 and sum(covered) / len(covered) >= max(0.3, 1.2 * base):
                want[s] = (round(sum(covered) / len(covered), 9), round(sum(covered) / len(rows), 9))
    pruned = {s: v for s, v in want.items() if not any(set(o) < set(s) and want[o][0] >= v[0] for o in want)}
    assert got == pruned and pruned


def test_mostly_bad_labels(spark):
    """With 80% of the labels bad a rule is still found, and tokens that all URLs or good ones have give none."""
    known = [(f"http://casino.x{i % 3}.org/en/{i}", 1) for i in range(120)] + [(f"http://news.x{i % 3}.org/en/{i}", int(i % 2 == 0)) for i in range(80)]
    known += [(f"http://casino.x{i % 3}.org/en/{i}", 1) for i in range(200, 320)] + [(f"http://rare.x1.org/en/{i}", 1) for i in range(2)]
    urls = ["http://casino.other.net/zz", "http://news.x1.org/en/7", "http://rare.net/", "http://x2.org/en/1"]
    got = {r.page_id: r for r in judge(pages(spark, urls), labelled(spark, known), []).collect()}
    assert sum(b for _, b in known) / len(known) > 0.8
    assert [got[i].verdict for i in range(4)] == ["block", "allow", "allow", "allow"] and got[0].antecedent == ["host=casino"]


def test_empty(spark):
    assert judge(pages(spark, []), labelled(spark, [("http://a.b/", 1)]), URL_RULES).collect() == []


def test_query(spark):
    rows = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op10_url_rules"](spark, DATA).collect()}
    assert len(got) == len(rows)
    for page in rows:
        h, p, rule, verdict = by_hand(page.url)
        r = got[page.page_id]
        assert (r.host, r.path, r.rule) == (h, p, rule) and r.verdict == (verdict or ("block" if r.antecedent else "allow"))
