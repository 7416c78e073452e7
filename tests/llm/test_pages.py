import random
import re
from html import unescape

from conftest import DATA

from llm.pages import blocks, common_lines, main_text, nearest_pages
from llm.queries import QUERIES


def test_common_lines_are_a_longest_subsequence():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(30))] for _ in range(2))
        size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
        kept = [x for x, k in zip(a, common_lines(a, b)) if k]
        rest = iter(b)
        assert len(kept) == size[-1][-1] and all(x in rest for x in kept)
    long = list(range(4000))
    assert common_lines(long, long[::2]).sum() == 2000


def test_blocks():
    text = lambda page: [b[0] for b in blocks(page)]
    assert text("<p>a<b>b</b>c<br>d &amp; e\n\tf<p>g") == ["abc", "d & e f", "g"]
    assert text('<script>var t="</p>";</script>x<style>y</style><!-- z --><p title="a>b">w') == ["x", "w"]
    assert text("1 < 2 <3 a&lt;b>") == ["1 < 2 <3 a<b>"] and text("") == [] and text("<p") == ["<p"] and text("<!-- never closed") == []
    assert text("<ul><li>a<li>b</ul>&#233;&nbsp;x") == ["a", "b", "é x"]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", "t") for r in rows], "page_id long, url string, html string, key string, text string")


def test_article_and_furniture(spark):
    page = """<html><head><title>T</title></head><body><header>logo</header><nav><a>menu</a></nav><div class="cookie-notice">cookies</div>
      <article><header><h1>Head &amp; line</h1></header><p>One<p>Two <i>words</i><div class="ad">buy</div><form><input>send</form>
      <section id="comments"><p>first!</section><footer>by me</footer></article><div class="sidebar">more</div><footer>&copy;</footer><script>x()</script>"""
    got = main_text(pages(spark, [(1, "http://a.b/1", page)])).collect()
    assert [tuple(r) for r in got] == [(1, "http://a.b/1", "Head & line One Two words")]


def test_shared_lines_go_without_an_article(spark):
    page = lambda own: f"<div>Site name</div><div>Latest news</div><p>{own}</p><div>All rights</div>"
    rows = [(i, f"http://h.example/a/{i}", page(f"own text {i}")) for i in range(6)]
    got = {r.page_id: r.text for r in main_text(pages(spark, rows)).collect()}
    assert got == {i: f"own text {i}" for i in range(6)}


def test_template_slots_inside_the_article(spark):
    page = lambda own: f"<article><p>{own}</p><p>Reprinted paragraph</p><div class='boiler'>Read our terms</div></article>"
    rows = [(i, f"http://h.example/a/{i}", page(f"x{i}</p><p>y{i}</p><p>z{i}" + (" also" if i % 2 else ""))) for i in range(8)]
    got = {r.page_id: r.text for r in main_text(pages(spark, rows)).collect()}
    assert got[2] == "x2 y2 z2 Reprinted paragraph"  # the slot of the terms is shared, that of paragraphs mostly not


def test_copies_are_no_neighbours(spark):
    """Pages crawled twice, with a tracking query, mirrored or copied but for a date keep their text, with and without an article."""
    page = lambda own, date="": f"<div>Site name</div><p>{own} with a long main text</p><p>More of {own}</p><span>{date}</span><div>All rights</div>"
    rows = [(i, f"http://h.example/a/{i // 2}?ref={i % 2}", page(f"story {i // 2}")) for i in range(8)]
    rows += [(100 + i, f"http://h.example/b/{i:03}", page("hot story", f"day {i}" if i % 3 else "")) for i in range(60)]
    rows += [(200 + i, f"http://copies.example/{i}", page("only story")) for i in range(3)]
    got = {r.page_id: r.text for r in main_text(pages(spark, rows)).collect()}
    text = lambda own, date="": f"{own} with a long main text More of {own} {date}".strip()
    assert got == {i: text(f"story {i // 2}") for i in range(8)} | {100 + i: text("hot story", f"day {i}" if i % 3 else "") for i in range(60)} | {200 + i: f"Site name {text('only story')} All rights" for i in range(3)}
    article = [(i, u, f"<article>{html}</article>") for i, u, html in rows]
    got = {r.page_id: r.text for r in main_text(pages(spark, article)).collect()}
    assert all("with a long main text More of" in t for t in got.values())


def test_nearest_of_another_kind(spark):
    rng = random.Random(4)
    kinds = [k for n in range(40) for k in [rng.randrange(3)] * rng.randrange(1, 40)]
    rows = [(i, f"http://h{i // 300}.org/{i % 300 // 100}/{i:05}", k) for i, k in enumerate(kinds)]
    got = {r.key: r.partner for r in nearest_pages(spark.createDataFrame(rows, "key long, url string, kind int"), "kind").collect()}
    want = {}
    for i, u, k in rows:
        here = [(j, v) for j, v, m in rows if m != k and j // 300 == i // 300]
        sides = [max((x for x in here if x[0] < i), default=None), min((x for x in here if x[0] > i), default=None)]
        alike = [-1 if x is None else (x[1].split("/")[3] == u.split("/")[3]) + 0 for x in sides]
        if max(alike) >= 0:
            want[i] = sides[0 if alike[0] >= alike[1] else 1][0]
    assert got == want


def test_awkward_rows(spark):
    rows = [(1, None, "<p>a"), (2, "nothing", None), (None, "http://h/", ""), (3, "http://h/x", "<main>m"), (3, "http://h/x", "<main>m"), (4, "http://h/x", "plain " * 30000)]
    got = sorted((repr(r.page_id), r.url, r.text) for r in main_text(pages(spark, rows)).collect())
    want = [("1", None, "a"), ("2", "nothing", ""), ("None", "http://h/", ""), ("3", "http://h/x", "m"), ("3", "http://h/x", "m"), ("4", "http://h/x", ("plain " * 30000).strip())]
    assert got == sorted(want, key=lambda x: x[:1] + (x[1] or "",)) or sorted(got, key=repr) == sorted(want, key=repr)
    assert main_text(pages(spark, [])).collect() == []


def test_nearest(spark):
    urls = [f"http://{'hot' if i % 3 else 'h%d' % (i % 7)}.org/{'abc'[i % 3]}/{i % 5}/{i}" for i in range(300)] + ["http://alone.org/"]
    rows = [(u.split("/")[2], u.split("/", 3)[3], i) for i, u in enumerate(urls)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "key long, url string")
    got = {r.key: r.partner for r in nearest_pages(df).collect()}
    order = sorted((h, "/" + p, k) for h, p, k in rows)
    common = lambda a, b: -1 if a[0] != b[0] else next((n for n, (x, y) in enumerate(zip(a[1].split("/"), b[1].split("/"))) if x != y), min(a[1].count("/"), b[1].count("/")) + 1)
    want = {}
    for n, row in enumerate(order):
        before = common(row, order[n - 1]) if n else -1
        after = common(row, order[n + 1]) if n + 1 < len(order) else -1
        if max(before, after) >= 0:
            want[row[2]] = (order[n - 1] if before >= after else order[n + 1])[2]
    assert got == want


def test_query(spark):
    got = {r.page_id: r for r in QUERIES["op2_page_differencing"](spark, DATA).collect()}
    for page in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        inside = re.sub(r"</?b>", "", page.html.split("<article>")[1].split("</article>")[0])
        want = " ".join(unescape(" ".join(re.split(r"<[^>]+>", inside))).split())
        assert (got[page.page_id].text, got[page.page_id].n_chars, got[page.page_id].url) == (want, len(want), page.url)
