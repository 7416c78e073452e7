"""Main text of web pages by differencing with the page whose URL is nearest."""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lists, materialize
from .urls import host, path

# Element names of the HTML standard, and words in classes, ids and roles that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
FURNITURE = frozenset("nav footer aside form head script style noscript template iframe svg canvas object button select textarea dialog menu audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar dialog alert form".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar side-bar aside menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "comment comments commentlist disqus respond reply replies cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "signup login search share sharing social related recommended widget widgets pagination pager toolbar skip-link site-header page-header site-footer page-footer banner".split()
)
MAIN = frozenset(("article", "main"))
#: Furniture of the page, but of an article the part with its headline.
HEADERS = frozenset(("header", "page_header", "top"))
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


def _mark(name: str, attributes: str) -> tuple[str, bool, bool]:
    """Label of an element in a slot, and whether it is page furniture or main content."""
    label, furniture, main = name, name in FURNITURE, name in MAIN
    if "=" in attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            value = unescape("".join(values)).lower()
            if key.lower() == "role":
                furniture, main = furniture or value in ROLES, main or value == "main"
                continue
            label += "." + re.sub(r"\d+", "#", value)
            names = value.split()
            furniture = furniture or not NAMES.isdisjoint(names) or not NAMES.isdisjoint(w for n in names for w in (n, *re.split(r"[-_]+", n)[:1]))
    return label, furniture, main


def blocks(page: str) -> list[tuple[str, str, bool, bool]]:
    """(text, slot, furniture, main) of every block of a page, in page order.

    A block is the text between two tags that are not inline. Its slot is the chain of labelled
    elements around it. Character references are decoded, white space becomes one space. Tags that
    never close end with the page; what looks like a tag but is none is text.
    """
    out, text = [], []
    stack: list[tuple[str, str, bool, bool]] = []

    def flush() -> None:
        if text:
            words = " ".join(unescape("".join(text)).split())
            text.clear()
            if words:
                slot = ">".join(x[1] for x in stack if x[0] not in INLINE)
                out.append((words, slot, any(x[2] for x in stack), any(x[3] for x in stack)))

    at, end = 0, len(page)
    while at < end:
        tag = _TAG.search(page, at)
        if not tag:
            text.append(page[at:])
            break
        if tag.start() > at:
            text.append(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            flush()
        if tag[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if name in INLINE and any(x[0] not in INLINE for x in stack[i:]):
                        break
                    del stack[i:]
                    break
            continue
        if name in VOID:
            if name == "br":
                text.append("\n")
            continue
        closed = CLOSES.get(name) or ({"p"} if name not in INLINE else ())
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in closed:
                del stack[i:]
            elif stack[i][0] not in INLINE:
                break
        if tag[0].endswith("/>") and name in INLINE:
            continue
        label, furniture, main = _mark(name, tag[3])
        heading = name == "header" or not HEADERS.isdisjoint(label.split("."))
        stack.append((name, label, furniture or heading and not any(x[3] for x in stack), main))
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            stop = close.start() if close else end
            if name in ("title", "textarea"):
                text.append(page[at:stop])
            at = stop
            if not close:
                break
    flush()
    return out


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _row_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of a and each beginning of b, bit-parallel."""
    places: dict[int, int] = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(a: list[int], b: list[int]) -> np.ndarray:
    """Which entries of a belong to a longest common subsequence with b; memory is linear (divide and conquer)."""
    kept = np.zeros(len(a), bool)
    in_a, in_b = set(a), set(b)
    start = [i for i, x in enumerate(a) if x in in_b]
    todo = [(start, [x for x in b if x in in_a])]
    while todo:
        places, other = todo.pop()
        while places and other and a[places[0]] == other[0]:
            kept[places[0]] = True
            places, other = places[1:], other[1:]
        while places and other and a[places[-1]] == other[-1]:
            kept[places[-1]] = True
            places, other = places[:-1], other[:-1]
        if not places or not other:
            continue
        if len(places) == 1:
            kept[places[0]] = a[places[0]] in other
            continue
        half = len(places) // 2
        values = [a[i] for i in places]
        total = _row_lengths(values[:half], other) + _row_lengths(values[half:][::-1], other[::-1])[::-1]
        cut = int(total.argmax())
        todo += [(places[:half], other[:cut]), (places[half:], other[cut:])]
    return kept


def _core(found: list[tuple[str, str, bool, bool]]) -> str:
    """The longest line of the main part; without an article or main element, of all but furniture."""
    text = [x for x in found if not x[2]]
    return max((x[0] for x in ([x for x in text if x[3]] or text)), key=len, default="")


def _lines(batches):
    """Per page the hashes of its lines and of their slots, of its whole line list and of its longest main line."""
    for batch in batches:
        lines, slots, counts, forms, cores = [], [], [], [], []
        known: dict[str, int] = {}
        for page in batch.column(batch.num_columns - 1):
            found = blocks(page.as_py() or "")
            counts.append(len(found))
            hashes = [_hash(x[0]) for x in found]
            lines += hashes
            slots += [known[x[1]] if x[1] in known else known.setdefault(x[1], _hash(x[1])) for x in found]
            forms.append(_hash(repr(hashes)))
            cores.append(_hash(_core(found)))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], lists(np.array(lines, np.int64), np.array(counts)), lists(np.array(slots, np.int64), np.array(counts)), pa.array(forms, pa.int64()), pa.array(cores, pa.int64())],
            names=[*batch.schema.names[:-1], "lines", "slots", "form", "core"],
        )


def _shared(batches):
    for batch in batches:
        flags = [common_lines(a, b).tolist() for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(4), pa.array(flags, pa.list_(pa.bool_()))], names=["key", "slots", "form", "shared"])


def _text(batches):
    for batch in batches:
        out = []
        for page, flags, templates in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            found, templates = blocks(page.as_py() or ""), set(templates or ())
            flags = flags if flags and len(flags) == len(found) else [False] * len(found)
            has_main = any(main and not furniture for _, _, furniture, main in found)
            out.append(" ".join(
                words for (words, slot, furniture, main), shared in zip(found, flags)
                if not furniture and (main or not has_main) and not (shared and (not has_main or _hash(slot) in templates))
            ))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def _guests(ends: list) -> list[tuple]:
    """For each range the rows that its first and last pages may need from outside: one row and one of another kind on each side."""
    other = lambda p, q: p is not None and q is not None and (p["host"], p["kind"]) != (q["host"], q["kind"])
    guests = []
    for side, order in (("last", ends), ("first", ends[::-1])):
        near = far = None  # the nearest row passed so far, and the nearest of another kind than that
        for r in order:
            guests += [(r["range"], *p) for p in (near, far) if p is not None]
            edge, next_ = r[side], r[f"{side}_other"]
            far = next_ if next_ is not None else near if other(near, edge) else far
            near = edge
    return guests


def nearest_pages(pages: DataFrame, kind: str = "key") -> DataFrame:
    """(key, partner): each page's neighbour of the same host, by URL path, among pages of another ``kind``; pages without one have no row.

    Pages stand in the order of host, path and key. Of the nearest pages before and after that differ
    in kind, the one that shares more leading path parts is taken, else the one before. The order is
    cut into ranges, so a large host is spread over many; the rows next to a range that its pages may
    need also stand in it, at most two on each side.
    """
    spark = pages.sparkSession
    keys = pages.select("key", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.col(kind).alias("kind")).distinct()
    keys = keys.where("host <> ''").repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "host", "path", "key")
    keys = materialize(keys.withColumn("range", F.spark_partition_id()), "page-order")
    place = F.struct("host", "path", "key", "kind")
    ends = keys.groupBy("range").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    ends = materialize(ends, "page-ranges")  # one row a range
    inner = keys.join(F.broadcast(ends), "range")
    differs = lambda end: (F.col("host") != F.col(f"{end}.host")) | (F.col("kind") != F.col(f"{end}.kind"))
    others = inner.groupBy("range", "first", "last").agg(F.min(F.when(differs("first"), place)).alias("first_other"), F.max(F.when(differs("last"), place)).alias("last_other"))
    guests = _guests(others.orderBy("range").collect())
    types = dict(keys.dtypes)
    guests = spark.createDataFrame(guests, f"range int, host string, path string, key {types['key']}, kind {types['kind']}").withColumn("guest", F.lit(True))
    rows = keys.select("range", "host", "path", "key", "kind", F.lit(False).alias("guest")).unionByName(guests)
    me = F.split("path", "/")

    def alike(other):
        parts = F.split(other["path"], "/")
        same = F.filter(F.sequence(F.lit(1), F.least(F.size(me), F.size(parts))), lambda i: F.slice(me, 1, i) == F.slice(parts, 1, i))
        return F.when(other["host"] == F.col("host"), F.size(same)).otherwise(-1)

    for name, order in (("before", [F.asc(c) for c in ("host", "path", "key")]), ("after", [F.desc(c) for c in ("host", "path", "key")])):
        order = Window.partitionBy("range").orderBy(*order)
        last = F.lag(place).over(order)
        rows = rows.withColumn(name, F.when((last["host"] != F.col("host")) | (last["kind"] != F.col("kind")), last))  # where a run of one kind begins
        rows = rows.withColumn(name, F.last(name, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.where("not guest")
    rows = rows.withColumns({"b": F.coalesce(alike(F.col("before")), F.lit(-1)), "a": F.coalesce(alike(F.col("after")), F.lit(-1))})
    rows = rows.where("a >= 0 or b >= 0")
    return rows.select("key", F.when(F.col("b") >= F.col("a"), F.col("before.key")).otherwise(F.col("after.key")).alias("partner"))


def main_text(pages: DataFrame, majority: float = 0.5) -> DataFrame:
    """One row per page: page_id, url, text (empty if none).

    Each page is aligned, line by line, with the page of its host whose URL is nearest; lines of their
    longest common subsequence are shared. Copies are no neighbours: the nearest page whose longest
    main line differs is taken, where a host has none the nearest whose line list differs, and a page
    whose host has only copies of it keeps all lines. On a page without an article or main element shared lines
    are deleted. Where there is one, only what it holds is text, and a shared line is deleted if its
    slot (the chain of elements and classes around it) is a template: of all lines in that slot, over
    all distinct line lists, more than ``majority`` are shared. So boilerplate inside the article goes, and a
    paragraph that two pages print alike stays. Elements, roles and classes that name page furniture
    (menus, footers, adverts, forms, comments and so on) are left out everywhere.

    Null html is empty, a null or malformed url has no neighbour. Repeated rows give repeated, equal
    results. Other columns are ignored.
    """
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("key", F.xxhash64("page_id", "url", "html"))
    lines = keyed.select("key", "html").mapInArrow(_lines, "key long, lines array<long>, slots array<long>, form long, core long").dropDuplicates(["key"])
    lines = materialize(lines, "page-lines")
    placed = materialize(keyed.select("key", "url").join(lines.select("key", "form", "core"), "key"), "page-kinds")
    pairs = materialize(nearest_pages(placed, "core"), "page-pairs")
    pairs = pairs.unionByName(nearest_pages(placed, "form").join(pairs, "key", "left_anti"))
    both = pairs.join(lines, "key").join(lines.select(F.col("key").alias("partner"), F.col("lines").alias("other")), "partner")
    shared = materialize(both.select("key", "lines", "other", "slots", "form").mapInArrow(_shared, "key long, slots array<long>, form long, shared array<boolean>"), "page-shared")
    once = shared.join(shared.groupBy("form").agg(F.min("key").alias("key")), ["form", "key"], "left_semi")
    votes = once.select(F.explode(F.arrays_zip("slots", "shared")).alias("x")).groupBy("x.slots").agg(F.avg(F.col("x.shared").cast("int")).alias("share"))
    templates = votes.where(F.col("share") > majority).select(F.col("slots").alias("slot"))
    holds = shared.select("key", F.explode(F.array_distinct("slots")).alias("slot")).join(templates, "slot").groupBy("key").agg(F.collect_set("slot").alias("templates"))
    decisions = shared.select("key", "shared").join(holds, "key", "left")
    rows = keyed.join(decisions, "key", "left").select("page_id", "url", "html", "shared", "templates")
    return rows.mapInArrow(_text, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string")
