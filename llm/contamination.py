"""Benchmark decontamination: n-gram seeds, a bound on common words, then Smith-Waterman alignment.

A seed names candidates only. Before a passage leaves the task that reads it, the words of the item that stand in it
are counted: an alignment that scores enough matches a known number of them, and rare words, not a stock phrase,
decide that. So a phrase that many items and documents share makes no pairs.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, list_parts, lists, materialize, text_chunks

#: Words in a seed, and bytes of test items in one block.
SEED, BLOCK_BYTES = 3, 16 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of items that are looked up at once.
LOOKUPS = 1 << 21


def normal(text):
    """Lower case; everything but letters, digits and combining marks becomes one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\p{M}]+", " "))


def _hits(grams: np.ndarray):
    """A function from words to the n-grams that are among ``grams`` (sorted): row, first word, hash. A bitmap screens them."""
    screen = np.zeros(1 << 24, bool)
    screen[grams >> np.uint64(40)] = True

    def find(words: Words):
        start, row = words.window_starts(SEED)
        hashes = words.span_hash(start, start + SEED)
        hit = np.flatnonzero(screen[hashes >> np.uint64(40)])
        hit = hit[grams[np.minimum(np.searchsorted(grams, hashes[hit]), len(grams) - 1)] == hashes[hit]]
        return row[hit], start[hit], hashes[hit]

    return find


def _bounded(counts: np.ndarray, limit: int = 1 << 20):
    """Slices of ``counts`` that add up to at most ``limit`` each, or hold one entry."""
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield slice(at, to)
        at = to


def _hashed(batches):
    """Rows (number, words) to rows (number, hashes of the words, hashes of the seeds)."""
    for batch in batches:
        for at, to, data, offsets in text_chunks(batch.column(1)):
            words = Words(data, offsets)
            start, row = words.window_starts(SEED)
            columns = [batch.column(0).slice(at, to - at), lists(words.hash.view(np.int64), words.count), lists(words.span_hash(start, start + SEED).view(np.int64), np.bincount(row, minlength=to - at))]
            yield pa.RecordBatch.from_arrays(columns, names=["number", "words", "seeds"])


class Items:
    """A block of test items: number, hashes of its words, and the entries (seed, item) of its distinct seeds, sorted by seed."""

    def __init__(self, rows: pa.Table | pa.RecordBatch, least: float):
        """``rows`` as _hashed makes them: hashing stays in tasks, because tables that it needs would travel with every later task of this driver."""
        self.numbers = rows.column(0).to_numpy()
        self.words, self.first = list_parts(rows.column(1))
        self.words = np.ascontiguousarray(self.words).view(np.uint64)
        self.count = np.diff(self.first)
        seeds, ends = list_parts(rows.column(2))
        entries = np.repeat(np.arange(len(self.count)), np.diff(ends))
        pairs = np.unique(np.rec.fromarrays([np.ascontiguousarray(seeds).view(np.uint64), entries], names="seed,item"))
        self.seeds, self.items = np.ascontiguousarray(pairs["seed"]), np.ascontiguousarray(pairs["item"])
        # An alignment of all words of an item loses at most 2 * (1 - least) of the score, one word of the text each.
        self.reach = np.ceil(self.count * (1 + MATCH * (1 - least) / -GAP)).astype(np.int64)
        # Only matches add to a score.
        self.needed = np.ceil(self.count * least - 1e-9).astype(np.int64)


def _passages(items: Items):
    """Parts of texts within an item's reach of its seeds that hold enough of its words: doc_id, where the part starts, the part, number of the item."""
    find = _hits(items.seeds)

    def run(batches):
        for batch in batches:
            for at, to, data, offsets in text_chunks(batch.column(1)):
                words = Words(data, offsets)
                row, start, found = find(words)
                low, high = np.searchsorted(items.seeds, found), np.searchsorted(items.seeds, found, "right")
                place = None
                # Seeds of one row stay together, so that what they share a passage with is known.
                for part in _rowwise(row, high - low):
                    place = place or Places(words)
                    yield from parts(batch, at, data, words, place, row[part], start[part], low[part], high[part])

    def parts(batch, at, data, words, place, row, start, low, high):
        n = high - low
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        row, start, item = np.repeat(row, n), np.repeat(start, n), items.items[entry]
        order = np.lexsort((start, item, row))
        row, start, item = row[order], start[order], item[order]
        reach = items.reach[item]
        new = np.ones(len(row), bool)  # seeds of an item further apart than it reaches to both sides belong to separate parts
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > 2 * reach[1:])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(row)) - 1
        row, item, reach, end = row[head], item[head], reach[head], start[tail]
        first = np.maximum(start[head] - reach, words.first[:-1][row])
        last = np.minimum(end + SEED + reach, words.first[1:][row])
        held = np.zeros(len(head), np.int64)
        for some in _bounded(items.count[item], LOOKUPS):
            count = items.count[item[some]]
            pair = np.repeat(np.arange(len(count)), count)
            word = items.words[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(items.first[:-1][item[some]], count)]
            held[some] = np.bincount(pair, place.within(word, first[some][pair], last[some][pair]), len(count))
        keep = np.flatnonzero(held >= items.needed[item])
        row, item, first, last = row[keep], item[keep], first[keep], last[keep]
        begin = (first - words.first[:-1][row]).astype(np.int32)
        for i in range(0, len(row), 1024):
            texts = [data[words.start[a] : words.end[b - 1]].tobytes().decode() for a, b in zip(first[i : i + 1024], last[i : i + 1024])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at + row[i : i + 1024])), pa.array(begin[i : i + 1024]), pa.array(texts, pa.string()), pa.array(items.numbers[item[i : i + 1024]])],
                names=["doc_id", "first", "passage", "number"],
            )

    return run


def _rowwise(row: np.ndarray, counts: np.ndarray, limit: int = 1 << 20):
    """Slices of hits, ordered by row, with about ``limit`` entries each; a row is not divided unless it has more alone.

    The parts of a row that is divided may overlap; that costs a repeated alignment, of which the best counts.
    """
    if not len(row):
        return
    heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    per_row = np.add.reduceat(counts, heads)
    ends = np.append(heads[1:], len(row))
    for some in _bounded(per_row, limit):
        whole = slice(int(heads[some.start]), int(ends[some.stop - 1]))
        for piece in _bounded(counts[whole], limit):
            yield slice(whole.start + piece.start, whole.start + piece.stop)


class Places:
    """Where each word stands, for looking up many words within many spans."""

    def __init__(self, words: Words):
        self.order = np.argsort(words.hash, kind="stable")  # by hash, then by place
        self.hash = words.hash[self.order]
        self.known, self.first = np.unique(self.hash, return_index=True)
        self.first = np.append(self.first, len(self.hash))
        # Number of the word and place as one rising key.
        self.key = np.repeat(np.arange(len(self.known)), np.diff(self.first)) * np.int64(1 << 32) + self.order

    def within(self, word: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether each word stands somewhere from ``first`` to before ``last``."""
        if not len(self.known):
            return np.zeros(len(word), bool)
        number = np.minimum(np.searchsorted(self.known, word), len(self.known) - 1)
        at = np.searchsorted(self.key, number * np.int64(1 << 32) + first)
        next_ = self.key[np.minimum(at, len(self.key) - 1)]
        return (self.known[number] == word) & (at < len(self.key)) & (next_ < number * np.int64(1 << 32) + last)


def smith_waterman(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """Best local alignment score of two word sequences, and where it begins and ends in ``b``.

    Linear gaps. Rows run over ``a``; within a row the gap along ``b`` is a running maximum. Only one
    row of scores and of beginnings is held.
    """
    if not a or not b:
        return 0, 0, 0
    b_ = np.asarray(b)
    place = np.arange(len(b) + 1)
    score, begin = np.zeros(len(b) + 1, np.int64), place.copy()
    best = (0, 0, 0)
    for x in a:
        diagonal = score[:-1] + np.where(b_ == x, MATCH, MISMATCH)
        up = score[1:] + GAP
        here, from_ = np.zeros(len(b) + 1, np.int64), place.copy()
        take = np.maximum(diagonal, up)
        here[1:] = np.maximum(take, 0)
        from_[1:] = np.where(take <= 0, place[1:], np.where(diagonal >= up, begin[:-1], begin[1:]))
        lifted = here - GAP * place  # a gap of k along b costs k * GAP
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, place, 0))
        moved = top + GAP * place
        from_ = np.where(moved > here, from_[source], from_)
        score, begin = np.maximum(here, moved), from_
        at = int(score.argmax())
        if score[at] > best[0]:
            best = (int(score[at]), int(begin[at]), at)
    return best


def _align(least: float):
    """Score and place of the best alignment of each passage and item, where it is at least ``least``.

    Each match adds MATCH and nothing else adds, so a passage with too few of the item's words is not aligned.
    """

    def run(batches):
        for batch in batches:
            rows, scores, starts, ends = [], [], [], []
            for i, (passage, item) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                item, passage = item.split(" "), passage.split(" ")
                if sum((Counter(item) & Counter(passage)).values()) / len(item) < least:
                    continue
                number: dict[str, int] = {}
                a, b = ([number.setdefault(w, len(number)) for w in words] for words in (item, passage))
                score, start, end = smith_waterman(a, b)
                if score / (MATCH * len(a)) >= least:
                    rows.append(i)
                    scores.append(score / (MATCH * len(a)))
                    starts.append(start)
                    ends.append(end)
            kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[2:]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=[*batch.schema.names[2:], "score", "a", "b"])

    return run


def item_blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> list[DataFrame]:
    """Test items (number, item_id, words) in blocks of at most about ``limit`` bytes.

    Items of fewer than SEED words, which have no seed, are left out (see short_items); so are null ids.
    """
    items = items.where("item_id is not null").select("item_id", normal(F.col("text")).alias("words")).distinct()
    items = items.where(F.size(F.split("words", " ")) >= SEED)
    items = items.withColumn("number", F.xxhash64("item_id", "words"))
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n = -(-size // limit) if size else 0
    return [items.where(F.pmod(F.col("number"), F.lit(n)) == i) for i in range(n)]


def short_items(items: DataFrame, limit: int = BLOCK_BYTES) -> list[DataFrame]:
    """Items (item_id, words) of one or two words, in blocks of at most about ``limit`` bytes."""
    items = items.where("item_id is not null").select("item_id", normal(F.col("text")).alias("words")).where("words <> ''").distinct()
    items = items.where(F.size(F.split("words", " ")) < SEED)
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n = -(-size // limit) if size else 0
    return [items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == i) for i in range(n)]


def _exact(texts: DataFrame, block: DataFrame) -> DataFrame:
    """First place of each item of one or two words in each document."""
    word = F.split("words", " ")
    places = F.transform(word, lambda w, i: F.struct(i.alias("first"), w.alias("words"), (i + 1).alias("end")))
    pairs = F.transform(F.slice(word, 1, F.size(word) - 1), lambda w, i: F.struct(i.alias("first"), F.concat(w, F.lit(" "), F.get(word, i + 1)).alias("words"), (i + 2).alias("end")))
    met = texts.select("doc_id", F.inline(F.concat(places, pairs))).join(F.broadcast(block), "words")  # at most about BLOCK_BYTES
    spans = met.groupBy("doc_id", "item_id").agg(F.min("first").alias("first"), F.min("end").alias("end"))
    return spans.select("doc_id", "item_id", F.lit(1.0).alias("score"), F.col("first").alias("first_word"), F.col("end").alias("end_word"))


def contaminated(docs: DataFrame, items: DataFrame, least: float = 0.5) -> DataFrame:
    """Pairs (doc_id, item_id, score, first_word, end_word) of documents and test items they hold a copy of.

    Texts are compared as lower-case words without punctuation. ``score`` is the best Smith-Waterman
    score (2 a match, -1 a mismatch or a skipped word) over the score of the whole item; pairs of at
    least ``least`` are returned, once each, with the place of the alignment in the normalised words
    of the document.

    Seeds are all SEED-word sequences of the items, however often they occur in the corpus. Around a
    seed a passage reaches as far as an alignment that scores ``least`` can; it leaves its task only if it holds
    as many words of the item as such an alignment matches, so stock phrases alone make no pair. Items are taken
    in blocks of BLOCK_BYTES, each of which reads all documents once. A block's words and seeds go out with the
    tasks, about eight times its bytes, and its texts by one broadcast.

    An item of fewer than SEED words is found where its words stand in the document one after the other. Null or
    empty texts and null ids match nothing. Repeated rows and rows that share an id give one row per id and item, the
    best. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", normal(F.col("text")).alias("words"))
    found = [_found(texts, block, least) for block in item_blocks(items)]
    found += [_exact(texts, block) for block in short_items(items)]
    if not found:
        return spark.createDataFrame([], f"doc_id {dict(docs.dtypes)['doc_id']}, item_id {dict(items.dtypes)['item_id']}, score double, first_word int, end_word int")
    best = F.max(F.struct("score", -F.col("first_word"), "end_word")).alias("m")
    pairs = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(best)
    return pairs.select("doc_id", "item_id", "m.score", (-F.col("m.col2")).alias("first_word"), "m.end_word")


def _found(texts: DataFrame, block: DataFrame, least: float) -> DataFrame:
    block = materialize(block, "items")
    hashed = block.select("number", "words").mapInArrow(_hashed, "number long, words array<long>, seeds array<long>")
    known = Items(hashed.toArrow(), least)  # of one block
    id_type, item_type = dict(texts.dtypes)["doc_id"], dict(block.dtypes)["item_id"]
    passages = texts.mapInArrow(_passages(known), f"doc_id {id_type}, first int, passage string, number long")
    pairs = passages.join(F.broadcast(block), "number")
    scored = pairs.select("passage", "words", "doc_id", "item_id", "first").mapInArrow(_align(least), f"doc_id {id_type}, item_id {item_type}, first int, score double, a int, b int")
    return scored.select("doc_id", "item_id", "score", (F.col("first") + F.col("a")).alias("first_word"), (F.col("first") + F.col("b")).alias("end_word"))
