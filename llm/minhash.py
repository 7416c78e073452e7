"""Near-duplicate groups by b-bit MinHash."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, lists, materialize, mix, row_key, signed, stream, text_chunks
from .components import connected

#: Bands of minima and minima in each: two sets with a similarity of 0.8 share no band with a probability of 7e-10.
BANDS, ROWS = 40, 4
#: Minima in a packed signature, and low bits that are kept of each.
MINIMA, LOW_BITS = 2048, 2
#: Six standard errors of the estimate; true links fall below the threshold minus this with a probability of 1e-9.
MARGIN = 0.064
_FIELD = sum(1 << i for i in range(0, 64, LOW_BITS)) - (1 << 64 if LOW_BITS == 1 else 0)


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows one after the other, and their number per row.

    A row with fewer words than ``size`` has its whole word sequence as one shingle; one without
    words has none.
    """
    n = np.where(words.count > 0, np.maximum(words.count - size + 1, 1), 0)
    row = np.repeat(np.arange(len(n)), n)
    ends = np.cumsum(n)
    start = np.arange(len(row)) - np.repeat(ends - n, n) + words.first[:-1][row]
    hashes = words.span_hash(start, np.minimum(start + size, words.first[1:][row]))
    for a, b in zip(ends - n, ends):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.bincount(row[new], minlength=len(n))


def minima(hashes: np.ndarray, counts: np.ndarray, how_many: int):
    """Yields the least value of each non-empty row under each of ``how_many`` hash functions."""
    full = counts[counts > 0]
    at = np.cumsum(full) - full
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    factors = stream(11, 2 * how_many)
    for a, b in zip((factors[::2] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (factors[1::2] >> np.uint64(32)).astype(np.uint32)):
        yield np.minimum.reduceat(short * a + b, at)


def _summaries(size: int):
    def run(batches):
        for batch in batches:
            for at, to, data, offsets in text_chunks(batch.column(1)):
                hashes, counts = shingle_sets(Words(data, offsets, lower=True), size)
                full = np.flatnonzero(counts)
                sums, bands = np.zeros((2, to - at), np.uint64), np.zeros((to - at, BANDS), np.uint64)
                if len(full):
                    first = (np.cumsum(counts) - counts)[full]
                    for i, seed in enumerate(stream(12, 2)):
                        sums[i, full] = np.add.reduceat(mix(hashes ^ seed), first)
                    for i, low in enumerate(minima(hashes, counts, BANDS * ROWS)):
                        band = i // ROWS
                        bands[full, band] = mix(bands[full, band] * np.uint64(31) + low + np.uint64(band + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, to - at), pa.array(counts.astype(np.int64)), signed(sums[0]), signed(sums[1]),
                    lists(bands[full].view(np.int64).ravel(), np.where(counts > 0, BANDS, 0)),
                ], names=["doc_id", "n_shingles", "s1", "s2", "bands"])

    return run


def _signatures(size: int):
    per_word = 64 // LOW_BITS

    def run(batches):
        for batch in batches:
            for at, to, data, offsets in text_chunks(batch.column(1)):
                hashes, counts = shingle_sets(Words(data, offsets, lower=True), size)
                full = np.flatnonzero(counts)
                packed = np.zeros((to - at, MINIMA // per_word), np.uint64)
                if len(full):
                    for i, low in enumerate(minima(hashes, counts, MINIMA)):
                        bits = (mix(low.astype(np.uint64)) & np.uint64((1 << LOW_BITS) - 1)) << np.uint64(i % per_word * LOW_BITS)
                        packed[full, i // per_word] |= bits
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, to - at), lists(hashes.view(np.int64), counts),
                    lists(packed.view(np.int64).ravel(), np.full(to - at, packed.shape[1])),
                ], names=["doc_id", "shingles", "signature"])

    return run


def estimate(a, b):
    """Similarity from two packed signatures, corrected for low bits that agree by chance."""

    def agreeing(x, y):
        differ = x.bitwiseXOR(y)
        for i in range(1, LOW_BITS):
            differ = differ.bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), i))
        return F.bit_count(F.bitwise_not(differ).bitwiseAND(F.lit(_FIELD)))

    same = F.aggregate(F.zip_with(a, b, agreeing), F.lit(0), lambda total, n: total + n)
    chance = 2.0**-LOW_BITS
    return (same / MINIMA - chance) / (1 - chance)


def _may_link(percent: int):
    """Whether a pair (columns a_*, b_*) can reach the threshold by size and by estimate."""
    smaller, larger = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return (100 * smaller >= percent * larger) & (estimate(F.col("a_sig"), F.col("b_sig")) >= percent / 100 - MARGIN)


def _side(sets: DataFrame, name: str, *columns: str) -> DataFrame:
    short = {"shingles": "set", "signature": "sig", "n_shingles": "n", "component": "c"}
    return sets.select(F.col("doc_id").alias(name), *(F.col(c).alias(f"{name}_{short.get(c, c)}") for c in columns))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    both = pairs.select("a", "b").join(_side(sets, "a", "shingles"), "a").join(_side(sets, "b", "shingles"), "b")
    both = both.withColumn("common", F.size(F.array_intersect("a_set", "b_set")))
    return both.where(F.col("common") * 100 >= percent * (F.size("a_set") + F.size("b_set") - F.col("common"))).select("a", "b").distinct()


def links(docs: DataFrame, summaries: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between representatives of equal sets that give the same components as all links.

    Documents that share a band are candidates. First each is held against the smallest member of its
    fullest band, then against the smallest members of those of its bands that still hold several
    components; that joins a large group in linear work. In the third round bands that hold several
    components even so are searched whole, pair by pair across components, each pair at its first
    common band. Every link is confirmed on full sets; estimates only leave out
    pairs that are below the threshold by MARGIN.
    """
    same = summaries.where("n_shingles > 0").groupBy("s1", "s2", "n_shingles")
    classes = same.agg(F.min("doc_id").alias("doc_id"), F.min_by("bands", "doc_id").alias("bands"))
    banded = classes.select("doc_id", "n_shingles", F.posexplode("bands").alias("band", "value"))
    shared = banded.groupBy("value").agg(F.min("doc_id").alias("hub"), F.count("*").alias("members")).where("members > 1")
    members = materialize(banded.join(shared, "value").drop("band"), "minhash-bands")
    wanted = members.select("doc_id").distinct()
    texts = docs.where("doc_id is not null").select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    texts = texts.withColumn("key", row_key()).dropDuplicates(["doc_id", "key"]).select("doc_id", "text")
    sets = materialize(texts.mapInArrow(_signatures(size), "doc_id long, shingles array<long>, signature array<long>"), "minhash-sets")
    signed_sets = sets.select("doc_id", "signature", F.size("shingles").alias("n_shingles"))

    def with_signatures(pairs):
        return pairs.join(_side(signed_sets, "a", "signature", "n_shingles"), "a").join(_side(signed_sets, "b", "signature", "n_shingles"), "b").where(_may_link(percent))

    largest = members.where("doc_id <> hub").groupBy(F.col("doc_id").alias("a")).agg(F.max_by("hub", F.struct("members", -F.col("hub"))).alias("b"))
    found = materialize(confirmed(with_signatures(largest), sets, percent), "minhash-links")
    for rounds in (2, 3):
        component = materialize(connected(found), "minhash-components")
        at = members.join(component, members["doc_id"] == component["node"], "left").withColumn("component", F.coalesce("component", "doc_id"))
        at = at.select("value", "doc_id", "n_shingles", "component")
        first = F.min(F.struct("doc_id", "component")).alias("first")
        mixed = at.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), first).where("lo <> hi").select("value", "first")
        if rounds == 2:
            pairs = at.join(mixed, "value").where("component <> first.component").select(F.col("doc_id").alias("a"), F.col("first.doc_id").alias("b"))
            pairs = with_signatures(pairs.distinct())
        else:
            mixed = mixed.drop("first")
            at = materialize(at.join(mixed, "value"), "minhash-open")
            ids = at.select("doc_id").distinct()
            about = signed_sets.select("doc_id", "signature").join(ids, "doc_id", "left_semi")
            about = about.join(at.groupBy("doc_id").agg(F.sort_array(F.collect_set("value")).alias("values")), "doc_id")
            at = materialize(at.join(about, "doc_id"), "minhash-open")
            a, b = (at.select("value", F.col("doc_id").alias(n), F.col("n_shingles").alias(f"{n}_n"), F.col("signature").alias(f"{n}_sig"), F.col("component").alias(f"{n}_c"), F.col("values").alias(f"{n}_v")) for n in "ab")
            first = F.array_min(F.array_intersect("a_v", "b_v")) == F.col("value")
            pairs = a.join(b, "value").where((F.col("a_c") < F.col("b_c")) & _may_link(percent) & first)
        found = materialize(found.unionByName(confirmed(pairs, sets, percent)), "minhash-links")
    return found


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Lower-cases A-Z and links documents whose sets of ``size``-word shingles have
    100 * intersection >= percent * union; component_id is the smallest id that links lead to, kept
    says that it is the document's own. Null or wordless text: an empty set, linked with nothing. Rows
    with words that share an id are one document in the graph (they get one component), each with its
    own n_shingles; repeated rows give repeated rows. A null id: component_id is that of its equal set
    if there is one, else null and kept.
    Other columns are ignored.
    """
    columns = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"
    summaries = materialize(docs.select("doc_id", "text").mapInArrow(_summaries(size), columns), "minhash-sums")
    known = summaries.where("doc_id is not null")
    # Written, so that the joins below are between plain exchanges, which can be split where a set is frequent.
    same = materialize(known.where("n_shingles > 0").groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("class")), "minhash-classes")
    of_class = known.join(same, ["s1", "s2", "n_shingles"]).select("doc_id", "class")
    first = of_class.groupBy("doc_id").agg(F.min("class").alias("b"), F.max("class").alias("last")).where("b < last")
    repeated = of_class.join(first, "doc_id").where("class <> b").select(F.col("class").alias("a"), "b")
    component = connected(links(docs, known, size, percent).unionByName(repeated))
    out = summaries.join(same, ["s1", "s2", "n_shingles"], "left").join(component, F.col("class") == F.col("node"), "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "class", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
