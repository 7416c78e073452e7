"""Removal of word passages that an earlier document already has."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, list_parts, materialize, row_key, signed, text_chunks

CELLS = "doc_id long, key long, anchor long, passage long, first int, windows int"


def _cells(size: int):
    """Content-defined runs of windows.

    Each window of ``size`` words is represented by the smallest hash among its grams of half that
    length (its anchor). Equal windows have equal anchors, whatever surrounds them. Neighbouring
    windows with one anchor form a cell; ``passage`` is the hash of all words the cell covers.
    """
    gram = size // 2
    width = size - gram + 1

    def run(batches):
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, to, data, offsets in text_chunks(batch.column(2)):
                words = Words(data, offsets)
                start, row = words.window_starts(size)
                if not len(start):
                    continue
                everywhere = np.arange(len(words.hash) - gram + 1)
                low, step = words.span_hash(everywhere, everywhere + gram), 1
                while step * 2 <= width:  # low[i] is the least of `step` grams from i on
                    low = np.minimum(low[:-step], low[step:])
                    step *= 2
                anchor = np.minimum(low[start], low[start + width - step])
                new = np.ones(len(start), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
                head = np.flatnonzero(new)
                n = np.diff(np.append(head, len(start)))
                first, row = start[head], row[head]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[at:to][row]), pa.array(keys[at:to][row]), signed(anchor[head]),
                    signed(words.span_hash(first, first + n + size - 1, 4)),
                    pa.array((first - words.first[:-1][row]).astype(np.int32)), pa.array(n.astype(np.int32)),
                ], names=["doc_id", "key", "anchor", "passage", "first", "windows"])

    return run


def _windows(size: int):
    """Single windows of the given cells."""

    def run(batches):
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            firsts, where = list_parts(batch.column(3))
            counts, _ = list_parts(batch.column(4))
            for at, to, data, offsets in text_chunks(batch.column(2)):
                words = Words(data, offsets)
                first, n = firsts[where[at] : where[to]], counts[where[at] : where[to]]
                row = np.repeat(np.repeat(np.arange(to - at), np.diff(where[at : to + 1])), n)
                position = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
                start = words.first[:-1][row] + position
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[at:to][row]), pa.array(keys[at:to][row]), signed(words.span_hash(start, start + size, 5)),
                    signed(words.span_hash(start, start + size, 6)), pa.array(position.astype(np.int32)),
                ], names=["doc_id", "key", "w1", "w2", "first"])

    return run


def estimated_repeats(cells: DataFrame, width_bits: int = 36) -> DataFrame:
    """Cells whose anchor a count-min sketch estimates to occur at least twice.

    The sketch has two rows of 2**width_bits counters; only counters in use are stored. The partial
    aggregate of each task is the sketch of its partition, the shuffle adds the sketches up. A
    counter is never below the true count, so no repeated anchor is lost. The second row counts only
    what the first one lets through, which keeps it an overestimate and makes it emptier. The sketch
    stays spread over the cluster: it grows with the data and is never collected or broadcast.
    """
    for seed in (101, 202):
        cells = cells.withColumn("counter", F.shiftrightunsigned(F.xxhash64("anchor", F.lit(seed)), 64 - width_bits))
        twice = cells.groupBy("counter").agg(F.count("*").alias("n")).where("n > 1").select("counter")
        cells = cells.join(twice, "counter", "left_semi").drop("counter")
    return cells


def repeated_spans(docs: DataFrame, size: int = 50) -> DataFrame:
    """Word spans (doc_id, key, first, windows) whose windows all start in a document with a smaller id.

    ``windows`` consecutive windows begin at word ``first``. Spans of one document may overlap.
    """
    keyed = docs.where("doc_id is not null and text is not null").select("doc_id", row_key().alias("key"), "text")
    cells = materialize(keyed.mapInArrow(_cells(size), CELLS), "substring-cells")
    cells = materialize(estimated_repeats(cells), "substring-repeats")
    # Equal passages are settled as wholes: all but the smallest id lose every window of the cell.
    passages = cells.groupBy("anchor", "passage").agg(F.min("doc_id").alias("owner"))
    kinds = passages.groupBy("anchor").agg(F.count("*").alias("kinds"))
    known = cells.join(passages.join(kinds, "anchor"), ["anchor", "passage"])
    known = materialize(
        known.where("doc_id > owner or kinds > 1").select("doc_id", "key", "first", "windows", (F.col("doc_id") > F.col("owner")).alias("gone")),
        "substring-known",
    )
    # An anchor with different passages: the owners' windows are compared one by one.
    open_cells = known.where("not gone").groupBy("doc_id", "key").agg(F.collect_list(F.struct("first", "windows")).alias("c"))
    texts = keyed.dropDuplicates(["doc_id", "key"]).join(open_cells, ["doc_id", "key"]).select("doc_id", "key", "text", "c.first", "c.windows")
    single = materialize(texts.mapInArrow(_windows(size), "doc_id long, key long, w1 long, w2 long, first int"), "substring-windows")
    # Written, so that the join below is between plain exchanges, which can be split where a window is frequent.
    least = single.groupBy("w1", "w2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).where("owner < last").drop("last")
    least = materialize(least, "substring-owners")
    later = single.join(least, ["w1", "w2"]).where("doc_id > owner").select("doc_id", "key", "first", F.lit(1).alias("windows"))
    return known.where("gone").select("doc_id", "key", "first", "windows").unionByName(later)


def _keep(size: int):
    def run(batches):
        for batch in batches:
            firsts, where = list_parts(batch.column(2))
            counts, _ = list_parts(batch.column(3))
            n_words, n_removed, kept = [], [], []
            for i, text in enumerate(batch.column(1)):
                words = (text.as_py() or "").encode().split()
                a, n = firsts[where[i] : where[i + 1]], counts[where[i] : where[i + 1]]
                n_words.append(len(words))
                if len(a):
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, a, 1)
                    np.add.at(change, a + n + size - 1, -1)
                    words = list(compress(words, np.cumsum(change)[:-1] == 0))
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the remaining words, joined by one space).

    Removes each word that lies in a window of ``size`` words which also starts in a document with a
    smaller id, judged on the input. Null text: no words. A null doc_id is neither a source nor
    compared: such rows keep their words. Rows that share an id are judged each for itself and never
    against each other. Repeated rows give repeated, equal results. Other columns are ignored.
    """
    gone = repeated_spans(docs, size).groupBy("doc_id", "key").agg(F.collect_list(F.struct("first", "windows")).alias("c"))
    nothing = F.array().cast("array<int>")
    texts = docs.select("doc_id", row_key().alias("key"), "text").join(gone, ["doc_id", "key"], "left")
    texts = texts.select("doc_id", "text", F.coalesce("c.first", nothing).alias("first"), F.coalesce("c.windows", nothing).alias("windows"))
    return texts.mapInArrow(_keep(size), "doc_id long, n_words long, n_removed long, kept string")
