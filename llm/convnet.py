"""Quality by a byte-level convolutional network, trained and run in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. In a chunk every byte becomes
a learned vector, learned filters slide over the bytes, and each filter's largest answer stays. A
dense layer turns the answers of a chunk into features; their mean over all chunks gives one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_chunks

#: Bytes of a chunk, and from one chunk's start to the next; more than a filter's width overlaps.
CHUNK, STEP = 512, 448
#: Size of a byte's vector, bytes under a filter, bytes from one window to the next, filters, features.
DEPTH, WIDTH, STRIDE, FILTERS, FEATURES = 6, 8, 2, 32, 16
TAPS = WIDTH // STRIDE
WINDOWS = CHUNK // STRIDE - TAPS + 1
#: Chunks that go through the network at once.
AT_ONCE = 128


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 4; fold 2 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def n_chunks(lengths: np.ndarray) -> np.ndarray:
    """Chunks that cover texts of so many bytes; an empty text has one, of padding."""
    return 1 + np.maximum(0, -(-(lengths - CHUNK) // STEP))


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes from each start, CHUNK long; zeros from ``ends`` on."""
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    if not len(data):
        return np.zeros(at.shape, np.uint8)
    return np.where(inside, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)


@dataclass
class Network:
    """bytes (256, DEPTH), filters (TAPS, STRIDE * DEPTH, FILTERS) and their offsets, dense layers. ``constant`` stands in for an untrained one."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    @classmethod
    def start(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        shape = {"bytes": (256, DEPTH), "filters": (TAPS, STRIDE * DEPTH, FILTERS), "offsets": (FILTERS,), "dense": (FILTERS, FEATURES), "shift": (FEATURES,), "out": (FEATURES,), "bias": (1,)}
        scale = {"bytes": 0.5, "filters": (WIDTH * DEPTH) ** -0.5, "dense": FILTERS**-0.5, "out": FEATURES**-0.5}
        return cls({n: (rng.standard_normal(s) * scale.get(n, 0.0)).astype(np.float32) for n, s in shape.items()})

    def answers(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(chunk, filter): the largest answer, and the window that gave it."""
        w = self.weights
        x = w["bytes"][chunks].reshape(-1, STRIDE * DEPTH)
        taps = (x @ np.concatenate(list(w["filters"]), axis=1)).reshape(len(chunks), CHUNK // STRIDE, TAPS, FILTERS)
        total = taps[:, :WINDOWS, 0].copy()
        for k in range(1, TAPS):
            total += taps[:, k : k + WINDOWS, k]
        where = total.argmax(axis=1)
        return np.take_along_axis(total, where[:, None], 1)[:, 0] + w["offsets"], where

    def features(self, chunks: np.ndarray) -> np.ndarray:
        """(chunk, feature)"""
        best, _ = self.answers(chunks)
        return np.tanh(np.maximum(best, 0) @ self.weights["dense"] + self.weights["shift"])

    def probability(self, mean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(mean @ self.weights["out"] + self.weights["bias"], -30, 30)))

    def gradient(self, chunks: np.ndarray, counts: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of texts with so many consecutive chunks each."""
        w = self.weights
        text = np.repeat(np.arange(len(counts)), counts)
        best, where = self.answers(chunks)
        on = np.maximum(best, 0)
        deep = np.tanh(on @ w["dense"] + w["shift"])
        mean = np.zeros((len(counts), FEATURES), np.float32)
        np.add.at(mean, text, deep / counts[text, None].astype(np.float32))
        wrong = ((self.probability(mean) - truth) / len(counts)).astype(np.float32)
        g = {"out": mean.T @ wrong, "bias": wrong.sum(keepdims=True)}
        back = (wrong[text] / counts[text])[:, None].astype(np.float32) * w["out"] * (1 - deep**2)
        g["dense"], g["shift"] = on.T @ back, back.sum(axis=0)
        back = (back @ w["dense"].T) * (best > 0)
        g["offsets"] = back.sum(axis=0)
        # Only the winning window of each filter and chunk takes part.
        seen = chunks[np.arange(len(chunks))[:, None, None], where[:, :, None] * STRIDE + np.arange(WIDTH)]
        x = w["bytes"][seen].reshape(len(chunks), FILTERS, TAPS, STRIDE * DEPTH)
        g["filters"] = np.einsum("nf,nftd->tdf", back, x, optimize=True)
        to_bytes = (back[:, :, None, None] * w["filters"].transpose(2, 0, 1)).reshape(-1, DEPTH)
        g["bytes"] = np.stack([np.bincount(seen.ravel(), to_bytes[:, d], 256) for d in range(DEPTH)], axis=1).astype(np.float32)
        return g


def fit(texts: list[tuple[np.ndarray, int]], epochs: int = 12, batch: int = 32, rate: float = 0.01, seed: int = 13) -> Network:
    """A network from (chunks, label) of each text, by Adam; the same texts in the same order give the same network."""
    net = Network.start(seed)
    rng = np.random.default_rng(seed)
    mean = {n: np.zeros_like(v) for n, v in net.weights.items()}
    spread = {n: np.zeros_like(v) for n, v in net.weights.items()}
    step, total = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            some = [texts[i] for i in order[at : at + batch]]
            counts = np.array([len(c) for c, _ in some])
            g = net.gradient(np.concatenate([c for c, _ in some]), counts, np.array([y for _, y in some], np.float32))
            step += 1
            pace = rate * (1 - step / (total + 1)) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            for n, d in g.items():
                mean[n] += 0.1 * (d - mean[n])
                spread[n] += 0.001 * (d * d - spread[n])
                net.weights[n] -= (pace * mean[n] / (np.sqrt(spread[n]) + 1e-8)).astype(np.float32)
    return net


def _some_chunks(most: int):
    """Rows (doc_id, quality, text) to at most ``most`` chunks of each text, evenly spread from its first to its last."""

    def run(batches):
        for batch in batches:
            for at, to, data, offsets in text_chunks(batch.column(2)):
                length = np.diff(offsets)
                parts = []
                for i, n in enumerate(n_chunks(length)):
                    pick = np.unique(np.rint(np.linspace(0, n - 1, min(n, most))).astype(np.int64))
                    parts.append(cut(data, offsets[i] + pick * STEP, np.full(len(pick), offsets[i + 1])).tobytes())
                yield pa.RecordBatch.from_arrays([*batch.slice(at, to - at).columns[:2], pa.array(parts, pa.binary())], names=["doc_id", "quality", "chunks"])

    return run


def _scores(net: Network):
    """Rows (kept columns, text) to rows (kept columns, score); the network's answers to a bounded number of chunks are held."""

    def run(batches):
        for batch in batches:
            for at, to, data, offsets in text_chunks(batch.column(batch.num_columns - 1)):
                counts = n_chunks(np.diff(offsets))
                text = np.repeat(np.arange(to - at), counts)
                starts = offsets[text] + (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * STEP
                ends = offsets[text + 1]
                total = np.zeros((to - at, FEATURES))
                for a in range(0, len(text), AT_ONCE):
                    some = slice(a, a + AT_ONCE)
                    np.add.at(total, text[some], net.features(cut(data, starts[some], ends[some])))
                score = np.round(net.probability(total / counts[:, None]).astype(np.float64), 6)
                kept = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([*kept.columns[:-1], pa.array(score)], names=[*batch.schema.names[:-1], "score"])

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000, chunks: int = 8, epochs: int = 6) -> Network:
    """Learns from labelled documents outside fold 2.

    At most ``sample`` labelled documents, those with the smallest hashes of their ids, and at most
    ``chunks`` chunks of each, spread over the whole text, are used; so at most sample * chunks * 512 bytes reach the driver, on any
    corpus. Several labels of one document: good if all say so. Null labels and labels without a document are left out.
    """
    labelled = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    labelled = labelled.where(fold("doc_id") != 2).join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id", F.lit(13)), "doc_id").limit(sample)
    chosen = docs.select("doc_id", "text").join(F.broadcast(labelled), "doc_id").select("doc_id", "quality", "text")  # at most `sample` rows
    chosen = materialize(chosen.mapInArrow(_some_chunks(chunks), f"doc_id {dict(docs.dtypes)['doc_id']}, quality int, chunks binary"), "quality-sample")
    # Rows that share an id are more than one text; `sample` bounds those, too.
    rows = chosen.orderBy(F.xxhash64("doc_id", F.lit(13)), "doc_id", "chunks").limit(sample).collect()
    good = sum(r.quality for r in rows)
    if not 0 < good < len(rows):
        return Network({}, constant=good / len(rows) if rows else 0.5)
    return fit([(np.frombuffer(r.chunks, np.uint8).reshape(-1, CHUNK), r.quality) for r in rows], epochs)


def score(docs: DataFrame, net: Network, *keep: str) -> DataFrame:
    """``keep`` columns plus score of the column text; null and empty texts are a chunk of padding."""
    if net.constant is not None:
        return docs.select(*keep, F.lit(net.constant).alias("score"))
    kinds = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(_scores(net), ", ".join(f"`{n}` {kinds[n]}" for n in keep) + ", score double")


def quality(docs: DataFrame, labels: DataFrame, sample: int = 4000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from 0.7 on). Inputs of a score are texts alone, read whole.

    Null text counts as empty, which is scored too. A null id is in no fold (held_out false). Repeated
    rows give repeated rows. Without labels of both kinds the score is the share of good ones, or 0.5.
    Other columns are ignored.
    """
    scored = score(docs, train(docs, labels, sample), "doc_id")
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
