"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import lists, materialize

# Words that open the lexicon, second-person words, and characters written for letters.
SEED_WORDS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "pathetic", "worthless", "disgusting", "clown")
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos ti tus usted ustedes".split())
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")
PREFIXES = (4, 5, 6)
FEATURES = (
    "word_density", "word_weight", "prefix_density", "prefix_weight", "hits", "hidden_density", "hidden_weight", "near_second_person", "second_person",
    "capitals", "shouted_words", "punctuation", "exclamations", "obfuscation", "stretched", "length",
)
NEAR = 5
#: Distinct words a worker remembers.
REMEMBERED = 300_000


def fold(doc_id):
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def bare(word: str) -> str:
    """Lower case without what is not a letter at either end."""
    word, a, b = word.lower(), 0, len(word)
    b = len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b]


def plain(word: str) -> str:
    """The word behind lookalike characters and separators inside it."""
    return "".join(c for c in word.lower().translate(LOOKALIKES) if c.isalpha())


def _word_counts(batches):
    """Documents of either label that hold a word or a prefix, per task."""
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            words = {bare(w) for w in set((text.as_py() or "").split())} - {""}
            terms = {"=" + w for w in words}
            for n in PREFIXES:
                terms |= {"^" + w[:n] for w in words if len(w) > n}
            counts[int(toxic)].update(terms)
    for toxic, found in counts.items():
        terms = list(found)
        for at in range(0, len(terms), 50_000):
            part = terms[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([found[t] for t in part], pa.int64()), pa.array([toxic] * len(part), pa.int32())], names=["term", "n", "toxic"]
            )


def learn_lexicon(sample: DataFrame, toxic: int, clean: int, size: int = 1000) -> dict[str, float]:
    """Log odds of the ``size`` most telling words ('=word') and prefixes ('^pref') of the labelled sample."""
    counts = sample.select("text", "toxic").mapInArrow(_word_counts, "term string, n long, toxic int").groupBy("term")
    counts = counts.agg(F.sum(F.col("n") * F.col("toxic")).alias("t"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    best = counts.where("t >= 5").select("term", odds.alias("odds"), "t").where("odds > 2.5").orderBy(F.desc(F.col("odds") * F.sqrt("t")), "term").limit(size)
    return {"=" + w: 3.0 for w in SEED_WORDS} | {r.term: r.odds for r in best.collect()}


def _features(lexicon: dict[str, float]):
    """Per text the values named in FEATURES. Each distinct word is judged once a worker."""
    by_length = sorted({len(t) - 1 for t in lexicon if t[0] == "^"}, reverse=True)

    def judge(raw: bytes) -> tuple:
        word = raw.decode("utf-8", "replace")
        core = bare(word)
        whole = lexicon.get("=" + core, 0.0)
        start = max((lexicon.get("^" + core[:n], 0.0) for n in by_length if len(core) >= n), default=0.0)
        odd = any(not c.isalpha() and c not in "'’-" for c in core)
        hidden = 0.0
        if odd or not core.isascii() or any(c in "0123457@$!|" for c in word):
            meant = plain(word)
            if meant != core:
                hidden = max(lexicon.get("=" + meant, 0.0), max((lexicon.get("^" + meant[:n], 0.0) for n in by_length if len(meant) >= n), default=0.0))
        stretched = any(core[i] == core[i + 1] == core[i + 2] for i in range(len(core) - 2))
        return (whole, start, hidden, float(core in SECOND_PERSON), float(len(core) > 1 and word.isupper()), float(odd), float(stretched))

    def run(batches):
        number: dict[bytes, int] = {}
        kinds: dict[tuple, int] = {}
        table = np.zeros((0, 7))

        for batch in batches:
            rows = []
            for text in batch.column(batch.num_columns - 1):
                raw = (text.as_py() or "").encode()
                words = raw.split()
                if len(number) > REMEMBERED:
                    number.clear()
                new = [w for w in set(words) if w not in number]
                for w in new:
                    number[w] = kinds.setdefault(judge(w), len(kinds))
                if len(kinds) > len(table):
                    table = np.array(list(kinds))
                n = max(len(words), 1)
                at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                whole, start, hidden, second, loud, odd, stretched = (table[at].T if len(words) else np.zeros((7, 0)))
                hit = (whole > 0) | (start > 0) | (hidden > 0)
                close = 0
                if hit.any() and second.any():
                    people, hits = np.flatnonzero(second), np.flatnonzero(hit)
                    right = np.searchsorted(people, hits)
                    gap = np.minimum(np.abs(hits - people[np.minimum(right, len(people) - 1)]), np.abs(hits - people[np.maximum(right - 1, 0)]))
                    close = int((gap <= NEAR).sum())
                bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
                upper, lower = bytes_[65:91].sum(), bytes_[97:123].sum()
                marks = bytes_[33:48].sum() + bytes_[58:65].sum() + bytes_[91:97].sum() + bytes_[123:127].sum()
                top = lambda x: float(x.max()) if len(x) else 0.0
                rows.append([
                    (whole > 0).sum() / n, top(whole), (start > 0).sum() / n, top(start), math.log1p(hit.sum()), (hidden > 0).sum() / n, top(hidden),
                    close / n, second.sum() / n, upper / max(upper + lower, 1), loud.sum() / n, marks / max(len(raw), 1),
                    (bytes_[33] + bytes_[63]) / max(len(raw), 1), odd.sum() / n, stretched.sum() / n, math.log1p(len(words)),
                ])
            values = np.array(rows, np.float64).reshape(len(rows), len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists(values.ravel(), np.full(len(rows), len(FEATURES)))], names=[*batch.schema.names[:-1], "values"])

    return run


@dataclass
class Toxicity:
    """What training yields. Without trees (one label only, or none) every score is ``constant``."""

    lexicon: dict[str, float]
    trees: object = None
    calibration: object = None
    constant: float = 0.0

    def score(self, docs: DataFrame, *keep: str) -> DataFrame:
        """``keep`` columns plus score of the column text; null and empty texts are scored as empty."""
        if self.trees is None:
            return docs.select(*keep, F.lit(self.constant).alias("score"))
        schema = StructType([*docs.select(*keep).schema.fields, StructField("values", ArrayType(DoubleType()))])
        values = docs.select(*keep, F.col("text").alias("__text")).mapInArrow(_features(self.lexicon), schema)
        return _calibrated(self.trees, self.calibration, values).select(*keep, "score")


def _probability(trees, values: DataFrame) -> DataFrame:
    out = trees.transform(values.withColumn("features", array_to_vector("values")))
    return out.withColumn("raw", vector_to_array("probability")[1]).drop("features", "probability", "rawPrediction", "prediction")


def _calibrated(trees, calibration, values: DataFrame) -> DataFrame:
    out = calibration.transform(_probability(trees, values))
    # A thousandth of the raw value orders documents on one step of the calibration.
    return out.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction") * 0.999 + F.col("raw") * 0.001)))


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Toxicity:
    """Learns from labelled documents outside fold 0.

    At most ``sample`` labelled documents, those with the smallest hashes of their ids, are used; the
    bound keeps training the same size on any corpus, and labels without a document take no place in it. A quarter of them calibrates, the others give
    the lexicon and the trees. Several labels of one document: toxic if one says so. Null labels and
    labels without a document are left out.
    """
    labelled = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    labelled = labelled.where(fold("doc_id") != 0).join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id", F.lit(8)), "doc_id").limit(sample)
    chosen = docs.select("doc_id", "text").join(F.broadcast(labelled), "doc_id")  # at most `sample` rows
    chosen = materialize(chosen.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(4))), "toxicity-sample")
    n = {(r.toxic, r.c): r.n for r in chosen.groupBy("toxic", (F.col("part") == 0).alias("c")).agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get((1, False), 0), n.get((0, False), 0)
    total = sum(n.values())
    if not toxic or not clean or not (n.get((0, True)) or n.get((1, True))):
        return Toxicity({}, constant=sum(v for (t, _), v in n.items() if t) / total if total else 0.0)
    lexicon = learn_lexicon(chosen.where("part <> 0"), toxic, clean)
    values = chosen.select("toxic", "part", "text").mapInArrow(_features(lexicon), "toxic int, part long, values array<double>")
    values = materialize(values.withColumn("toxic", F.col("toxic").cast("double")), "toxicity-features")
    classifier = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=15, maxDepth=3, stepSize=0.3, seed=8)
    trees = classifier.fit(values.where("part <> 0").select("toxic", array_to_vector("values").alias("features")))
    isotonic = IsotonicRegression(labelCol="toxic", featuresCol="raw")
    return Toxicity(lexicon, trees, isotonic.fit(_probability(trees, values.where("part = 0")).select("toxic", "raw")))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Inputs of a score are texts alone.

    Null text counts as empty, which is scored too. A null id is in no fold (held_out false). Repeated
    rows give repeated, equal results. Without labels of both kinds the score is the share of toxic
    ones, or 0. Other columns are ignored.
    """
    scored = train(docs, labels, sample).score(docs, "doc_id")
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
