"""The corpus pipeline: five stages over the documents, each written as Parquet and read again.

Every stage but the last returns the columns of its input, whatever their names: only doc_id, source and
text are shown to an operator, the other columns travel in one struct. Rows without a doc_id pass all
filters that go by id: near-dedup and decontamination.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialize, row_key
from llm.contamination import contaminated
from llm.hilbert import shard
from llm.minhash import near_duplicates
from llm.mixing import mix
from llm.toxicity import train

#: Words in a shingle of the near-dedup stage.
SHINGLE = 5


def wrapped(docs: DataFrame, *shown: str, **more: Column) -> DataFrame:
    """The columns ``shown``, ``more`` made from all of them, and the others in the struct __rest."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in shown]
    return docs.select(*shown, *[c.alias(name) for name, c in more.items()], (F.struct(*rest) if rest else F.lit(0)).alias("__rest"))


def unwrapped(rows: DataFrame, docs: DataFrame, *shown: str) -> DataFrame:
    """Back to the columns of ``docs``."""
    return rows.select(*[F.col(c) if c in shown else F.col("__rest")[c].alias(c) for c in docs.columns])


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not call toxic."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return unwrapped(model.score(wrapped(docs, "text"), "text", "__rest").where("score < 0.5"), docs, "text")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies by five-word shingles.

    Of rows that share id and text the one stays whose lang, source and n_chars come first, nulls first;
    where these agree too, the one with the smallest hash of its columns.
    """
    kept = near_duplicates(docs, SHINGLE).where("kept and doc_id is not null").select("doc_id").distinct()
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    order = F.struct(*[c for c in ("lang", "source", "n_chars") if c in docs.columns], F.xxhash64(*hashed))
    rows = wrapped(docs, "doc_id", "text", __order=order)
    named = rows.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    one = named.groupBy("doc_id", row_key().alias("__key")).agg(F.min_by(F.struct("text", "__rest"), "__order").alias("__row"))
    one = one.select("doc_id", "__row.text", "__row.__rest").unionByName(rows.where("doc_id is null").drop("__order"))
    return unwrapped(one, docs, "doc_id", "text")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    leaks = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    shown = ("doc_id", "source", "text")
    taken = mix(wrapped(docs, *shown)).where("copies > 0")
    return unwrapped(taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))), docs, *shown)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with shard and slot along the Hilbert curve."""
    return shard(docs)


STAGES = [
    ("toxicity", clean), ("minhash_near_dedup", deduplicated), ("decontamination", decontaminated), ("cube_mixing", mixed), ("hilbert_sharding", sharded),
]

#: The classifier, MinHash and the cube method cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
