"""Relevance gate: contexts, scoring in two passes, verdicts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import injection as inj
from ..functions.cells import gate
from ..functions.ids import ARTICLE_IDS
from ..functions.text import DESCRIPTOR_FIELDS, descriptor_text, methods_excerpt, strip
from ..session import materialize
from .idjoin import id_pairs
from .ranking import join_same, lookup
from .scan import scan_signal

EXCERPT_CHARS = 4600
# The texts of a missing context and a missing score.
NO_CONTEXT = "No study text/abstract/descriptor available to score."
NO_SCORE = "Model did not return a usable score."


def _parts(*columns: Column) -> Column:
    return F.concat_ws("\n\n", *[F.when(c != "", c) for c in columns])


def build_context(
    articles: DataFrame, texts: DataFrame | None = None, descriptors: DataFrame | None = None,
    excerpt_chars: int = EXCERPT_CHARS, fulltext_chars: int | None = None, model: str | None = None,
) -> DataFrame:
    """Article columns plus ``context``, ``context_level`` and ``full_context``.

    A stored descriptor (newest, any identifier) comes first, then an excerpt of the full
    text, then title and abstract alone. ``texts`` is ``(path, text)``; without it a
    ``text`` column of ``articles`` is used. Articles are distinct in their identifiers.
    """
    keep = articles.columns
    rows = articles
    if texts is not None:
        rows = lookup(rows, texts.select(F.col("path").alias("_path"), F.col("text").alias("_full")), F.col("article_filepath"), "_path")
    else:
        rows = rows.withColumn("_full", F.col("text") if "text" in keep else F.lit(None).cast("string"))
    if descriptors is not None:
        known = descriptors if model is None else descriptors.where(F.col("model") == model)
        fields = [name for name, _ in DESCRIPTOR_FIELDS]
        found = id_pairs(articles.select(*ARTICLE_IDS), known.select(*ARTICLE_IDS, *fields, "created_at", "id"))
        newest = found.groupBy(*[F.col(f"l_{k}").alias(k) for k in ARTICLE_IDS]).agg(
            F.max_by(F.struct(*[F.col(f"r_{f}").alias(f) for f in fields]), F.struct("r_created_at", "r_id")).alias("_d")
        )
        rows = join_same(rows, newest, ARTICLE_IDS, "left")
        described = F.when(F.col("_d").isNotNull(), descriptor_text(**{f: F.col("_d")[f] for f in fields}))
    else:
        described = F.lit(None).cast("string")
    header = F.concat_ws(
        "\n", F.when(F.col("title") != "", F.concat(F.lit("TITLE: "), F.col("title"))),
        F.when(F.col("abstract") != "", F.concat(F.lit("ABSTRACT: "), F.col("abstract"))),
    )
    rows = rows.withColumn("_header", header).withColumn("_described", described)
    head, full = F.col("_header"), F.col("_full")
    has_text = F.coalesce(full != "", F.lit(False))
    from_text = _parts(head, methods_excerpt(full, limit=excerpt_chars))
    context = (
        F.when(F.col("_described").isNotNull(), _parts(F.col("_described"), head))
        .when(has_text, from_text)
        .otherwise(head)
    )
    level = F.when(F.col("_described").isNotNull(), "descriptor").otherwise("excerpt")
    read = full if fulltext_chars is None else F.substring(full, 1, fulltext_chars)
    whole = F.when(has_text, _parts(head, read))
    return rows.select(*[F.col(f"`{c}`") for c in keep], context.alias("context"), level.alias("context_level"),
                       whole.alias("full_context"))


def judge(df: DataFrame, include: float = 0.7, exclude: float = 0.4) -> DataFrame:
    """Add ``verdict`` from ``score`` and ``directly_measures``."""
    return df.withColumn("verdict", gate(F.col("score"), F.col("directly_measures"), include, exclude))


Scorer = Callable[[Column, Column, Column], Column]


def score_studies(
    contexts: DataFrame, question: str, scorer: Scorer, escalate: bool = True, include: float = 0.7, exclude: float = 0.4,
    partitions: int | None = None,
) -> DataFrame:
    """Score each context, and once more on the full text where the first verdict is ``flag``.

    ``scorer(question, context, level)`` gives ``struct(score double, directly_measures
    boolean, reason string, error string)``, normally an Arrow function around a model. Both
    passes are materialised, since calling the model again would cost and could differ. With ``partitions`` the rows of each
    pass are first dealt out over so many tasks: scan and model take far longer than an exchange.
    """
    asked = F.lit(question)

    def scanned(df, text_col):
        df = df if partitions is None else df.repartition(partitions)
        signal = scan_signal(df.withColumn("_scan", F.col(text_col)), "_scan")
        wanted = [F.col(f"`{c}`") for c in df.columns]
        return signal.select(
            *wanted, F.col("risk_score").alias("injection_risk_score"), F.col("risk_level").alias("injection_risk_level"),
            (F.col("risk_score") >= inj.RISK_MEDIUM).alias("injection_flagged"),
            F.col("matched_categories").alias("injection_categories"),
        )

    def scored(df, text_col, level):
        # A study without any text is never sent to the model.
        sendable = strip(F.coalesce(F.col(text_col), F.lit(""))) != ""
        got = df.withColumn("_s", scorer(asked, F.when(sendable, F.col(text_col)), level))
        s = F.col("_s")
        error = (
            F.when(~sendable, NO_CONTEXT)
            .when(s["error"].isNotNull(), F.concat(F.lit("scoring failed: "), s["error"]))
            .when(s["score"].isNull(), NO_SCORE)
        )
        ok = error.isNull()
        got = got.withColumn("score", F.when(ok, s["score"])).withColumn("directly_measures", F.when(ok, s["directly_measures"]))
        got = got.withColumn("reason", F.when(sendable, F.trim(F.coalesce(s["reason"], F.lit(""))))).withColumn("error", error)
        return judge(got.drop("_s"), include, exclude)

    base = contexts.columns
    first = materialize(scored(scanned(contexts, "context"), "context", F.col("context_level")).withColumn("escalated", F.lit(False)))
    more = F.coalesce(F.col("full_context") != F.col("context"), F.lit(False)) & (strip(F.col("full_context")) != "")
    again = F.lit(escalate) & (F.col("verdict") == "flag") & F.coalesce(more, F.lit(False))
    if escalate:
        second = scanned(first.where(again).select(*base), "full_context").withColumn("context_level", F.lit("full_text"))
        second = materialize(scored(second, "full_context", F.col("context_level")).withColumn("escalated", F.lit(True)))
        first = first.where(~again).unionByName(second)
    return first.drop("context", "full_context").withColumn("question_sha256", F.sha2(asked, 256))
