"""Metadata filters, embedding search and request lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import dot, dot_literal


def doi_union(*frames: DataFrame) -> DataFrame:
    """Distinct, non-NULL dois of several tables."""
    parts = [f.where(F.col("doi").isNotNull()).select("doi") for f in frames]
    return reduce(DataFrame.union, parts).distinct()


def _like_any(c: Column, terms: Sequence[str]) -> Column:
    # '%' and '_' in a term act as wildcards, as they do in the searched store.
    return reduce(lambda a, b: a | b, [F.lower(c).like(f"%{t.lower()}%") for t in terms])


def filter_articles(
    tables: dict[str, DataFrame],
    keywords: Sequence[str] | None = None,
    has_dataset: bool | None = None,
    has_quantified_data: bool | None = None,
    authors: Sequence[str] | None = None,
    article_type: str | None = None,
    journal: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    mesh_terms: Sequence[str] | None = None,
    language: str | None = None,
) -> DataFrame:
    """Distinct dois of the articles that meet every filter; lists mean "any of"."""
    a = tables["articles"].where(F.col("doi").isNotNull())
    if article_type:
        a = a.where(F.col("article_type") == article_type)
    if date_from:
        a = a.where(F.col("publication_date") >= F.lit(date_from).cast("date"))
    if date_to:
        a = a.where(F.col("publication_date") <= F.lit(date_to).cast("date"))
    if language:
        a = a.where(F.col("language") == language)
    if journal:
        named = tables["journals"].where(_like_any(F.col("name"), [journal])).select("journal_id")
        a = a.join(named, "journal_id", "left_semi")
    a = a.select("doi")
    if keywords:
        wanted = [k.lower() for k in keywords]
        sets = []
        for link, terms, key in (
            ("article_keywords", "keywords", "keyword_id"),
            ("article_llm_keywords", "llm_keywords", "llm_keyword_id"),
        ):
            if link in tables and terms in tables:
                hits = tables[terms].where(F.lower("keyword").isin(wanted)).select(key)
                sets.append(tables[link].join(hits, key, "left_semi"))
        a = a.join(doi_union(*sets), "doi", "left_semi")
    if has_dataset is not None:
        linked = doi_union(tables["llm_raw_data"], tables["llm_processed_data"])
        a = a.join(linked, "doi", "left_semi" if has_dataset else "left_anti")
    if has_quantified_data is not None:
        linked = doi_union(tables["llm_processed_data"])
        a = a.join(linked, "doi", "left_semi" if has_quantified_data else "left_anti")
    if authors:
        # Names are matched against "first last" without trimming.
        full = F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "), F.coalesce("last_name", F.lit("")))
        named = tables["author_info"].where(_like_any(full, authors)).select("author_id")
        a = a.join(doi_union(tables["article_authors"].join(named, "author_id", "left_semi")), "doi", "left_semi")
    if mesh_terms:
        hits = tables["mesh_terms"].where(_like_any(F.col("descriptor_name"), mesh_terms)).select("mesh_term_id")
        a = a.join(doi_union(tables["article_mesh_terms"].join(hits, "mesh_term_id", "left_semi")), "doi", "left_semi")
    return a.distinct()


def search(embeddings: DataFrame, query_vec: Sequence[float], k: int = 5, tiebreak: Sequence[str] = ("doi", "pmid", "pmcid")) -> DataFrame:
    """The ``k`` rows with the highest dot product."""
    scored = embeddings.withColumn("score", dot_literal(F.col("embedding"), list(query_vec))).drop("embedding")
    return scored.orderBy(F.desc("score"), *tiebreak).limit(k)


def search_filtered(tables: dict[str, DataFrame], query_vec: Sequence[float], k: int = 5, **filters) -> DataFrame:
    """Embedding search among the articles that pass :func:`filter_articles`, with their titles."""
    dois = filter_articles(tables, **filters)
    # Scored before the join, so that eight bytes a row are shuffled and not a vector.
    score = dot_literal(F.col("embedding"), list(query_vec)).alias("score")
    candidates = tables["embeddings"].select("doi", "pmid", "pmcid", score).join(dois, "doi", "left_semi")
    top = candidates.orderBy(F.desc("score"), "doi", "pmid", "pmcid").limit(k)
    titles = tables["articles"].select("doi", "title")
    # Every doi found is one of an article; adaptive execution sees that only k rows need a title.
    return titles.join(top, "doi").select("doi", "pmid", "pmcid", "title", "score")


def most_similar(requests: DataFrame, query_vec: Sequence[float], threshold: float = 0.0) -> DataFrame:
    """One row: the request with the highest cosine (lowest id on ties), ``found`` by threshold."""
    query = [float(q) for q in query_vec]
    length = sum(q * q for q in query) ** 0.5
    e = F.col("embedding")
    scored = requests.where(e.isNotNull()).withColumn(
        "_score", F.coalesce(F.try_divide(dot_literal(e, query), F.sqrt(dot(e, e)) * F.lit(length)), F.lit(0.0))
    )
    fields = [c for c in requests.columns if c != "embedding"]
    best = scored.agg(
        F.max("_score").alias("similarity_score"),
        F.max_by(F.struct(*fields), F.struct("_score", -F.col("id"))).alias("_row"),
    )
    found = F.coalesce(F.col("similarity_score") >= threshold, F.lit(False))
    return best.select(
        found.alias("found"),
        *[F.when(found, F.col("_row")[c]).alias("request_id" if c == "id" else c) for c in fields],
        "similarity_score",
    )


def oldest_approved(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("request_status") == "approved").orderBy("creation_time", "id").limit(1)
