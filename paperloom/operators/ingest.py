"""Batch ingest of article XML and repository records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import ARTICLE_IDS
from ..session import materialize
from ..sources.articles_xml import first_rows, pubmed_records, record_tables
from .idjoin import id_anti
from .merge import add_links, assign_keys, resolve_authors, resolve_grants, resolve_mesh, upsert_articles, upsert_datasets, upsert_embeddings
from .ranking import join_same, key_in_order


def _rowwise(df: DataFrame) -> DataFrame:
    """``df`` has a row for each article or item: it is never broadcast, because a written file tells too little of its rows' size in memory."""
    return df.hint("merge")


def article_status(records: DataFrame, articles: DataFrame, overwrite: bool = False) -> DataFrame:
    """``seq, status`` of parsed records: failed, already_processed, skipped_no_abstract, overwritten, newly_processed.

    An article is known if any identifier is stored, or came with an earlier record of the
    batch that has an abstract. What is needed of the records is materialised.
    """
    # Read several times below, and records are usually still to be parsed.
    base = materialize(first_rows(records).select("seq", F.coalesce("requested_pmid", "pmid").alias("pmid"), "doi", "pmcid",
                                      (F.coalesce("abstract", F.lit("")) != "").alias("_abstract"), "error"))
    fresh = id_anti(base, articles).select("seq", F.lit(True).alias("_fresh"))
    rows = join_same(base, _rowwise(fresh), [], "left", exact=["seq"])
    firsts = []
    for i, key in enumerate(ARTICLE_IDS):
        usable = F.col("_abstract") & F.col("error").isNull() & F.col(key).isNotNull()
        heads = base.where(usable).groupBy(key).agg(F.min("seq").alias(f"_head{i}"))
        rows = join_same(rows, _rowwise(heads), [], "left", exact=[key])
        firsts.append(F.coalesce(F.col(f"_head{i}") >= F.col("seq"), F.lit(True)))
    known = F.col("_fresh").isNull() | ~reduce(lambda a, b: a & b, firsts)
    status = (
        F.when(F.col("error").isNotNull(), "failed")
        .when(known & F.lit(not overwrite), "already_processed")
        .when(~F.col("_abstract"), "skipped_no_abstract")
        .when(known, "overwritten")
        .otherwise("newly_processed")
    )
    return rows.select("seq", status.alias("status"))


def _in_order(items: DataFrame, *positions: str) -> DataFrame:
    """Items with ``doc``, the seq of their article, and ``seq``, which grows in the order of articles and positions."""
    return key_in_order(items.withColumnRenamed("seq", "doc"), ["doc", *positions], "seq")


def _written(frames: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    return materialize(frames[0]), materialize(frames[1])


def ingest_articles(
    tables: dict[str, DataFrame], raw_xml: DataFrame, overwrite: bool = False, xml_col: str = "xml",
    pmid_col: str | None = None, embedder: Callable[[Column], Column] | None = None, embedding_model: str | None = None,
    partitions: int | None = None, part_col: str | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All literature tables after one batch of PubMed documents ``(seq, xml)``, and outcome counters.

    With ``part_col`` a document comes in several rows, as ``pubmed_records`` has it. ``seq`` holds distinct integers of any size; items are ordered by it and their positions. The parsed records are
    materialised once, since a dozen tables are derived from them, and so are the numbered items of each kind and
    all grown tables but articles: a plan of all of them would be too large for the driver, and so would all tables
    that it broadcasts.
    """
    records = materialize(pubmed_records(raw_xml, xml_col, "seq", pmid_col, partitions, part_col))
    status = materialize(article_status(records, tables["articles"], overwrite))
    accepted = status.where(F.col("status").isin("newly_processed", "overwritten")).select("seq")
    parsed = {name: t.join(accepted, "seq", "left_semi") for name, t in record_tables(records).items() if name != "errors"}
    out = dict(tables)

    out["journals"], journal_ids = _written(assign_keys(tables["journals"], parsed["journals"], ["name"], "journal_id"))
    fallback = F.coalesce(F.nullif("doi", F.lit("")), F.concat(F.lit("pmid:"), F.col("pmid")))
    articles = join_same(
        parsed["articles"].withColumn("doi", fallback), journal_ids.withColumnRenamed("name", "journal_name"), [], "left",
        exact=["journal_name"],
    ).drop("journal_name")
    out["articles"] = upsert_articles(tables["articles"], articles)
    of_doc = materialize(articles.select(F.col("seq").alias("doc"), *ARTICLE_IDS))

    def links(table, items, payload, **kwargs):
        rows = items.join(_rowwise(of_doc), "doc").select(*ARTICLE_IDS, *payload, "seq")
        # Without overwriting, accepted articles share no identifier, so their links are consistent.
        return materialize(add_links(tables[table], rows, payload[:1], id_col="id", consistent=not overwrite, **kwargs))

    people = _in_order(parsed["authors"], "author_position")
    table, author_ids = resolve_authors(tables["author_info"], people)
    out["author_info"] = materialize(table)
    author_ids = materialize(people.select("doc", "seq", "author_position").join(_rowwise(author_ids), "seq"))
    out["article_authors"] = links("article_authors", author_ids.withColumn("is_corresponding", F.lit(False)), ["author_id", "author_position", "is_corresponding"])

    places = _in_order(parsed["affiliations"], "author_position", "affiliation_position")
    out["affiliations"], place_ids = _written(assign_keys(tables["affiliations"], places.select("affiliation_text", "seq"), ["affiliation_text"], "affiliation_id"))
    pairs = places.join(place_ids, "affiliation_text").join(_rowwise(author_ids.drop("seq")), ["doc", "author_position"])
    out["author_affiliations"] = materialize(add_links(
        tables["author_affiliations"], pairs.select("author_id", "affiliation_id", "seq"), ["affiliation_id"],
        null_safe=["author_id"], id_col="id",
    ))

    words = _in_order(parsed["keywords"], "keyword_position")
    out["keywords"], word_ids = _written(assign_keys(tables["keywords"], words.select("keyword", "seq"), ["keyword"], "keyword_id"))
    out["article_keywords"] = links("article_keywords", words.join(word_ids, "keyword"), ["keyword_id"])

    grants = _in_order(parsed["grants"], "grant_position")
    out["grants"], grant_ids = _written(resolve_grants(tables["grants"], grants))
    out["article_grants"] = links("article_grants", grants.select("doc", "seq").join(_rowwise(grant_ids), "seq"), ["grant_id"])

    terms = _in_order(parsed["mesh_terms"], "mesh_position")
    table, term_ids = resolve_mesh(tables["mesh_terms"], terms)
    out["mesh_terms"] = materialize(table)
    term_ids = materialize(terms.select("doc", "seq", "mesh_position", "is_major_topic").join(_rowwise(term_ids), "seq"))
    out["article_mesh_terms"] = links("article_mesh_terms", term_ids, ["mesh_term_id", "is_major_topic"], null_safe=["doi", "pmid"])

    qualifiers = _in_order(parsed["mesh_qualifiers"], "mesh_position", "qualifier_position")
    out["mesh_qualifiers"], qualifier_ids = _written(assign_keys(tables["mesh_qualifiers"], qualifiers.select("qualifier_name", "seq"), ["qualifier_name"], "qualifier_id"))
    headings = join_same(
        term_ids.select("doc", "mesh_position", "mesh_term_id").join(_rowwise(of_doc), "doc"),
        _rowwise(out["article_mesh_terms"].select("doi", "pmid", "mesh_term_id", F.col("id").alias("article_mesh_term_id"))),
        ["doi", "pmid"], exact=["mesh_term_id"],
    )
    pairs = qualifiers.join(qualifier_ids, "qualifier_name").join(
        _rowwise(headings.select("doc", "mesh_position", "article_mesh_term_id")), ["doc", "mesh_position"]
    )
    out["article_mesh_qualifiers"] = materialize(add_links(
        tables["article_mesh_qualifiers"], pairs.select("article_mesh_term_id", "qualifier_id", "seq"), ["qualifier_id"],
        null_safe=["article_mesh_term_id"], id_col="id",
    ))

    if embedder is not None:
        vectors = articles.select(*ARTICLE_IDS, embedder(F.col("abstract")).alias("embedding"), F.lit(embedding_model).alias("model"), "seq")
        out["embeddings"] = upsert_embeddings(tables["embeddings"], materialize(vectors.where(F.col("embedding").isNotNull())))
    return out, ingest_counters(status)


def ingest_counters(status: DataFrame) -> DataFrame:
    names = ("already_processed", "newly_processed", "overwritten", "failed", "skipped_no_abstract")
    return status.agg(F.count("*").alias("total_found"), *[F.count_if(F.col("status") == s).alias(s) for s in names])


def _joined(c: Column) -> Column:
    return F.nullif(F.array_join(c, ", "), F.lit(""))


def dataset_rows(records: DataFrame, *more: Column) -> DataFrame:
    """Repository records as rows of the datasets table, and ``more`` columns; lists become comma-separated text."""
    have = set(records.columns)

    def field(name, kind="string"):
        return F.col(name) if name in have else F.lit(None).cast(kind)

    instrument = _joined(F.col("instruments")) if "instruments" in have else field("platform")
    return records.select(
        "dataset_id", field("title").alias("title"), field("description").alias("description"),
        (_joined(F.col("species")) if "species" in have else field("species")).alias("species"), instrument.alias("instrument"),
        "repository", field("submission_date", "date").alias("submission_date"),
        field("publication_date", "date").alias("publication_date"), field("local_filepath").alias("local_filepath"),
        field("doi").alias("doi"), field("pmid").alias("pmid"), field("pmcid").alias("pmcid"), *more,
    )


def ingest_datasets(
    datasets: DataFrame, records: DataFrame, seq: str = "seq", overwrite: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Datasets table after one batch of repository records, and ``(dataset_id, status)``.

    Rows count in ``seq`` order (distinct values): the first row of an unknown id makes the dataset known. Known
    datasets are left alone unless ``overwrite``; then new non-NULL values replace old ones.
    """
    rows = dataset_rows(records, F.col(seq).alias("seq"))
    known = datasets.select("dataset_id", F.lit(True).alias("_known"))
    checked = join_same(rows, known, [], "left", exact=["dataset_id"])
    heads = rows.groupBy("dataset_id").agg(F.min("seq").alias("_head"))
    checked = join_same(checked, heads, [], "left", exact=["dataset_id"])
    exists = F.col("_known").isNotNull() | (F.col("seq") > F.col("_head"))
    status = F.when(exists & F.lit(not overwrite), "already_exists").when(exists, "overwritten").otherwise("ingested")
    new = (checked if overwrite else checked.where(~exists)).drop("_known", "_head")
    return upsert_datasets(datasets, new), checked.select("dataset_id", status.alias("status"))
