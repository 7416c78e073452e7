"""Literature graph, article-dataset graph, dataset links and graph export."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import ARTICLE_IDS, article_key
from ..functions.text import author_name, short_label
from ..session import materialize
from .idjoin import id_lookup, id_pairs
from .ranking import first_by, number_in_order

PARTS = ("journals", "authors", "keywords", "mesh_terms", "datasets")


def dataset_links(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Distinct article-dataset links of both fact tables."""
    columns = [*ARTICLE_IDS, "dataset_id", "data_repository"]
    parts = [t.where(F.col("dataset_id").isNotNull()).select(*columns) for t in (raw, processed)]
    return parts[0].union(parts[1]).distinct()


def _fact(t: DataFrame) -> DataFrame:
    url = F.col("url") if "url" in t.columns else F.lit(None).cast("string")
    return t.select(*ARTICLE_IDS, "dataset_id", F.col("data_repository").alias("repository"), url.alias("url"))


def datasets_of_articles(articles: DataFrame, raw: DataFrame, processed: DataFrame, keep: Sequence[str] = ARTICLE_IDS) -> DataFrame:
    """Datasets named for each article: every raw row, then processed rows not yet listed.

    Raw duplicates stay, each as a row. Processed rows are listed once, and only if no raw row of the same
    article has the same dataset, repository and address. ``articles`` rows must be distinct
    in ``keep``. The pairs of articles and facts are written once.
    """
    entry = ["dataset_id", "repository", "url"]
    keep = list(keep)

    def pairs(t):
        found = id_pairs(articles, _fact(t))
        return found.select(*[F.col(f"l_{c}").alias(c) for c in keep], *[F.col(f"r_{c}").alias(c) for c in entry])

    # Written once: raw rows are read as they are, and processed rows are left out where a raw one says the same.
    both = materialize(pairs(raw).withColumn("source", F.lit("raw")).unionByName(pairs(processed).withColumn("source", F.lit("processed"))))
    new = both.groupBy(*keep, *entry).agg(F.max("source").alias("source")).where("source = 'processed'")
    return both.where("source = 'raw'").unionByName(new)


def _json(**fields: Column) -> Column:
    """JSON object of the non-NULL fields."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def _column(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def literature_graph(
    tables: dict[str, DataFrame],
    include: Sequence[str] = PARTS,
    limit: int | None = None,
    seq: str | None = None,
    distinct_edges: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``nodes(id, type, label, attributes)``, ``edges(source, target, type, attributes)``, ``counts``.

    The first article per key wins: by ``seq`` if the table has such a column, else by title
    and date. Links are found by any identifier. Dataset edges appear once per fact row unless
    ``distinct_edges`` is set.
    """
    articles = tables["articles"]
    order = F.col(seq) if seq else F.struct(*[F.col(c) for c in ("title", "publication_date", *ARTICLE_IDS)])
    if limit is not None:
        articles = articles.orderBy(order).limit(limit)
    keyed = articles.withColumn("_key", article_key(*[F.col(c) for c in ARTICLE_IDS])).where(F.col("_key").isNotNull())
    wanted = [*ARTICLE_IDS, "title", "publication_date", "article_type", "journal_id"]
    kept = first_by(keyed.select("_key", *wanted, order.alias("_seq")), ["_key"], "_seq").drop("_seq")
    node = F.concat(F.lit("article:"), F.col("_key"))
    ids = kept.select(*ARTICLE_IDS, node.alias("article"))

    nodes = [
        kept.select(
            node.alias("id"), F.lit("article").alias("type"), short_label(F.col("title"), 80).alias("label"),
            _json(doi=F.col("doi"), pmid=F.col("pmid"), pmcid=F.col("pmcid"), title=F.col("title"),
                  publication_date=F.col("publication_date"), article_type=F.col("article_type")).alias("attributes"),
        )
    ]
    edges = []
    found_links, term_tables = [], []

    def add(links: DataFrame, terms: DataFrame, key: str, kind: str, edge: str, label: Column, attributes: Column,
            edge_attributes: Column, to_article: bool = False) -> None:
        """One term table whose terms some articles use."""
        found = links.join(terms.select(key), key, "left_semi")
        found_links.append(found.select("article", F.lit(kind).alias("kind"), F.col(key).cast("string").alias("term"), edge_attributes.alias("attributes")))
        term_tables.append((kind, terms.select(F.col(key).cast("string").alias("term"), label.alias("label"), attributes.alias("attributes")), edge, to_article))

    def linked(link_table: str, columns: Sequence[str]) -> DataFrame:
        found = id_pairs(ids, tables[link_table].select(*ARTICLE_IDS, *columns))
        return found.select(F.col("l_article").alias("article"), *[F.col(f"r_{c}").alias(c) for c in columns])

    empty = F.lit("{}")
    if "journals" in include:
        j = tables["journals"]
        add(kept.select(node.alias("article"), "journal_id").where(F.col("journal_id").isNotNull()), j, "journal_id",
            "journal", "published_in", F.col("name"),
            _json(journal_id=F.col("journal_id"), name=F.col("name"), issn=_column(j, "issn"),
                  iso_abbreviation=_column(j, "iso_abbreviation")), empty)
    if "authors" in include:
        a, links = tables["author_info"], tables["article_authors"]
        if "is_corresponding" not in links.columns:
            links = links.withColumn("is_corresponding", F.lit(False))
            tables = {**tables, "article_authors": links}
        add(linked("article_authors", ["author_id", "author_position", "is_corresponding"]), a, "author_id", "author",
            "authored", author_name(F.col("first_name"), F.col("last_name")),
            _json(author_id=F.col("author_id"), first_name=F.col("first_name"), last_name=F.col("last_name"),
                  orcid=_column(a, "author_orcid"),
                  is_collective=F.coalesce(_column(a, "is_collective", "boolean"), F.lit(False))),
            _json(position=F.col("author_position"),
                  is_corresponding=F.coalesce(F.col("is_corresponding"), F.lit(False))), to_article=True)
    if "keywords" in include:
        add(linked("article_keywords", ["keyword_id"]), tables["keywords"], "keyword_id", "keyword", "has_keyword",
            F.col("keyword"), _json(keyword_id=F.col("keyword_id"), keyword=F.col("keyword")), empty)
    if "mesh_terms" in include and "article_mesh_terms" in tables:
        add(linked("article_mesh_terms", ["mesh_term_id", "is_major_topic"]), tables["mesh_terms"], "mesh_term_id",
            "mesh", "has_mesh_term", F.col("descriptor_name"),
            _json(mesh_term_id=F.col("mesh_term_id"), descriptor_name=F.col("descriptor_name"),
                  descriptor_ui=_column(tables["mesh_terms"], "descriptor_ui")),
            _json(is_major_topic=F.coalesce(F.col("is_major_topic"), F.lit(False))))
    if found_links:
        # The links of all kinds are found by one job and written; nodes, edges and counts only read them.
        index = materialize(reduce(DataFrame.unionByName, found_links))
        for kind, terms, edge, to_article in term_tables:
            of_kind = index.where(F.col("kind") == kind)
            other = F.concat(F.lit(f"{kind}:"), F.col("term"))
            nodes.append(terms.join(of_kind.select("term").distinct(), "term", "left_semi").select(other.alias("id"), F.lit(kind).alias("type"), "label", "attributes"))
            ends = (other, F.col("article")) if to_article else (F.col("article"), other)
            edges.append(of_kind.select(ends[0].alias("source"), ends[1].alias("target"), F.lit(edge).alias("type"), "attributes"))
    if "datasets" in include:
        used = datasets_of_articles(ids, tables["llm_raw_data"], tables["llm_processed_data"], ["article"])
        key = F.concat(F.lit("dataset:"), F.col("dataset_id"))
        one = used.groupBy("dataset_id").agg(F.min(F.struct("repository", "url")).alias("_row"))
        nodes.append(one.select(
            key.alias("id"), F.lit("dataset").alias("type"), F.col("dataset_id").alias("label"),
            _json(dataset_id=F.col("dataset_id"), repository=F.col("_row.repository"), url=F.col("_row.url")).alias("attributes")))
        edge = used.select(F.col("article").alias("source"), key.alias("target"), F.lit("uses_dataset").alias("type"),
                           empty.alias("attributes"))
        edges.append(edge.distinct() if distinct_edges else edge)

    all_nodes = reduce(DataFrame.unionByName, nodes)
    no_edges = all_nodes.select(
        F.col("id").alias("source"), F.col("id").alias("target"), F.col("type"), F.col("attributes")
    ).limit(0)
    all_edges = reduce(DataFrame.unionByName, edges) if edges else no_edges
    return all_nodes, all_edges, graph_counts(all_nodes, all_edges)


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(what, name, n)``: nodes and edges per type."""
    n = nodes.groupBy(F.lit("node").alias("what"), F.col("type").alias("name")).agg(F.count("*").alias("n"))
    e = edges.groupBy(F.lit("edge").alias("what"), F.col("type").alias("name")).agg(F.count("*").alias("n"))
    return n.unionByName(e)


def article_dataset_graph(
    tables: dict[str, DataFrame], orphan_articles: bool = True, orphan_datasets: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges between articles and datasets.

    Links come from the datasets table and from the fact tables; each finds its article by
    doi, else pmid, else pmcid. One edge per pair, the datasets table preferred. An edge may
    point to a dataset that has no row of its own, for which no node is made.
    """
    key = article_key(*[F.col(c) for c in ARTICLE_IDS], typed=True)
    articles = tables["articles"].withColumn("_key", key).where(F.col("_key").isNotNull())
    lookup = articles.select(*ARTICLE_IDS, "_key")
    datasets = tables["datasets"]
    none = F.lit(None).cast("string")
    links = datasets.select(*ARTICLE_IDS, "dataset_id", F.lit(0).alias("_rank"), none.alias("data_repository")).unionByName(
        dataset_links(tables["llm_raw_data"], tables["llm_processed_data"]).withColumn("_rank", F.lit(1))
    )
    found = id_lookup(links, lookup, ["_key"]).where(F.col("_key").isNotNull())
    best = found.groupBy("_key", "dataset_id").agg(F.min(F.struct("_rank", "data_repository")).alias("_best"))
    from_table = F.col("_best._rank") == 0
    edges = best.select(
        F.col("_key").alias("source"), F.concat(F.lit("dataset:"), F.col("dataset_id")).alias("target"),
        F.lit("has_dataset").alias("type"),
        F.when(from_table, _json(source_table=F.lit("datasets")))
        .otherwise(_json(source_table=F.lit("llm_extraction"), data_repository=F.col("_best.data_repository")))
        .alias("attributes"),
    )
    if not orphan_articles:
        articles = articles.join(best.select("_key"), "_key", "left_semi")
    if not orphan_datasets:
        datasets = datasets.join(best.select("dataset_id"), "dataset_id", "left_semi")
    nodes = articles.select(
        F.col("_key").alias("id"), F.lit("article").alias("type"),
        short_label(F.col("title"), 50, 47, F.regexp_replace("_key", "article:", "")).alias("label"),
        _json(**{c: F.col(c) for c in (*ARTICLE_IDS, "title", "publication_date", "journal_id")}).alias("attributes"),
    ).unionByName(datasets.select(
        F.concat(F.lit("dataset:"), F.col("dataset_id")).alias("id"), F.lit("dataset").alias("type"),
        short_label(F.col("title"), 50, 47, F.col("dataset_id")).alias("label"),
        _json(**{c: F.col(c) for c in ("dataset_id", "title", "description", "species", "repository")}).alias("attributes"),
    ))
    return nodes, edges


def _merged(head: Column, attributes: Column) -> Column:
    """JSON object of ``head`` followed by the members of the JSON object ``attributes``."""
    first, rest = F.to_json(head), F.coalesce(attributes, F.lit("{}"))
    return F.when(rest == "{}", first).otherwise(
        F.concat(F.substr(first, F.lit(1), F.char_length(first) - 1), F.lit(","), F.substr(rest, F.lit(2)))
    )


def export_graph(nodes: DataFrame, edges: DataFrame, fmt: str = "standard", path: str | None = None) -> DataFrame:
    """JSON lines ``(part, json)`` in standard, ``cytoscape`` or ``visjs`` form; written to ``path`` if given."""
    a = F.col("attributes")
    if fmt == "standard":
        n = _with_properties(F.struct("id", "type", "label"), a)
        e = _with_properties(F.struct("source", "target", "type"), a)
    elif fmt == "cytoscape":
        n = F.concat(F.lit('{"data":'), _merged(F.struct("id", "label", "type"), a), F.lit("}"))
        e = F.concat(F.lit('{"data":'), _merged(F.struct("source", "target", "type"), a), F.lit("}"))
    elif fmt == "visjs":
        title = F.coalesce(F.nullif(F.get_json_object(a, "$.title"), F.lit("")), F.col("label"))
        # The attribute "title" repeats the tooltip, so it is the one that stays.
        head = F.struct("id", "label", F.col("type").alias("group"), title.alias("title"))
        plain = F.struct("id", "label", F.col("type").alias("group"))
        n = F.when(F.get_json_object(a, "$.title").isNotNull(), _merged(plain, a)).otherwise(_merged(head, a))
        edges = number_in_order(edges, edges.columns, "_no")
        e = _merged(
            F.struct(F.concat(F.lit("edge_"), (F.col("_no") - 1).cast("string")).alias("id"), F.col("source").alias("from"),
                     F.col("target").alias("to"), F.col("type").alias("label"), F.lit("to").alias("arrows")), a)
    else:
        raise ValueError(f"unknown graph format: {fmt}")
    out = nodes.select(F.lit("node").alias("part"), n.alias("json")).unionByName(
        edges.select(F.lit("edge").alias("part"), e.alias("json"))
    )
    if path:
        out.write.partitionBy("part").text(path)
    return out


def _with_properties(head: Column, attributes: Column) -> Column:
    first = F.to_json(head)
    return F.concat(
        F.substr(first, F.lit(1), F.char_length(first) - 1), F.lit(',"properties":'), F.coalesce(attributes, F.lit("{}")), F.lit("}")
    )
