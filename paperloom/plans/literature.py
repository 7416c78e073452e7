"""Queries over articles, links, embeddings and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids, vectors
from ..operators import batch_search, catalog, facts, fidelity, getters, graph, idjoin, search
from .derived import Tables, oracle
from .registry import query

SAME = "(f.doi = a.doi OR f.pmid = a.pmid OR f.pmcid = a.pmcid)"


def first_vector(t: Tables) -> list[float]:
    """The query vector of the search queries: the embedding of vector 0."""
    return list(t["embeddings"].where("vec_id = 0").select("embedding").first()[0])


class SearchTables:
    """The tables a filtered search may ask for; each is built only when it is asked for."""

    NAMES = ("articles", "journals", "author_info", "article_authors", "keywords", "article_keywords", "llm_raw_data",
             "llm_processed_data", "mesh_terms", "article_mesh_terms", "embeddings")

    def __init__(self, t: Tables, **changed):
        self.t, self.changed = t, {"embeddings": lambda: t["article_embeddings"], **changed}

    def __contains__(self, name: str) -> bool:
        return name in self.NAMES

    def __getitem__(self, name: str) -> DataFrame:
        return self.changed[name]() if name in self.changed else self.t[name]


_SCORE = (
    "list_dot_product(CAST(e.embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0))"
)


@query("filtered_search", oracle(
    f"""SELECT e.doi, e.pmid, e.pmcid, a.title, round({_SCORE}, 6) AS score
    FROM article_embeddings e JOIN articles a ON a.doi = e.doi
    WHERE a.language = 'en' AND a.publication_date BETWEEN DATE '2020-01-10' AND DATE '2023-06-30'
      AND a.doi IN (SELECT ak.doi FROM article_keywords ak JOIN keywords k ON k.keyword_id = ak.keyword_id
                    WHERE lower(k.keyword) IN ('small ring', 'red widget', 'large gear') AND ak.doi IS NOT NULL)
    ORDER BY {_SCORE} DESC, e.doi LIMIT 5""", "articles", "article_embeddings", "article_keywords", "keywords"))
def filtered_search(t):
    found = search.search_filtered(
        SearchTables(t), first_vector(t), 5, keywords=["small ring", "Red Widget", "large gear"], language="en",
        date_from="2020-01-10", date_to="2023-06-30",
    )
    return found.withColumn("score", F.round("score", 6))


@query("embedding_search", oracle(
    f"""SELECT e.doi, e.pmid, e.pmcid, e.vec_id, round({_SCORE}, 6) AS score FROM article_embeddings e
    ORDER BY {_SCORE} DESC, e.vec_id LIMIT 20""", "article_embeddings"))
def embedding_search(t):
    return search.search(t["article_embeddings"], first_vector(t), 20, ["vec_id"]).withColumn("score", F.round("score", 6))


_MANY = """SELECT q.vec_id AS query_id, e.vec_id AS id, round(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) DESC, e.vec_id) AS rank
    FROM {0} q JOIN {0} e ON q.vec_id % 100 = 0"""


@query("embedding_search_batch", f"SELECT query_id, id, score, CAST(rank AS INT) AS rank FROM ({_MANY.format('embeddings')}) WHERE rank <= 10")
def embedding_search_batch(t):
    """The ten nearest of all vectors for every vector whose id is divisible by 100."""
    asked = t["embeddings"].where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return batch_search.search_many(t["embeddings"], asked, 10, id_col="vec_id").withColumn("score", F.round("score", 6))


@query("embedding_search_batch_filtered", oracle(
    f"""SELECT query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rank) AS INT) AS rank FROM ({_MANY.format('embeddings')}) s
      WHERE id IN (SELECT e.vec_id FROM article_embeddings e JOIN articles a ON a.doi = e.doi WHERE a.language = 'en' AND a.article_type = 'Review')
      QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rank) <= 5""", "articles", "article_embeddings"))
def embedding_search_batch_filtered(t):
    """The same among the articles that pass a filter."""
    dois = search.filter_articles(SearchTables(t), language="en", article_type="Review")
    rows = t["article_embeddings"].join(dois, "doi", "left_semi")
    asked = t["embeddings"].where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return batch_search.search_many(rows, asked, 5, id_col="vec_id").withColumn("score", F.round("score", 6))


def _filter(name: str, condition: str, views: tuple[str, ...], **filters):
    def build(t):
        # Over all facts every article has a dataset; those of one kind tell articles apart.
        changed = {f: (lambda f=f: t[f].where("data_repository = 'error'")) for f in ("llm_raw_data", "llm_processed_data")}
        return search.filter_articles(SearchTables(t, **changed), **filters)

    query(f"filter_articles_{name}", oracle(
        f"SELECT DISTINCT a.doi FROM articles a WHERE a.doi IS NOT NULL AND {condition}", "articles", *views
    ))(build)


_ERRORS = ("SELECT doi FROM llm_raw_data WHERE doi IS NOT NULL AND data_repository = 'error' "
           "UNION SELECT doi FROM llm_processed_data WHERE doi IS NOT NULL AND data_repository = 'error'")
_LINKED = "SELECT doi FROM llm_raw_data WHERE doi IS NOT NULL UNION SELECT doi FROM llm_processed_data WHERE doi IS NOT NULL"
_QUANTIFIED = "SELECT doi FROM llm_processed_data WHERE doi IS NOT NULL AND data_repository = 'error'"
_filter("keyword", """a.doi IN (SELECT ak.doi FROM article_keywords ak JOIN keywords k ON k.keyword_id = ak.keyword_id
    WHERE lower(k.keyword) IN ('small ring', 'red widget') AND ak.doi IS NOT NULL)""",
        ("article_keywords", "keywords"), keywords=["Small Ring", "red widget"])
_filter("with_dataset", f"a.doi IN ({_ERRORS})", ("llm_raw_data", "llm_processed_data"), has_dataset=True)
_filter("without_dataset", f"a.doi NOT IN ({_ERRORS})", ("llm_raw_data", "llm_processed_data"), has_dataset=False)
_filter("quantified", f"a.doi IN ({_QUANTIFIED})", ("llm_processed_data",), has_quantified_data=True)
_filter("not_quantified", f"a.doi NOT IN ({_QUANTIFIED})", ("llm_processed_data",), has_quantified_data=False)
_filter("author", """a.doi IN (SELECT aa.doi FROM article_authors aa JOIN author_info ai ON ai.author_id = aa.author_id
    WHERE (lower(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) LIKE '%machinery customer#00000001%'
        OR lower(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) LIKE '%customer#000000007%') AND aa.doi IS NOT NULL)""",
        ("article_authors", "author_info"), authors=["MACHINERY Customer#00000001", "customer#000000007"])
_filter("journal_type_date", """a.journal_id IN (SELECT journal_id FROM journals WHERE lower(name) LIKE '%nation_1%')
    AND a.article_type = 'Review' AND a.publication_date >= DATE '2020-02-01' AND a.publication_date <= DATE '2022-06-01'""",
        ("journals",), journal="NATION_1", article_type="Review", date_from="2020-02-01", date_to="2022-06-01")
_filter("mesh_language", """a.language = 'de' AND a.doi IN (SELECT am.doi FROM article_mesh_terms am
    JOIN mesh_terms m ON m.mesh_term_id = am.mesh_term_id
    WHERE (lower(m.descriptor_name) LIKE '%term 1%' OR lower(m.descriptor_name) LIKE '%term 23%') AND am.doi IS NOT NULL)""",
        ("article_mesh_terms", "mesh_terms"), mesh_terms=["TERM 1", "term 23"], language="de")
_filter("none", "1 = 1", ())


@query("most_similar_request", oracle(
    """SELECT true AS found, id AS request_id, agent_name, request_status, round(cos, 6) AS similarity_score FROM (
      SELECT r.*, list_cosine_similarity(CAST(r.embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)) AS cos
      FROM request_vectors r) ORDER BY cos DESC, id LIMIT 1""", "request_vectors"))
def most_similar_request(t):
    best = search.most_similar(t["request_vectors"], first_vector(t), 0.5)
    return best.withColumn("similarity_score", F.round("similarity_score", 6))


@query("oldest_approved_request", oracle(
    """SELECT id, agent_name, request_status, creation_time FROM agent_requests WHERE request_status = 'approved'
    ORDER BY creation_time, id LIMIT 1""", "agent_requests"))
def oldest_approved_request(t):
    return search.oldest_approved(t["agent_requests"]).select("id", "agent_name", "request_status", "creation_time")


@query("decode_embedding", "SELECT vec_id, CAST(round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS DOUBLE) AS total, len(embedding) AS size FROM embeddings")
def decode_embedding(t):
    blobs = t["embeddings"].select("vec_id", vectors.encode_embedding("embedding").alias("blob"))
    decoded = blobs.select("vec_id", vectors.decode_embedding("blob").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return decoded.select("vec_id", F.round(total, 5).alias("total"), F.size("v").cast("bigint").alias("size"))


@query("vector_cosine", """SELECT vec_id, label,
    round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), list_reverse(CAST(embedding AS DOUBLE[]))), 6) AS cosine,
    round(list_dot_product(CAST(embedding AS DOUBLE[]), list_reverse(CAST(embedding AS DOUBLE[]))), 6) AS dot FROM embeddings""")
def vector_cosine(t):
    e, r = F.col("embedding"), F.reverse("embedding")
    return t["embeddings"].select("vec_id", "label", F.round(vectors.cosine(e, r), 6).alias("cosine"), F.round(vectors.dot(e, r), 6).alias("dot"))


# ---- any-identifier joins ----


def _ids(t: Tables, name: str, *more: str) -> DataFrame:
    return t[name].select("doi", "pmid", "pmcid", *more)


@query("id_join_inner", oracle(
    f"SELECT a.row_id, f.id AS fact_id FROM articles a JOIN llm_raw_data f ON {SAME}", "articles", "llm_raw_data"))
def id_join_inner(t):
    pairs = idjoin.id_join(_ids(t, "articles", "row_id"), _ids(t, "llm_raw_data", "id"))
    return pairs.select(F.col("l_row_id").alias("row_id"), F.col("r_id").alias("fact_id"))


_MOVED = """SELECT CASE WHEN vec_id % 4 = 1 THEN doi || 'x' ELSE doi END AS doi, CASE WHEN vec_id % 4 = 1 THEN NULL WHEN vec_id % 4 = 2 THEN CAST(vec_id + 100001 AS STRING) ELSE pmid END AS pmid,
    CASE WHEN vec_id % 4 = 1 THEN NULL ELSE pmcid END AS pmcid, vec_id FROM article_embeddings WHERE embedding IS NOT NULL"""


@query("id_join_left", oracle(
    f"""SELECT f.vec_id, a.row_id FROM ({_MOVED}) f LEFT JOIN articles a ON {SAME}""", "articles", "article_embeddings"))
def id_join_left(t):
    """Vectors whose identifiers are those of an article, of two articles, of none that is stored, or missing."""
    left = t.sql(_MOVED)
    right = _ids(t, "articles", "row_id")
    return idjoin.id_join(left, right, "left").select(F.col("l_vec_id").alias("vec_id"), F.col("r_row_id").alias("row_id"))


@query("id_join_semi", oracle(
    f"SELECT a.row_id FROM articles a WHERE EXISTS (SELECT 1 FROM llm_processed_data f WHERE {SAME} AND f.model = 'm1')",
    "articles", "llm_processed_data"))
def id_join_semi(t):
    facts_ = t["llm_processed_data"].where("model = 'm1'")
    return idjoin.id_join(_ids(t, "articles", "row_id"), facts_, "semi").select("row_id")


@query("id_join_anti", oracle(
    f"SELECT a.row_id FROM articles a WHERE NOT EXISTS (SELECT 1 FROM llm_processed_data f WHERE {SAME} AND f.model = 'm1')",
    "articles", "llm_processed_data"))
def id_join_anti(t):
    facts_ = t["llm_processed_data"].where("model = 'm1'")
    return idjoin.id_join(_ids(t, "articles", "row_id"), facts_, "anti").select("row_id")


_FACTS = ("llm_raw_data", "llm_processed_data", "descriptors")


@query("pending_extraction", oracle(
    "SELECT a.row_id, a.created_at FROM articles a WHERE a.article_filepath IS NOT NULL AND "
    + " AND ".join(f"NOT EXISTS (SELECT 1 FROM {f} f WHERE {SAME} AND f.model = 'm1')" for f in _FACTS), "articles", *_FACTS))
def pending_extraction(t):
    return idjoin.pending_extraction(t["articles"], [t[f] for f in _FACTS], "m1").select("row_id", "created_at")


@query("has_extraction", oracle(
    "SELECT count(*) > 0 AS found FROM llm_raw_data WHERE model = 'm0' AND (doi = '10.1000/12' OR pmcid = 'PMC12')", "llm_raw_data"))
def has_extraction(t):
    return idjoin.has_extraction([t["llm_raw_data"]], "m0", doi="10.1000/12", pmcid="PMC12")


@query("extraction_request_counters", oracle(
    "SELECT count(*) AS n_articles, CAST(sum(CASE WHEN article_filepath IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS skipped_no_fulltext, "
    "CAST(sum(CASE WHEN article_filepath IS NOT NULL AND NOT pending THEN 1 ELSE 0 END) AS BIGINT) AS already_extracted, "
    "CAST(sum(CASE WHEN article_filepath IS NOT NULL AND pending THEN 1 ELSE 0 END) AS BIGINT) AS requested, CAST(0 AS BIGINT) AS failed FROM ("
    "SELECT a.article_filepath, " + " AND ".join(f"NOT EXISTS (SELECT 1 FROM {f} f WHERE {SAME} AND f.model = 'm0')" for f in _FACTS)
    + " AS pending FROM articles a)", "articles", *_FACTS))
def extraction_request_counters(t):
    return facts.extraction_requests(t["articles"], t["texts"], [t[f] for f in _FACTS], "m0")[1]


@query("extraction_requests", oracle(
    "SELECT a.doi, a.pmid, a.pmcid, 'm0' AS model, 'Read this.' || chr(10) || chr(10) || x.text AS prompt "
    "FROM articles a JOIN texts x ON x.path = a.article_filepath WHERE "
    + " AND ".join(f"NOT EXISTS (SELECT 1 FROM {f} f WHERE {SAME} AND f.model = 'm0')" for f in _FACTS), "articles", "texts", *_FACTS))
def extraction_requests(t):
    sections = {"preamble": "Read this."}
    return facts.extraction_requests(t["articles"], t["texts"], [t[f] for f in _FACTS], "m0", sections=sections)[0]


@query("id_lookup", oracle(
    """SELECT d.dataset_id, coalesce(x.row_id, y.row_id, z.row_id) AS row_id,
      CASE WHEN x.row_id IS NOT NULL THEN 'doi' WHEN y.row_id IS NOT NULL THEN 'pmid' WHEN z.row_id IS NOT NULL THEN 'pmcid' END AS matched_by
    FROM datasets d LEFT JOIN articles x ON x.doi = d.doi LEFT JOIN articles y ON y.pmid = d.pmid LEFT JOIN articles z ON z.pmcid = d.pmcid""",
    "datasets", "articles"))
def id_lookup(t):
    return idjoin.id_lookup(t["datasets"], t["articles"], ["row_id"]).select("dataset_id", "row_id", "matched_by")


@query("dimension_join", oracle(
    "SELECT ak.doi, k.keyword FROM article_keywords ak JOIN keywords k ON k.keyword_id = ak.keyword_id", "article_keywords", "keywords"))
def dimension_join(t):
    return t["article_keywords"].join(t["keywords"], "keyword_id").select("doi", "keyword")


# New metadata whose pmid belongs to the next article for every eleventh row.
_NEW = """SELECT doi, CASE WHEN row_id % 11 = 0 THEN CAST(row_id + 100001 AS STRING) ELSE pmid END AS pmid,
  CASE WHEN row_id % 5 = 0 THEN 'PMC9' || CAST(row_id AS STRING) ELSE pmcid END AS pmcid FROM articles"""


@query("id_conflicts", oracle(
    """SELECT n.doi, n.pmid, n.pmcid, i.* FROM hits n CROSS JOIN LATERAL (
      SELECT 'other_article' AS issue, 'doi' AS id_type, n.doi AS seen, n.d_doi AS stored WHERE n.d AND n.r_doi IS DISTINCT FROM n.d_doi
      UNION ALL SELECT 'other_article', 'pmid', n.pmid, n.p_doi WHERE n.p AND n.r_doi IS DISTINCT FROM n.p_doi
      UNION ALL SELECT 'other_article', 'pmcid', n.pmcid, n.c_doi WHERE n.c AND n.r_doi IS DISTINCT FROM n.c_doi
      UNION ALL SELECT 'id_differs', 'doi', n.doi, n.r_doi WHERE n.doi <> n.r_doi
      UNION ALL SELECT 'id_differs', 'pmid', n.pmid, n.r_pmid WHERE n.pmid <> n.r_pmid
      UNION ALL SELECT 'id_differs', 'pmcid', n.pmcid, n.r_pmcid WHERE n.pmcid <> n.r_pmcid) i""",
    "articles", extra=f"""fresh AS ({_NEW}), hits AS (
      SELECT n.*, x.row_id IS NOT NULL AS d, y.row_id IS NOT NULL AS p, z.row_id IS NOT NULL AS c,
        x.doi AS d_doi, y.doi AS p_doi, z.doi AS c_doi,
        CASE WHEN x.row_id IS NOT NULL THEN x.doi WHEN y.row_id IS NOT NULL THEN y.doi ELSE z.doi END AS r_doi,
        CASE WHEN x.row_id IS NOT NULL THEN x.pmid WHEN y.row_id IS NOT NULL THEN y.pmid ELSE z.pmid END AS r_pmid,
        CASE WHEN x.row_id IS NOT NULL THEN x.pmcid WHEN y.row_id IS NOT NULL THEN y.pmcid ELSE z.pmcid END AS r_pmcid
      FROM fresh n LEFT JOIN articles x ON x.doi = n.doi LEFT JOIN articles y ON y.pmid = n.pmid LEFT JOIN articles z ON z.pmcid = n.pmcid)"""))
def id_conflicts(t):
    return idjoin.id_conflicts(t.sql(_NEW), t["articles"])


# ---- set operations and graphs ----


@query("doi_union", oracle(_LINKED, "llm_raw_data", "llm_processed_data"))
def doi_union(t):
    return search.doi_union(t["llm_raw_data"], t["llm_processed_data"])


@query("dataset_links", oracle(
    """SELECT doi, pmid, pmcid, dataset_id, data_repository FROM llm_raw_data WHERE dataset_id IS NOT NULL
    UNION SELECT doi, pmid, pmcid, dataset_id, data_repository FROM llm_processed_data WHERE dataset_id IS NOT NULL""",
    "llm_raw_data", "llm_processed_data"))
def dataset_links(t):
    return graph.dataset_links(t["llm_raw_data"], t["llm_processed_data"])


_USED = f"""SELECT a.row_id, f.dataset_id, f.data_repository AS repository, 'raw' AS source FROM articles a JOIN llm_raw_data f ON {SAME}
    UNION ALL SELECT DISTINCT a.row_id, f.dataset_id, f.data_repository, 'processed' FROM articles a JOIN llm_processed_data f ON {SAME}
    WHERE NOT EXISTS (SELECT 1 FROM llm_raw_data r WHERE (r.doi = a.doi OR r.pmid = a.pmid OR r.pmcid = a.pmcid)
      AND r.dataset_id = f.dataset_id AND r.data_repository = f.data_repository)"""


@query("datasets_of_articles", oracle(_USED, "articles", "llm_raw_data", "llm_processed_data"))
def datasets_of_articles(t):
    used = graph.datasets_of_articles(_ids(t, "articles", "row_id"), t["llm_raw_data"], t["llm_processed_data"], ["row_id"])
    return used.select("row_id", "dataset_id", "repository", "source")


@query("shared_features", oracle(
    "SELECT feature_id FROM matrix_reproduced INTERSECT SELECT feature_id FROM matrix_published", "matrix_reproduced", "matrix_published"))
def shared_features(t):
    return fidelity.shared(t["matrix_reproduced"], t["matrix_published"])


@query("only_features", oracle(
    "SELECT feature_id FROM matrix_reproduced EXCEPT SELECT feature_id FROM matrix_published", "matrix_reproduced", "matrix_published"))
def only_features(t):
    return fidelity.only(t["matrix_reproduced"], t["matrix_published"])


_GRAPH = ("articles", "journals", "author_info", "article_authors", "keywords", "article_keywords", "mesh_terms",
          "article_mesh_terms", "llm_raw_data", "llm_processed_data")
_KEYED = """keyed AS (SELECT a.*, 'article:' || coalesce(doi, pmid, pmcid) AS node FROM articles a WHERE coalesce(doi, pmid, pmcid) IS NOT NULL),
  e_authors AS (SELECT a.node, f.author_id, f.author_position FROM keyed a JOIN article_authors f ON """ + SAME + """),
  e_keywords AS (SELECT a.node, f.keyword_id FROM keyed a JOIN article_keywords f ON """ + SAME + """),
  e_mesh AS (SELECT a.node, f.mesh_term_id, f.is_major_topic FROM keyed a JOIN article_mesh_terms f ON """ + SAME + """),
  used AS (""" + _USED.replace("FROM articles a", "FROM keyed a").replace("a.row_id", "a.node") + """),
  edges AS (
    SELECT node AS source, 'journal:' || CAST(journal_id AS STRING) AS target, 'published_in' AS type, NULL AS position FROM keyed WHERE journal_id IN (SELECT journal_id FROM journals)
    UNION ALL SELECT 'author:' || CAST(author_id AS STRING), node, 'authored', author_position FROM e_authors
    UNION ALL SELECT node, 'keyword:' || CAST(keyword_id AS STRING), 'has_keyword', NULL FROM e_keywords
    UNION ALL SELECT node, 'mesh:' || CAST(mesh_term_id AS STRING), 'has_mesh_term', NULL FROM e_mesh
    UNION ALL SELECT node, 'dataset:' || dataset_id, 'uses_dataset', NULL FROM used),
  nodes AS (
    SELECT node AS id, 'article' AS type, CASE WHEN length(title) > 80 THEN substr(title, 1, 80) || '...' ELSE title END AS label FROM keyed
    UNION ALL SELECT 'journal:' || CAST(journal_id AS STRING), 'journal', name FROM journals WHERE journal_id IN (SELECT journal_id FROM keyed)
    UNION ALL SELECT 'author:' || CAST(author_id AS STRING), 'author', first_name || ' ' || last_name FROM author_info WHERE author_id IN (SELECT author_id FROM e_authors)
    UNION ALL SELECT 'keyword:' || CAST(keyword_id AS STRING), 'keyword', keyword FROM keywords WHERE keyword_id IN (SELECT keyword_id FROM e_keywords)
    UNION ALL SELECT 'mesh:' || CAST(mesh_term_id AS STRING), 'mesh', descriptor_name FROM mesh_terms WHERE mesh_term_id IN (SELECT mesh_term_id FROM e_mesh)
    UNION ALL SELECT DISTINCT 'dataset:' || dataset_id, 'dataset', dataset_id FROM used)"""


def _literature(t):
    return graph.literature_graph(t.many(*_GRAPH), seq="row_id")


@query("literature_graph_nodes", oracle("SELECT id, type, label FROM nodes", *_GRAPH, extra=_KEYED))
def literature_graph_nodes(t):
    return _literature(t)[0].select("id", "type", "label")


@query("literature_graph_edges", oracle("SELECT source, target, type, CAST(position AS INT) AS position FROM edges", *_GRAPH, extra=_KEYED))
def literature_graph_edges(t):
    position = F.get_json_object("attributes", "$.position").cast("int")
    return _literature(t)[1].select("source", "target", "type", position.alias("position"))


@query("literature_graph_counts", oracle(
    """SELECT 'node' AS what, type AS name, count(*) AS n FROM nodes GROUP BY type
    UNION ALL SELECT 'edge', type, count(*) FROM edges GROUP BY type""", *_GRAPH, extra=_KEYED))
def literature_graph_counts(t):
    return _literature(t)[2]


_PAIRS = ("articles", "datasets", "llm_raw_data", "llm_processed_data")
_LINKS = """lookup AS (SELECT a.*, CASE WHEN doi IS NOT NULL THEN 'article:doi:' || doi WHEN pmid IS NOT NULL THEN 'article:pmid:' || pmid
    ELSE 'article:pmcid:' || pmcid END AS node FROM articles a WHERE coalesce(doi, pmid, pmcid) IS NOT NULL),
  links AS (SELECT doi, pmid, pmcid, dataset_id, 0 AS rank, NULL AS data_repository FROM datasets
    UNION ALL SELECT DISTINCT doi, pmid, pmcid, dataset_id, 1, data_repository FROM (
      SELECT doi, pmid, pmcid, dataset_id, data_repository FROM llm_raw_data
      UNION SELECT doi, pmid, pmcid, dataset_id, data_repository FROM llm_processed_data)),
  found AS (SELECT coalesce(x.node, y.node, z.node) AS node, l.* FROM links l LEFT JOIN lookup x ON x.doi = l.doi
    LEFT JOIN lookup y ON y.pmid = l.pmid LEFT JOIN lookup z ON z.pmcid = l.pmcid WHERE coalesce(x.node, y.node, z.node) IS NOT NULL)"""


@query("article_dataset_edges", oracle(
    """SELECT node AS source, 'dataset:' || dataset_id AS target, 'has_dataset' AS type,
      CASE WHEN min(rank) = 0 THEN 'datasets' ELSE 'llm_extraction' END AS source_table FROM found GROUP BY node, dataset_id""",
    *_PAIRS, extra=_LINKS))
def article_dataset_edges(t):
    _, edges = graph.article_dataset_graph(t.many(*_PAIRS))
    return edges.select("source", "target", "type", F.get_json_object("attributes", "$.source_table").alias("source_table"))


@query("article_dataset_nodes", oracle(
    """SELECT node AS id, 'article' AS type, CASE WHEN length(title) > 50 THEN substr(title, 1, 47) || '...' WHEN title = '' OR title IS NULL
        THEN replace(node, 'article:', '') ELSE title END AS label FROM lookup WHERE node IN (SELECT node FROM found)
    UNION ALL SELECT 'dataset:' || dataset_id, 'dataset', CASE WHEN length(title) > 50 THEN substr(title, 1, 47) || '...' ELSE title END
      FROM datasets WHERE dataset_id IN (SELECT dataset_id FROM found)""", *_PAIRS, extra=_LINKS))
def article_dataset_nodes(t):
    nodes, _ = graph.article_dataset_graph(t.many(*_PAIRS), orphan_articles=False, orphan_datasets=False)
    return nodes.select("id", "type", "label")


@query("export_graph_cytoscape", oracle(
    """SELECT 'edge' AS part, '{"data":{"source":"' || node || '","target":"dataset:' || dataset_id || '","type":"has_dataset","source_table":"' ||
      CASE WHEN min(rank) = 0 THEN 'datasets"' ELSE 'llm_extraction","data_repository":"' || min(data_repository) || '"' END || '}}' AS json
    FROM found GROUP BY node, dataset_id""", *_PAIRS, extra=_LINKS))
def export_graph_cytoscape(t):
    return graph.export_graph(*graph.article_dataset_graph(t.many(*_PAIRS)), "cytoscape").where("part = 'edge'")


@query("export_graph_visjs", oracle(
    "SELECT e - 1 AS edge_no FROM (SELECT unnest(generate_series(1, (SELECT count(*) FROM (SELECT DISTINCT node, dataset_id FROM found)))) AS e)",
    *_PAIRS, extra=_LINKS))
def export_graph_visjs(t):
    rows = graph.export_graph(*graph.article_dataset_graph(t.many(*_PAIRS)), "visjs").where("part = 'edge'")
    return rows.select(F.regexp_extract("json", r'"id":"edge_([0-9]+)"', 1).cast("bigint").alias("edge_no"))


# ---- getters ----

_RUNS = """SELECT event_id AS id, 'PXD' || CAST(user_id AS STRING) AS dataset_id, event_type AS tool, event_id % 13 AS created_at FROM events"""


@query("quantification_runs", f"""SELECT * FROM ({_RUNS}) r WHERE dataset_id = 'PXD8' AND tool = 'error'
    ORDER BY created_at DESC, id DESC LIMIT 10""")
def quantification_runs(t):
    return getters.quantification_runs(t.sql(_RUNS), dataset_id="PXD8", tool="error", limit=10)


_ANALYSES = "SELECT event_id AS id, user_id AS quantification_run_id, event_type AS analysis_type, event_id % 13 AS created_at FROM events"


@query("analysis_runs", f"SELECT * FROM ({_ANALYSES}) r WHERE quantification_run_id = 8 AND analysis_type = 'click' ORDER BY created_at DESC, id DESC")
def analysis_runs(t):
    return getters.analysis_runs(t.sql(_ANALYSES), quant_run=8, type="click")


_DEPS = """SELECT CAST(substr(feature_id, 2) AS BIGINT) AS id, CAST(substr(feature_id, 2) AS BIGINT) % 5 AS analysis_run_id, feature_id, log2fc,
    pvalue, padj, coalesce(significant, false) AS significant FROM dep_reproduced"""


@query("dep_results", oracle(
    f"SELECT * FROM ({_DEPS}) r WHERE analysis_run_id = 3 AND significant ORDER BY padj ASC NULLS LAST, id LIMIT 50", "dep_reproduced"))
def dep_results(t):
    return getters.dep_results(t.sql(_DEPS), 3, significant_only=True, limit=50)


_ANNOTATIONS = """SELECT event_id AS id, a.doi, a.pmid, a.pmcid, 'PXD' || CAST(user_id AS STRING) AS dataset_id, event_type AS category,
    'm' || CAST(event_id % 2 AS STRING) AS model, event_id % 13 AS created_at
  FROM (SELECT event_id, user_id, event_type, event_id % {documents} AS row_id FROM events) e JOIN articles a ON a.row_id = e.row_id"""


@query("benchmark_annotations", oracle(
    f"SELECT * FROM ({_ANNOTATIONS}) r WHERE doi = '10.1000/12' AND category = 'click' ORDER BY created_at DESC, id DESC", "articles"))
def benchmark_annotations(t):
    return getters.benchmark_annotations(t.sql(_ANNOTATIONS), doi="10.1000/12", category="click")


@query("benchmark_predictions", oracle(
    f"SELECT * FROM ({_ANNOTATIONS}) r WHERE pmid = '100012' AND model = 'm0' ORDER BY created_at DESC, id DESC", "articles"))
def benchmark_predictions(t):
    return getters.benchmark_predictions(t.sql(_ANNOTATIONS), pmid="100012", model="m0", dataset_id=None)


_SCORES = """SELECT j.doc_id AS id, a.doi, a.pmid, a.pmcid, CASE WHEN score < 0.4 THEN 'exclude' ELSE 'flag' END AS verdict,
    j.doc_id % 13 AS created_at FROM judgements j JOIN articles a ON a.row_id = j.doc_id"""


@query("relevance_scores", oracle(f"SELECT * FROM ({_SCORES}) r WHERE verdict = 'exclude' ORDER BY created_at DESC, id DESC", "judgements", "articles"))
def relevance_scores(t):
    return getters.relevance_scores(t.sql(_SCORES), verdict="exclude")


_CLASSES = """SELECT file_id AS id, 'A' || CAST(file_id % 20 AS STRING) AS archive_path, filename AS file_path,
    CASE file_id % 3 WHEN 0 THEN 'raw_data' WHEN 1 THEN 'summary' ELSE 'unknown' END AS classification FROM file_names"""


@query("supplemental_classes", oracle(f"SELECT * FROM ({_CLASSES}) r WHERE archive_path = 'A7' AND classification = 'summary' ORDER BY file_path", "file_names"))
def supplemental_classes(t):
    return getters.supplemental_classes(t.sql(_CLASSES), archive_path="A7", classification="summary")


@query("has_supplemental_class", oracle(f"SELECT count(*) > 0 AS found FROM ({_CLASSES}) r WHERE archive_path = 'A7'", "file_names"))
def has_supplemental_class(t):
    return getters.has_supplemental_class(t.sql(_CLASSES), "A7")


@query("dataset_by_id", oracle("SELECT * FROM datasets WHERE dataset_id = 'PXD8'", "datasets"))
def dataset_by_id(t):
    return getters.dataset_by_id(t["datasets"], "PXD8")


@query("datasets_of", oracle("SELECT * FROM datasets WHERE doi = '10.1000/9' OR pmid = '100010'", "datasets"))
def datasets_of(t):
    return getters.datasets_of(t["datasets"], doi="10.1000/9", pmid="100010")


@query("dataset_files", oracle("SELECT * FROM file_names WHERE dataset_id = 'D7' ORDER BY filename", "file_names"))
def dataset_files(t):
    return getters.dataset_files(t["file_names"], "D7")


@query("without_dataset_files", oracle("SELECT * FROM file_names WHERE dataset_id <> 'D7'", "file_names"))
def without_dataset_files(t):
    return getters.without_dataset_files(t["file_names"], "D7")


@query("extractions_of", oracle(
    "SELECT * FROM descriptors WHERE (doi = '10.1000/12' OR pmid = '100018') AND model = 'm0' ORDER BY created_at DESC, id DESC", "descriptors"))
def extractions_of(t):
    return getters.extractions_of(t["descriptors"], doi="10.1000/12", pmid="100018", model="m0")


@query("with_fulltext", oracle(
    "SELECT row_id FROM articles WHERE article_filepath IS NOT NULL ORDER BY created_at DESC, doi NULLS FIRST, pmid NULLS FIRST, pmcid NULLS FIRST LIMIT 100", "articles"))
def with_fulltext(t):
    return getters.with_fulltext(t["articles"], 100).select("row_id")


@query("article_by", oracle("SELECT row_id, doi FROM articles WHERE pmcid = 'PMC12'", "articles"))
def article_by(t):
    return getters.article_by(t["articles"], pmcid="PMC12").select("row_id", "doi")


_PROTEOMES = """SELECT 'UP' || CAST(s_suppkey AS STRING) AS proteome_id, CAST(s_suppkey AS BIGINT) AS tax_id,
    CASE WHEN s_suppkey % 3 = 0 THEN 'None' ELSE 'OS' || CAST(s_suppkey AS STRING) END AS oscode, n_name AS species_name,
    CASE WHEN n_regionkey < 2 THEN 'eukaryota' ELSE 'bacteria' END AS superregnum FROM supplier JOIN nation ON n_nationkey = s_nationkey"""


@query("proteomes", f"""SELECT proteome_id, tax_id, nullif(oscode, 'None') AS oscode, species_name, superregnum FROM ({_PROTEOMES}) p
    WHERE superregnum = 'eukaryota' AND species_name ILIKE '%ion_1%'""")
def proteomes(t):
    return getters.proteomes(t.sql(_PROTEOMES), superregnum="eukaryota", species_name="Ion_1")


@query("proteome_url", f"""SELECT proteome_id, 'https://ftp.uniprot.org/pub/databases/uniprot/current_release/knowledgebase/reference_proteomes/' ||
    upper(superregnum[1]) || superregnum[2:] || '/' || proteome_id || '/' || proteome_id || '_' || tax_id || '.fasta.gz' AS url FROM ({_PROTEOMES}) p""")
def proteome_url(t):
    return t.sql(_PROTEOMES).select("proteome_id", ids.proteome_url(F.col("proteome_id"), F.col("tax_id"), F.col("superregnum")).alias("url"))


@query("latest_descriptor", oracle(
    """SELECT doi, pmid, pmcid, id, biological_system, created_at FROM (
      SELECT *, row_number() OVER (PARTITION BY doi, pmid, pmcid ORDER BY created_at DESC, id DESC) AS r FROM descriptors WHERE model = 'm0') d
    WHERE r = 1""", "descriptors"))
def latest_descriptor(t):
    return getters.latest_descriptor(t["descriptors"], "m0").select("doi", "pmid", "pmcid", "id", "biological_system", "created_at")


_ASKED = """SELECT CASE doc_id % 4 WHEN 0 THEN ' 10.1000/' || CAST(doc_id AS STRING) WHEN 1 THEN CAST(doc_id + 100000 AS STRING) || ' '
    WHEN 2 THEN 'pmc' || CAST(doc_id AS STRING) ELSE 'none' || CAST(doc_id AS STRING) END AS identifier FROM documents"""
_SOME_TEXTS = "SELECT path, text FROM texts WHERE path NOT LIKE '%7.txt'"
_FULL = f"""SELECT i.identifier, i.id_type, CASE WHEN a.row_id IS NULL THEN 'not_found' WHEN article_filepath IS NULL THEN 'no_filepath'
      WHEN x.text IS NULL THEN 'file_read_error' ELSE 'found' END AS status, x.text FROM (
      SELECT trim(identifier) AS identifier, CASE WHEN upper(trim(identifier)) SIMILAR TO 'PMC[0-9]+' THEN 'pmcid' WHEN identifier LIKE '%/%' THEN 'doi'
        WHEN trim(identifier) SIMILAR TO '[0-9]+' THEN 'pmid' ELSE 'doi' END AS id_type FROM ({_ASKED}) q) i
    LEFT JOIN articles a ON (i.id_type = 'doi' AND a.doi = i.identifier) OR (i.id_type = 'pmid' AND a.pmid = i.identifier)
      OR (i.id_type = 'pmcid' AND a.pmcid = upper(i.identifier))
    LEFT JOIN ({_SOME_TEXTS}) x ON x.path = a.article_filepath"""


def _full_text(t):
    return catalog.full_text(t.sql(_ASKED), t["articles"], t.sql(_SOME_TEXTS))


@query("full_text", oracle(f"SELECT identifier, id_type, status, CAST(length(text) AS BIGINT) AS n FROM ({_FULL}) r", "articles", "texts"))
def full_text(t):
    return _full_text(t).select("identifier", "id_type", "status", F.char_length("text").cast("bigint").alias("n"))


@query("full_text_counters", oracle(
    f"""SELECT count(*) FILTER (status <> 'not_found') AS found, count(*) FILTER (status = 'not_found') AS not_found,
    count(*) FILTER (status = 'no_filepath') AS no_filepath, count(*) FILTER (status = 'file_read_error') AS file_read_errors FROM ({_FULL}) r""",
    "articles", "texts"))
def full_text_counters(t):
    return catalog.full_text_counters(_full_text(t))
