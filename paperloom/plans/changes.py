"""Queries that build the next state of stored tables: upserts, keys, links, status, ingest, validation."""

from __future__ import annotations

import io
import tarfile
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import facts, ingest, merge, ranking, validate
from ..session import new_folder
from ..sources import articles_xml, listings, matrices, repositories
from .derived import oracle
from .registry import query

# ---- upserts ----

_OLD = "SELECT doi, pmid, pmcid, title, article_filepath FROM articles WHERE row_id % 3 <> 0"
_NEW = """SELECT doi, CASE WHEN row_id % 4 = 0 THEN NULL ELSE pmid || 'n' END AS pmid, pmcid,
    CASE row_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '<i>' || title || '</i> and more' ELSE 'short' END AS title,
    CAST(NULL AS STRING) AS article_filepath, row_id * 2 + 1 AS seq FROM articles
  UNION ALL SELECT doi, NULL, NULL, title || ' and some more', '/new', row_id * 2 + 2 FROM articles WHERE row_id % 2 = 0"""
_MERGED = f"""rows AS (SELECT *, 0 AS seq FROM ({_OLD}) o UNION ALL
    SELECT doi, pmid, pmcid, regexp_replace(title, '<[^>]+>', '', 'g') AS title, article_filepath, seq FROM ({_NEW}) n)"""


@query("upsert_articles", oracle(
    """SELECT doi, arg_max(pmid, seq) FILTER (pmid IS NOT NULL) AS pmid, arg_max(pmcid, seq) FILTER (pmcid IS NOT NULL) AS pmcid,
      arg_max(title, length(title) * 100000000 - seq) FILTER (title IS NOT NULL) AS title,
      arg_max(article_filepath, seq) FILTER (article_filepath IS NOT NULL) AS article_filepath FROM rows WHERE doi IS NOT NULL GROUP BY doi
    UNION ALL SELECT doi, pmid, pmcid, title, article_filepath FROM rows WHERE doi IS NULL""", "articles", extra=_MERGED))
def upsert_articles(t):
    return merge.upsert_articles(t.sql(_OLD), t.sql(_NEW))


_VECTORS_OLD = "SELECT doi, pmid, pmcid, vec_id AS embedding, 'm1' AS model FROM article_embeddings WHERE doi IS NOT NULL AND vec_id % 2 = 0"
_VECTORS_NEW = """SELECT doi, CAST(NULL AS STRING) AS pmid, pmcid, vec_id + 1000 AS embedding, CASE WHEN vec_id % 3 = 0 THEN NULL ELSE 'm2' END AS model, vec_id AS seq
    FROM article_embeddings WHERE doi IS NOT NULL AND vec_id % 5 < 3"""


@query("upsert_embeddings", oracle(
    f"""SELECT coalesce(o.doi, n.doi) AS doi, coalesce(n.pmid, o.pmid) AS pmid, coalesce(n.pmcid, o.pmcid) AS pmcid,
      CASE WHEN n.doi IS NULL THEN o.embedding ELSE n.embedding END AS embedding, CASE WHEN n.doi IS NULL THEN o.model ELSE n.model END AS model
    FROM ({_VECTORS_OLD}) o FULL JOIN ({_VECTORS_NEW}) n ON n.doi = o.doi""", "article_embeddings"))
def upsert_embeddings(t):
    return merge.upsert_embeddings(t.sql(_VECTORS_OLD), t.sql(_VECTORS_NEW))


_DATASETS_NEW = """SELECT 'PXD' || CAST(user_id AS STRING) AS dataset_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'title ' || CAST(event_id AS STRING) END AS title,
    CAST(NULL AS STRING) AS species, event_type AS repository, event_id AS seq FROM events"""


@query("upsert_datasets", oracle(
    f"""SELECT dataset_id, arg_max(title, seq) FILTER (title IS NOT NULL) AS title, arg_max(species, seq) FILTER (species IS NOT NULL) AS species,
      arg_max(repository, seq) FILTER (repository IS NOT NULL) AS repository FROM (
      SELECT dataset_id, title, species, repository, -1 AS seq FROM datasets UNION ALL SELECT * FROM ({_DATASETS_NEW}) n) GROUP BY dataset_id""", "datasets"))
def upsert_datasets(t):
    old = t["datasets"].select("dataset_id", "title", "species", "repository")
    return merge.upsert_datasets(old, t.sql(_DATASETS_NEW))


_CLASSES_OLD = "SELECT 'A' || CAST(p_size AS STRING) AS archive_path, p_name AS file_path, min(p_type) AS classification, 'old' AS justification, min(p_brand) AS doi FROM part GROUP BY 1, 2"
_CLASSES_NEW = "SELECT 'A' || CAST(p_size AS STRING) AS archive_path, p_name AS file_path, p_brand AS classification, CAST(NULL AS STRING) AS justification, CAST(NULL AS STRING) AS doi, p_partkey AS seq FROM part"


@query("upsert_classes", f"""SELECT o.archive_path, o.file_path, coalesce(n.classification, o.classification) AS classification,
    CASE WHEN n.file_path IS NULL THEN o.justification END AS justification, o.doi FROM ({_CLASSES_OLD}) o LEFT JOIN (
    SELECT archive_path, file_path, arg_max(classification, seq) AS classification FROM ({_CLASSES_NEW}) x GROUP BY 1, 2) n
    ON n.archive_path = o.archive_path AND n.file_path = o.file_path""")
def upsert_classes(t):
    return merge.upsert_classes(t.sql(_CLASSES_OLD), t.sql(_CLASSES_NEW))


@query("upsert_dataset_files", oracle(
    "SELECT dataset_id, filename, CASE WHEN file_id % 2 = 0 THEN 'summary' ELSE 'unknown' END AS file_type, size_bytes FROM file_names", "file_names"))
def upsert_dataset_files(t):
    old = t.sql("SELECT dataset_id, filename, 'unknown' AS file_type, size_bytes FROM file_names WHERE file_id % 5 <> 0 OR file_id % 2 = 1")
    new = t.sql("SELECT dataset_id, filename, 'summary' AS file_type, size_bytes, file_id AS seq FROM file_names WHERE file_id % 2 = 0")
    return merge.upsert_dataset_files(old, new)


@query("update_proteome_files", """SELECT s_suppkey AS proteome_id, CASE WHEN s_suppkey % 2 = 0 THEN '/f/' || s_suppkey ELSE 'old' END AS local_filepath,
    CASE WHEN s_suppkey % 2 = 1 THEN 'sum' END AS sha256sum FROM supplier""")
def update_proteome_files(t):
    old = t.sql("SELECT s_suppkey AS proteome_id, 'old' AS local_filepath, 'sum' AS sha256sum FROM supplier")
    new = t.sql("SELECT s_suppkey AS proteome_id, '/f/' || CAST(s_suppkey AS STRING) AS local_filepath, CAST(NULL AS STRING) AS sha256sum, s_suppkey AS seq FROM supplier WHERE s_suppkey % 2 = 0")
    return merge.update_proteome_files(old, new.union(new.withColumn("proteome_id", F.col("proteome_id") + 1000000)))


# ---- keys and links ----

_WORDS = "SELECT p_name || CASE WHEN p_partkey % 3 = 0 THEN ' ' || p_brand ELSE '' END AS keyword, p_partkey AS seq FROM part"


@query("assign_keys", oracle(
    f"""SELECT keyword, keyword_id FROM keywords UNION ALL
    SELECT keyword, (SELECT max(keyword_id) FROM keywords) + row_number() OVER (ORDER BY first_seq) FROM (
      SELECT keyword, min(seq) AS first_seq FROM ({_WORDS}) w WHERE keyword NOT IN (SELECT keyword FROM keywords) GROUP BY keyword)""", "keywords"))
def assign_keys(t):
    return merge.assign_keys(t["keywords"], t.sql(_WORDS), ["keyword"], "keyword_id")[0].select("keyword", "keyword_id")


_GRANTS_OLD = "SELECT s_suppkey + 1 AS grant_id, 'G' || CAST(s_suppkey AS STRING) AS grant_number, 'NIH' AS agency FROM supplier"
_GRANTS_NEW = """SELECT CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'G' || CAST(c_custkey % 400 AS STRING) END AS grant_number,
    CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'NIH' END AS agency, c_custkey AS seq FROM customer"""


@query("resolve_grants", f"""WITH old AS ({_GRANTS_OLD}), fresh AS ({_GRANTS_NEW}),
    keyed AS (SELECT *, CASE WHEN grant_number <> '' AND agency <> '' THEN grant_number || '|' || agency ELSE 'row ' || seq END AS k FROM fresh),
    known AS (SELECT grant_number || '|' || agency AS k, grant_id FROM old),
    opened AS (SELECT k, (SELECT max(grant_id) FROM old) + row_number() OVER (ORDER BY min(seq)) AS grant_id FROM keyed WHERE k NOT IN (SELECT k FROM known) GROUP BY k)
  SELECT seq, coalesce(known.grant_id, opened.grant_id) AS grant_id FROM keyed LEFT JOIN known ON known.k = keyed.k LEFT JOIN opened ON opened.k = keyed.k""")
def resolve_grants(t):
    return merge.resolve_grants(t.sql(_GRANTS_OLD), t.sql(_GRANTS_NEW))[1]


_MESH_OLD = "SELECT p_size AS mesh_term_id, 'Term ' || CAST(p_size AS STRING) AS descriptor_name, CASE WHEN p_size % 2 = 0 THEN 'D' || CAST(p_size AS STRING) END AS descriptor_ui FROM (SELECT DISTINCT p_size FROM part) p"
# Terms 0-99: even sizes are met by UI, odd ones by name, the rest are new with a UI of their own.
_MESH_NEW = "SELECT 'Term ' || CAST(o_custkey % 100 AS STRING) AS descriptor_name, CASE WHEN o_custkey % 2 = 0 OR o_custkey % 100 > 60 THEN 'D' || CAST(o_custkey % 100 AS STRING) END AS descriptor_ui, o_orderkey AS seq FROM orders"


@query("resolve_mesh", f"""WITH old AS ({_MESH_OLD}), fresh AS ({_MESH_NEW}),
    keyed AS (SELECT *, coalesce((SELECT min(mesh_term_id) FROM old WHERE old.descriptor_ui = fresh.descriptor_ui),
      (SELECT min(mesh_term_id) FROM old WHERE old.descriptor_ui IS NULL AND old.descriptor_name = fresh.descriptor_name)) AS known FROM fresh),
    opened AS (SELECT descriptor_name, (SELECT max(mesh_term_id) FROM old) + row_number() OVER (ORDER BY min(seq)) AS id FROM keyed WHERE known IS NULL GROUP BY descriptor_name)
  SELECT seq, coalesce(known, id) AS mesh_term_id FROM keyed LEFT JOIN opened ON opened.descriptor_name = keyed.descriptor_name""")
def resolve_mesh(t):
    return merge.resolve_mesh(t.sql(_MESH_OLD), t.sql(_MESH_NEW))[1]


_PEOPLE_OLD = """SELECT c_custkey + 1 AS author_id, c_name AS last_name, c_mktsegment AS first_name, CAST(NULL AS STRING) AS initials,
    CASE WHEN c_custkey % 2 = 0 THEN 'O' || CAST(c_custkey AS STRING) END AS author_orcid FROM customer WHERE c_custkey % 3 = 0"""
_PEOPLE_NEW = """SELECT c_name AS last_name, c_mktsegment AS first_name, CAST(NULL AS STRING) AS initials,
    CASE WHEN o_orderkey % 4 = 0 THEN 'O' || CAST(c_custkey AS STRING) END AS author_orcid, o_orderkey AS seq FROM orders JOIN customer ON c_custkey = o_custkey"""


@query("resolve_authors", f"""WITH old AS ({_PEOPLE_OLD}), fresh AS ({_PEOPLE_NEW}),
    keyed AS (SELECT f.seq, f.last_name, coalesce(a.author_id, b.author_id) AS known FROM fresh f LEFT JOIN old a ON a.author_orcid = f.author_orcid
      LEFT JOIN old b ON b.last_name = f.last_name AND b.first_name = f.first_name AND (b.author_orcid IS NULL OR f.author_orcid IS NULL)),
    opened AS (SELECT last_name, (SELECT max(author_id) FROM old) + row_number() OVER (ORDER BY min(seq)) AS id FROM keyed WHERE known IS NULL GROUP BY last_name)
  SELECT seq, coalesce(known, id) AS author_id FROM keyed LEFT JOIN opened ON opened.last_name = keyed.last_name""")
def resolve_authors(t):
    return merge.resolve_authors(t.sql(_PEOPLE_OLD), t.sql(_PEOPLE_NEW))[1]


# One name and one ORCID after the other, neither of them consistent: who comes first decides. Rows of a name have its four ORCIDs or none.
_MIXED = """SELECT 'L' || CAST(o_custkey - o_custkey % 4 AS STRING) AS last_name, CAST(NULL AS STRING) AS first_name, CAST(NULL AS STRING) AS initials,
    CASE WHEN o_orderkey % 5 > 1 THEN 'O' || CAST(o_custkey AS STRING) END AS author_orcid, o_orderkey AS seq FROM orders"""


@query("resolve_authors_in_batch", f"""WITH r AS ({_MIXED}),
    b AS (SELECT last_name, min(seq) FILTER (author_orcid IS NULL) AS bare_at, min(seq) AS any_at FROM r GROUP BY last_name),
    -- A name is opened without an ORCID only if nobody of that name came before; from then on it meets everybody new.
    o AS (SELECT last_name, author_orcid, min(seq) AS opened FROM r JOIN b USING (last_name) WHERE author_orcid IS NOT NULL AND (bare_at > any_at OR bare_at IS NULL) GROUP BY ALL),
    a AS (SELECT opened FROM o UNION SELECT any_at FROM b)
  SELECT r.seq, n.author_id FROM r JOIN b USING (last_name) LEFT JOIN o ON o.last_name = r.last_name AND o.author_orcid = r.author_orcid
    JOIN (SELECT opened, row_number() OVER (ORDER BY opened) AS author_id FROM a) n ON n.opened = coalesce(o.opened, b.any_at)""")
def resolve_authors_in_batch(t):
    from .. import schemas

    rows = t.sql(_MIXED)
    return merge.resolve_authors(schemas.empty_table(t.spark, "author_info"), rows)[1]


_LINKS_OLD = "SELECT doi, pmid, pmcid, keyword_id FROM article_keywords WHERE keyword_id % 2 = 0"
# Each article links to a term through several orders, with all its identifiers.
_LINKS_NEW = """SELECT a.doi, a.pmid, a.pmcid, k.keyword_id, o.o_orderkey AS seq
    FROM (SELECT o_orderkey, o_custkey, o_orderkey % {documents} AS row_id FROM orders) o
    JOIN part p ON p.p_partkey = o.o_custkey JOIN keywords k ON k.keyword = p.p_name JOIN articles a ON a.row_id = o.row_id
    WHERE coalesce(a.doi, a.pmid, a.pmcid) IS NOT NULL"""


@query("add_links", oracle(
    f"""SELECT doi, pmid, pmcid, keyword_id FROM ({_LINKS_OLD}) o UNION ALL
    SELECT DISTINCT doi, pmid, pmcid, keyword_id FROM ({_LINKS_NEW}) n WHERE NOT EXISTS (SELECT 1 FROM ({_LINKS_OLD}) o
      WHERE o.keyword_id = n.keyword_id AND (o.doi = n.doi OR o.pmid = n.pmid OR o.pmcid = n.pmcid))""", "articles", "keywords", "article_keywords"))
def add_links(t):
    return merge.add_links(t.sql(_LINKS_OLD), t.sql(_LINKS_NEW), ["keyword_id"])


# Chains of a thousand rows, each of which clashes with the one before it and the one after it: every second one counts.
_CHAINS = """SELECT '10.9/' || CAST(doc_id + 1 - (doc_id + 1) % 2 AS STRING) AS doi, CAST(doc_id - doc_id % 2 AS STRING) AS pmid, CAST(NULL AS STRING) AS pmcid,
    doc_id - doc_id % 1000 AS keyword_id, doc_id AS seq FROM documents"""


@query("add_links_chains", f"SELECT doi, pmid, pmcid, keyword_id FROM ({_CHAINS}) c WHERE seq % 2 = 0")
def add_links_chains(t):
    rows = t.sql(_CHAINS)
    return merge.add_links(rows.drop("seq").limit(0), rows, ["keyword_id"])


@query("add_mesh_links", oracle(
    f"""SELECT doi, pmid, keyword_id FROM ({_LINKS_OLD}) o UNION ALL
    SELECT DISTINCT doi, pmid, keyword_id FROM ({_LINKS_NEW}) n WHERE NOT EXISTS (SELECT 1 FROM ({_LINKS_OLD}) o
      WHERE o.keyword_id = n.keyword_id AND o.doi IS NOT DISTINCT FROM n.doi AND o.pmid IS NOT DISTINCT FROM n.pmid)""", "articles", "keywords", "article_keywords"))
def add_mesh_links(t):
    return merge.add_links(t.sql(_LINKS_OLD), t.sql(_LINKS_NEW), ["keyword_id"], null_safe=["doi", "pmid"]).select("doi", "pmid", "keyword_id")


_DESC_OLD = "SELECT doi, pmid, pmcid, species, model FROM descriptors WHERE id % 2 = 0"
_DESC_NEW = "SELECT doi, pmid, pmcid, 'new ' || CAST(id AS STRING) AS species, model, id AS seq FROM descriptors WHERE id % 2 = 1"


@query("replace_descriptors", oracle(
    """SELECT doi, pmid, pmcid, species, model FROM rows r WHERE NOT EXISTS (SELECT 1 FROM fresh n WHERE n.seq > r.seq AND n.model = r.model AND
      (n.doi = r.doi OR (n.doi IS NULL AND n.pmid = r.pmid) OR (n.doi IS NULL AND n.pmid IS NULL AND n.pmcid = r.pmcid)))""", "descriptors",
    extra=f"fresh AS ({_DESC_NEW}), rows AS (SELECT *, -1 AS seq FROM ({_DESC_OLD}) o UNION ALL SELECT * FROM fresh)"))
def replace_descriptors(t):
    return merge.replace_descriptors(t.sql(_DESC_OLD), t.sql(_DESC_NEW))


# ---- requests, dates, appends ----

_PROPOSALS = """SELECT CASE WHEN id % 13 = 0 THEN id + 1000000000 ELSE id END AS request_id, CASE id % 3 WHEN 0 THEN 'in_progress' WHEN 1 THEN 'implemented' ELSE 'incomplete' END AS new_status,
    CASE WHEN id % 5 = 0 THEN ' ' ELSE ' because ' END AS status_reason FROM agent_requests"""


@query("apply_status", oracle(
    f"""SELECT p.request_id, r.request_status AS previous_status, CASE
      WHEN new_status = 'incomplete' AND trim(status_reason) = '' THEN 'status_reason is required when marking a request as incomplete'
      WHEN r.id IS NULL THEN 'Feature request with ID ' || p.request_id || ' not found'
      WHEN r.request_status = new_status THEN 'Feature request is already marked as ' || new_status
      WHEN NOT (r.request_status = 'approved' OR (r.request_status = 'in_progress' AND new_status <> 'in_progress')) THEN 'Cannot mark request as ' || new_status ||
        ': current status is ''' || r.request_status || ''', but only ' || CASE new_status WHEN 'in_progress' THEN '''approved''' ELSE '''approved'' or ''in_progress''' END ||
        ' requests can be marked as ' || new_status END AS error
    FROM ({_PROPOSALS}) p LEFT JOIN agent_requests r ON r.id = p.request_id""", "agent_requests"))
def apply_status(t):
    return merge.apply_status(t["agent_requests"], t.sql(_PROPOSALS))[0].select("request_id", "previous_status", "error")


@query("apply_status_table", oracle(
    f"""SELECT r.id, CASE WHEN p.request_id IS NOT NULL AND NOT (new_status = 'incomplete' AND trim(status_reason) = '') AND
      (r.request_status = 'approved' OR (r.request_status = 'in_progress' AND new_status <> 'in_progress')) THEN new_status ELSE r.request_status END AS request_status
    FROM agent_requests r LEFT JOIN ({_PROPOSALS}) p ON p.request_id = r.id""", "agent_requests"))
def apply_status_table(t):
    return merge.apply_status(t["agent_requests"], t.sql(_PROPOSALS))[1].select("id", "request_status")


_DATED = "SELECT row_id, doi, pmid, pmcid, CASE WHEN row_id % 3 = 0 THEN publication_date END AS publication_date FROM articles"
_SNAP = """SELECT pmid, CASE WHEN row_id % 4 = 0 THEN NULL ELSE DATE '2010-01-01' + CAST(row_id % 100 AS INT) END AS publication_date,
    CASE WHEN row_id % 8 = 1 THEN 'HTTP 500' END AS error FROM articles WHERE pmid IS NOT NULL AND row_id % 10 <> 7"""
_BACKFILL = f"""joined AS (SELECT a.row_id, a.publication_date, a.pmid IS NOT NULL AND a.publication_date IS NULL AS asked, s.pmid AS s_pmid, s.publication_date AS s_date, s.error
    FROM ({_DATED}) a LEFT JOIN ({_SNAP}) s ON s.pmid = a.pmid)"""


@query("backfill_dates", oracle(
    "SELECT row_id, CASE WHEN asked AND error IS NULL AND s_date IS NOT NULL THEN s_date ELSE publication_date END AS publication_date FROM joined", "articles", extra=_BACKFILL))
def backfill_dates(t):
    return merge.backfill_dates(t.sql(_DATED), t.sql(_SNAP))[0].select("row_id", "publication_date")


@query("backfill_counters", oracle(
    """SELECT count(*) FILTER (asked) AS total_articles, count(*) FILTER (asked AND error IS NULL AND s_date IS NOT NULL) AS updated, CAST(0 AS BIGINT) AS no_pmid,
    count(*) FILTER (asked AND s_pmid IS NOT NULL AND error IS NULL AND s_date IS NULL) AS no_date_found,
    count(*) FILTER (asked AND (s_pmid IS NULL OR error IS NOT NULL)) AS fetch_failed FROM joined""", "articles", extra=_BACKFILL))
def backfill_counters(t):
    return merge.backfill_dates(t.sql(_DATED), t.sql(_SNAP))[1]


# Run rows carry a list column, stored as JSON text.
@query("append_run", """SELECT event_id + 1 AS id, event_type AS tool, CASE WHEN event_id >= 50 THEN '["' || event_type || '","x"]' END AS input_files_json FROM events""")
def append_run(t):
    e = t["events"].select("event_id", F.col("event_type").alias("tool"))
    old = e.where("event_id < 50").select((F.col("event_id") + 1).alias("id"), "tool", F.lit(None).cast("string").alias("input_files_json"))
    new = e.where("event_id >= 50").select("tool", F.array("tool", F.lit("x")).alias("input_files_json"), F.col("event_id").alias("seq"))
    return merge.append_run(old, new, ["input_files_json"])


@query("decode_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def decode_json(t):
    k = F.try_variant_get(merge.decode_json(F.col("props")), "$.k", "bigint")
    return t["events"].select("event_id", k.alias("k"))


# ---- stored facts ----

_FACTS_NEW = """SELECT a.doi, a.pmid, a.pmcid, 'm0' AS model, 'PXD' || CAST(f.user_id AS STRING) AS dataset_id, 'PRIDE' AS data_repository, f.event_id AS seq
    FROM (SELECT event_id, user_id, event_id % {documents} AS row_id FROM events) f JOIN articles a ON a.row_id = f.row_id
    WHERE coalesce(a.doi, a.pmid, a.pmcid) IS NOT NULL"""


@query("store_facts", oracle(
    f"""SELECT doi, pmcid, dataset_id, model FROM llm_raw_data UNION ALL SELECT doi, pmcid, dataset_id, model FROM (
      SELECT DISTINCT doi, pmid, pmcid, dataset_id, model FROM ({_FACTS_NEW}) n WHERE NOT EXISTS (SELECT 1 FROM llm_raw_data o
        WHERE o.dataset_id = n.dataset_id AND o.model = n.model AND (o.doi = n.doi OR o.pmid = n.pmid OR o.pmcid = n.pmcid)))""", "articles", "llm_raw_data"))
def store_facts(t):
    stored = facts.store_facts({"llm_raw_data": t["llm_raw_data"]}, {"raw_data": t.sql(_FACTS_NEW)})
    return stored["llm_raw_data"].select("doi", "pmcid", "dataset_id", "model")


_KINDS_NEW = """SELECT a.doi, a.pmid, a.pmcid, 'm' || CAST(f.event_id % 3 AS STRING) AS model, 'MSV' || CAST(f.user_id AS STRING) AS dataset_id,
      ' ' || f.event_type AS method_name, CASE WHEN f.event_id % 10 = 0 THEN '' ELSE 'repo' || CAST(f.user_id % 50 AS STRING) END AS repository,
      'species ' || CAST(f.event_id AS STRING) AS species, a.row_id, f.event_id AS seq
    FROM (SELECT event_id, user_id, event_type, event_id % {documents} AS row_id FROM events) f JOIN articles a ON a.row_id = f.row_id
    WHERE coalesce(a.doi, a.pmid, a.pmcid) IS NOT NULL"""
_KINDS = {"processed_data": "dataset_id", "analysis_methods": "method_name", "code": "repository", "measurement_descriptor": "species"}


# Facts are stored once an article; of descriptors an article's last one of each model stays.
@query("store_facts_kinds", oracle(" UNION ALL ".join(
    f"SELECT DISTINCT '{kind}' AS kind, doi, pmid, pmcid, model, {c} AS value FROM ({_KINDS_NEW}) n WHERE {c} <> ''" for kind, c in list(_KINDS.items())[:3]
) + f""" UNION ALL SELECT 'measurement_descriptor', doi, pmid, pmcid, model, species FROM ({_KINDS_NEW}) n
    QUALIFY row_number() OVER (PARTITION BY row_id, model ORDER BY seq DESC) = 1""", "articles"))
def store_facts_kinds(t):
    rows = t.sql(_KINDS_NEW)
    parsed = {kind: rows.select("doi", "pmid", "pmcid", "model", c, "seq") for kind, c in _KINDS.items()}
    names = {**{k: v[0] for k, v in facts.FACT_TABLES.items()}, "measurement_descriptor": "llm_measurement_descriptors"}
    stored = facts.store_facts({names[k]: p.drop("seq").limit(0) for k, p in parsed.items()}, parsed)
    out = None
    for kind, c in _KINDS.items():
        part = stored[names[kind]].select(F.lit(kind).alias("kind"), "doi", "pmid", "pmcid", "model", F.col(c).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


_WORDS_NEW = """SELECT a.doi, a.pmid, a.pmcid, 'm' || CAST(a.row_id % 2 AS STRING) AS model, ' ' || p.p_name || ' ' AS keyword, p.p_partkey AS seq
    FROM (SELECT p_partkey, p_name, p_partkey % {documents} AS row_id FROM part) p JOIN articles a ON a.row_id = p.row_id WHERE coalesce(a.doi, a.pmid, a.pmcid) IS NOT NULL"""


@query("store_keywords", oracle(
    f"SELECT doi, pmid, pmcid, trim(keyword) AS keyword, model FROM ({_WORDS_NEW}) w GROUP BY ALL", "articles"))
def store_keywords(t):
    words = t.sql("SELECT 0 AS llm_keyword_id, 'none' AS keyword, 'none' AS model FROM nation WHERE n_nationkey < 0")
    links = t.sql("SELECT '' AS doi, '' AS pmid, '' AS pmcid, 0 AS llm_keyword_id FROM nation WHERE n_nationkey < 0")
    stored = facts.store_facts({"llm_keywords": words, "article_llm_keywords": links}, {"keywords": t.sql(_WORDS_NEW)})
    return stored["article_llm_keywords"].join(stored["llm_keywords"], "llm_keyword_id").select("doi", "pmid", "pmcid", "keyword", "model")


# ---- article XML ----

_XML_ARTICLES = """SELECT row_id, doi, CAST(row_id + 100000 AS STRING) AS pmid, pmcid, replace(replace(replace(title, '&', ' '), '<', ' '), '>', ' ') AS title,
    replace(replace(replace(abstract, '&', ' '), '<', ' '), '>', ' ') AS abstract, publication_date, journal_id, language FROM articles"""
_AUTHORED = """SELECT o_orderkey % {documents} AS row_id, o_custkey, o_orderkey FROM orders"""


def pubmed_xml(t):
    """PubMed documents built from the derived articles, with up to a few authors and terms each."""
    c, lit = F.col, F.lit

    def tag(name, body, attributes=""):
        return F.concat(lit(f"<{name}{attributes}>"), body, lit(f"</{name}>"))

    a = t.sql(_XML_ARTICLES)
    people = t.sql(_AUTHORED).groupBy("row_id").agg(F.array_sort(F.collect_set("o_custkey")).alias("people"))
    rows = a.join(people, "row_id", "left")
    author = F.transform(F.coalesce("people", F.array().cast("array<bigint>")), lambda p: tag("Author", F.concat(
        tag("LastName", F.concat(lit("L"), (p % 400).cast("string"))), tag("ForeName", lit("F")), tag("Initials", lit("F")),
        F.when(p % 2 == 0, tag("Identifier", F.concat(lit("https://orcid.org/"), (p % 400).cast("string")), ' Source="ORCID"')).otherwise(lit("")),
        tag("AffiliationInfo", tag("Affiliation", F.concat(lit("Institute "), (p % 50).cast("string"))))), ' ValidYN="Y"'))
    article_id = F.concat(
        F.when(c("doi").isNotNull(), tag("ArticleId", c("doi"), ' IdType="doi"')).otherwise(lit("")),
        F.when(c("pmcid").isNotNull(), tag("ArticleId", c("pmcid"), ' IdType="pmc"')).otherwise(lit("")))
    title = F.concat(F.substring("title", 1, 20), lit("<i>"), F.substring("title", 21, 20), lit("</i>"), F.expr("substr(title, 41)"))
    xml = tag("PubmedArticleSet", tag("PubmedArticle", F.concat(
        tag("MedlineCitation", F.concat(
            tag("PMID", c("pmid")), tag("Article", F.concat(
                tag("Journal", F.concat(
                    tag("ISSN", lit("1234"), ' IssnType="Print"'),
                    tag("JournalIssue", F.concat(tag("Volume", lit("7")), tag("PubDate", F.concat(
                        tag("Year", F.year("publication_date").cast("string")), tag("Month", F.date_format("publication_date", "MMM")),
                        tag("Day", F.dayofmonth("publication_date").cast("string")))))),
                    tag("Title", F.concat(lit("Journal "), c("journal_id").cast("string"))))),
                tag("ArticleTitle", title),
                F.when(c("row_id") % 13 != 5, tag("Abstract", tag("AbstractText", c("abstract"), ' Label="AIM"'))).otherwise(lit("")),
                tag("AuthorList", F.array_join(author, "")), tag("Language", c("language")))),
            tag("MeshHeadingList", tag("MeshHeading", F.concat(
                F.concat(lit('<DescriptorName UI="D'), (c("row_id") % 40).cast("string"), lit('" MajorTopicYN="Y">Term '), (c("row_id") % 40).cast("string"), lit("</DescriptorName>")),
                tag("QualifierName", F.concat(lit("q"), (c("row_id") % 3).cast("string")))))),
            tag("KeywordList", F.concat(tag("Keyword", F.concat(lit("kw"), (c("row_id") % 30).cast("string"))), tag("Keyword", lit("common")))))),
        tag("PubmedData", tag("ArticleIdList", article_id)))))
    return rows.select(c("row_id").alias("seq"), F.when(c("row_id") % 50 == 49, lit("<broken")).otherwise(xml).alias("xml"))


_OK = "row_id % 50 <> 49"


@query("pubmed_articles", oracle(
    f"""SELECT row_id AS seq, doi, pmid, pmcid, trim(trim(substr(title, 1, 20) || trim(substr(title, 21, 20), ' ' || chr(10)) || substr(title, 41)), ' ' || chr(10)) AS title,
      CASE WHEN row_id % 13 <> 5 THEN 'AIM: ' || trim(abstract, ' ' || chr(10)) END AS abstract, publication_date, 'Journal ' || journal_id AS journal_name, language
    FROM ({_XML_ARTICLES}) a WHERE {_OK}""", "articles"))
def pubmed_articles(t):
    a = articles_xml.pubmed_tables(pubmed_xml(t), "xml", partitions=t.partitions)["articles"]
    return a.select("seq", "doi", "pmid", "pmcid", "title", "abstract", "publication_date", "journal_name", "language")


@query("pubmed_authors", oracle(
    f"""SELECT row_id AS seq, CAST(row_number() OVER (PARTITION BY row_id ORDER BY o_custkey) AS INT) AS author_position, 'L' || o_custkey % 400 AS last_name,
      CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey % 400 AS STRING) END AS author_orcid FROM (SELECT DISTINCT row_id, o_custkey FROM ({_AUTHORED}) o)
    WHERE {_OK}"""))
def pubmed_authors(t):
    return articles_xml.pubmed_tables(pubmed_xml(t), "xml", partitions=t.partitions)["authors"].select("seq", "author_position", "last_name", "author_orcid")


@query("pubmed_terms", oracle(
    f"""SELECT row_id AS seq, 'mesh' AS kind, 'Term ' || row_id % 40 AS name FROM articles WHERE {_OK} UNION ALL SELECT row_id, 'qualifier', 'q' || row_id % 3 FROM articles WHERE {_OK}
    UNION ALL SELECT row_id, 'keyword', 'kw' || row_id % 30 FROM articles WHERE {_OK} UNION ALL SELECT row_id, 'keyword', 'common' FROM articles WHERE {_OK}""", "articles"))
def pubmed_terms(t):
    p = articles_xml.pubmed_tables(pubmed_xml(t), "xml", partitions=t.partitions)
    return (
        p["mesh_terms"].select("seq", F.lit("mesh").alias("kind"), F.col("descriptor_name").alias("name"))
        .unionByName(p["mesh_qualifiers"].select("seq", F.lit("qualifier").alias("kind"), F.col("qualifier_name").alias("name")))
        .unionByName(p["keywords"].select("seq", F.lit("keyword").alias("kind"), F.col("keyword").alias("name")))
    )


@query("pubmed_snapshot", oracle(
    f"SELECT row_id AS seq, pmid, doi, pmcid, publication_date FROM ({_XML_ARTICLES}) a WHERE {_OK}", "articles"))
def pubmed_snapshot(t):
    s = articles_xml.pubmed_snapshot(pubmed_xml(t), "xml", partitions=t.partitions).where("error IS NULL")
    return s.select("seq", "pmid", "doi", "pmcid", "publication_date")


def _stored(t):
    """A store that already holds every fourth article."""
    from .. import schemas

    names = ("journals", "articles", "author_info", "affiliations", "author_affiliations", "article_authors", "keywords", "article_keywords",
             "grants", "article_grants", "mesh_terms", "mesh_qualifiers", "article_mesh_terms", "article_mesh_qualifiers")
    tables = {n: schemas.empty_table(t.spark, n) for n in names}
    known = t.sql("SELECT doi, CAST(row_id + 100000 AS STRING) AS pmid, pmcid, 'old' AS title FROM articles WHERE row_id % 4 = 0")
    tables["articles"] = tables["articles"].unionByName(known, allowMissingColumns=True)
    return tables


_STATUS = """SELECT row_id AS seq, CASE WHEN row_id % 50 = 49 THEN 'failed' WHEN row_id % 4 = 0 THEN 'already_processed' WHEN row_id % 13 = 5 THEN 'skipped_no_abstract'
    ELSE 'newly_processed' END AS status FROM articles"""


@query("ingest_status", oracle(_STATUS, "articles"))
def ingest_status(t):
    records = articles_xml.pubmed_records(pubmed_xml(t), "xml", partitions=t.partitions)
    return ingest.article_status(records, _stored(t)["articles"])


@query("ingest_counters", oracle(
    f"""SELECT count(*) AS total_found, count(*) FILTER (status = 'already_processed') AS already_processed, count(*) FILTER (status = 'newly_processed') AS newly_processed,
    count(*) FILTER (status = 'overwritten') AS overwritten, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped_no_abstract') AS skipped_no_abstract
    FROM ({_STATUS}) s""", "articles"))
def ingest_counters(t):
    records = articles_xml.pubmed_records(pubmed_xml(t), "xml", partitions=t.partitions)
    return ingest.ingest_counters(ingest.article_status(records, _stored(t)["articles"]))


_ACCEPTED = f"SELECT a.row_id, coalesce(a.doi, 'pmid:' || CAST(a.row_id + 100000 AS STRING)) AS doi, a.journal_id FROM articles a JOIN ({_STATUS}) s ON s.seq = a.row_id WHERE s.status = 'newly_processed'"


@query("ingest_articles", oracle(
    f"""SELECT 'articles' AS name, count(*) AS n FROM (SELECT doi FROM ({_ACCEPTED}) a UNION ALL SELECT doi FROM articles WHERE row_id % 4 = 0)
    UNION ALL SELECT 'journals', count(DISTINCT journal_id) FROM ({_ACCEPTED}) a
    UNION ALL SELECT 'keywords', 1 + count(DISTINCT row_id % 30) FROM ({_ACCEPTED}) a
    UNION ALL SELECT 'article_keywords', 2 * count(*) FROM ({_ACCEPTED}) a
    UNION ALL SELECT 'mesh_terms', count(DISTINCT row_id % 40) FROM ({_ACCEPTED}) a
    UNION ALL SELECT 'article_mesh_terms', count(*) FROM ({_ACCEPTED}) a
    UNION ALL SELECT 'article_mesh_qualifiers', count(*) FROM ({_ACCEPTED}) a
    UNION ALL SELECT 'article_authors', count(*) FROM (SELECT DISTINCT o.row_id, o.o_custkey % 400 FROM ({_AUTHORED}) o JOIN ({_ACCEPTED}) a ON a.row_id = o.row_id)
    UNION ALL SELECT 'author_info', count(DISTINCT o.o_custkey % 400) FROM ({_AUTHORED}) o JOIN ({_ACCEPTED}) a ON a.row_id = o.row_id
    UNION ALL SELECT 'author_affiliations', count(*) FROM (SELECT DISTINCT o.o_custkey % 400, o.o_custkey % 50 FROM ({_AUTHORED}) o JOIN ({_ACCEPTED}) a ON a.row_id = o.row_id)""", "articles"))
def ingest_articles(t):
    out, _ = ingest.ingest_articles(_stored(t), pubmed_xml(t), partitions=t.partitions)
    counted = None
    for name in ("articles", "journals", "keywords", "article_keywords", "mesh_terms", "article_mesh_terms", "article_mesh_qualifiers", "article_authors",
                 "author_info", "author_affiliations"):
        row = out[name].agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        counted = row if counted is None else counted.unionByName(row)
    return counted


# Seven articles with more than a thousand authors each, numbered beyond 2^28; some people appear several times in one of them.
_CROWDS = """SELECT o_orderkey % 7 AS k, o_orderkey, 'L' || CAST(o_custkey AS STRING) AS last_name FROM orders"""


@query("ingest_many_authors", f"""WITH a AS (SELECT k, k * 268435456 + 268435457 AS seq, last_name, row_number() OVER (PARTITION BY k ORDER BY o_orderkey) AS author_position FROM ({_CROWDS}) c),
    n AS (SELECT last_name, row_number() OVER (ORDER BY min(seq * 1000000 + author_position)) AS author_id FROM a GROUP BY last_name)
    SELECT CAST(seq AS STRING) AS pmid, last_name, author_id, CAST(min(author_position) AS INT) AS author_position FROM a JOIN n USING (last_name) GROUP BY ALL""")
def ingest_many_authors(t):
    from .. import schemas

    lit, seq = F.lit, F.col("k") * 268435456 + 268435457
    # A document comes in parts of 64 authors and less: its row would hold all of them.
    people = ranking.key_in_order(t.sql(_CROWDS).select(seq.alias("seq"), "o_orderkey", "last_name"), ["seq", "o_orderkey", "last_name"], "no")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("no", "last_name"))), lambda p: F.concat(
        lit("<Author><LastName>"), p["last_name"], lit("</LastName><ForeName>F</ForeName></Author>")))
    inner = people.groupBy("seq", F.shiftright("no", 6).alias("part")).agg(F.array_join(listed, "").alias("xml"))
    head = F.concat(
        lit("<PubmedArticle><MedlineCitation><PMID>"), F.col("seq").cast("string"), lit("</PMID><Article><Journal><Title>J</Title></Journal><ArticleTitle>T</ArticleTitle>"),
        lit("<Abstract><AbstractText>A</AbstractText></Abstract><AuthorList>"))
    tail = lit("</AuthorList></Article></MedlineCitation></PubmedArticle>")
    ends = F.explode(F.array(F.struct(lit(-1).cast("bigint").alias("part"), head.alias("xml")), F.struct(lit((1 << 63) - 1).alias("part"), tail.alias("xml"))))
    parts = people.select("seq").distinct().select("seq", ends.alias("e")).select("seq", "e.*").unionByName(inner)
    names = ("journals", "articles", "author_info", "affiliations", "author_affiliations", "article_authors", "keywords", "article_keywords", "grants", "article_grants",
             "mesh_terms", "mesh_qualifiers", "article_mesh_terms", "article_mesh_qualifiers")
    out, _ = ingest.ingest_articles({n: schemas.empty_table(t.spark, n) for n in names}, parts, part_col="part")
    return out["article_authors"].join(out["author_info"].select("author_id", "last_name"), "author_id").select("pmid", "last_name", "author_id", "author_position")


_JATS = """SELECT doc_id, trim(replace(replace(replace(replace(split_part(text, chr(10), 1), '&', ' '), '<', ' '), '>', ' '), chr(10), ' ')) AS head,
    trim(replace(replace(replace(replace(text, '&', ' '), '<', ' '), '>', ' '), chr(10), ' ')) AS body FROM documents"""


@query("jats_text", f"""SELECT doc_id, md5(CASE doc_id % 3 WHEN 2 THEN '<article><body>' || body ELSE
    'TITLE: ' || head || chr(10) || chr(10) || CASE doc_id % 3 WHEN 0 THEN chr(10) || 'METHODS' || chr(10) || chr(10) || body || chr(10) || chr(10) || chr(10) || 'DATA AVAILABILITY'
      || chr(10) || chr(10) || 'PXD' || doc_id || chr(10) || chr(10) || chr(10) || 'REFERENCES: 2 references' ELSE body END END) AS digest FROM ({_JATS}) j""")
def jats_text(t):
    c, lit = F.col, F.lit
    n = c("doc_id") % 3
    front = F.concat(lit("<article><front><article-title>"), c("head"), lit("</article-title></front>"))
    sectioned = F.concat(front, lit("<body><sec><title>Methods</title><p>"), c("body"), lit('</p></sec></body><back><notes notes-type="data-availability"><p>PXD'),
                         c("doc_id").cast("string"), lit("</p></notes><ref-list><ref/><ref/></ref-list></back></article>"))
    plain = F.concat(front, lit("<body><p>"), c("body"), lit("</p></body></article>"))
    xml = F.when(n == 0, sectioned).when(n == 1, plain).otherwise(F.concat(lit("<article><body>"), c("body")))
    parsed = articles_xml.jats_text(t.sql(_JATS).select("doc_id", xml.alias("xml")), "xml", partitions=t.partitions)
    return parsed.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


# ---- archives ----


def _archives(t):
    """A zip, tar.gz or broken archive per document, with its text and its language as members."""

    @F.pandas_udf(T.BinaryType())
    def pack(ids: pd.Series, texts: pd.Series, langs: pd.Series) -> pd.Series:
        def one(i, text, lang):
            out, members = io.BytesIO(), (("in/text.txt", (text or "").encode()), ("lang", (lang or "").encode()))
            if i % 3 == 0:
                with zipfile.ZipFile(out, "w") as z:
                    z.writestr("in/", "")
                    for name, body in members:
                        z.writestr(name, body)
            elif i % 3 == 1:
                with tarfile.open(fileobj=out, mode="w:gz") as a:
                    for name, body in members:
                        info = tarfile.TarInfo(name)
                        info.size = len(body)
                        a.addfile(info, io.BytesIO(body))
            return out.getvalue()

        return pd.Series([one(*row) for row in zip(ids, texts, langs)])

    ending = F.when(F.col("doc_id") % 3 == 1, ".tar.gz").otherwise(".zip")
    docs = t["documents"].repartition(t.partitions)
    return docs.select(F.concat(F.lit("/a/"), "doc_id", ending).alias("path"), pack("doc_id", "text", "lang").alias("content"))


@query("archive_contents", """SELECT '/a/' || doc_id || CASE WHEN doc_id % 3 = 1 THEN '.tar.gz' ELSE '.zip' END AS archive_path,
    count(*) FILTER (doc_id % 3 <> 2) * 2 AS total_files,
    CAST(coalesce(sum(octet_length(encode(coalesce(text, ''))) + octet_length(encode(coalesce(lang, '')))) FILTER (doc_id % 3 <> 2), 0) AS BIGINT) AS total_size,
    doc_id % 3 = 2 AS broken FROM documents GROUP BY doc_id""")
def archive_contents(t):
    contents = listings.archive_contents(listings.archive_members(_archives(t)))
    return contents.select("archive_path", "total_files", "total_size", F.col("error").isNotNull().alias("broken"))


# ---- repositories ----


@query("pride_projects", """SELECT 'PXD' || o_orderkey AS dataset_id, 'Project ' || o_orderkey AS title, 'd' || o_custkey AS description, 'Homo sapiens|mouse' AS species,
    'Orbitrap' AS instruments, CAST(o_orderdate AS DATE) AS submission_date, CASE WHEN o_orderkey % 2 = 0 THEN '10.1/' || o_custkey END AS doi, CAST(o_custkey AS STRING) AS pmid FROM orders""")
def pride_projects(t):
    o = t["orders"]
    s = F.struct
    j = F.to_json(s(
        F.concat(F.lit("Project "), "o_orderkey").alias("title"), F.lit("").alias("projectDescription"), F.concat(F.lit("d"), "o_custkey").alias("description"),
        F.array(s(F.lit(None).cast("string").alias("name"), F.lit("Orbitrap").alias("cvLabel"))).alias("instruments"),
        F.to_date("o_orderdate").cast("string").alias("submissionDate"),
        F.array(s(F.lit(None).cast("bigint").alias("pubmedId"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("10.1/"), "o_custkey")).alias("doi")),
                s(F.col("o_custkey").alias("pubmedId"), F.lit(None).cast("string").alias("doi"))).alias("references")))
    organisms = '"organisms":[{"name":"Homo sapiens"},"mouse"],'
    j = F.concat(F.lit("{" + organisms), F.substr(j, F.lit(2)))
    p = repositories.pride_projects(o.select(F.concat(F.lit("PXD"), "o_orderkey").alias("dataset_id"), j.alias("json")), "json", partitions=t.partitions)
    return p.select("dataset_id", "title", "description", F.array_join("species", "|").alias("species"), F.array_join("instruments", "|").alias("instruments"),
                    "submission_date", "doi", "pmid")


_PROXI = """SELECT 'MSV' || CAST(c_custkey AS STRING) AS dataset_id, '{"title":"' || c_name || '","summary":"s","species":[[{"name":"taxonomy: scientific name","value":"Homo sapiens"},' ||
    '{"name":"taxonomy: common name","value":"human"}],[{"name":"taxonomy: scientific name","value":"Homo sapiens"}],"' || c_mktsegment || '"],"instruments":[{"accession":"MS:1"},"x"],' ||
    '"identifiers":[{"accession":"MSV1"},{"accession":"PXD' || CAST(c_custkey AS STRING) || '"}],"publications":[{"pmid":' || CAST(c_nationkey AS STRING) || '},{"doi":"10.1/x"}],"submissionDate":"2020-01-02T03:04"}' AS json FROM customer"""


@query("proxi_datasets", """SELECT 'MSV' || c_custkey AS dataset_id, c_name AS title, 'Homo sapiens|' || c_mktsegment AS species, 'MS:1' AS instruments, DATE '2020-01-02' AS submission_date,
    '10.1/x' AS doi, CAST(c_nationkey AS STRING) AS pmid, 'PXD' || c_custkey AS pxd_id FROM customer""")
def proxi_datasets(t):
    p = repositories.proxi_datasets(t.sql(_PROXI), "json", partitions=t.partitions)
    return p.select("dataset_id", "title", F.array_join("species", "|").alias("species"), F.array_join("instruments", "|").alias("instruments"), "submission_date", "doi", "pmid", "pxd_id")


_GEO = """SELECT 'GSE' || CAST(c_custkey AS STRING) AS dataset_id, '{"title":"' || c_name || '","summary":"s","gpl":"570","n_samples":' || CAST(c_nationkey AS STRING) ||
    ',"taxon":' || CASE WHEN c_custkey % 2 = 0 THEN '"Homo sapiens"' ELSE '["Mus musculus","rat"]' END || ',"pdat":"2021/03/04"}' AS json, c_custkey AS seq FROM customer"""


@query("geo_series", """SELECT 'GSE' || c_custkey AS dataset_id, c_name AS title, '570' AS platform, CAST(c_nationkey AS BIGINT) AS n_samples,
    CASE WHEN c_custkey % 2 = 0 THEN 'Homo sapiens' ELSE 'Mus musculus|rat' END AS species, DATE '2021-03-04' AS publication_date FROM customer""")
def geo_series(t):
    g = repositories.geo_series(t.sql(_GEO), "json", partitions=t.partitions)
    return g.select("dataset_id", "title", "platform", "n_samples", F.array_join("species", "|").alias("species"), "publication_date")


_FILE_JSON = """SELECT CAST(p_partkey AS STRING) AS dataset_id, CASE p_partkey % 2 WHEN 0 THEN '{"_embedded":{"files":[' ELSE '[' END || '{"fileName":"' || p_name || '","fileCategory":"RAW","fileSizeBytes":' ||
    CAST(p_size AS STRING) || '},{"fileName":"b"}]' || CASE p_partkey % 2 WHEN 0 THEN '}}' ELSE '' END AS json FROM part"""
_IPROX_JSON = """SELECT CAST(p_partkey AS STRING) AS dataset_id, '{"data":[{"files":[{"fileName":"' || p_name || '"},{"fileName":"c"}]},{"downloadUrl":"u"},{"other":1}]}' AS json FROM part"""


@query("repo_file_list", """SELECT CAST(p_partkey AS STRING) AS dataset_id, CAST(0 AS INT) AS file_no, p_name AS filename, 'RAW' AS file_type, CAST(p_size AS BIGINT) AS size_bytes FROM part
    UNION ALL SELECT CAST(p_partkey AS STRING), 1, 'b', NULL, 0 FROM part UNION ALL SELECT 'i' || p_partkey, 0, p_name, NULL, 0 FROM part
    UNION ALL SELECT 'i' || p_partkey, 1, 'c', NULL, 0 FROM part UNION ALL SELECT 'i' || p_partkey, 2, '', NULL, 0 FROM part""")
def repo_file_list(t):
    pride = repositories.repo_file_list(t.sql(_FILE_JSON), "json", "pride")
    iprox = repositories.repo_file_list(t.sql(_IPROX_JSON), "json", "iprox").withColumn("dataset_id", F.concat(F.lit("i"), "dataset_id"))
    return pride.unionByName(iprox).select("dataset_id", "file_no", "filename", "file_type", "size_bytes")


_SOFT = """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '!Series_sample_id = GSM' || CAST(o_custkey AS STRING) WHEN 1 THEN '!Series_sample_id = none' ELSE '!Series_title = GSM1' END AS value FROM orders"""


@query("soft_sample_ids", "SELECT o_orderkey, 'GSM' || o_custkey AS sample_id FROM orders WHERE o_orderkey % 3 = 0")
def soft_sample_ids(t):
    return repositories.soft_sample_ids(t.sql(_SOFT))


_RECORDS = f"SELECT dataset_id, json, seq FROM ({_GEO}) g"


@query("ingest_datasets", """SELECT 'GSE' || c_custkey AS dataset_id, CASE WHEN c_custkey % 3 = 0 THEN 'kept' ELSE c_name END AS title,
    CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Homo sapiens' ELSE 'Mus musculus, rat' END AS species, 'GEO' AS repository FROM customer""")
def ingest_datasets(t):
    from .. import schemas

    known = t.sql("SELECT 'GSE' || CAST(c_custkey AS STRING) AS dataset_id, 'kept' AS title, 'GEO' AS repository FROM customer WHERE c_custkey % 3 = 0")
    old = schemas.empty_table(t.spark, "datasets").unionByName(known, allowMissingColumns=True)
    return ingest.ingest_datasets(old, repositories.geo_series(t.sql(_RECORDS), "json"))[0].select("dataset_id", "title", "species", "repository")


@query("ingest_datasets_status", "SELECT 'GSE' || c_custkey AS dataset_id, CASE WHEN c_custkey % 3 = 0 THEN 'already_exists' ELSE 'ingested' END AS status FROM customer")
def ingest_datasets_status(t):
    from .. import schemas

    known = t.sql("SELECT 'GSE' || CAST(c_custkey AS STRING) AS dataset_id FROM customer WHERE c_custkey % 3 = 0")
    old = schemas.empty_table(t.spark, "datasets").unionByName(known, allowMissingColumns=True)
    return ingest.ingest_datasets(old, repositories.geo_series(t.sql(_RECORDS), "json"))[1]


# Every id three times: the first record counts, the others change nothing.
_REPEATED = f"SELECT 'GSE' || CAST(seq % 50 AS STRING) AS dataset_id, json, seq FROM ({_GEO}) g WHERE seq IS NOT NULL"


@query("ingest_datasets_repeated", """SELECT 'GSE' || (c_custkey % 50) AS dataset_id,
      CASE WHEN c_custkey % 50 = 7 OR row_number() OVER (PARTITION BY c_custkey % 50 ORDER BY c_custkey) > 1 THEN 'already_exists' ELSE 'ingested' END AS status,
      CASE WHEN c_custkey % 50 = 7 THEN 'kept' ELSE first_value(c_name) OVER (PARTITION BY c_custkey % 50 ORDER BY c_custkey) END AS title FROM customer""")
def ingest_datasets_repeated(t):
    from .. import schemas

    known = t.sql("SELECT 'GSE7' AS dataset_id, 'kept' AS title, 'GEO' AS repository FROM customer WHERE c_custkey = 7")
    old = schemas.empty_table(t.spark, "datasets").unionByName(known, allowMissingColumns=True)
    table, status = ingest.ingest_datasets(old, repositories.geo_series(t.sql(_REPEATED), "json"))
    return status.join(table.select("dataset_id", "title"), "dataset_id")


# ---- matrices ----


@query("melt_matrix", """SELECT CAST(p_partkey AS STRING) AS feature_id, 'a.1' AS sample, CAST(p_size AS DOUBLE) AS value FROM part
    UNION ALL SELECT CAST(p_partkey AS STRING), 'b', CASE WHEN p_size % 2 = 0 THEN p_retailprice END FROM part""")
def melt_matrix(t):
    wide = t["part"].select(
        F.col("p_partkey").cast("string").alias("Protein.Group"), F.col("p_name").alias("Genes"), F.col("p_size").cast("string").alias("a.1"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_retailprice").cast("string")).otherwise("Filtered").alias("b"))
    return matrices.melt_matrix(wide, "Protein.Group", metadata_cols=matrices.DIANN_METADATA)


@query("dep_columns", """SELECT CAST(p_partkey AS STRING) AS feature_id, CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS log2fc,
    CAST(NULL AS DOUBLE) AS pvalue, CAST(p_retailprice AS DOUBLE) AS padj, p_size % 2 = 0 AS significant FROM part""")
def dep_columns(t):
    s = F.col("p_size")
    raw = t["part"].select(
        F.col("p_partkey").cast("string").alias("gene"), F.when(s % 3 == 0, "NA").otherwise(s.cast("string")).alias("lfc"),
        F.col("p_retailprice").cast("string").alias("padj"), F.when(s % 2 == 0, "+").alias("significant"))
    return matrices.dep_columns(raw, "gene", "lfc")


def _file(df, **options):
    """Writes rows in their order as delimited text with a header in each part; returns the folder."""
    path = new_folder(df.sparkSession)
    df.write.options(header=True, emptyValue="", **options).csv(path)
    return path


# Each line of an order is one row of a matrix with six samples, most cells empty; a part occurs in many rows.
_WIDE = "SELECT *, (l_orderkey * 8 + l_linenumber) * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT) AS place FROM lineitem"


def _wide(t, feature, sample):
    rows = t.sql(_WIDE).orderBy("place")
    cells = [F.when(F.col("l_suppkey") % 6 == i, F.col("l_extendedprice").cast("string")).otherwise("NA").alias(sample.format(i)) for i in range(6)]
    return rows.select(F.concat(F.lit("P"), "l_partkey").alias(feature), F.col("l_returnflag").alias("Genes"), *cells)


@query("read_matrix_last_row", f"""SELECT 'P' || l_partkey AS feature_id, 's' || l_suppkey % 6 AS sample, l_extendedprice AS value
    FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY place DESC) AS r FROM ({_WIDE}) w) x WHERE r = 1""")
def read_matrix_last_row(t):
    """A written matrix read again: of a repeated feature the last row counts."""
    m = matrices.read_diann_matrix(t.spark, _file(_wide(t, "Protein.Group", "s{}"), sep="\t"), sep="\t", position="at", last_rows=True)
    return ranking.last_by(m, ["feature_id", "sample"], "at").where("value IS NOT NULL").drop("at")


@query("read_maxquant_matrix", f"""SELECT 'P' || l_partkey AS feature_id, 's' || l_suppkey % 6 AS sample, count(*) AS n, round(sum(l_extendedprice), 2) AS total
    FROM ({_WIDE}) w GROUP BY ALL""")
def read_maxquant_matrix(t):
    m = matrices.read_maxquant_matrix(t.spark, _file(_wide(t, "Majority protein IDs", "LFQ intensity s{}"), sep="\t"))
    found = m.where("value IS NOT NULL").groupBy("feature_id", "sample")
    return found.agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("read_dep_first_row", f"""SELECT 'P' || l_partkey AS feature_id, l_discount - 0.05 AS log2fc, l_tax AS pvalue, CAST(NULL AS DOUBLE) AS padj, l_returnflag = 'R' AS significant
    FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY place) AS r FROM ({_WIDE}) w) x WHERE r = 1""")
def read_dep_first_row(t):
    """A written differential-expression table read again: of a repeated feature the first row counts."""
    rows = t.sql(_WIDE).orderBy("place").select(
        F.concat(F.lit("P"), "l_partkey").alias("gene"), (F.col("l_discount") - 0.05).alias("lfc"), F.col("l_tax").alias("p"),
        F.when(F.col("l_returnflag") == "R", "+").otherwise("").alias("sig"))
    dep = matrices.read_dep(t.spark, _file(rows), ",", position="at", id_col="gene", log2fc_col="lfc", pvalue_col="p", sig_col="sig")
    return ranking.first_by(dep, ["feature_id"], "at").drop("at")


@query("read_unknown_text", """SELECT ';' AS delimiter, c_custkey, c_name || ', "x;y"' AS c_name, c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 2 = 0 END AS even,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer""")
def read_unknown_text(t):
    """Customers written with a delimiter that the reader has to find, and types it has to tell."""
    c = F.col("c_custkey")
    rows = t["customer"].select(
        "c_custkey", F.concat("c_name", F.lit(', "x;y"')).alias("c_name"), "c_acctbal", F.when(c % 3 == 0, "").otherwise((c % 2 == 0).cast("string")).alias("even"),
        F.when(c % 5 == 0, "NA").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"))
    frame, report = matrices.read_table(t.spark, _file(rows, sep=";", escape='"'))
    kinds = {n: k for n, k in frame.dtypes if k != "string"}
    assert kinds == {"c_custkey": "bigint", "c_acctbal": "double", "even": "boolean", "c_nationkey": "bigint"}, kinds
    return frame.withColumn("delimiter", F.lit(report.first().delimiter))


@query("file_checksums", """SELECT CAST(c_nationkey AS BIGINT) AS nation, CAST(sum(octet_length(encode(c_name)) + 1) AS BIGINT) AS size_bytes,
    sha256(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS sha256sum FROM customer GROUP BY c_nationkey""")
def file_checksums(t):
    """One text file of customers per nation, and the checksums of their contents."""
    path = new_folder(t.spark)
    rows = t["customer"].repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    rows.select(F.col("c_name").alias("value"), "c_nationkey").write.partitionBy("c_nationkey").text(path)
    found = listings.file_checksums(t.spark, path).where(F.col("path").endswith(".txt"))
    return found.select(F.regexp_extract("path", r"c_nationkey=(-?\d+)", 1).cast("bigint").alias("nation"), "size_bytes", "sha256sum")


# ---- validation ----

_CHECKED = """SELECT row_id, doi, pmid, pmcid, title, publication_date, CAST(NULL AS DATE) AS electronic_publication_date FROM articles"""
_CROSSREF = """SELECT doi, CASE WHEN row_id % 6 = 0 THEN 'something else entirely here' ELSE title END AS title,
    publication_date + CAST(CASE WHEN row_id % 4 = 0 THEN 1 ELSE 0 END AS INT) AS publication_date, CAST(NULL AS DATE) AS electronic_publication_date,
    CASE WHEN row_id % 9 = 0 THEN 'HTTP 404' END AS error FROM articles WHERE doi IS NOT NULL"""
_PUBMED = """SELECT pmid AS requested_pmid, CASE WHEN row_id % 8 = 0 THEN upper(doi) || 'x' ELSE upper(doi) END AS doi, pmcid, title, publication_date,
    CAST(NULL AS DATE) AS electronic_publication_date, CAST(NULL AS STRING) AS error FROM articles WHERE pmid IS NOT NULL"""
_VALID = f"""v AS (SELECT a.row_id, a.title,
      CASE WHEN a.doi IS NOT NULL AND c.error IS NOT NULL THEN 1 ELSE 0 END AS c_failed,
      CASE WHEN a.doi IS NOT NULL AND c.error IS NULL AND a.row_id % 6 = 0 THEN 1 ELSE 0 END AS c_title,
      CASE WHEN a.doi IS NOT NULL AND c.error IS NULL AND c.publication_date <> a.publication_date THEN 1 ELSE 0 END AS c_date,
      CASE WHEN a.pmid IS NULL AND a.pmcid IS NOT NULL THEN 1 ELSE 0 END AS p_failed,
      CASE WHEN a.doi IS NOT NULL AND c.error IS NULL AND a.pmid IS NOT NULL AND a.row_id % 6 = 0 THEN 1 ELSE 0 END AS x_title,
      CASE WHEN a.doi IS NOT NULL AND c.error IS NULL AND a.pmid IS NOT NULL AND a.row_id % 8 = 0 THEN 1 ELSE 0 END AS x_doi
    FROM articles a LEFT JOIN ({_CROSSREF}) c ON c.doi = a.doi)"""


def _validated(t):
    return validate.validate_articles(t.sql(_CHECKED), t.sql(_CROSSREF), t.sql(_PUBMED))


@query("validate_articles", oracle(
    """SELECT a.doi, a.pmid, a.pmcid, CAST(c_failed + c_title + c_date + p_failed + x_title + x_doi AS INT) AS n_issues,
      c_failed + c_title + c_date + p_failed + x_title + x_doi = 0 AS is_valid FROM v JOIN articles a ON a.row_id = v.row_id""", "articles", extra=_VALID))
def validate_articles(t):
    return _validated(t).select("doi", "pmid", "pmcid", F.size("issues").alias("n_issues"), "is_valid")


@query("validation_summary", oracle(
    """SELECT count(*) AS total_articles, count(*) FILTER (c_failed + c_title + c_date + p_failed + x_title + x_doi = 0) AS valid_articles,
      count(*) FILTER (c_failed + c_title + c_date + p_failed + x_title + x_doi > 0) AS invalid_articles FROM v""", "articles", extra=_VALID))
def validation_summary(t):
    return validate.validation_summary(_validated(t))


_MESSAGES = """SELECT doi, '{"message":{"title":["T' || CAST(row_id AS STRING) || '"],' || CASE row_id % 3 WHEN 0 THEN '"published-print":{"date-parts":[[2020,2]]},'
    WHEN 1 THEN '"published-online":{"date-parts":[[2021]]},' ELSE '' END || '"issued":{"date-parts":[[2019,5,6]]}}}' AS json, row_id FROM articles WHERE doi IS NOT NULL"""


@query("crossref_snapshot", oracle(
    """SELECT doi, 'T' || row_id AS title, CASE row_id % 3 WHEN 0 THEN DATE '2020-02-01' WHEN 2 THEN DATE '2019-05-06' END AS publication_date,
      CASE row_id % 3 WHEN 1 THEN DATE '2021-01-01' END AS electronic_publication_date FROM articles WHERE doi IS NOT NULL""", "articles"))
def crossref_snapshot(t):
    return repositories.crossref_snapshot(t.sql(_MESSAGES), "json").drop("error")


@query("constraint_report", oracle(
    """SELECT 'article_keywords' AS table_name, 'unique' AS kind, 'pmcid,keyword_id' AS constraint_columns, pmcid || '|' || keyword_id AS key, count(*) AS n
      FROM article_keywords WHERE pmcid IS NOT NULL GROUP BY pmcid, keyword_id HAVING count(*) > 1
    UNION ALL SELECT 'article_keywords', 'unique', 'doi,keyword_id', doi || '|' || keyword_id, count(*) FROM article_keywords WHERE doi IS NOT NULL GROUP BY doi, keyword_id HAVING count(*) > 1
    UNION ALL SELECT 'llm_raw_data', 'unique', 'doi,dataset_id,model', doi || '|' || dataset_id || '|' || model, count(*) FROM llm_raw_data WHERE doi IS NOT NULL
      GROUP BY doi, dataset_id, model HAVING count(*) > 1
    UNION ALL SELECT 'llm_raw_data', 'unique', 'pmcid,dataset_id,model', pmcid || '|' || dataset_id || '|' || model, count(*) FROM llm_raw_data WHERE pmcid IS NOT NULL
      GROUP BY pmcid, dataset_id, model HAVING count(*) > 1
    UNION ALL SELECT 'agent_requests', 'check', 'request_status', request_status, count(*) FROM agent_requests WHERE request_status = 'pending' GROUP BY request_status
    UNION ALL SELECT 'article_keywords', 'foreign_key', 'keyword_id', CAST(keyword_id AS STRING), count(*) FROM article_keywords WHERE keyword_id % 5 = 0 GROUP BY keyword_id""",
    "article_keywords", "keywords", "llm_raw_data", "agent_requests"))
def constraint_report(t):
    requests = t["agent_requests"].withColumn("request_status", F.regexp_replace("request_status", "^pending$", "waiting"))
    report = validate.constraint_report({
        "article_keywords": t["article_keywords"], "keywords": t["keywords"].where("keyword_id % 5 <> 0"), "llm_raw_data": t["llm_raw_data"],
        "agent_requests": requests.select("request_status"),
    })
    return report.withColumn("key", F.regexp_replace("key", "^waiting$", "pending"))
