"""Queries over texts: injection scan, titles, excerpts, responses, relevance, files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cells, dates, files, ids, text
from ..functions import injection as inj
from ..operators import catalog, facts, relevance, scan
from .derived import oracle
from .registry import query

# ---- injection scan ----


def _re2_count(pattern) -> str:
    regex = pattern.regex.replace("'", "''")
    return f"len(regexp_extract_all(text, '{regex}', 0, 'i'))"


def _base64_count(n: int) -> str:
    # RE2 has no look-around: take maximal runs and test their length and padding.
    runs = "regexp_extract_all(text, '[A-Za-z0-9+/]+=*')"
    return f"len(list_filter({runs}, lambda r: length(rtrim(r, '=')) >= {n} AND length(r) - length(rtrim(r, '=')) <= 2))"


def _signal_sql(view: str) -> str:
    counts = {c: [] for c in inj.WEIGHTS}
    for p in inj.PATTERNS:
        counts[p.category].append(_re2_count(p))
    counts["encoded_payload"].append(_base64_count(48))
    columns = ", ".join(f"CAST({' + '.join(parts)} AS BIGINT) AS n_{c}" for c, parts in counts.items())
    total = " + ".join(f"n_{c}" for c in counts)
    weighted = " + ".join(f"n_{c} * {w}" for c, w in inj.WEIGHTS.items())
    listed = ", ".join(f"CASE WHEN n_{c} > 0 THEN '{c}' END" for c in counts)
    return f"""counted AS (SELECT doc_id, length(text) AS n_chars, {columns} FROM {view}),
      scored AS (SELECT *, {total} AS total_matches, CAST({weighted} AS DOUBLE) AS weighted_score, concat_ws(',', {listed}) AS matched FROM counted),
      signal AS (SELECT *, round(100.0 * (1.0 - exp(-weighted_score / 4.0)), 4) AS risk_score FROM scored)"""


_LEVEL = ("CASE WHEN total_matches = 0 THEN 'none' WHEN risk_score >= 65 THEN 'high' WHEN risk_score >= 40 THEN 'medium' ELSE 'low' END")
_N = ", ".join(f"n_{c}" for c in inj.WEIGHTS)


@query("scan_signal", oracle(
    f"SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, {_N}, total_matches, weighted_score, risk_score, {_LEVEL} AS risk_level, matched FROM signal",
    "scan_texts", extra=_signal_sql("scan_texts")))
def scan_signal(t):
    s = scan.scan_signal(t["scan_texts"], partitions=t.partitions)
    return s.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), *[f"n_{c}" for c in inj.WEIGHTS], "total_matches", "weighted_score",
        "risk_score", "risk_level", F.array_join("matched_categories", ",").alias("matched"),
    )


@query("scan_summary", oracle(
    "SELECT count(*) AS n_items, count(*) FILTER (risk_score >= 40) AS n_flagged, CAST(0 AS BIGINT) AS n_errors, CAST(40 AS DOUBLE) AS flag_threshold FROM signal",
    "scan_texts", extra=_signal_sql("scan_texts")))
def scan_summary(t):
    return scan.scan_summary(scan.scan_signal(t["scan_texts"], partitions=t.partitions))


@query("scan_flagged", oracle(f"SELECT doc_id, risk_score, {_LEVEL} AS risk_level FROM signal WHERE risk_score >= 40", "scan_texts", extra=_signal_sql("scan_texts")))
def scan_flagged(t):
    return scan.flagged_items(scan.scan_signal(t["scan_texts"], partitions=t.partitions), "doc_id")


@query("scan_spans", oracle(
    f"SELECT doc_id, {_N} FROM signal WHERE total_matches > 0",
    "scan_texts", extra=_signal_sql("scan_texts")))
def scan_spans(t):
    spans = scan.scan_spans(t["scan_texts"], "doc_id", partitions=t.partitions)
    return spans.groupBy("doc_id").agg(*[F.count_if(F.col("category") == c).alias(f"n_{c}") for c in inj.WEIGHTS])


def _marked_sql() -> str:
    """Each match between two marks; what lies before a mark gives the offsets."""
    parts = []
    for p in inj.PATTERNS:
        regex = p.regex.replace("'", "''")
        parts.append(f"SELECT doc_id, '{p.category}' AS category, '{p.label}' AS pattern, string_split(regexp_replace(text, '({regex})', chr(1) || '\\1' || chr(2), 'gi'), chr(1)) AS parts FROM scan_texts")
    return " UNION ALL ".join(parts)


# The encoded payload has look-arounds, which the checking engine does not know; scan_spans counts it.
@query("scan_offsets", oracle(
    """SELECT doc_id, category, pattern, CAST(list_sum(list_transform(parts[1:i], lambda t: length(replace(t, chr(2), '')))) AS BIGINT) AS start,
      CAST(list_sum(list_transform(parts[1:i], lambda t: length(replace(t, chr(2), '')))) + length(string_split(parts[i + 1], chr(2))[1]) AS BIGINT) AS "end",
      CASE WHEN length(s) > 60 THEN rtrim(substr(s, 1, 59)) || '…' ELSE s END AS snippet
    FROM (SELECT *, trim(regexp_replace(string_split(parts[i + 1], chr(2))[1], '\\s+', ' ', 'g')) AS s FROM (SELECT *, unnest(range(1, len(parts))) AS i FROM marked))""",
    "scan_texts", extra=f"marked AS ({_marked_sql()})"))
def scan_offsets(t):
    """Offsets, labels and snippets of all spans of the listed patterns."""
    spans = scan.scan_spans(t["scan_texts"], "doc_id", snippet_len=60, partitions=t.partitions).where("pattern <> 'base64_blob'")
    return spans.select("doc_id", "category", "pattern", "start", "end", "snippet")


@query("scan_pages", f"""WITH {_signal_sql("(SELECT page_id AS doc_id, html AS text FROM pages)")}
    SELECT doc_id, total_matches, risk_score FROM signal""")
def scan_pages(t):
    s = scan.scan_signal(t["pages"].select(F.col("page_id").alias("doc_id"), F.col("html").alias("text")), partitions=t.partitions)
    return s.select("doc_id", "total_matches", "risk_score")


# ---- scalar text functions ----


@query("strip_tags", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS bare FROM pages")
def strip_tags(t):
    return t["pages"].select("page_id", text.strip_tags(F.col("html")).alias("bare"))


@query("normalize_title", oracle(
    # Letters outside Latin survive in both engines; accents are removed by the same rule.
    """SELECT row_id, trim(regexp_replace(regexp_replace(lower(strip_accents(nfc_normalize(title))), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS norm
    FROM articles""", "articles"))
def normalize_title(t):
    return t["articles"].select("row_id", text.normalize_title(F.col("title")).alias("norm"))


_TITLES = """SELECT row_id, title, CASE row_id % 4 WHEN 0 THEN title || ' !' WHEN 1 THEN substr(title, 1, 60)
    WHEN 2 THEN 'Another ' || substr(title, 40) ELSE reverse(title) END AS other FROM articles"""


@query("titles_similar", oracle(
    f"""SELECT row_id, CASE WHEN a = b OR (length(b) >= 20 AND starts_with(a, b)) OR (length(a) >= 20 AND starts_with(b, a)) THEN true
      WHEN a = '' OR b = '' THEN false ELSE CAST(len(list_intersect(list_distinct(string_split(a, ' ')), list_distinct(string_split(b, ' ')))) AS DOUBLE)
        / len(list_distinct(string_split(a, ' ') || string_split(b, ' '))) >= 0.85 END AS similar FROM (
      SELECT row_id, trim(regexp_replace(regexp_replace(lower(strip_accents(title)), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS a,
        trim(regexp_replace(regexp_replace(lower(strip_accents(other)), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS b FROM ({_TITLES}) x)""", "articles"))
def titles_similar(t):
    return t.sql(_TITLES).select("row_id", text.titles_similar(F.col("title"), F.col("other")).alias("similar"))


_HEADED = """SELECT doc_id, text || CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'Materials  and Methods' || chr(10) || repeat('step. ', 600) ELSE '' END AS text FROM documents"""


@query("methods_excerpt", f"""SELECT doc_id, substr(substr(text, 1, 1800) || CASE WHEN pos > 0 THEN chr(10) || '...' || chr(10) || substr(text, pos, 2600) ELSE '' END, 1, 4600) AS excerpt
    FROM (SELECT doc_id, text, CASE WHEN m <> '' THEN instr(text, m) ELSE 0 END AS pos FROM (
      SELECT doc_id, text, regexp_extract(text, '\\b(materials\\s+and\\s+methods|methods|experimental\\s+procedures|star\\s+methods)\\b', 0, 'i') AS m FROM ({_HEADED}) h))""")
def methods_excerpt(t):
    return t.sql(_HEADED).select("doc_id", text.methods_excerpt(F.col("text")).alias("excerpt"))


@query("truncate_cell", """SELECT doc_id, CASE WHEN length(c) > 80 THEN rtrim(substr(c, 1, 79)) || '…' ELSE c END AS cell
    FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS c FROM documents)""")
def truncate_cell(t):
    return t["documents"].select("doc_id", text.truncate_cell(F.col("text"), 80).alias("cell"))


@query("short_label", oracle("SELECT row_id, CASE WHEN length(title) > 80 THEN substr(title, 1, 80) || '...' ELSE title END AS label FROM articles", "articles"))
def short_label(t):
    return t["articles"].select("row_id", text.short_label(F.col("title"), 80).alias("label"))


@query("question_hash", "SELECT conv_id, turn, sha256(text) AS hash FROM conversations")
def question_hash(t):
    return t["conversations"].select("conv_id", "turn", text.question_hash(F.col("text")).alias("hash"))


@query("article_key", oracle(
    """SELECT row_id, coalesce(doi, pmid, pmcid) AS plain, CASE WHEN doi IS NOT NULL THEN 'article:doi:' || doi WHEN pmid IS NOT NULL THEN 'article:pmid:' || pmid
      ELSE 'article:pmcid:' || pmcid END AS typed, CAST(row_id AS STRING) AS id FROM articles""", "articles"))
def article_key(t):
    k = [F.col(c) for c in ("doi", "pmid", "pmcid")]
    return t["articles"].select("row_id", ids.article_key(*k).alias("plain"), ids.article_key(*k, typed=True).alias("typed"), ids.as_id(F.col("row_id")).alias("id"))


_ACCESSIONS = "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN ' gse' || CAST(o_orderkey AS STRING) WHEN 1 THEN 'GSE' || CAST(o_custkey AS STRING) || 'x' ELSE 'MSV1' END AS a FROM orders"


@query("accession", f"""SELECT o_orderkey, upper(trim(a)) AS id, CASE WHEN NOT regexp_full_match(upper(trim(a)), 'GSE[0-9]+') THEN 'Invalid GEO Series ID format: ' || upper(trim(a)) ||
    '. Expected format: GSE followed by digits (e.g., GSE12345)' END AS error FROM ({_ACCESSIONS}) x""")
def accession(t):
    return t.sql(_ACCESSIONS).select("o_orderkey", ids.accession(F.col("a"), "gse").alias("r")).select("o_orderkey", "r.*")


@query("geo_dir", """SELECT o_orderkey, '/geo/series/GSE' || substr(CAST(o_orderkey AS STRING), 1, greatest(0, length(CAST(o_orderkey AS STRING)) - 3)) || 'nnn/GSE' ||
    CAST(o_orderkey AS STRING) AS dir FROM orders""")
def geo_dir(t):
    gse = F.concat(F.lit("GSE"), F.col("o_orderkey").cast("string"))
    return t["orders"].select("o_orderkey", ids.geo_dir(gse).alias("dir"))


_URLS = """SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'https://github.com/own' || CAST(page_id AS STRING) || '/tool.git'
    WHEN 1 THEN 'www.GitLab.com/own' || CAST(page_id AS STRING) || '/tool/' WHEN 2 THEN 'bitbucket.org/own' || CAST(page_id AS STRING) || '/tool'
    WHEN 3 THEN 'https://git.example.org/own' || CAST(page_id AS STRING) || '/digit.git' ELSE url END AS url FROM pages"""


@query("parse_repo_url", f"""SELECT page_id, CASE WHEN page_id % 5 < 4 THEN 'own' || CAST(page_id AS STRING) WHEN len(p) >= 2 THEN p[1] END AS owner,
    CASE WHEN page_id % 5 < 3 THEN 'tool' WHEN page_id % 5 = 3 THEN 'd' WHEN len(p) >= 2 THEN p[2] END AS repo_name,
    CASE page_id % 5 WHEN 0 THEN 'github' WHEN 1 THEN 'gitlab' WHEN 2 THEN 'bitbucket' ELSE 'unknown' END AS platform
  FROM (SELECT page_id, string_split(rtrim(trim(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/'), '.git'), '/') AS p FROM ({_URLS}) u)""")
def parse_repo_url(t):
    return t.sql(_URLS).select("page_id", files.parse_repo_url(F.col("url")).alias("r")).select("page_id", "r.*")


_DATES = """SELECT o_orderkey, CAST(2000 + o_orderkey % 25 AS STRING) AS y,
    CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Feb' WHEN 2 THEN CAST(o_custkey % 14 AS STRING) WHEN 3 THEN 'Winter' ELSE '11' END AS m,
    CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'x' ELSE CAST(o_custkey % 33 AS STRING) END AS d FROM orders"""
_YMD = f"""SELECT o_orderkey, y, CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN CAST(m AS INT) WHEN 3 THEN 1 ELSE 11 END AS mm,
    d, coalesce(TRY_CAST(d AS INT), 1) AS dd FROM ({_DATES}) x"""


def _try(y, m, d):
    return f"TRY_CAST({y} || '-' || lpad(CAST({m} AS STRING), 2, '0') || '-' || lpad(CAST({d} AS STRING), 2, '0') AS DATE)"


@query("pubmed_date", f"""SELECT o_orderkey, coalesce({_try('y', 'mm', 'dd')}, {_try('y', 'mm', '1')}, {_try('y', '1', '1')}) AS lenient,
    CASE WHEN d = 'x' THEN NULL ELSE {_try('y', 'mm', 'dd')} END AS strict, {_try('y', '1', '1')} AS medline FROM ({_YMD}) z""")
def pubmed_date(t):
    y, m, d = F.col("y"), F.col("m"), F.col("d")
    return t.sql(_DATES).select(
        "o_orderkey", dates.pubmed_date(y, m, d).alias("lenient"), dates.pubmed_date_strict(y, m, d).alias("strict"),
        dates.medline_date(F.concat(y, F.lit(" Spring-Summer"))).alias("medline"),
    )


@query("pride_date", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def pride_date(t):
    day = F.to_date("o_orderdate")
    millis = (F.unix_date(day).cast("bigint") * 86400000 + 3600000).cast("string")
    raw = (
        F.when(F.col("o_orderkey") % 4 == 0, millis).when(F.col("o_orderkey") % 4 == 1, F.concat(day.cast("string"), F.lit("T10:00:00")))
        .when(F.col("o_orderkey") % 4 == 2, F.date_format(day, "yyyy/MM/dd")).otherwise("soon")
    )
    return t["orders"].select("o_orderkey", dates.pride_date(raw).alias("day"))


@query("crossref_date", f"""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN {_try('2001', '1', '1')} WHEN 1 THEN {_try('2001', 'o_custkey % 14', '1')}
    WHEN 2 THEN {_try('2001', 'o_custkey % 14', 'o_custkey % 31')} END AS day FROM orders""")
def crossref_date(t):
    n, c = F.col("o_orderkey") % 4, F.col("o_custkey").cast("int")
    year, month, day = F.lit(2001), c % 14, c % 31
    parts = F.when(n == 0, F.array(F.array(year))).when(n == 1, F.array(F.array(year, month))).when(n == 2, F.array(F.array(year, month, day)))
    return t["orders"].select("o_orderkey", dates.crossref_date(parts).alias("day"))


_CELLS = """SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN ' NA ' WHEN 1 THEN '1d' WHEN 2 THEN '-inf' WHEN 3 THEN '#N/A' WHEN 4 THEN '+1.5e3'
    WHEN 5 THEN '.5' WHEN 6 THEN 'filtered' WHEN 7 THEN '1_000' WHEN 8 THEN '' ELSE CAST(o_orderkey AS STRING) END AS n,
    CASE o_orderkey % 6 WHEN 0 THEN ' TRUE' WHEN 1 THEN 'ns' WHEN 2 THEN '+' WHEN 3 THEN '' WHEN 4 THEN 'perhaps' END AS b FROM orders"""


@query("to_number", f"""SELECT o_orderkey, CASE o_orderkey % 10 WHEN 4 THEN 1500.0 WHEN 5 THEN 0.5 WHEN 7 THEN 1000.0 WHEN 9 THEN CAST(o_orderkey AS DOUBLE) END AS number,
    CASE o_orderkey % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false END AS flag FROM ({_CELLS}) x""")
def to_number(t):
    return t.sql(_CELLS).select("o_orderkey", cells.to_number(F.col("n")).alias("number"), cells.to_bool(F.col("b")).alias("flag"))


# ---- model responses ----

_RESPONSES = """SELECT doi, pmid, pmcid, row_id AS seq, CASE row_id % 9 WHEN 7 THEN 'no json' WHEN 8 THEN '[1, 2]' ELSE
    '{"keywords": ["kw ' || CAST(row_id % 30 AS STRING) || '", "", " shared "], "raw_data": [{"Dataset ID": "", "accession": "PXD' || CAST(row_id AS STRING) ||
    '", "Data-Repository": "PRIDE"}, "text", {"file": "f"}], "processed_data": [{"id": "GSE' || CAST(row_id AS STRING) || '", "link": "u"}],' ||
    '"analysis_methods": [{"method_name": "m' || CAST(row_id % 5 AS STRING) || '"}, {"name": "x"}], "code": [{"repository": "r", "url": null}],' ||
    CASE WHEN row_id % 2 = 0 THEN '"measurement_descriptor": {"cell type": " HeLa ", "species": ""}' ELSE '"measurement_descriptor": [3, {"species": ""}]' END || '}' END AS response
  FROM articles"""
_GOOD = f"SELECT * FROM ({_RESPONSES}) r WHERE seq % 9 < 7"


def _parsed(t):
    return facts.parse_responses(t.sql(_RESPONSES), "response", "m9")


@query("response_errors", oracle(
    f"SELECT seq, CASE WHEN seq % 9 = 7 THEN 'Invalid JSON response' ELSE 'Expected JSON object, got array' END AS error FROM ({_RESPONSES}) r WHERE seq % 9 >= 7", "articles"))
def response_errors(t):
    return _parsed(t)["errors"].select("seq", "error")


@query("response_keywords", oracle(
    f"SELECT doi, 'kw ' || CAST(seq % 30 AS STRING) AS keyword FROM ({_GOOD}) g UNION ALL SELECT doi, ' shared ' FROM ({_GOOD}) g", "articles"))
def response_keywords(t):
    return _parsed(t)["keywords"].select("doi", "keyword")


@query("response_raw_data", oracle(f"SELECT doi, 'PXD' || CAST(seq AS STRING) AS dataset_id, 'PRIDE' AS data_repository FROM ({_GOOD}) g", "articles"))
def response_raw_data(t):
    return _parsed(t)["raw_data"].select("doi", "dataset_id", "data_repository")


@query("response_processed_data", oracle(f"SELECT pmid, 'GSE' || CAST(seq AS STRING) AS dataset_id, '' AS data_repository, 'u' AS url FROM ({_GOOD}) g", "articles"))
def response_processed_data(t):
    return _parsed(t)["processed_data"].select("pmid", "dataset_id", "data_repository", "url")


@query("response_methods_and_code", oracle(
    f"SELECT doi, 'm' || CAST(seq % 5 AS STRING) AS name FROM ({_GOOD}) g UNION ALL SELECT doi, 'r' FROM ({_GOOD}) g", "articles"))
def response_methods_and_code(t):
    p = _parsed(t)
    return p["analysis_methods"].select("doi", F.col("method_name").alias("name")).unionByName(p["code"].select("doi", F.col("repository").alias("name")))


@query("response_descriptors", oracle(f"SELECT doi, 'HeLa' AS biological_system, CAST(NULL AS STRING) AS species FROM ({_GOOD}) g WHERE seq % 2 = 0", "articles"))
def response_descriptors(t):
    return _parsed(t)["measurement_descriptor"].select("doi", "biological_system", "species")


@query("strip_fence", "SELECT conv_id, turn, trim(text, ' ' || chr(10)) AS body FROM conversations")
def strip_fence(t):
    fenced = F.concat(F.lit(" ```json\n"), F.col("text"), F.lit("\n```\n"))
    return t["conversations"].select("conv_id", "turn", F.trim(text.strip_fence(fenced), F.lit(" \n")).alias("body"))


# ---- relevance gate ----


@query("relevance_gate", oracle(
    """SELECT doc_id, score, directly_measures, CASE WHEN score IS NULL THEN 'error' WHEN score < 0.4 THEN 'exclude' WHEN score >= 0.7 AND directly_measures THEN 'include'
    ELSE 'flag' END AS verdict FROM judgements""", "judgements"))
def relevance_gate(t):
    return relevance.judge(t["judgements"])


_ANSWERS = "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'high' WHEN 1 THEN '1.7' WHEN 2 THEN '-3' ELSE CAST(quality / 2.0E0 AS STRING) END AS score, CASE toxic WHEN 0 THEN ' Yes' ELSE '0' END AS flag FROM labels"


@query("coerce_answers", f"""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 1.0 WHEN 2 THEN 0.0 ELSE CAST(score AS DOUBLE) END AS score,
    trim(flag) = 'Yes' AS flag FROM ({_ANSWERS}) a""".replace("CAST(score AS DOUBLE)", "TRY_CAST(score AS DOUBLE)"))
def coerce_answers(t):
    return t.sql(_ANSWERS).select("doc_id", cells.coerce_score(F.col("score")).alias("score"), cells.coerce_flag(F.col("flag")).alias("flag"))


# Two of three articles may have descriptors, three of four a text.
_STUDIES = "SELECT row_id, doi, pmid, pmcid, title, abstract, article_filepath FROM articles WHERE coalesce(doi, pmid, pmcid) IS NOT NULL"
_NEWEST = f"""newest AS (SELECT * FROM (SELECT a.row_id, f.biological_system, f.measured_compartment, f.species, f.omics_assay,
      row_number() OVER (PARTITION BY a.row_id ORDER BY f.created_at DESC, f.id DESC) AS r
    FROM articles a JOIN descriptors f ON (f.doi = a.doi OR f.pmid = a.pmid OR f.pmcid = a.pmcid)) WHERE r = 1),
  built AS (SELECT s.row_id, 'TITLE: ' || s.title || chr(10) || 'ABSTRACT: ' || s.abstract AS header, x.text,
      'MEASUREMENT DESCRIPTOR (cached):' || chr(10) || concat_ws(chr(10), '- biological system / cell type: ' || n.biological_system,
        '- measured compartment: ' || n.measured_compartment, '- species: ' || n.species, '- omics / assay: ' || n.omics_assay) AS described,
      n.row_id IS NOT NULL AS has_descriptor
    FROM ({_STUDIES}) s LEFT JOIN texts x ON x.path = s.article_filepath LEFT JOIN newest n ON n.row_id = s.row_id)"""


def _contexts(t):
    return relevance.build_context(t.sql(_STUDIES), t["texts"], t["descriptors"])


@query("build_context", oracle(
    """SELECT row_id, CASE WHEN has_descriptor THEN 'descriptor' ELSE 'excerpt' END AS context_level,
      md5(CASE WHEN has_descriptor THEN described || chr(10) || chr(10) || header
        WHEN text <> '' THEN header || chr(10) || chr(10) || substr(substr(text, 1, 1800) || CASE WHEN m <> '' THEN chr(10) || '...' || chr(10) || substr(text, instr(text, m), 2600) ELSE '' END, 1, 4600)
        ELSE header END) AS context,
      md5(CASE WHEN text <> '' THEN header || chr(10) || chr(10) || text END) AS full_context
    FROM (SELECT *, regexp_extract(text, '\\b(materials\\s+and\\s+methods|methods|experimental\\s+procedures|star\\s+methods)\\b', 0, 'i') AS m FROM built)""",
    "articles", "texts", "descriptors", extra=_NEWEST))
def build_context(t):
    return _contexts(t).select("row_id", "context_level", F.md5(F.col("context").cast("binary")).alias("context"), F.md5(F.col("full_context").cast("binary")).alias("full_context"))



def length_scorer(question, context, level):
    """A stand-in for a model: the score is a function of the context's length."""
    size = F.char_length(context) % 101 / 100.0
    return F.struct(size.alias("score"), (F.char_length(context) % 2 == 0).alias("directly_measures"),
                    F.concat(level, F.lit(" "), F.char_length(context).cast("string")).alias("reason"), F.lit(None).cast("string").alias("error"))


@query("score_studies", oracle(
    """SELECT row_id, CASE WHEN again THEN s2 ELSE s1 END AS score, again AS escalated, CASE WHEN again THEN 'full_text' ELSE 'excerpt' END AS context_level,
      CASE WHEN (CASE WHEN again THEN s2 ELSE s1 END) < 0.4 THEN 'exclude' WHEN (CASE WHEN again THEN s2 ELSE s1 END) >= 0.7 AND (CASE WHEN again THEN n2 ELSE n1 END) % 2 = 0 THEN 'include' ELSE 'flag' END AS verdict
    FROM (SELECT *, s1 >= 0.4 AND NOT (s1 >= 0.7 AND n1 % 2 = 0) AND n2 IS NOT NULL AND c1 <> c2 AS again FROM (
      SELECT row_id, c1, c2, length(c1) AS n1, length(c2) AS n2, (length(c1) % 101) / 100.0E0 AS s1, (length(c2) % 101) / 100.0E0 AS s2 FROM (
        SELECT row_id, header || CASE WHEN text <> '' THEN chr(10) || chr(10) || substr(substr(text, 1, 1800) || CASE WHEN m <> '' THEN chr(10) || '...' || chr(10) || substr(text, instr(text, m), 2600) ELSE '' END, 1, 4600) ELSE '' END AS c1,
          CASE WHEN text <> '' THEN header || chr(10) || chr(10) || text END AS c2
        FROM (SELECT *, regexp_extract(text, '\\b(materials\\s+and\\s+methods|methods|experimental\\s+procedures|star\\s+methods)\\b', 0, 'i') AS m FROM built))))""",
    "articles", "texts", "descriptors", extra=_NEWEST))
def score_studies(t):
    scored = relevance.score_studies(relevance.build_context(t.sql(_STUDIES), t["texts"]), "Which study measures microglia?", length_scorer, partitions=t.partitions)
    return scored.select("row_id", "score", "escalated", "context_level", "verdict")


# ---- files ----


def _list_sql(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _pattern_sql(name: str, patterns) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN contains({name}, '{p}') THEN '{p}' END" for p in patterns) + ")"


_SUFFIXED = "SELECT *, lower(filename) AS name, regexp_extract(base, '(\\.[^.]*)$', 1) AS last, regexp_extract(base, '^[^.]*(\\..*)$', 1) AS joined FROM (SELECT *, lower(regexp_extract(filename, '([^/]*)$', 1)) AS base FROM file_names)"


def _category_sql() -> str:
    f = files
    raw, inst = _list_sql(f.RAW_EXTENSIONS), _list_sql(f.INSTRUMENT_EXTENSIONS)
    tab, summ, proc, amb = (_list_sql(x) for x in (f.TABULAR_EXTENSIONS, f.SUMMARY_EXTENSIONS, f.PROCESSING_EXTENSIONS, f.AMBIGUOUS_EXTENSIONS))
    cases = [
        (f"last IN ({raw}) OR joined IN ({raw})", "raw_data", "'Extension ' || joined || ' indicates raw instrument data'"),
        ("contains(name, '.d/') OR name LIKE '%.d'", "raw_data", "'Agilent/Bruker .d directory indicates raw instrument data'"),
        (f"last IN ({inst}) OR joined IN ({inst})", "instrument_parameters", "'Extension ' || joined || ' indicates instrument parameters'"),
        (f"i IS NOT NULL AND last NOT IN ({tab}, {summ})", "instrument_parameters", "'Filename contains ''' || i || ''' indicating instrument parameters'"),
        (f"last IN ({summ})", "summary", "'Extension ' || last || ' indicates summary/figure file'"),
        (f"last IN ({amb}) AND p IS NOT NULL", "processing_parameters", "'Extension ' || last || ' with ''' || p || ''' indicates processing parameters'"),
        (f"last IN ({proc}) AND last NOT IN ({amb})", "processing_parameters", "'Extension ' || last || ' indicates processing parameters'"),
        (f"last IN ({tab}) AND q IS NOT NULL", "quantitative_data", "'Extension ' || last || ' with ''' || q || ''' indicates quantitative data'"),
        (f"last IN ({tab}) AND s IS NOT NULL", "summary", "'Extension ' || last || ' with ''' || s || ''' indicates summary data'"),
        ("r IS NOT NULL", "raw_data", "'Filename contains ''' || r || ''' indicating raw data'"),
        ("s IS NOT NULL", "summary", "'Filename contains ''' || s || ''''"),
    ]
    category = " ".join(f"WHEN {c} THEN '{k}'" for c, k, _ in cases)
    reason = " ".join(f"WHEN {c} THEN {r}" for c, _, r in cases)
    marks = ", ".join(f"{_pattern_sql('name', p)} AS {a}" for a, p in (
        ("i", f.INSTRUMENT_PATTERNS), ("p", f.PROCESSING_PATTERNS), ("q", f.QUANTITATIVE_PATTERNS), ("s", f.SUMMARY_PATTERNS), ("r", f.RAW_PATTERNS)))
    return f"""classed AS (SELECT file_id, dataset_id, filename, size_bytes, CASE {category} ELSE 'unknown' END AS category,
      CASE {reason} ELSE 'Could not classify by heuristics' END AS reason FROM (SELECT *, {marks} FROM ({_SUFFIXED})))"""


_CLASSED = _category_sql()


@query("file_category", oracle(
    """SELECT file_id, category, reason, CASE category WHEN 'summary' THEN 'summary_data' WHEN 'instrument_parameters' THEN 'supporting'
      WHEN 'processing_parameters' THEN 'supporting' ELSE category END AS stored,
      CASE WHEN lower(filename) LIKE '%.zip' THEN 'zip' END AS archive,
      contains(lower(filename), 's1_') OR contains(lower(filename), 'supp') OR regexp_matches(lower(filename), '\\.(pdf|xlsx|xls|csv|zip|doc|docx)$') AS supplemental
    FROM classed""", "file_names", extra=_CLASSED))
def file_category(t):
    f = t["file_names"].withColumn("c", files.file_category(F.col("filename")))
    return f.select("file_id", "c.category", "c.reason", files.stored_category(F.col("c.category")).alias("stored"),
                    files.archive_type(F.col("filename")).alias("archive"), files.is_supplemental(F.col("filename")).alias("supplemental"))


_LABELS = """SELECT dataset_id, filename, CASE file_id % 4 WHEN 0 THEN 'raw_data' WHEN 1 THEN 'nonsense' ELSE 'summary' END AS category,
    repeat('long reason ', 20) AS reason, 'm9' AS model, file_id FROM file_names WHERE file_id % 3 <> 0"""
_CATALOGUED = f"""{_CLASSED}, catalogued AS (SELECT c.file_id, c.dataset_id,
    CASE WHEN c.category = 'unknown' AND l.category IN ('raw_data', 'summary') THEN l.category ELSE c.category END AS file_type,
    CASE WHEN c.category <> 'unknown' THEN c.reason WHEN l.category IN ('raw_data', 'summary') THEN l.reason
      ELSE 'Could not classify by heuristics or LLM' END AS file_type_reason,
    CASE WHEN c.category = 'unknown' AND l.category IN ('raw_data', 'summary') THEN 'shallow_llm' ELSE 'heuristic' END AS method
  FROM classed c LEFT JOIN ({_LABELS}) l ON l.file_id = c.file_id)"""


def _catalogued(t):
    return catalog.catalog_files(t["file_names"], t.sql(_LABELS).drop("file_id"))


@query("catalog_files", oracle("SELECT file_id, file_type, file_type_reason, method FROM catalogued", "file_names", extra=_CATALOGUED))
def catalog_files(t):
    return _catalogued(t).select("file_id", "file_type", "file_type_reason", "method")


@query("catalog_counters", oracle(
    """SELECT count(*) AS total_files, count(*) FILTER (file_type <> 'unknown' AND method = 'heuristic') AS heuristic_classified,
    count(*) FILTER (file_type <> 'unknown' AND method = 'shallow_llm') AS shallow_llm_classified, count(*) FILTER (file_type = 'unknown') AS unknown FROM catalogued""",
    "file_names", extra=_CATALOGUED))
def catalog_counters(t):
    return catalog.catalog_counters(_catalogued(t))


@query("classification_summary", oracle(
    """SELECT 'by_category' AS kind, file_type AS name, count(*) AS n FROM catalogued GROUP BY file_type
    UNION ALL SELECT 'by_method', CASE WHEN file_type = 'unknown' THEN 'unknown' ELSE method END, count(*) FROM catalogued GROUP BY 2""",
    "file_names", extra=_CATALOGUED))
def classification_summary(t):
    return catalog.classification_summary(_catalogued(t))


@query("size_totals", oracle(
    """SELECT dataset_id, count(*) AS file_count, CAST(sum(size_bytes) AS BIGINT) AS total_size_bytes,
      CAST(round_even(sum(size_bytes) / 1048576.0, 0) AS BIGINT) AS size_mb FROM file_names GROUP BY dataset_id""", "file_names"))
def size_totals(t):
    return catalog.size_totals(t["file_names"])


@query("filename_batches", oracle(
    "SELECT file_id, dataset_id, (row_number() OVER (PARTITION BY dataset_id ORDER BY file_id) - 1) // 50 AS batch FROM file_names", "file_names"))
def filename_batches(t):
    return catalog.filename_batches(t["file_names"], "file_id").select("file_id", "dataset_id", "batch")


# A quarter of the paths are of datasets that nobody asks for.
_LISTING = """SELECT '/data/PXD' || CAST(user_id + CASE WHEN user_id % 4 = event_id % 4 THEN 100000000 ELSE 0 END AS STRING) || CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN '.zip' ELSE '.tar.gz' END AS path,
    event_id % 3 = 0 AS is_dir FROM events"""


@query("dataset_availability", oracle(
    f"""SELECT d.dataset_id, coalesce(max(p), 0) > 0 AS exists, max(p) = 3 AS is_directory,
      CASE max(p) WHEN 3 THEN NULL WHEN 2 THEN '.tar.gz' WHEN 1 THEN '.zip' END AS archive_format FROM datasets d LEFT JOIN (
      SELECT regexp_extract(path, 'PXD[0-9]+') AS id, CASE WHEN is_dir THEN 3 WHEN path LIKE '%.tar.gz' THEN 2 ELSE 1 END AS p FROM ({_LISTING}) l) x ON x.id = d.dataset_id
    GROUP BY d.dataset_id""", "datasets"))
def dataset_availability(t):
    return catalog.dataset_availability(t["datasets"], t.sql(_LISTING)).select("dataset_id", "exists", "is_directory", "archive_format")
