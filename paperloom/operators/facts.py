"""From model responses to stored facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import ARTICLE_IDS
from ..functions.text import extraction_prompt, strip
from ..session import materialize
from .idjoin import pending_extraction
from .merge import add_links, assign_keys, replace_descriptors

# Accepted names of an entry's fields.
FIELD_ALIASES = {
    "dataset_id": (
        "dataset_id", "datasetid", "dataset", "dataset_accession", "dataset_identifier", "dataset_number", "accession",
        "accession_number", "accession_no", "accession_id", "identifier", "id", "data_id",
    ),
    "data_repository": (
        "data_repository", "repository", "repo", "database", "data_repo", "database_name", "repository_name",
        "source_repository", "data_source", "source",
    ),
    "url": ("url", "uri", "link", "web_link", "weblink", "hyperlink", "address"),
    "file": ("file", "filename", "file_name", "files", "file_path"),
    "evidence_text": ("evidence_text", "evidence", "evidence_quote", "quote", "supporting_text", "evidence_sentence"),
}
# Descriptor fields and the names each may have, best first.
DESCRIPTOR_ALIASES = {
    "biological_system": ("biological_system", "biological_system_cell_type", "cell_type"),
    "measured_compartment": ("measured_compartment", "compartment"),
    "species": ("species",),
    "perturbations": ("perturbations", "perturbations_contrasts", "contrasts"),
    "omics_assay": ("omics_assay", "omics", "assay"),
    "evidence_text": ("evidence_text",),
}
DESCRIPTOR_CONTENT = ("biological_system", "measured_compartment", "species", "perturbations", "omics_assay")
# Facts of one response are numbered inside the block of 2 ** POSITION_BITS that follows its seq.
POSITION_BITS = 20


def normalize_key(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def _canonical(key: Column) -> Column:
    pairs = [F.lit(x) for field, names in FIELD_ALIASES.items() for name in names for x in (name, field)]
    plain = normalize_key(key)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), plain), plain)


def canonical_entry(entry: Column) -> Column:
    """MAP with canonical field names; of colliding keys the first non-empty value wins.

    Built from the entry list: ``transform_keys`` would raise on keys that become equal.
    """
    pairs = F.transform(F.map_entries(entry), lambda e: F.struct(_canonical(e["key"]).alias("k"), e["value"].alias("v")))

    def value_of(name):
        values = F.transform(F.filter(pairs, lambda p: p["k"] == name), lambda p: p["v"])
        return F.coalesce(F.get(F.filter(values, lambda v: v != ""), 0), F.get(values, 0))

    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), value_of(n).alias("value"))))


def _items(text: Column, path: str) -> Column:
    """Elements of a JSON list as texts; objects keep their JSON form."""
    found = F.get_json_object(text, path)
    return F.from_json(F.when(F.startswith(found, F.lit("[")), found), "array<string>")


def _entry(item: Column) -> Column:
    return F.when(F.startswith(item, F.lit("{")), F.from_json(item, "map<string,string>"))


def parse_responses(
    df: DataFrame, json_col: str = "response", model: str | Column = "model", seq: str = "seq",
    ids: Sequence[str] = ARTICLE_IDS,
) -> dict[str, DataFrame]:
    """Fact rows per kind, and ``errors`` for responses that are not a JSON object.

    Each kind is one lazy frame over the responses; unused kinds cost nothing. ``seq`` orders
    facts as they appear.
    """
    model = F.lit(model) if isinstance(model, str) and model not in df.columns else (F.col(model) if isinstance(model, str) else model)
    text = F.col(json_col)
    base = df.select(*ids, F.col(seq).alias("_seq"), model.alias("model"), text.alias("_json"))
    json = F.col("_json")
    # The type is the outermost token of the schema text: OBJECT<...>, ARRAY<...>, STRING ...
    parsed = F.try_parse_json(json)
    kind = F.regexp_extract(F.schema_of_variant(parsed), "^[A-Z]+", 0)
    error = F.when(parsed.isNull(), "Invalid JSON response").when(
        kind != "OBJECT", F.concat(F.lit("Expected JSON object, got "), F.lower(kind))
    )
    judged = base.withColumn("error", error)
    errors = judged.where(F.col("error").isNotNull()).select(*ids, F.col("_seq").alias("seq"), "model", "error")
    good = judged.where(F.col("error").isNull()).drop("error")

    def listed(path):
        rows = good.select(*ids, "model", "_seq", F.posexplode(_items(json, path)).alias("_pos", "_item"))
        place = (F.shiftleft(F.col("_seq").cast("bigint"), POSITION_BITS) + F.col("_pos")).alias("seq")
        return rows.select(*ids, "model", place, "_item")

    keywords = listed("$.keywords").where(F.col("_item") != "").select(*ids, "model", "seq", F.col("_item").alias("keyword"))

    def data(path, fields):
        entry = listed(path).withColumn("_e", canonical_entry(_entry(F.col("_item")))).where(F.map_contains_key("_e", "dataset_id"))
        e = F.col("_e")
        text_fields = [F.coalesce(F.try_element_at(e, F.lit(f)), F.lit("")).alias(f) for f in ("dataset_id", "data_repository")]
        return entry.select(*ids, "model", "seq", *text_fields, *[F.try_element_at(e, F.lit(f)).alias(f) for f in fields])

    def plain(path, needed, fields):
        entry = listed(path).withColumn("_e", _entry(F.col("_item"))).where(F.map_contains_key("_e", needed))
        e = F.col("_e")
        return entry.select(*ids, "model", "seq", F.try_element_at(e, F.lit(needed)).alias(needed),
                            *[F.try_element_at(e, F.lit(f)).alias(f) for f in fields])

    found = F.get_json_object(json, "$.measurement_descriptor")
    first = F.get(F.filter(_items(json, "$.measurement_descriptor"), lambda i: F.startswith(i, F.lit("{"))), 0)
    e = F.col("_e")

    def field(names):
        return strip(F.coalesce(*[F.nullif(F.try_element_at(e, F.lit(n)), F.lit("")) for n in names]))

    descriptor = good.withColumn("_e", canonical_entry(_entry(F.when(F.startswith(found, F.lit("{")), found).otherwise(first))))
    descriptor = descriptor.where(e.isNotNull()).select(
        *ids, "model", F.col("_seq").alias("seq"), *[field(names).alias(f) for f, names in DESCRIPTOR_ALIASES.items()]
    )
    filled = F.coalesce(*[F.nullif(F.col(f), F.lit("")) for f in DESCRIPTOR_CONTENT]).isNotNull()
    return {
        "errors": errors,
        "keywords": keywords,
        "raw_data": data("$.raw_data", ("url", "evidence_text")),
        "processed_data": data("$.processed_data", ("url", "file", "evidence_text")),
        "analysis_methods": plain("$.analysis_methods", "method_name", ("method_description",)),
        "code": plain("$.code", "repository", ("url", "description")),
        "measurement_descriptor": descriptor.where(filled),
    }


# Where each kind of fact is stored and what makes it unique besides the article.
FACT_TABLES = {
    "raw_data": ("llm_raw_data", "dataset_id"),
    "processed_data": ("llm_processed_data", "dataset_id"),
    "analysis_methods": ("llm_analysis_methods", "method_name"),
    "code": ("llm_code", "repository"),
}


def store_facts(tables: dict[str, DataFrame], parsed: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The fact tables after storing parsed facts; facts already known for an article are ignored."""
    out = {}
    if "keywords" in parsed:
        words = parsed["keywords"].withColumn("keyword", strip(F.col("keyword"))).where(F.col("keyword") != "")
        out["llm_keywords"], assigned = assign_keys(
            tables["llm_keywords"], words.select("keyword", "model", "seq"), ["keyword", "model"], "llm_keyword_id"
        )
        links = words.join(assigned, ["keyword", "model"]).select(*ARTICLE_IDS, "llm_keyword_id", "seq")
        out["article_llm_keywords"] = add_links(tables["article_llm_keywords"], links, ["llm_keyword_id"])
    for kind, (table, key) in FACT_TABLES.items():
        if kind in parsed:
            rows = parsed[kind].where(F.coalesce(F.col(key), F.lit("")) != "")
            out[table] = add_links(tables[table], rows, [key, "model"])
    if "measurement_descriptor" in parsed:
        out["llm_measurement_descriptors"] = replace_descriptors(
            tables["llm_measurement_descriptors"], parsed["measurement_descriptor"]
        )
    return out


def extraction_requests(
    articles: DataFrame, texts: DataFrame, facts: Sequence[DataFrame], model: str, limit: int | None = None,
    sections: dict[str, str] | None = None, overwrite: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Prompts for articles that have text and no facts of ``model`` yet, and counters.

    ``texts`` is ``(path, text)``. ``failed`` counts articles whose file is not among the texts.
    """
    with_file = articles.where(F.col("article_filepath").isNotNull())
    if overwrite:
        chosen = with_file if limit is None else with_file.orderBy(*ARTICLE_IDS).limit(limit)
    else:
        # Both the requests and the counters need the pending set, so it is found and written once.
        columns = [*ARTICLE_IDS, "article_filepath", *(["created_at"] if "created_at" in articles.columns else [])]
        pending = materialize(pending_extraction(articles.select(*columns), facts, model))
        newest = [F.desc("created_at")] if "created_at" in articles.columns else []
        chosen = pending if limit is None else pending.orderBy(*newest, *ARTICLE_IDS).limit(limit)
    rows = chosen.join(texts.withColumnRenamed("path", "_path"), F.col("article_filepath") == F.col("_path"), "left")
    requests = rows.where(F.col("text").isNotNull()).select(
        *ARTICLE_IDS, F.lit(model).alias("model"), extraction_prompt(F.col("text"), sections).alias("prompt")
    )
    totals = articles.agg(
        F.count("*").alias("n_articles"), F.count_if(F.col("article_filepath").isNull()).alias("skipped_no_fulltext")
    )
    picked = rows.agg(F.count("*").alias("requested"), F.count_if(F.col("text").isNull()).alias("failed"))
    done = F.lit(0).cast("bigint") if overwrite else F.col("n_articles") - F.col("skipped_no_fulltext") - pending.agg(F.count("*")).scalar()
    counters = totals.select(
        "n_articles", "skipped_no_fulltext", done.alias("already_extracted"),
        picked.select("requested").scalar().alias("requested"), picked.select("failed").scalar().alias("failed"),
    )
    return requests, counters
