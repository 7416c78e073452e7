"""Dataset-repository JSON and text records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_day, pride_date
from ..functions.text import strip


def _field(json: Column, *names: str) -> Column:
    """First non-empty text among several member names."""
    return F.coalesce(*[F.nullif(F.get_json_object(json, f"$.{n}"), F.lit("")) for n in names])


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _list(json: Column, *names: str) -> Column:
    """First non-empty list among several member names, elements as texts, NULL elements dropped."""

    def listed(found):
        return _once(F.from_json(F.when(F.startswith(found, F.lit("[")), found), "array<string>"), lambda items: F.when(F.size(items) > 0, items))

    lists = [_once(F.get_json_object(json, f"$.{n}"), listed) for n in names]
    empty = F.expr("cast(array() as array<string>)")
    return F.filter(F.coalesce(*lists, empty), lambda x: x.isNotNull())


def _is_object(item: Column) -> Column:
    return F.startswith(item, F.lit("{"))


def _present(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull() & (x != ""))


def _names(items: Column, *keys: str) -> Column:
    return _present(F.transform(items, lambda i: F.when(_is_object(i), _field(i, *keys)).otherwise(i)))


def _first(items: Column, *keys: str) -> Column:
    return F.get(_present(F.transform(F.filter(items, _is_object), lambda i: _field(i, *keys))), 0)


def _order(df: DataFrame) -> list[Column]:
    """The order of records in a batch, kept where the input has it as ``seq``."""
    return [F.col("seq")] if "seq" in df.columns else []


def _dealt(df: DataFrame, partitions: int | None) -> DataFrame:
    """Rows dealt out over so many tasks, for inputs in few files: reading a record takes far longer than an exchange."""
    return df if partitions is None else df.repartition(partitions)


def pride_projects(df: DataFrame, json_col: str, id_col: str = "dataset_id", partitions: int | None = None) -> DataFrame:
    """PRIDE project records: both API versions' member names are understood."""
    df = _dealt(df, partitions)
    j = F.col(json_col)
    references = _list(j, "references", "publications")

    def date(name):
        raw = F.get_json_object(j, f"$.{name}")
        quoted = F.schema_of_variant(F.variant_get(F.try_parse_json(j), f"$.{name}", "variant")) == "STRING"
        return pride_date(raw, F.coalesce(~quoted, F.lit(False)) & raw.rlike("^-?[0-9]+$"))

    return df.select(
        F.col(id_col).alias("dataset_id"), F.get_json_object(j, "$.title").alias("title"),
        _field(j, "projectDescription", "description").alias("description"),
        _names(_list(j, "organisms", "species"), "name", "scientificName").alias("species"),
        _names(_list(j, "instruments", "instrumentNames"), "name", "cvLabel").alias("instruments"),
        date("submissionDate").alias("submission_date"), date("publicationDate").alias("publication_date"),
        _first(references, "doi").alias("doi"), _first(references, "pubmedId").alias("pmid"),
        _list(j, "keywords").alias("keywords"), F.lit("PRIDE").alias("repository"), *_order(df),
    )


def proxi_datasets(df: DataFrame, json_col: str, id_col: str = "dataset_id", partitions: int | None = None) -> DataFrame:
    """MassIVE records in the PROXI form."""
    j = F.col(json_col)
    order = _order(df)
    # Lists that are used twice are columns first, so that each is read once.
    df = _dealt(df, partitions).withColumns({"_instruments": _list(j, "instruments"), "_publications": _list(j, "publications")})
    nested = _list(j, "species")
    flat = F.flatten(F.transform(nested, lambda i: F.when(F.startswith(i, F.lit("[")), F.from_json(i, "array<string>")).otherwise(F.array(i))))
    scientific = F.transform(flat, lambda i: F.when(
        _is_object(i), F.when(F.get_json_object(i, "$.name") == "taxonomy: scientific name", F.get_json_object(i, "$.value"))).otherwise(i))
    instruments, publications = F.col("_instruments"), F.col("_publications")
    objects = F.filter(instruments, _is_object)
    named = F.transform(objects, lambda i: F.coalesce(F.get_json_object(i, "$.name"), F.get_json_object(i, "$.accession"), i))
    accessions = F.transform(F.filter(_list(j, "identifiers"), _is_object), lambda i: F.get_json_object(i, "$.accession"))
    return df.select(
        F.col(id_col).alias("dataset_id"), F.get_json_object(j, "$.title").alias("title"),
        F.get_json_object(j, "$.summary").alias("description"), F.array_distinct(_present(scientific)).alias("species"),
        F.when(F.size(objects) > 0, named).otherwise(_present(instruments)).alias("instruments"),
        iso_day(_field(j, "submissionDate", "submission_date")).alias("submission_date"),
        iso_day(_field(j, "publicationDate", "publication_date")).alias("publication_date"),
        _first(publications, "doi").alias("doi"), _first(publications, "pubmedId", "pmid").alias("pmid"),
        F.get(F.filter(accessions, lambda a: F.startswith(a, F.lit("PXD"))), 0).alias("pxd_id"), F.lit("MassIVE").alias("repository"), *order,
    )


def geo_series(df: DataFrame, json_col: str, id_col: str = "dataset_id", partitions: int | None = None) -> DataFrame:
    """GEO summary records."""
    df = _dealt(df, partitions)
    j = F.col(json_col)
    taxon = F.get_json_object(j, "$.taxon")
    listed = F.from_json(F.when(F.startswith(taxon, F.lit("[")), taxon), "array<string>")
    empty = F.expr("cast(array() as array<string>)")
    return df.select(
        F.col(id_col).alias("dataset_id"), F.get_json_object(j, "$.title").alias("title"),
        F.get_json_object(j, "$.summary").alias("description"), F.get_json_object(j, "$.gpl").alias("platform"),
        F.get_json_object(j, "$.n_samples").try_cast("bigint").alias("n_samples"),
        F.coalesce(listed, F.when(taxon != "", F.array(taxon)), empty).alias("species"),
        F.replace(F.get_json_object(j, "$.pdat"), F.lit("/"), F.lit("-")).try_cast("date").alias("publication_date"),
        F.lit("GEO").alias("repository"), *_order(df),
    )


def iprox_datasets(df: DataFrame, id_col: str = "dataset_id") -> DataFrame:
    """iProX offers no metadata: only the id and the repository are known."""
    return df.select(F.col(id_col).alias("dataset_id"), F.lit("iProX").alias("repository"), *_order(df))


def repo_file_list(df: DataFrame, json_col: str, kind: str, id_col: str = "dataset_id") -> DataFrame:
    """Files of a repository's file-list answer, one row each: ``pride`` or ``iprox``."""
    j = F.col(json_col)
    top = F.from_json(F.when(F.startswith(strip(j), F.lit("[")), j), "array<string>")
    if kind == "pride":
        items = F.coalesce(top, _list(j, "_embedded.files"))
    elif kind == "iprox":
        data = F.filter(_list(j, "data"), _is_object)

        def expand(i):
            bare = F.get_json_object(i, "$.fileName").isNotNull() | F.get_json_object(i, "$.downloadUrl").isNotNull()
            empty = F.expr("cast(array() as array<string>)")
            return F.when(F.get_json_object(i, "$.files").isNotNull(), _list(i, "files")).when(bare, F.array(i)).otherwise(empty)

        items = F.coalesce(top, F.flatten(F.transform(data, expand)))
    else:
        raise ValueError(f"unknown file list kind: {kind}")
    f = F.col("_item")
    return df.select(F.col(id_col).alias("dataset_id"), F.posexplode(items).alias("file_no", "_item")).where(_is_object(f)).select(
        "dataset_id", "file_no", F.coalesce(F.get_json_object(f, "$.fileName"), F.lit("")).alias("filename"),
        _field(f, "fileCategory", "fileType").alias("file_type"),
        F.coalesce(F.get_json_object(f, "$.fileSizeBytes").try_cast("bigint"), F.lit(0)).alias("size_bytes"),
        F.get_json_object(f, "$.checksum").alias("checksum"), F.get_json_object(f, "$.downloadUrl").alias("url"),
    )


def soft_sample_ids(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Sample ids named by the ``!Series_sample_id`` lines of a SOFT file, duplicates kept."""
    found = F.regexp_extract(F.col(line_col), r"=\s*(GSM[0-9]+)", 1)
    lines = df.where(F.startswith(F.col(line_col), F.lit("!Series_sample_id")))
    return lines.withColumn("sample_id", found).where(F.col("sample_id") != "").drop(line_col)


def crossref_snapshot(df: DataFrame, json_col: str, doi_col: str = "doi") -> DataFrame:
    """Title and dates of CrossRef answers; ``issued`` counts as print date when nothing else is known."""
    from ..functions.dates import crossref_date

    j = F.col(json_col)

    def date(name):
        return crossref_date(F.from_json(F.get_json_object(j, f"$.message.{name}.date-parts"), "array<array<int>>"))

    printed, online = date("published-print"), date("published-online")
    return df.select(
        F.col(doi_col).alias("doi"), F.get(_list(j, "message.title"), 0).alias("title"),
        F.when(printed.isNull() & online.isNull(), date("issued")).otherwise(printed).alias("publication_date"),
        online.alias("electronic_publication_date"), F.when(F.try_parse_json(j).isNull(), "Invalid JSON response").alias("error"),
    )
