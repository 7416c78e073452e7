"""Equality getters over stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_where(df: DataFrame, eq: dict | None = None, order: Sequence[Column | str] = (), limit: int | None = None) -> DataFrame:
    """Rows equal to every given value; absent (None) conditions are skipped."""
    for name, value in (eq or {}).items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    if order:
        df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)


def _newest() -> list[Column]:
    return [F.desc("created_at"), F.desc("id")]


def quantification_runs(t, dataset_id=None, tool=None, run_id=None, limit=None):
    return select_where(t, {"dataset_id": dataset_id, "tool": tool, "id": run_id}, _newest(), limit)


def analysis_runs(t, quant_run=None, type=None, run_id=None, limit=None):
    return select_where(t, {"quantification_run_id": quant_run, "analysis_type": type, "id": run_id}, _newest(), limit)


def dep_results(t, run_id, significant_only=False, limit=None):
    eq = {"analysis_run_id": run_id, "significant": True if significant_only else None}
    return select_where(t, eq, [F.asc_nulls_last("padj"), F.asc("id")], limit)


def benchmark_annotations(t, limit=None, **eq):
    return select_where(t, eq, _newest(), limit)


def benchmark_predictions(t, limit=None, **eq):
    return select_where(t, eq, _newest(), limit)


def relevance_scores(t, limit=None, **eq):
    return select_where(t, eq, _newest(), limit)


def supplemental_classes(t, **eq):
    return select_where(t, eq, ["file_path"])


def has_supplemental_class(t, archive_path):
    return select_where(t, {"archive_path": archive_path}).limit(1).agg((F.count("*") > 0).alias("found"))


def _any_id(df, doi, pmid, pmcid):
    given = {"doi": doi, "pmid": pmid, "pmcid": pmcid}
    tests = [F.col(k) == v for k, v in given.items() if v]
    return df.where(reduce(lambda a, b: a | b, tests) if tests else F.lit(False))


def dataset_by_id(t, dataset_id):
    return select_where(t, {"dataset_id": dataset_id})


def datasets_of(t, doi=None, pmid=None, pmcid=None):
    """Datasets that carry any of the given identifiers; none given, none returned."""
    return _any_id(t, doi, pmid, pmcid).orderBy(F.desc("submission_date"), "dataset_id")


def dataset_files(t, dataset_id, file_type=None):
    return select_where(t, {"dataset_id": dataset_id, "file_type": file_type}, ["filename"])


def without_dataset_files(t, dataset_id):
    """The table after deleting one dataset's files."""
    return t.where(~F.coalesce(F.col("dataset_id") == dataset_id, F.lit(False)))


def extractions_of(t, doi=None, pmid=None, pmcid=None, model=None, limit=None):
    rows = _any_id(t, doi, pmid, pmcid)
    return select_where(rows, {"model": model}, _newest(), limit)


def extraction_by_id(t, extraction_id):
    return select_where(t, {"id": extraction_id})


def with_fulltext(articles, limit=None):
    rows = articles.where(F.col("article_filepath").isNotNull())
    return select_where(rows, None, [F.desc("created_at"), "doi", "pmid", "pmcid"], limit)


def article_by(t, **one_id):
    return select_where(t, one_id)


def embedding_by(t, **one_id):
    return select_where(t, one_id).select("embedding")


# Columns the proteome index may be queried by.
PROTEOME_COLUMNS = ("proteome_id", "tax_id", "oscode", "superregnum", "species_name")


def proteomes(t, **eq):
    """Proteome index by equality, species name by case-blind substring."""
    unknown = set(eq) - set(PROTEOME_COLUMNS)
    if unknown:
        raise ValueError(f"Invalid query columns: {sorted(unknown)}. Valid columns are: {list(PROTEOME_COLUMNS)}")
    given = {k: v for k, v in eq.items() if v is not None}
    if not given:
        raise ValueError("At least one non-None query parameter must be provided")
    species = given.pop("species_name", None)
    rows = select_where(t, given)
    if species is not None:
        rows = rows.where(F.col("species_name").ilike(f"%{species}%"))
    return rows.withColumn("oscode", F.nullif(F.col("oscode"), F.lit("None")))


def latest_descriptor(t, model=None, keys=("doi", "pmid", "pmcid")):
    """Newest descriptor per article (and of one model, if given); ties go to the higher id."""
    rows = select_where(t, {"model": model})
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("created_at", "id")).alias("_row"))
    return newest.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
