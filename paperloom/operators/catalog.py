"""Catalogue and classification of dataset files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.files import CATEGORIES, DATASET_ARCHIVE_ENDINGS, base_name, file_category
from .ranking import lookup, number_rows


def filename_batches(df: DataFrame, seq: str, size: int = 50, by: str = "dataset_id") -> DataFrame:
    """Add ``batch``: 0-based number of the group of ``size`` files a file is sent with."""
    numbered = number_rows(df, seq, [by], "_no")
    return numbered.withColumn("batch", F.floor((F.col("_no") - 1) / size)).drop("_no")


def catalog_files(listing: DataFrame, labels: DataFrame | None = None, filename: str = "filename", by: str = "dataset_id") -> DataFrame:
    """Add ``file_type, file_type_reason, method, model`` to a file listing.

    Rules come first. ``labels(dataset_id, filename, category, reason, model)`` is the answer
    of an external classifier and is used where the rules leave a file unknown; a category
    that does not exist becomes ``unknown``.
    """
    rows = listing.withColumn("_rule", file_category(F.col(filename)))
    rule = F.col("_rule")
    if labels is None:
        return rows.select(
            *[F.col(f"`{c}`") for c in listing.columns], rule["category"].alias("file_type"),
            rule["reason"].alias("file_type_reason"), F.lit("heuristic").alias("method"), F.lit(None).cast("string").alias("model"),
        )
    given = labels.select(
        F.col(by).alias("_by"), F.col("filename").alias("_file"),
        F.struct(
            F.when(F.col("category").isin(*CATEGORIES), F.col("category")).otherwise("unknown").alias("category"),
            F.coalesce(F.nullif("reason", F.lit("")), F.lit("LLM classification")).alias("reason"),
            F.col("model").alias("model"),
        ).alias("_label"),
    )
    open_name = F.when(rule["category"] == "unknown", F.col(filename))
    joined = rows.join(given, (F.col(by) == F.col("_by")) & (open_name == F.col("_file")), "left")
    label = F.when(F.col("_label")["category"] != "unknown", F.col("_label"))
    asked = rule["category"] == "unknown"
    return joined.select(
        *[F.col(f"`{c}`") for c in listing.columns],
        F.coalesce(label["category"], rule["category"]).alias("file_type"),
        F.coalesce(label["reason"], F.when(asked, F.lit("Could not classify by heuristics or LLM")), rule["reason"]).alias("file_type_reason"),
        F.when(label.isNotNull(), "shallow_llm").otherwise("heuristic").alias("method"),
        label["model"].alias("model"),
    )


def catalog_counters(catalogued: DataFrame) -> DataFrame:
    known = F.col("file_type") != "unknown"
    return catalogued.agg(
        F.count("*").alias("total_files"),
        F.count_if(known & (F.col("method") == "heuristic")).alias("heuristic_classified"),
        F.count_if(known & (F.col("method") == "shallow_llm")).alias("shallow_llm_classified"),
        F.count_if(~known).alias("unknown"),
    )


def classification_summary(catalogued: DataFrame) -> DataFrame:
    """``(kind, name, n)``: files by method (unknown ones as ``unknown``) and by category, in one pass."""
    method = F.when(F.col("file_type") == "unknown", "unknown").otherwise(F.col("method"))
    rows = catalogued.select(method.alias("method"), F.col("file_type").alias("category"))
    grouped = rows.groupingSets([["method"], ["category"]], "method", "category").agg(
        F.grouping("category").alias("_by_method"), F.count("*").alias("n")
    )
    by_method = F.col("_by_method") == 1
    return grouped.select(
        F.when(by_method, "by_method").otherwise("by_category").alias("kind"),
        F.when(by_method, F.col("method")).otherwise(F.col("category")).alias("name"), "n",
    )


def size_totals(files: DataFrame, by: str = "dataset_id", size: str = "size_bytes") -> DataFrame:
    """Files, bytes and whole megabytes (half to even) per group. The files themselves stay rows."""
    total = F.coalesce(F.sum(size), F.lit(0)).cast("bigint")
    return files.groupBy(by).agg(
        F.count("*").alias("file_count"), total.alias("total_size_bytes"),
        F.bround(total / F.lit(1048576.0)).cast("bigint").alias("size_mb"),
    )


def dataset_availability(ids: DataFrame, listing: DataFrame) -> DataFrame:
    """Where each dataset is found: ``ids(dataset_id)`` against ``listing(path, is_dir)`` of one folder.

    A directory beats archives; archive endings are tried in a fixed order.
    """
    name = base_name(F.col("path"))
    choices = [F.struct(F.lit(0).alias("rank"), name.alias("id"), F.lit(None).cast("string").alias("ending"), F.col("is_dir").alias("fits"))]
    for rank, ending in enumerate(DATASET_ARCHIVE_ENDINGS, 1):
        stem = F.substr(name, F.lit(1), F.char_length(name) - len(ending))
        fits = ~F.col("is_dir") & F.endswith(name, F.lit(ending))
        choices.append(F.struct(F.lit(rank).alias("rank"), stem.alias("id"), F.lit(ending).alias("ending"), fits.alias("fits")))
    options = listing.select("path", F.explode(F.array(*choices)).alias("c")).where(F.col("c.fits"))
    best = options.groupBy(F.col("c.id").alias("_id")).agg(F.min(F.struct("c.rank", "path", "c.ending")).alias("_b"))
    b = F.col("_b")
    return ids.select("dataset_id").join(best, F.col("dataset_id") == F.col("_id"), "left").select(
        "dataset_id", b.isNotNull().alias("exists"), b["path"].alias("path"),
        F.coalesce(b["rank"] == 0, F.lit(False)).alias("is_directory"), F.coalesce(b["rank"] > 0, F.lit(False)).alias("is_archive"),
        b["ending"].alias("archive_format"), F.when(F.col("dataset_id") == "", "dataset_id cannot be empty").alias("error"),
    )


def full_text(ids: DataFrame, articles: DataFrame, texts: DataFrame) -> DataFrame:
    """Text and status per identifier: ``ids(identifier)``, ``texts(path, text)``.

    Identifiers of one type can only match that column, so this is one equi-join on
    (type, value).
    """
    from ..functions.ids import id_type
    from ..functions.text import strip

    value = strip(F.col("identifier"))
    kind = id_type(value)
    asked = ids.select(value.alias("identifier"), kind.alias("id_type"),
                       F.when(kind == "pmcid", F.upper(value)).otherwise(value).alias("_value"))
    stored = articles.select(
        "article_filepath",
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("v")) for k in ("doi", "pmid", "pmcid")])).alias("_e"),
    ).where(F.col("_e.v").isNotNull()).select(F.col("_e.k").alias("_k"), F.col("_e.v").alias("_v"), "article_filepath", F.lit(True).alias("_known"))
    rows = asked.join(stored, (F.col("id_type") == F.col("_k")) & (F.col("_value") == F.col("_v")), "left")
    # Articles without a path, and identifiers without an article, are spread.
    rows = lookup(rows, texts.select(F.col("path").alias("_path"), "text"), F.col("article_filepath"), "_path")
    status = (
        F.when(F.col("_known").isNull(), "not_found")
        .when(F.coalesce(F.col("article_filepath"), F.lit("")) == "", "no_filepath")
        .when(F.col("text").isNull(), "file_read_error")
        .otherwise("found")
    )
    error = (
        # The error of each status.
        F.when(status == "not_found", "Article not found in database")
        .when(status == "no_filepath", "Article has no downloaded full text")
        .when(status == "file_read_error", F.concat(F.lit("File not found: "), F.col("article_filepath")))
    )
    return rows.select("identifier", "id_type", status.alias("status"), error.alias("error"), "text")


def full_text_counters(result: DataFrame) -> DataFrame:
    """``found`` counts every article in the store, with or without text."""
    s = F.col("status")
    return result.agg(
        F.count_if(s != "not_found").alias("found"), F.count_if(s == "not_found").alias("not_found"),
        F.count_if(s == "no_filepath").alias("no_filepath"), F.count_if(s == "file_read_error").alias("file_read_errors"),
    )
