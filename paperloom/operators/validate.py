"""Metadata validation and constraint reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import normalize_title, similar_normalized
from .ranking import lookup


def validate_articles(articles: DataFrame, crossref: DataFrame, pubmed: DataFrame, threshold: float = 0.85) -> DataFrame:
    """One row per article with the match flags, the ``issues`` found and ``is_valid``.

    ``crossref`` has one row per doi, ``pubmed`` one per requested pmid, each with title,
    print and electronic date and ``error``. Articles without a doi (pmid and pmcid) are not
    checked against that source; a row missing from a snapshot is a failed lookup.
    """
    fields = ["title", "publication_date", "electronic_publication_date", "error"]

    def snapshot(df, key, name, extra=()):
        row = F.struct(*[F.col(c).alias(c) for c in (*fields, *extra)], normalize_title(F.col("title")).alias("norm"))
        return df.where(F.col(key).isNotNull()).select(F.col(key).alias(f"_{name}_id"), row.alias(f"_{name}"))

    by_pmid = pubmed if "requested_pmid" in pubmed.columns else pubmed.withColumn("requested_pmid", F.col("pmid"))
    rows = articles.withColumn("_norm", normalize_title(F.col("title")))
    pubmed_id = F.coalesce("pmid", "pmcid")
    rows = lookup(rows, snapshot(crossref, "doi", "c"), F.col("doi"), "_c_id")
    asked_as = by_pmid.withColumn("requested_pmid", F.coalesce("requested_pmid", "pmcid"))
    rows = lookup(rows, snapshot(asked_as, "requested_pmid", "p", ("doi",)), pubmed_id, "_p_id")

    def source(name, label, word, asked):
        s = F.col(f"_{name}")
        failed = F.when(asked, F.when(s.isNull(), F.lit("not in snapshot")).otherwise(s["error"]))
        usable = asked & failed.isNull()

        def both(a, b, empty=False):
            given = a.isNotNull() & b.isNotNull()
            return usable & (given & (a != "") & (b != "") if empty else given)

        title_ok = F.when(both(F.col("title"), s["title"], True), similar_normalized(F.col("_norm"), s["norm"], threshold))
        date_ok = F.when(both(F.col("publication_date"), s["publication_date"]), F.col("publication_date") == s["publication_date"])
        e_ok = F.when(
            both(F.col("electronic_publication_date"), s["electronic_publication_date"]),
            F.col("electronic_publication_date") == s["electronic_publication_date"],
        )

        def date_issue(ok, kind, column):
            return F.when(~ok, F.concat(F.lit(f"{kind} date mismatch with {label}: stored="), F.col(column).cast("string"),
                                        F.lit(f" vs {word}="), s[column].cast("string")))

        # The texts of all issues, here and below.
        issues = [
            F.when(failed.isNotNull(), F.concat(F.lit(f"{label} lookup failed: "), failed)),
            F.when(~title_ok, F.concat(F.lit(f"Title mismatch with {label}: stored='"), F.col("title"),
                                       F.lit(f"' vs {word}='"), s["title"], F.lit("'"))),
            date_issue(date_ok, "Print", "publication_date"),
            date_issue(e_ok, "Electronic", "electronic_publication_date"),
        ]
        return usable, title_ok, date_ok, e_ok, issues

    has_doi = F.coalesce(F.col("doi") != "", F.lit(False))
    has_pm = F.coalesce(pubmed_id != "", F.lit(False))
    c_ok, c_title, c_date, c_edate, c_issues = source("c", "CrossRef", "crossref", has_doi)
    p_ok, p_title, p_date, p_edate, p_issues = source("p", "PubMed", "pubmed", has_pm)
    c, p = F.col("_c"), F.col("_p")
    two = F.coalesce(c_ok & p_ok, F.lit(False))
    titled = two & (F.coalesce(c["title"], F.lit("")) != "") & (F.coalesce(p["title"], F.lit("")) != "")
    agree = F.when(titled, similar_normalized(c["norm"], p["norm"], threshold))
    same_doi = F.when(two & (p["doi"] != ""), F.lower("doi") == F.lower(p["doi"]))
    cross = [
        F.when(~agree, F.concat(F.lit("IDs point to different articles: CrossRef title='"), c["title"],
                                F.lit("' vs PubMed title='"), p["title"], F.lit("'"))),
        F.when(~same_doi, F.concat(F.lit("DOI mismatch: provided="), F.col("doi"), F.lit(" vs PubMed extracted="), p["doi"])),
    ]
    issues = F.filter(F.array(*c_issues, *p_issues, *cross), lambda i: i.isNotNull())
    checked = rows.select(
        "doi", "pmid", "pmcid", c_title.alias("title_matches_crossref"), p_title.alias("title_matches_pubmed"),
        c_date.alias("date_matches_crossref"), p_date.alias("date_matches_pubmed"),
        c_edate.alias("electronic_date_matches_crossref"), p_edate.alias("electronic_date_matches_pubmed"),
        F.when(~agree | ~same_doi, False).when(agree, True).alias("ids_consistent"), issues.alias("issues"),
    )
    return checked.withColumn("is_valid", F.size("issues") == 0)


def validation_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_articles"), F.count_if("is_valid").alias("valid_articles"),
        F.count_if(~F.col("is_valid")).alias("invalid_articles"),
    )


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of UNIQUE, CHECK and foreign keys: ``(table_name, kind, constraint_columns, key, n)``.

    Only constraints whose tables and columns are given are tested.
    """
    parts = []

    def report(df, table, kind, columns, key, n):
        parts.append(df.select(F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), F.lit(",".join(columns)).alias("constraint_columns"),
                               key.alias("key"), n.cast("bigint").alias("n")))

    for table, df in tables.items():
        for columns in schemas.UNIQUE.get(table, []):
            if set(columns) <= set(df.columns):
                present = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
                repeated = present.groupBy(*columns).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
                report(repeated, table, "unique", columns, F.concat_ws("|", *[F.col(c).cast("string") for c in columns]), F.col("_n"))
        for column, allowed in schemas.CHECKS.get(table, {}).items():
            if column in df.columns:
                bad = df.where(~F.col(column).isin(*allowed)).groupBy(column).agg(F.count("*").alias("_n"))
                report(bad, table, "check", [column], F.col(column), F.col("_n"))
    for (table, column), (parent, key) in schemas.FOREIGN_KEYS.items():
        if table in tables and parent in tables and column in tables[table].columns and key in tables[parent].columns:
            # Counting first leaves one row per value, so a frequent value cannot fill one join task.
            values = tables[table].where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
            known = tables[parent].where(F.col(key).isNotNull()).select(F.col(key).alias(column)).distinct()
            orphan = values.join(known, column, "left_anti")
            report(orphan, table, "foreign_key", [column], F.col(column).cast("string"), F.col("_n"))
    return reduce(DataFrame.unionByName, parts)
