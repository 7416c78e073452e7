"""Identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

ARTICLE_IDS = ("doi", "pmid", "pmcid")


def id_type(c: Column) -> Column:
    """``pmcid``, ``doi`` or ``pmid`` by the shape of the text; ``doi`` when in doubt."""
    text = strip(c)
    return (
        F.when(text.rlike(r"(?i)^PMC[0-9]+$"), "pmcid")
        .when(F.contains(text, F.lit("/")) | F.startswith(text, F.lit("10.")), "doi")
        .when(text.rlike(r"^[0-9]+$"), "pmid")
        .when(text.isNotNull(), "doi")
    )


# Accession shape, name and description per repository.
ACCESSIONS = {
    "gse": (r"^GSE[0-9]+$", "GEO Series", "GSE followed by digits (e.g., GSE12345)"),
    "msv": (r"^MSV[0-9]{9}$", "MassIVE", "MSV followed by 9 digits (e.g., MSV000092832)"),
    "ipx": (r"^IPX[0-9]{10}$", "iProX", "IPX followed by 10 digits (e.g., IPX0001234000)"),
}


def accession(c: Column, kind: str) -> Column:
    """``struct(id, error)``: trimmed upper-case accession, or the reason it is not one."""
    pattern, label, expected = ACCESSIONS[kind]
    value = F.upper(strip(c))
    message = F.concat(F.lit(f"Invalid {label} ID format: "), value, F.lit(f". Expected format: {expected}"))
    return F.struct(value.alias("id"), F.when(~value.rlike(pattern), message).alias("error"))


def geo_dir(c: Column) -> Column:
    """Server folder of a GEO series: the last three digits become ``nnn``."""
    digits = F.substr(c, F.lit(4))
    stem = F.regexp_replace(digits, r"^(.*?).{0,3}$", "$1")
    return F.concat(F.lit("/geo/series/GSE"), stem, F.lit("nnn/"), c)


# Fixed value: public folder of the reference proteomes.
PROTEOME_BASE = (
    "https://ftp.uniprot.org/pub/databases/uniprot/current_release/knowledgebase/reference_proteomes"
)


def proteome_url(proteome_id: Column, tax_id: Column, superregnum: Column) -> Column:
    folder = F.concat(F.upper(F.substring(superregnum, 1, 1)), F.lower(F.substr(superregnum, F.lit(2))))
    name = F.concat(proteome_id, F.lit("_"), tax_id.cast("string"), F.lit(".fasta.gz"))
    return F.concat_ws("/", F.lit(PROTEOME_BASE), folder, proteome_id, name)


def orcid(c: Column) -> Column:
    """Bare ORCID; a full address is reduced to its last path part."""
    return F.when(F.startswith(c, F.lit("http")), F.element_at(F.split(c, "/"), -1)).otherwise(c)


def as_id(c: Column) -> Column:
    return c.cast("string")


def _given(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def article_key(doi: Column, pmid: Column, pmcid: Column, typed: bool = False) -> Column:
    """First identifier present; ``typed`` gives the ``article:doi:...`` form."""
    if not typed:
        return F.coalesce(_given(doi), _given(pmid), _given(pmcid))
    return F.coalesce(
        F.concat(F.lit("article:doi:"), _given(doi)),
        F.concat(F.lit("article:pmid:"), _given(pmid)),
        F.concat(F.lit("article:pmcid:"), _given(pmcid)),
    )
