"""File name, archive and repository address expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: extensions and name patterns per file category ----
RAW_EXTENSIONS = (
    ".raw", ".mzml", ".mzxml", ".wiff", ".wiff2", ".d", ".mgf", ".mzid",
    ".fastq", ".fq", ".fastq.gz", ".fq.gz", ".bam", ".sam", ".cram", ".bcf", ".vcf", ".vcf.gz",
    ".sra", ".ab1",
)
INSTRUMENT_EXTENSIONS = (
    ".method", ".m", ".wiff.scan", ".instmethod", ".acqmethod", ".tune", ".cal", ".meth", ".prm", ".acq",
    ".qmethod", ".exp",
)
TABULAR_EXTENSIONS = (".xlsx", ".xls", ".csv", ".tsv", ".txt", ".parquet", ".h5", ".hdf5")
SUMMARY_EXTENSIONS = (
    ".pdf", ".doc", ".docx", ".pptx", ".ppt", ".png", ".jpg", ".jpeg", ".tif", ".tiff", ".svg", ".eps", ".html",
)
PROCESSING_EXTENSIONS = (
    ".params", ".config", ".ini", ".cfg", ".json", ".yaml", ".yml", ".xml", ".toml", ".fasta", ".fa", ".sptxt",
    ".msp", ".blib", ".dlib", ".pepxml", ".protxml", ".pep.xml", ".prot.xml",
)
AMBIGUOUS_EXTENSIONS = (".json", ".xml", ".yaml", ".yml")
RAW_PATTERNS = ("raw", "_raw", "instrument", ".d/")
INSTRUMENT_PATTERNS = (
    "method", "acquisition", "tune", "calibration", "acqmethod", "instmethod", "_settings", "instrument_",
)
QUANTITATIVE_PATTERNS = (
    "abundance", "quantification", "expression", "counts", "intensity", "ratio", "protein", "peptide", "gene",
    "transcript", "metabolite", "peak_area", "normalized", "matrix", "quant", "fpkm", "tpm", "rpkm", "lfq",
)
SUMMARY_PATTERNS = ("supplementary", "figure", "table", "result", "summary", "report", "visualization")
PROCESSING_PATTERNS = (
    "parameters", "config", "library", "reference", "database", "fasta", "spectral", "search_", "_search",
    "pipeline", "workflow", "analysis_",
)
CATEGORIES = (
    "raw_data", "instrument_parameters", "quantitative_data", "summary", "processing_parameters", "unknown",
)
# The rules in their order: what is found, the category, and the reason with what was found.
CATEGORY_RULES = (
    ("raw_extension", "raw_data", "Extension {joined} indicates raw instrument data"),
    ("d_folder", "raw_data", "Agilent/Bruker .d directory indicates raw instrument data"),
    ("instrument_extension", "instrument_parameters", "Extension {joined} indicates instrument parameters"),
    ("instrument_name", "instrument_parameters", "Filename contains '{instrument}' indicating instrument parameters"),
    ("summary_extension", "summary", "Extension {last} indicates summary/figure file"),
    ("ambiguous_with_processing_name", "processing_parameters", "Extension {last} with '{processing}' indicates processing parameters"),
    ("processing_extension", "processing_parameters", "Extension {last} indicates processing parameters"),
    ("table_with_quantitative_name", "quantitative_data", "Extension {last} with '{quantitative}' indicates quantitative data"),
    ("table_with_summary_name", "summary", "Extension {last} with '{summary}' indicates summary data"),
    ("raw_name", "raw_data", "Filename contains '{raw}' indicating raw data"),
    ("summary_name", "summary", "Filename contains '{summary}'"),
    ("any_name", "unknown", "Could not classify by heuristics"),
)
# Name stored for each category.
STORED_CATEGORIES = {
    "raw_data": "raw_data",
    "quantitative_data": "quantitative_data",
    "summary": "summary_data",
    "instrument_parameters": "supporting",
    "processing_parameters": "supporting",
    "unknown": "unknown",
}
# Marks and endings of supplemental files.
SUPPLEMENT_MARKS = ("supp", "supplement", "si_", "s1_", "s2_", "s3_", "s4_")
SUPPLEMENT_ENDINGS = (".pdf", ".xlsx", ".xls", ".csv", ".zip", ".doc", ".docx")
# Archive endings, longest first where one ends with another.
ARCHIVE_ENDINGS = ("zip", "tar.gz", "tgz", "tar")
# Endings tried, in this order, when a dataset is looked for as an archive.
DATASET_ARCHIVE_ENDINGS = (".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tbz2", ".zip", ".7z")
# Code hosts and their repository address shapes.
CODE_HOSTS = {
    "github": r"(?i)^(?:https?://)?(?:www\.)?github\.com/([^/]+)/([^/]+?)(?:\.git)?/?$",
    "bitbucket": r"(?i)^(?:https?://)?(?:www\.)?bitbucket\.org/([^/]+)/([^/]+?)(?:\.git)?/?$",
    "gitlab": r"(?i)^(?:https?://)?(?:www\.)?gitlab\.com/([^/]+)/([^/]+?)(?:\.git)?/?$",
}


def archive_type(c: Column) -> Column:
    """``zip``, ``tar.gz``, ``tgz``, ``tar`` or NULL."""
    name = F.lower(c)
    return F.coalesce(*[F.when(F.endswith(name, F.lit(f".{e}")), e) for e in ARCHIVE_ENDINGS])


def is_supplemental(c: Column) -> Column:
    name = F.lower(c)
    tests = [F.contains(name, F.lit(m)) for m in SUPPLEMENT_MARKS]
    tests += [F.endswith(name, F.lit(e)) for e in SUPPLEMENT_ENDINGS]
    return reduce(lambda a, b: a | b, tests)


def base_name(c: Column) -> Column:
    return F.regexp_extract(c, r"([^/]*)/*$", 1)


def suffixes(c: Column) -> tuple[Column, Column]:
    """All suffixes joined (``.tar.gz``) and the last one (``.gz``) of a lower-case path."""
    stem = F.regexp_replace(base_name(c), r"^\.+", "")
    return (
        F.when(F.endswith(stem, F.lit(".")), "").otherwise(F.regexp_extract(stem, r"^[^.]*(\..*)$", 1)),
        F.when(F.endswith(stem, F.lit(".")), "").otherwise(F.regexp_extract(stem, r"(\.[^.]*)$", 1)),
    )


def _first_pattern(name: Column, patterns: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.when(F.contains(name, F.lit(p)), p) for p in patterns])


def file_category(c: Column) -> Column:
    """``struct(category, reason)`` by extension and name; the first of CATEGORY_RULES that fits decides."""
    name = F.lower(c)
    joined, last = suffixes(name)
    patterns = {
        "instrument": INSTRUMENT_PATTERNS, "processing": PROCESSING_PATTERNS, "quantitative": QUANTITATIVE_PATTERNS,
        "summary": SUMMARY_PATTERNS, "raw": RAW_PATTERNS,
    }
    words = {"joined": joined, "last": last, **{kind: _first_pattern(name, p) for kind, p in patterns.items()}}
    named = {kind: words[kind].isNotNull() for kind in patterns}
    table, ambiguous = last.isin(*TABULAR_EXTENSIONS), last.isin(*AMBIGUOUS_EXTENSIONS)
    found = {
        "raw_extension": last.isin(*RAW_EXTENSIONS) | joined.isin(*RAW_EXTENSIONS),
        "d_folder": F.contains(name, F.lit(".d/")) | F.endswith(name, F.lit(".d")),
        "instrument_extension": last.isin(*INSTRUMENT_EXTENSIONS) | joined.isin(*INSTRUMENT_EXTENSIONS),
        "instrument_name": named["instrument"] & ~last.isin(*TABULAR_EXTENSIONS, *SUMMARY_EXTENSIONS),
        "summary_extension": last.isin(*SUMMARY_EXTENSIONS),
        "ambiguous_with_processing_name": ambiguous & named["processing"],
        "processing_extension": last.isin(*PROCESSING_EXTENSIONS) & ~ambiguous,
        "table_with_quantitative_name": table & named["quantitative"],
        "table_with_summary_name": table & named["summary"],
        "raw_name": named["raw"],
        "summary_name": named["summary"],
        "any_name": c.isNotNull(),
    }

    def reason(form: str) -> Column:
        return F.concat(*[words[part] if at % 2 else F.lit(part) for at, part in enumerate(re.split(r"[{}]", form)) if part])

    rules = [F.when(found[test], F.struct(F.lit(category).alias("category"), reason(form).alias("reason"))) for test, category, form in CATEGORY_RULES]
    return F.coalesce(*rules)


def stored_category(c: Column) -> Column:
    """Category name as stored. Two stored names are outside the table's CHECK list; both are kept."""
    pairs = [F.lit(x) for pair in STORED_CATEGORIES.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit("unknown"))


def parse_repo_url(c: Column) -> Column:
    """``struct(owner, repo_name, platform)``.

    For unknown hosts the first two path parts count, after trimming any of the characters
    ``.``, ``g``, ``i``, ``t`` from the end of the path.
    """

    def parts(owner, repo, platform):
        return F.struct(owner.alias("owner"), repo.alias("repo_name"), F.lit(platform).alias("platform"))

    # The path of a URL: after scheme and host, before parameters, query and fragment.
    path = F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, r";[^/]*$", "")
    pieces = F.split(F.regexp_replace(F.regexp_replace(path, r"^/+|/+$", ""), r"[.git]+$", ""), "/")
    generic = parts(
        F.when(F.size(pieces) >= 2, F.get(pieces, 0)), F.when(F.size(pieces) >= 2, F.get(pieces, 1)), "unknown"
    )
    known = [
        F.when(c.rlike(shape), parts(F.regexp_extract(c, shape, 1), F.regexp_extract(c, shape, 2), host))
        for host, shape in CODE_HOSTS.items()
    ]
    return F.coalesce(*known, F.when(c.isNotNull(), generic))
