"""Text expressions: tags, whitespace, labels, titles, excerpts, prompts."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Python's str.split() and strip() also treat the four separators 1C-1F as white space.
WS = r"[\s\x1c-\x1f]"


def strip_tags(c: Column) -> Column:
    """Remove ``<...>`` tags; NULL stays NULL."""
    return F.regexp_replace(c, r"<[^>]+>", "")


def strip(c: Column) -> Column:
    """Trim every kind of white space, not just blanks."""
    return F.regexp_replace(c, rf"(?U)^{WS}+|{WS}+$", "")


def collapse(c: Column) -> Column:
    """Turn each run of white space into one blank and trim."""
    return F.trim(F.regexp_replace(c, rf"(?U){WS}+", " "))


def cut(c: Column, limit: int) -> Column:
    """Shorten already collapsed text to ``limit`` characters, the last being an ellipsis."""
    return F.when(
        F.char_length(c) > limit,
        F.concat(F.rtrim(F.substring(c, 1, max(0, limit - 1))), F.lit("…")),
    ).otherwise(c)


def truncate_cell(c: Column, limit: int) -> Column:
    """One-line form of a cell, NULL as empty text, at most ``limit`` characters."""
    return cut(collapse(F.coalesce(c.cast("string"), F.lit(""))), limit)


def short_label(c: Column, limit: int, keep: int | None = None, fallback: Column | None = None) -> Column:
    """Text longer than ``limit`` keeps ``keep`` characters plus dots; empty text gives ``fallback``."""
    keep = limit if keep is None else keep
    label = F.when(F.char_length(c) > limit, F.concat(F.substring(c, 1, keep), F.lit("..."))).otherwise(c)
    if fallback is None:
        return label
    return F.when(c.isNull() | (c == ""), fallback).otherwise(label)


def _plain_title(c: Column) -> Column:
    return collapse(F.regexp_replace(F.lower(c), r"[^\w\s]", " "))


@F.pandas_udf(T.StringType())
def _accented_title(titles: pd.Series) -> pd.Series:
    def fold(text):
        if text is None:
            return None
        base = (ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))
        return " ".join(re.sub(r"[^\w\s]", " ", "".join(base).lower()).split())

    return titles.map(fold, na_action="ignore")


def normalize_title(c: Column) -> Column:
    """Comparison form of a title: no tags, accents or punctuation, lower case; NULL gives ''.

    Spark has no Unicode decomposition, so only titles with non-ASCII characters go through
    the Arrow function; all others stay in the JVM.
    """
    bare = strip_tags(c)
    ascii_only = ~bare.rlike(r"[^\x00-\x7F]")
    return F.when(bare.isNull(), F.lit("")).when(ascii_only, _plain_title(bare)).otherwise(
        _accented_title(F.when(~ascii_only, bare))
    )


def similar_normalized(a: Column, b: Column, threshold: float = 0.85) -> Column:
    """Similarity test on two outputs of :func:`normalize_title`."""
    a_first = F.char_length(a) <= F.char_length(b)
    shorter, longer = F.when(a_first, a).otherwise(b), F.when(a_first, b).otherwise(a)
    words_a, words_b = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    overlap = F.size(F.array_intersect(words_a, words_b)) / F.size(F.array_union(words_a, words_b))
    return (
        F.when(a == b, True)
        .when((F.char_length(shorter) >= 20) & F.startswith(longer, shorter), True)
        .when((a == "") | (b == ""), False)
        .otherwise(overlap >= threshold)
    )


def titles_similar(a: Column, b: Column, threshold: float = 0.85) -> Column:
    """True when two titles are equal, one is a long prefix, or their words overlap enough."""
    given = F.coalesce((a != "") & (b != ""), F.lit(False))
    return F.when(given, similar_normalized(normalize_title(a), normalize_title(b), threshold)).otherwise(False)


# Fixed value: headings that open a methods section.
METHODS_HEADING = r"(?i)\b(materials\s+and\s+methods|methods|experimental\s+procedures|star\s+methods)\b"


def methods_excerpt(c: Column, head: int = 1800, methods: int = 2600, limit: int = 4600) -> Column:
    """Leading window, then a window from the first methods heading, cut to ``limit``."""
    pieces = F.split(c, METHODS_HEADING, 2)
    section = F.substr(c, F.char_length(pieces[0]) + 1, F.lit(methods))
    tail = F.when(F.size(pieces) == 2, F.concat(F.lit("\n...\n"), section)).otherwise(F.lit(""))
    return F.substring(F.concat(F.substring(c, 1, head), tail), 1, limit)


def strip_fence(c: Column) -> Column:
    """Remove a Markdown code fence around a JSON answer."""
    text = strip(c)
    body = F.regexp_replace(text, r"^[^\n]*\n", "")
    return F.when(F.startswith(text, F.lit("```")), strip(F.regexp_replace(body, rf"(?U)```{WS}*$", ""))).otherwise(text)


def question_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def author_name(first: Column, last: Column) -> Column:
    blank = F.lit("")
    return strip(F.concat(F.coalesce(first, blank), F.lit(" "), F.coalesce(last, blank)))


# Fixed value: descriptor field and its printed name, in print order.
DESCRIPTOR_FIELDS = (
    ("biological_system", "biological system / cell type"),
    ("measured_compartment", "measured compartment"),
    ("species", "species"),
    ("perturbations", "perturbations / contrasts"),
    ("omics_assay", "omics / assay"),
)


def descriptor_text(**fields: Column) -> Column:
    """Compact text of a measurement descriptor; empty fields are left out."""
    lines = [
        F.when(fields[name] != "", F.concat(F.lit(f"- {label}: "), fields[name]))
        for name, label in DESCRIPTOR_FIELDS
    ]
    return F.concat(F.lit("MEASUREMENT DESCRIPTOR (cached):\n"), F.concat_ws("\n", *lines))


# Wording of the extraction request; any part can be replaced by the caller.
EXTRACTION_SECTIONS = {
    "preamble": "Read the scientific article at the end and answer with one JSON object holding the keys below.",
    "keywords": "keywords: list of strings naming the topic, methods and findings.",
    "raw_data": "raw_data: list of {dataset_id, data_repository, url, evidence_text} for unprocessed data.",
    "processed_data": "processed_data: list of {dataset_id, data_repository, url, file, evidence_text} for quantities.",
    "analysis_methods": "analysis_methods: list of {method_name, method_description}.",
    "code": "code: list of {repository, url, description}.",
    "measurement_descriptor": "measurement_descriptor: one object with biological_system, measured_compartment, "
    "species, perturbations, omics_assay, evidence_text; null where the text does not say.",
    "postamble": "ARTICLE TEXT\n============",
}


def extraction_prompt(c: Column, sections: dict[str, str] | None = None) -> Column:
    """Instruction sections followed by the article text, blank lines between."""
    parts = [part.strip() for part in (EXTRACTION_SECTIONS if sections is None else sections).values()]
    return F.concat_ws("\n\n", *[F.lit(part) for part in parts], c)
