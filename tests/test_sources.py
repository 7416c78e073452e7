import datetime
import gzip
import hashlib
import io
import os
import tarfile
import tempfile
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.functions.vectors import decode_embedding
from paperloom.operators import catalog, profile
from paperloom.operators.ranking import first_by, last_by
from paperloom.sources import articles_xml, listings, matrices, repositories


def folder():
    return tempfile.mkdtemp(prefix="run-")


def write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)
    return path


def article(body="", back=""):
    return ("<article><front><article-meta><article-title>A study</article-title><abstract><p>An abstract.</p></abstract></article-meta></front>"
            f"<body><sec><title>Methods</title><p>We did <i>things</i>.</p></sec>{body}</body><back>{back}</back></article>")


JATS = {
    "body": article('<sec sec-type="data-availability"><title>Data availability</title><p>Deposited as PXD069212.</p></sec>'),
    "back": article(back='<sec sec-type="data-availability"><title>Data availability</title><p>PASS05975.</p></sec><ref-list><ref/><ref/></ref-list>'),
    "notes": article(back='<notes notes-type="data-availability"><title>Data availability</title><p>PXD059818 and GSE287770.</p></notes>'
                          '<notes notes-type="data-availability"><title>Code availability</title><p>At github.com/example/repo.</p></notes><ref-list><ref/></ref-list>'),
    "nested": article(back='<notes><title>Declarations</title><notes notes-type="COI-statement"><title>Competing interests</title><p>No competing interests.</p></notes></notes>'),
    "untitled": article(back='<notes notes-type="funding-statement"><p>Funded by NIGMS.</p></notes><sec><p>Plain.</p></sec>'),
    "plain": article(),
    "malformed": "<article><body>unclosed",
    "no_sections": "<article><body><p>One.</p><p>Two.</p></body></article>",
    "absent": None,
}


def test_jats(spark):
    df = spark.createDataFrame(list(JATS.items()), "name string, xml string")
    text = {r["name"]: r.text for r in articles_xml.jats_text(df, "xml").collect()}
    assert text["plain"] == "TITLE: A study\n\nABSTRACT:\nAn abstract.\n\n\nMETHODS\n\nWe did things."
    assert "PXD069212" in text["body"] and "DATA AVAILABILITY" in text["body"]
    assert "PASS05975" in text["back"] and text["back"].endswith("REFERENCES: 2 references")
    assert all(w in text["notes"] for w in ("PXD059818", "GSE287770", "CODE AVAILABILITY", "github.com/example/repo", "REFERENCES: 1 references"))
    assert text["nested"].count("No competing interests.") == 1 and "COMPETING INTERESTS" in text["nested"] and "DECLARATIONS" not in text["nested"]
    assert "FUNDING STATEMENT\n\nFunded by NIGMS." in text["untitled"] and "NOTES\n\nPlain." in text["untitled"]
    assert text["malformed"] == "<article><body>unclosed" and text["no_sections"] == "One.\n\nTwo." and text["absent"] is None
    binary = df.where("name = 'plain'").select(F.col("xml").cast("binary").alias("xml"))
    assert articles_xml.jats_text(binary, "xml").first().text == text["plain"]


PUBMED = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>77</PMID><Article>
<Journal><ISSN IssnType="Electronic">9</ISSN><JournalIssue><Volume>3</Volume><PubDate><MedlineDate>2019 Nov-Dec</MedlineDate></PubDate></JournalIssue><Title>J</Title></Journal>
<ArticleTitle>A <i>bold</i> title</ArticleTitle><ELocationID EIdType="doi">10.1/e</ELocationID>
<Abstract><AbstractText Label="AIM">Find <b>x</b>.</AbstractText><AbstractText>More.</AbstractText><CopyrightInformation>(c) me</CopyrightInformation></Abstract>
<AuthorList><Author><LastName>Li</LastName><ForeName>A</ForeName><Identifier Source="ORCID">http://orcid.org/0-1</Identifier>
<AffiliationInfo><Affiliation>Here</Affiliation></AffiliationInfo><AffiliationInfo><Affiliation>There</Affiliation></AffiliationInfo></Author>
<Author><CollectiveName>The Group</CollectiveName></Author></AuthorList><Language>eng</Language>
<GrantList><Grant><GrantID>G1</GrantID><Agency>NIH</Agency></Grant></GrantList>
<PublicationTypeList><PublicationType>Review</PublicationType></PublicationTypeList>
<ArticleDate DateType="Electronic"><Year>2019</Year><Month>02</Month><Day>31</Day></ArticleDate></Article>
<MeshHeadingList><MeshHeading><DescriptorName UI="D1" MajorTopicYN="Y">Mice</DescriptorName><QualifierName>genetics</QualifierName></MeshHeading></MeshHeadingList>
<KeywordList><Keyword>k1</Keyword><Keyword/></KeywordList></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="pubmed">77</ArticleId></ArticleIdList>
<ReferenceList><Reference><ArticleIdList><ArticleId IdType="doi">10.9/cited</ArticleId></ArticleIdList></Reference></ReferenceList></PubmedData></PubmedArticle></PubmedArticleSet>"""


def test_pubmed(spark):
    df = spark.createDataFrame([(1, PUBMED), (2, "<x/>"), (3, "<broken"), (4, None)], "seq bigint, xml string")
    t = articles_xml.pubmed_tables(df, "xml")
    a = t["articles"].first()
    assert (a.pmid, a.doi, a.title, a.abstract) == ("77", None, "A bold title", "AIM: Find x. More.")
    assert a.publication_date == datetime.date(2019, 1, 1) and a.electronic_publication_date == datetime.date(2019, 2, 1)
    assert (a.copyright, a.article_type, a.language, a.volume) == ("(c) me", "Review", "eng", "3")
    j = t["journals"].first()
    assert (j["name"], j.issn, j.eissn) == ("J", None, "9")
    assert [tuple(r) for r in t["authors"].select("author_position", "last_name", "author_orcid", "is_collective").collect()] == [(1, "Li", "0-1", False), (2, "The Group", None, True)]
    assert [r.affiliation_text for r in t["affiliations"].collect()] == ["Here", "There"]
    assert [r.keyword for r in t["keywords"].collect()] == ["k1"]
    assert t["mesh_terms"].first().descriptor_ui == "D1" and t["mesh_terms"].first().is_major_topic and t["mesh_qualifiers"].first().qualifier_name == "genetics"
    assert t["grants"].first().agency == "NIH"
    errors = {r.seq: r.error for r in t["errors"].collect()}
    assert errors[2] == "No article found in response" and errors[3].startswith("XML parse error") and errors[4] == "No document"
    s = articles_xml.pubmed_snapshot(df, "xml").where("seq = 1").first()
    assert (s.doi, s.title, s.publication_date, s.electronic_publication_date) == ("10.1/e", "A ", None, None)


def test_matrices(spark):
    d = folder()
    csv = write(d + "/m.csv", "﻿id, s1 ,s.2,notes\nP1,1.5,NA,x\nP2,2,,y\n")
    rows = matrices.read_matrix(spark, csv, metadata_cols=["notes"]).collect()
    assert {(r.feature_id, r.sample): r.value for r in rows} == {("P1", "s1"): 1.5, ("P1", "s.2"): None, ("P2", "s1"): 2.0, ("P2", "s.2"): None}
    diann = write(d + "/report.pg_matrix.tsv", "Protein.Group\tProtein.Ids\tGenes\tFirst.Protein.Description\trun1.raw\nP1\ta\tg\td\t10\n")
    assert [tuple(r) for r in matrices.read_diann_matrix(spark, diann).collect()] == [("P1", "run1.raw", 10.0)]
    maxquant = write(d + "/proteinGroups.txt", "Protein IDs\tLFQ intensity\tLFQ intensity A\tIntensity A\nP1\t1\t2\t3\n")
    assert [tuple(r) for r in matrices.read_maxquant_matrix(spark, maxquant).collect()] == [("P1", "A", 2.0)]
    plain = write(d + "/pg2.txt", "id\tIntensity B\nP1\t3\n")
    assert [tuple(r) for r in matrices.read_maxquant_matrix(spark, plain).collect()] == [("P1", "B", 3.0)]
    with pytest.raises(ValueError):
        matrices.read_matrix(spark, csv, id_col="nope")


def test_rows_keep_their_order(spark):
    """Of a repeated feature the last matrix row and the first differential-expression row count, over files and splits."""
    d = folder() + "/many"
    rows = [(f"P{(i * 7) % 50}", i) for i in range(3000)]
    for part in range(3):
        some = rows[part * 1000 : part * 1000 + 1000]
        write(f"{d}/part-{part}.tsv", "id\ts1\n" + "".join(f"{k}\t{v}\n" for k, v in some))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        m = matrices.read_matrix(spark, d, sep="\t", position="at")
        assert m.rdd.getNumPartitions() > 10
        last = {r.feature_id: r.value for r in last_by(m, ["feature_id", "sample"], "at").collect()}
        assert last == {k: float(v) for k, v in rows}
        dep = matrices.read_dep(spark, d, "\t", position="at", id_col="id", log2fc_col="s1")
        first = {r.feature_id: r.log2fc for r in first_by(dep, ["feature_id"], "at").collect()}
        assert first == {k: float(v) for k, v in reversed(rows)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_surplus_cells_and_quoted_line_breaks(spark):
    d = folder()
    path = write(d + "/s.csv", "\ufeffid,a,a\n\n1,2,3\n4,5,6,7,8\n9\n")
    got = [tuple(r) for r in matrices.read_text_table(spark, path, surplus="more").orderBy("id").collect()]
    assert got == [("1", "3", None), ("4", "6", "7"), ("9", None, None)]  # of two columns with one name the last counts
    path = write(d + "/q.csv", 'id,a\n1,"x\ny"\n2,z\n')
    assert [tuple(r) for r in matrices.read_text_table(spark, path, multi_line=True, position="at").orderBy("at").select("id", "a").collect()] == [("1", "x\ny"), ("2", "z")]


def test_delimiters_and_types_are_found(spark):
    d = folder()
    lines = ["k;name;x|y;f"] + [f'{i};"a;b{i}, c";{i}|{i};{"NA" if i % 4 else "0.5"}' for i in range(50)] + ["broken line"]
    frame, report = matrices.read_table(spark, write(d + "/unknown.dat", "\n".join(lines)))
    assert report.first().delimiter == ";" and dict(frame.dtypes) == {"k": "string", "name": "string", "x|y": "string", "f": "double"}
    assert frame.where("k = '7'").first()["name"] == "a;b7, c"
    sep, kinds, share = matrices.delimiter_and_types(spark.read.text(d + "/unknown.dat"), lines[0])
    assert (sep, kinds[0]) == (";", "string") and 0.97 < share < 1
    frame, _ = matrices.read_table(spark, write(d + "/flags.dat", "a|b|c\ntrue|1|1e3\nFALSE||-2\n|9223372036854775807|inf\n"))
    assert dict(frame.dtypes) == {"a": "boolean", "b": "bigint", "c": "double"}
    assert [tuple(r) for r in frame.orderBy("b").collect()] == [(False, None, -2.0), (True, 1, 1000.0), (None, 9223372036854775807, float("inf"))]
    one, report = matrices.read_table(spark, write(d + "/one.dat", "word\nx\ny\n"))
    assert one.columns == ["word"] and one.count() == 2
    empty, _ = matrices.read_table(spark, write(d + "/none.dat", "a;b\n"))
    assert empty.columns == ["a", "b"] and empty.count() == 0


def test_dep_table(spark):
    path = write(folder() + "/d.tsv", "gene\tlfc\tpadj\tsignificant\na\t1.5\t0.01\t+\nb\tNA\t\t\nc\t-1\t0.5\tmaybe\n")
    got = {r.feature_id: tuple(r)[1:] for r in matrices.read_dep(spark, path, id_col="gene", log2fc_col="lfc").collect()}
    assert got == {"a": (1.5, None, 0.01, True), "b": (None, None, None, False), "c": (-1.0, None, 0.5, None)}
    partial = matrices.read_dep(spark, path, id_col="gene", sig_col=None).first()
    assert partial.significant is None and partial.log2fc is None


def test_read_table(spark):
    d = folder()
    rng = np.random.default_rng(0)
    lines = ["protein_id," + ",".join(f"sample_{i}" for i in range(8)) + ",group"]
    lines += [f"P{i:05d}," + ",".join(f"{x:.4f}" for x in rng.normal(20, 3, 8)) + f",{'treated' if i % 2 else 'control'}" for i in range(5000)]
    frame, report = matrices.read_table(spark, write(d + "/matrix.csv", "\n".join(lines)))
    assert report.first().file_type == "csv" and report.first().error is None
    p = {r.name: r for r in profile.profile_table(frame).collect()}
    assert len(p) == 10 and p["sample_0"].is_numeric and 19 < p["sample_0"].mean < 21
    assert sorted(t.value for t in p["group"].top_values) == ["control", "treated"] and p["protein_id"].n_unique == 5000 and not p["protein_id"].top_values
    tsv, report = matrices.read_table(spark, write(d + "/m.tsv", "a\tb\n1\t2\n"))
    assert report.first().file_type == "tsv" and tsv.columns == ["a", "b"]
    missing, report = matrices.read_table(spark, d + "/nope.csv")
    assert missing is None and "not found" in report.first().error.lower()
    frame.limit(10).write.parquet(d + "/t.parquet")
    assert matrices.read_table(spark, d + "/t.parquet")[0].count() == 10


def test_archives_and_listing(spark):
    d = folder()
    write(d + "/data/readme.txt", "hello")
    with zipfile.ZipFile(d + "/data/a.zip", "w") as z:
        z.writestr("in/one.csv", "x" * 10)
        z.writestr("dir/", "")
    with tarfile.open(d + "/data/b.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("two.raw")
        info.size = 3
        t.addfile(info, io.BytesIO(b"abc"))
        sub = tarfile.TarInfo("sub")
        sub.type = tarfile.DIRTYPE
        t.addfile(sub)
        link = tarfile.TarInfo("link")
        link.type, link.linkname = tarfile.SYMTYPE, "two.raw"
        t.addfile(link)
    write(d + "/data/c.zip", "not a zip")
    names = {r.path.split("/data/")[1]: r.size_bytes for r in listings.list_files(spark, d + "/data").collect()}
    assert names["a.zip/in/one.csv"] == 10 and names["b.tar.gz/two.raw"] == 3 and names["readme.txt"] == 5
    assert set(names) == {"a.zip", "b.tar.gz", "c.zip", "readme.txt", "a.zip/in/one.csv", "b.tar.gz/two.raw"}
    assert listings.list_files(spark, d + "/data", inspect_archives=False).count() == 4
    files = spark.read.format("binaryFile").load(d + "/data/*").select("path", "content")
    totals = {r.archive_path.rsplit("/", 1)[1]: r for r in listings.archive_contents(listings.archive_members(files)).collect()}
    assert (totals["a.zip"].total_files, totals["a.zip"].total_size) == (1, 10) and (totals["b.tar.gz"].total_files, totals["b.tar.gz"].total_size) == (2, 3)
    assert totals["c.zip"].error.startswith("Failed to read archive") and totals["c.zip"].total_files == 0
    sums = {r.path.rsplit("/", 1)[1]: r.sha256sum for r in listings.file_checksums(spark, d + "/data").collect()}
    assert sums["readme.txt"] == hashlib.sha256(b"hello").hexdigest()
    texts = listings.read_texts(spark, d + "/data/readme.txt").first()
    assert texts.text == "hello" and texts.path.endswith("readme.txt")
    catalogued = catalog.catalog_files(listings.list_files(spark, d + "/data"), filename="path")
    assert {r.file_type for r in catalogued.where("path LIKE '%two.raw'").collect()} == {"raw_data"}


def test_empty_archive_read(spark):
    empty = gzip.compress(b"")
    df = spark.createDataFrame([("x.tar.gz", bytearray(empty)), ("y.txt", bytearray(b""))], "path string, content binary")
    assert [r.path for r in listings.archive_members(df).collect()] in ([], ["x.tar.gz"])


def test_schema_report(spark):
    tables = {n: schemas.empty_table(spark, n) for n in schemas.DDL}
    assert len(tables) == 34
    rows = listings.schema_report(tables, schemas.PRIMARY_KEYS, "datasets").collect()
    assert [r.column for r in rows][:2] == ["dataset_id", "title"] and rows[0].is_primary_key and not rows[1].is_primary_key
    assert listings.schema_report(tables, schemas.PRIMARY_KEYS).select("table").distinct().count() == 34


def test_embedding_bytes(spark):
    df = spark.createDataFrame([(bytearray(np.array([1.5, -2.0], "<f4").tobytes()),), (None,)], "b binary")
    assert [r[0] for r in df.select(decode_embedding("b")).collect()] == [[1.5, -2.0], None]


def test_pride_variants(spark):
    rows = [("P1", '{"title":"T","projectDescription":"","description":"D","organisms":[],"species":["mouse",{"scientificName":"Homo"},{"name":null}],'
                   '"submissionDate":1600000000000,"publicationDate":"1600000000000","references":[{"pubmedId":0,"doi":""},{"pubmedId":5,"doi":"10.1/x"}]}'),
            ("P2", "{}")]
    got = repositories.pride_projects(spark.createDataFrame(rows, "dataset_id string, json string"), "json").orderBy("dataset_id").collect()
    assert got[0].species == ["mouse", "Homo"] and got[0].description == "D" and got[0].submission_date == datetime.date(2020, 9, 13)
    assert got[0].publication_date is None and got[0].doi == "10.1/x"
    assert got[1].species == [] and got[1].title is None and got[1].pmid is None


def test_availability_prefers_directory(spark):
    listing = spark.createDataFrame([("/d/A.zip", False), ("/d/A", True), ("/d/B.tar.gz", False), ("/d/B.zip", False), ("/d/C", False)], "path string, is_dir boolean")
    ids = spark.createDataFrame([("A",), ("B",), ("C",), ("",)], "dataset_id string")
    got = {r.dataset_id: (r.exists, r.is_directory, r.archive_format) for r in catalog.dataset_availability(ids, listing).collect()}
    assert got == {"A": (True, True, None), "B": (True, False, ".tar.gz"), "C": (False, False, None), "": (False, False, None)}
