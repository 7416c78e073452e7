"""What keeps ingest within bounds: small plans, one parse, few documents and authors held at once."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from paperloom import schemas
from paperloom.operators import ingest, merge
from paperloom.sources import articles_xml

ARTICLE = "<PubmedArticle><MedlineCitation><PMID>{0}</PMID><Article><Journal><Title>J</Title></Journal><ArticleTitle>T</ArticleTitle><Abstract><AbstractText>A</AbstractText></Abstract>{1}</Article></MedlineCitation></PubmedArticle>"
NAMES = ("journals", "articles", "author_info", "affiliations", "author_affiliations", "article_authors", "keywords", "article_keywords", "grants", "article_grants",
         "mesh_terms", "mesh_qualifiers", "article_mesh_terms", "article_mesh_qualifiers")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def people(n):
    return "<AuthorList>" + "".join(f"<Author><LastName>L{i}</LastName><ForeName>F</ForeName></Author>" for i in range(n)) + "</AuthorList>"


def author_type(spark):
    return to_arrow_schema(T.StructType.fromDDL(articles_xml.RECORD)).field("authors").type.value_type


def test_grown_tables_have_small_plans(spark):
    df = spark.createDataFrame([(1, ARTICLE.format(1, people(3))), (2, ARTICLE.format(2, people(2)))], "seq bigint, xml string")
    out, _ = ingest.ingest_articles({n: schemas.empty_table(spark, n) for n in NAMES}, df)
    for name in set(NAMES) - {"articles"}:
        assert "Join" not in plan(out[name]) and "Aggregate" not in plan(out[name]), name
    assert out["article_authors"].count() == 5 and out["author_info"].count() == 3


def test_status_parses_documents_once(spark):
    df = spark.createDataFrame([(1, ARTICLE.format(1, "")), (2, "<broken"), (3, ARTICLE.format(1, ""))], "seq bigint, xml string")
    status = ingest.article_status(articles_xml.pubmed_records(df, "xml"), schemas.empty_table(spark, "articles"))
    assert "MapInArrow" not in plan(status)
    assert sorted(map(tuple, status.collect())) == [(1, "newly_processed"), (2, "failed"), (3, "already_processed")]


def test_many_authors_leave_the_tree(spark):
    kind, n = author_type(spark), 2 * articles_xml.HELD_AUTHORS + 5
    root, lists = articles_xml._tree(ARTICLE.format(7, people(n)).encode(), kind)
    assert len(list(root.iter())) < 20
    (found,) = lists.values()
    assert [len(a) for a in found.arrays] == [articles_xml.HELD_AUTHORS] * 2 and len(found.rows) == 5
    got = articles_xml._author_lists([None, [found], []], kind).to_pylist()
    assert got[0] is None and got[2] == [] and [a["last_name"] for a in got[1]] == [f"L{i}" for i in range(n)]


def test_unusual_authors_stay_in_the_tree_and_in_order(spark):
    inner = "<Author><LastName>B</LastName><Note><Language>xx</Language></Note></Author>"
    xml = ARTICLE.format(7, people(2).replace("</AuthorList>", inner + "<Author><CollectiveName>C</CollectiveName></Author></AuthorList>"))
    record, lists = articles_xml._pubmed_record(pa.py_buffer(xml.encode()), author_type(spark))
    assert record["language"] == "xx" and [a["last_name"] for a in lists[0].rows] == ["L0", "L1", "B", "C"]


def test_documents_are_parsed_in_small_batches(spark):
    n = 3 * articles_xml.PARSED_ROWS + 1
    parse = []

    class Frame:
        def select(self, *_):
            return self

        def mapInArrow(self, function, schema):
            parse.append(function)

    articles_xml.pubmed_records(Frame(), "xml")
    rows = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([ARTICLE.format(5, people(1))] * n), pa.nulls(n, pa.string())], ["seq", "xml", "requested_pmid"])
    got = list(parse[0]([rows]))
    assert [b.num_rows for b in got] == [articles_xml.PARSED_ROWS] * 3 + [1]
    assert {b.column(b.schema.get_field_index("authors"))[0].as_py()[0]["last_name"] for b in got} == {"L0"}


def test_keys_and_links_are_numbered_from_written_rows(spark):
    """Plans of what numbers new rows hold no copy of the plan that made these rows."""
    names = spark.createDataFrame([(f"n{i % 5}", i) for i in range(20)], "name string, seq bigint")
    new = names.join(names.groupBy("name").count(), "name").drop("count")
    table, ids = merge.assign_keys(schemas.empty_table(spark, "journals"), new, ["name"], "journal_id")
    assert not {w for w in ("Aggregate", "Window") if w in plan(table) or w in plan(ids)}
    assert sorted((r.name, r.journal_id) for r in ids.collect()) == [(f"n{i}", i + 1) for i in range(5)]
    terms = new.select(F.lit(None).cast("string").alias("descriptor_ui"), F.col("name").alias("descriptor_name"), "seq")
    table, ids = merge.resolve_mesh(schemas.empty_table(spark, "mesh_terms"), terms)
    assert "Aggregate" not in plan(table) and "Window" not in plan(ids) and plan(ids).count("Join") == 1
    assert sorted((r.seq, r.mesh_term_id) for r in ids.collect()) == [(i, i % 5 + 1) for i in range(20)]
    links = new.select(F.col("name").alias("doi"), F.lit(None).cast("string").alias("pmid"), F.lit(None).cast("string").alias("pmcid"), (F.col("seq") % 2).alias("k"), "seq")
    old = spark.createDataFrame([], "id bigint, doi string, pmid string, pmcid string, k bigint")
    grown = merge.add_links(old, links, ["k"], id_col="id", consistent=True)
    assert "Aggregate" in plan(grown) and "SortAggregate" not in plan(grown) and plan(grown).count("Scan") + plan(grown).count("Relation") <= 4
    assert [(r.id, r.doi, r.k) for r in grown.orderBy("id").collect()] == [(i + 1, f"n{i % 5}", i % 2) for i in range(10)]


def test_items_keep_their_order(spark):
    rows = [(d, p, f"w{d}{p}") for d in (3, 1, 2) for p in range(40)]
    items = ingest._in_order(spark.createDataFrame(rows, "seq bigint, keyword_position int, keyword string").repartition(5), "keyword_position")
    assert "Window" not in plan(items) and "Join" not in plan(items)
    got = items.orderBy("seq").collect()
    assert [(r.doc, r.keyword_position) for r in got] == sorted((d, p) for d, p, _ in rows) and len({r.seq for r in got}) == len(rows)


def parsed(batches, **options):
    """Batches of records that the parser of ``pubmed_records`` makes of batches of (seq, xml)."""
    parse = []

    class Frame:
        def select(self, *_):
            return self

        repartition = sortWithinPartitions = drop = select

        def mapInArrow(self, function, schema):
            parse.append(function)

    articles_xml.pubmed_records(Frame(), "xml", **options)
    return list(parse[0](pa.RecordBatch.from_arrays([pa.array([s for s, _ in b], pa.int64()), pa.array([x for _, x in b], pa.string()), pa.nulls(len(b), pa.string())], ["seq", "xml", "requested_pmid"]) for b in batches))


def test_many_authors_take_several_rows(spark):
    n = 3 * articles_xml.ROW_AUTHORS + 5
    got = [r for b in parsed([[(1, ARTICLE.format(1, people(n))), (2, ARTICLE.format(2, people(2)))]]) for r in b.to_pylist()]
    assert [(r["seq"], r["pmid"], r["authors_before"], len(r["authors"])) for r in got] == [
        (1, "1" if not i else None, i * articles_xml.ROW_AUTHORS, articles_xml.ROW_AUTHORS if i < 3 else 5) for i in range(4)] + [(2, "2", 0, 2)]
    df = spark.createDataFrame([(1, ARTICLE.format(1, people(n))), (2, ARTICLE.format(2, people(2))), (3, "<broken")], "seq bigint, xml string")
    tables = articles_xml.pubmed_tables(df, "xml")
    assert [tables[t].count() for t in ("articles", "journals", "errors", "authors")] == [2, 2, 1, n + 2]
    assert [(r.author_position, r.last_name) for r in tables["authors"].where("seq = 1").orderBy("author_position").collect()] == [(i + 1, f"L{i}") for i in range(n)]
    assert articles_xml.pubmed_snapshot(df, "xml").count() == 3
    assert ingest.article_status(articles_xml.pubmed_records(df, "xml"), schemas.empty_table(spark, "articles")).count() == 3


def test_authors_beyond_held_arrays_are_kept_in_a_file(spark, monkeypatch):
    monkeypatch.setattr(articles_xml, "HELD_AUTHORS", 10)
    monkeypatch.setattr(articles_xml, "HELD_ARRAYS", 3)
    monkeypatch.setattr(articles_xml, "ROW_AUTHORS", 7)
    _, (found,) = articles_xml._pubmed_record(pa.py_buffer(ARTICLE.format(7, people(75)).encode()), author_type(spark))
    assert found.filed == 60 and len(found.arrays) == 1 and len(found.rows) == 5 and len(found) == 75
    pieces = list(found.pieces(author_type(spark)))
    assert max(map(len, pieces)) == 7 and [a["last_name"] for p in pieces for a in p.to_pylist()] == [f"L{i}" for i in range(75)]


def test_a_document_may_come_in_parts(spark):
    whole = ARTICLE.format(1, people(300))
    cut = [(1, i, whole[i : i + 50]) for i in range(0, len(whole), 50)]
    rows = [*reversed(cut), (2, 0, ARTICLE.format(2, people(1))), (3, 0, whole[:90]), (4, 0, "<a>"), (4, 1, None), (4, 2, "</a>"), (None, 1, None)]
    df = spark.createDataFrame(rows, "seq bigint, part int, xml string")
    records = articles_xml.pubmed_records(df, "xml", part_col="part", partitions=3)
    assert sorted((r.seq or 0, r.pmid, (r.error or "")[:9]) for r in articles_xml.first_rows(records).collect()) == [
        (0, None, "No docume"), (1, "1", ""), (2, "2", ""), (3, None, "XML parse"), (4, None, "No docume")]
    authors = articles_xml.record_tables(records)["authors"]
    assert [r.last_name for r in authors.where("seq = 1").orderBy("author_position").collect()] == [f"L{i}" for i in range(300)]
    got = [r for b in parsed([[(1, whole[:70])], [(1, whole[70:200]), (1, whole[200:])], [(2, ARTICLE.format(2, ""))]], part_col="part") for r in b.to_pylist()]
    assert [(r["seq"], r["pmid"], r["error"], len(r["authors"])) for r in got] == [(1, "1", None, 256), (1, None, None, 44), (2, "2", None, 0)]
