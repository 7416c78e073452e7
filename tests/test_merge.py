"""Set-based merges against row-by-row simulations of the same rules."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from paperloom.operators import merge, validate
from paperloom.operators.idjoin import id_anti, id_join, id_lookup

IDS = ("doi", "pmid", "pmcid")


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def random_ids(rnd, n):
    k = rnd.randrange(n)
    return (
        None if rnd.random() < 0.4 else f"d{k if rnd.random() < 0.9 else rnd.randrange(n)}",
        None if rnd.random() < 0.4 else f"p{k if rnd.random() < 0.9 else rnd.randrange(n)}",
        None if rnd.random() < 0.4 else f"c{k}",
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_add_links_is_greedy_insert_or_ignore(spark, seed):
    rnd = random.Random(seed)
    old = [(*random_ids(rnd, 12), rnd.randrange(3)) for _ in range(15)]
    new = [(*random_ids(rnd, 12), rnd.randrange(3), i) for i in range(120)]
    taken = list(old)
    for row in new:
        if not any(t[3] == row[3] and any(a is not None and a == b for a, b in zip(t[:3], row[:3])) for t in taken):
            taken.append(row[:4])
    schema = "doi string, pmid string, pmcid string, k int"
    got = merge.add_links(frame(spark, old, schema), frame(spark, new, schema + ", seq bigint"), ["k"])
    assert rows_of(got, *IDS, "k") == sorted(taken, key=repr)


def jobs_of(spark, run):
    """Number of Spark jobs that ``run`` starts."""
    group = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def chain(n, start=0):
    """Rows of which each clashes with the one before and the one after it only."""
    return [(f"d{start}-{(i + 1) // 2}", f"p{start}-{i // 2}", None, start, i + start * n) for i in range(n)]


@pytest.mark.parametrize("order", ["rising", "falling", "mixed"])
def test_add_links_chains(spark, order):
    rows = [r for start in range(3) for r in chain(1000, start)]
    at = list(range(len(rows)))
    if order != "rising":
        at = at[::-1] if order == "falling" else random.Random(9).sample(at, len(at))
    rows = [(*r[:4], s) for r, s in zip(rows, at)]
    taken, seen = [], set()
    for r in sorted(rows, key=lambda r: r[4]):
        if not {(r[0], r[3]), (r[1], r[3])} & seen:
            seen |= {(r[0], r[3]), (r[1], r[3])}
            taken.append(r[:4])
    schema = "doi string, pmid string, pmcid string, k int"
    got = merge.add_links(frame(spark, [], schema), frame(spark, rows, schema + ", seq bigint"), ["k"])
    assert rows_of(got, *IDS, "k") == sorted(taken, key=repr)


def test_add_links_copies_and_rows_without_ids(spark):
    rows = [("d", None, None, 1, i) for i in range(500)] + [(None, None, None, 1, 500 + i) for i in range(3)] + [("e", "p", None, None, 600), ("e", None, None, None, 601), ("e", None, None, 2, 602)]
    schema = "doi string, pmid string, pmcid string, k int"
    got = merge.add_links(frame(spark, [], schema), frame(spark, rows, schema + ", seq int"), ["k"])
    assert rows_of(got, *IDS, "k") == sorted([("d", None, None, 1), ("e", "p", None, None), ("e", None, None, 2)] + [(None, None, None, 1)] * 3, key=repr)


def test_rounds_grow_with_the_logarithm_of_a_chain(spark):
    schema = "doi string, pmid string, pmcid string, k int"
    run = lambda n: jobs_of(spark, lambda: merge.add_links(frame(spark, [], schema), frame(spark, chain(n), schema + ", seq bigint"), ["k"]).collect())
    short, long = run(8), run(1000)
    assert long <= short + 8 * 10


def test_add_links_null_safe(spark):
    schema = "doi string, pmid string, pmcid string, k int"
    old = frame(spark, [("a", None, None, 1)], schema)
    new = frame(spark, [("a", None, "x", 1, 1), (None, None, None, 1, 2), (None, None, "y", 1, 3), ("a", "b", None, 1, 4)], schema + ", seq int")
    got = merge.add_links(old, new, ["k"], null_safe=["doi", "pmid"])
    assert rows_of(got, *IDS) == sorted([("a", None, None), (None, None, None), ("a", "b", None)], key=repr)


def test_upsert_articles_in_order(spark):
    old = frame(spark, [("a", "p", None, "Old title"), (None, "z", None, "loose")], "doi string, pmid string, pmcid string, title string")
    new = [("a", None, "c1", "<b>Old</b> title", 1), ("a", "q", None, "A new title", 2), ("a", None, "c2", "B new title", 3), ("b", None, None, None, 4),
           (None, None, None, "loose 2", 5)]
    got = merge.upsert_articles(old, frame(spark, new, "doi string, pmid string, pmcid string, title string, seq int"))
    assert rows_of(got, "doi", "pmid", "pmcid", "title") == sorted(
        [("a", "q", "c2", "A new title"), ("b", None, None, None), (None, "z", None, "loose"), (None, None, None, "loose 2")], key=repr)


def test_upsert_replaced_and_kept_columns(spark):
    old = frame(spark, [("x", 1, "m1", "t0")], "k string, v int, model string, made string")
    new = frame(spark, [("x", None, None, "t1", 1)], "k string, v int, model string, made string, seq int")
    got = merge.coalesce_upsert(old, new, ["k"], replaced=["model"], kept=["made"])
    assert rows_of(got, "k", "v", "model", "made") == [("x", 1, None, "t0")]


def mesh_one_by_one(old, new):
    table = list(old)
    out = {}
    for name, ui, seq in new:
        hit = next((t for t in table if ui and t[2] == ui), None) or next((t for t in table if t[1] == name and t[2] is None), None)
        if hit is None:
            hit = (max([t[0] for t in table], default=0) + 1, name, ui)
            table.append(hit)
        out[seq] = hit[0]
    return table, out


@pytest.mark.parametrize("seed", range(4))
def test_resolve_mesh(spark, seed):
    rnd = random.Random(seed)
    old = [(i + 1, f"n{rnd.randrange(6)}", f"u{i}" if rnd.random() < 0.5 else None) for i in range(4)]
    new = [(f"n{rnd.randrange(8)}", f"u{rnd.randrange(9)}" if rnd.random() < 0.6 else None, i) for i in range(60)]
    table, ids = mesh_one_by_one(old, new)
    got, assigned = merge.resolve_mesh(
        frame(spark, old, "mesh_term_id bigint, descriptor_name string, descriptor_ui string"),
        frame(spark, new, "descriptor_name string, descriptor_ui string, seq bigint"))
    assert {r.seq: r.mesh_term_id for r in assigned.collect()} == ids
    assert rows_of(got, "mesh_term_id", "descriptor_name", "descriptor_ui") == sorted(table, key=repr)


def authors_one_by_one(old, new):
    table, out = list(old), {}
    for last, first, orcid, seq in new:
        hit = next((t for t in table if orcid and t[3] == orcid), None)
        hit = hit or next((t for t in table if last is not None and t[1] == last and t[2] == first and (t[3] is None or orcid is None)), None)
        if hit is None:
            hit = (max([t[0] for t in table], default=0) + 1, last, first, orcid)
            table.append(hit)
        out[seq] = hit[0]
    return table, out


AUTHOR = "author_id bigint, last_name string, first_name string, initials string, author_orcid string"
ROW = "last_name string, first_name string, initials string, author_orcid string, seq bigint"


def resolved(spark, old, new):
    got, assigned = merge.resolve_authors(
        frame(spark, [(a, b, c, None, d) for a, b, c, d in old], AUTHOR), frame(spark, [(a, b, None, c, d) for a, b, c, d in new], ROW))
    return rows_of(got, "author_id", "last_name", "first_name", "author_orcid"), {r.seq: r.author_id for r in assigned.collect()}


@pytest.mark.parametrize("seed", range(8))
def test_resolve_authors(spark, seed):
    """Random batches in which names and ORCIDs mix freely; few of either make long dependencies."""
    rnd = random.Random(seed)
    names, orcids = (3, 3) if seed < 2 else (9, 7) if seed < 5 else (40, 40)
    name = lambda: (f"L{rnd.randrange(names)}", rnd.choice([None, "F"]))
    old = [(i + 1, *name(), rnd.choice([None, f"o{rnd.randrange(orcids)}"])) for i in range(rnd.randrange(5))]
    new = []
    for i in range(150):
        last, first = name()
        new.append((None if rnd.random() < 0.05 else last, first, rnd.choice(["", None, f"o{rnd.randrange(orcids)}", f"o{rnd.randrange(orcids)}"]), i * 3))
    table, ids = authors_one_by_one(old, [(a, b, c or None, s) for a, b, c, s in new])
    got, assigned = resolved(spark, old, new)
    assert assigned == ids
    assert got == sorted(table, key=repr)


def test_resolve_authors_long_dependencies(spark):
    """Each row's fate hangs on the row before it."""
    new, seq = [], 0
    for i in range(60):
        new += [(f"L{i}", None, f"o{i}", seq), (f"L{i}", None, None, seq + 1), (f"L{i}", None, f"o{i + 1}", seq + 2)]
        seq += 3
    new += [("hot", "x", f"h{i % 7}" if i % 3 else None, 1000 + i) for i in range(300)]
    table, ids = authors_one_by_one([], new)
    got, assigned = resolved(spark, [], new)
    assert assigned == ids and got == sorted(table, key=repr)
    assert resolved(spark, [], []) == ([], {})


def test_resolve_grants_and_keys(spark):
    grants = frame(spark, [(1, "G1", "NIH")], "grant_id bigint, grant_number string, agency string")
    new = frame(spark, [("G1", "NIH", 1), ("G1", None, 2), ("G1", None, 3), ("G2", "NSF", 4), ("G2", "NSF", 5)], "grant_number string, agency string, seq bigint")
    table, ids = merge.resolve_grants(grants, new)
    assert {r.seq: r.grant_id for r in ids.collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4} and table.count() == 4
    journals = frame(spark, [(7, "J1", "1")], "journal_id bigint, name string, issn string")
    new = frame(spark, [("J2", "first", 3), ("J2", "second", 4), ("J0", "x", 1), ("J1", "ignored", 2), (None, "none", 5)], "name string, issn string, seq bigint")
    table, ids = merge.assign_keys(journals, new, ["name"], "journal_id")
    assert rows_of(table, "journal_id", "name", "issn") == [(7, "J1", "1"), (8, "J0", "x"), (9, "J2", "first")]
    assert rows_of(ids, "name", "journal_id") == [("J0", 8), ("J1", 7), ("J2", 9)]
    empty = merge.assign_keys(journals.limit(0), new, ["name"], "journal_id")[0]
    assert rows_of(empty, "journal_id", "name") == [(1, "J0"), (2, "J1"), (3, "J2")]


@pytest.mark.parametrize("seed", [5, 6])
def test_replace_descriptors(spark, seed):
    rnd = random.Random(seed)
    old = [(*random_ids(rnd, 8), "m" + str(rnd.randrange(2)), f"old{i}") for i in range(20)]
    new = [(*random_ids(rnd, 8), "m" + str(rnd.randrange(2)), f"new{i}", i) for i in range(30)]
    table = list(old)
    for *row, _ in new:
        kind = next((i for i in range(3) if row[i]), None)
        if kind is not None:
            table = [t for t in table if not (t[kind] == row[kind] and t[3] == row[3])]
        table.append(tuple(row))
    schema = "doi string, pmid string, pmcid string, model string, species string"
    got = merge.replace_descriptors(frame(spark, old, schema), frame(spark, new, schema + ", seq bigint"))
    assert rows_of(got, *IDS, "model", "species") == sorted(table, key=repr)


def test_apply_status_errors_and_times(spark):
    now = datetime.datetime(2024, 5, 1)
    requests = frame(spark, [(1, "approved", None, None, None), (2, "in_progress", "why", None, None), (3, "pending", None, None, None)],
                     "id bigint, request_status string, status_reason string, assigned_time timestamp_ntz, updated_at timestamp_ntz")
    p = frame(spark, [(1, "in_progress", "start"), (2, "incomplete", " no api "), (3, "implemented", None), (9, "implemented", None)],
              "request_id bigint, new_status string, status_reason string")
    results, table = merge.apply_status(requests, p, F.lit(now))
    by = {r.request_id: r for r in results.collect()}
    assert by[1].success and by[2].success and by[2].status_reason == "no api"
    assert by[3].error == ("Cannot mark request as implemented: current status is 'pending', but only 'approved' or 'in_progress' requests can be "
                           "marked as implemented")
    assert by[9].error == "Feature request with ID 9 not found"
    state = {r.id: r for r in table.collect()}
    assert (state[1].request_status, state[1].status_reason, state[1].assigned_time, state[1].updated_at) == ("in_progress", "start", now, now)
    assert (state[2].request_status, state[2].status_reason, state[2].assigned_time) == ("incomplete", "no api", None)
    assert state[3].request_status == "pending" and state[3].updated_at is None
    blank, _ = merge.apply_status(requests, frame(spark, [(99, "incomplete", " ")], "request_id bigint, new_status string, status_reason string"))
    assert blank.first().error == "status_reason is required when marking a request as incomplete"


def test_backfill_overwrite_and_limit(spark):
    articles = frame(spark, [("a", "1", None, datetime.date(2000, 1, 1)), ("b", "2", None, None), ("c", None, None, None)],
                     "doi string, pmid string, pmcid string, publication_date date")
    snapshot = frame(spark, [("1", datetime.date(2001, 1, 1), None), ("2", None, None)], "pmid string, publication_date date, error string")
    out, counters = merge.backfill_dates(articles, snapshot)
    assert counters.first().asDict() == {"total_articles": 1, "updated": 0, "no_pmid": 0, "no_date_found": 1, "fetch_failed": 0}
    out, counters = merge.backfill_dates(articles, snapshot, overwrite=True, limit=1)
    assert counters.first().total_articles == 1
    assert rows_of(out, "doi", "publication_date")[0] == ("a", datetime.date(2001, 1, 1))


def test_append_and_json(spark):
    old = frame(spark, [(4, "x", "[1]")], "id bigint, tool string, params string")
    new = frame(spark, [("y", {"a": 1}, 20), ("z", None, 10)], "tool string, params map<string,int>, seq bigint")
    got = merge.append_run(old, new, ["params"])
    assert rows_of(got, "id", "tool", "params") == [(4, "x", "[1]"), (5, "z", None), (6, "y", '{"a":1}')]
    decoded = got.select(merge.decode_json(F.lit("not json")).isNull(), merge.decode_json(F.lit("[1,2]")).isNull()).first()
    assert tuple(decoded) == (True, False)


def test_id_join_equals_or_join(spark):
    rnd = random.Random(3)
    left = [(*random_ids(rnd, 15), i) for i in range(60)]
    right = [(*random_ids(rnd, 15), i) for i in range(80)]
    l, r = (frame(spark, x, "doi string, pmid string, pmcid string, i int") for x in (left, right))
    match = lambda a, b: any(x is not None and x == y for x, y in zip(a[:3], b[:3]))
    pairs = sorted((a[3], b[3]) for a in left for b in right if match(a, b))
    assert rows_of(id_join(l, r), "l_i", "r_i") == sorted(pairs, key=repr)
    lonely = [a[3] for a in left if not any(match(a, b) for b in right)]
    assert sorted(x.i for x in id_join(l, r, "anti").collect()) == lonely
    assert sorted(x.i for x in id_join(l, r, "semi").collect()) == sorted({p[0] for p in pairs})
    outer = rows_of(id_join(l, r, "left"), "l_i", "r_i")
    assert outer == sorted(pairs + [(i, None) for i in lonely], key=repr)
    with pytest.raises(ValueError):
        id_join(l, r, "full")


def test_id_lookup_priority(spark):
    right = frame(spark, [("a", None, None, 1), ("b", "p", None, 2)], "doi string, pmid string, pmcid string, i int")
    left = frame(spark, [("a", "p", None), ("zz", "p", None), ("", None, None)], "doi string, pmid string, pmcid string")
    assert rows_of(id_lookup(left, right, ["i"]), "doi", "i", "matched_by") == sorted([("a", 1, "doi"), ("zz", 2, "pmid"), ("", None, None)], key=repr)


def test_constraint_report(spark):
    files = frame(spark, [(1, "D", "f", "guess"), (2, "D", "f", None), (3, "E", "g", "llm")], "id bigint, dataset_id string, filename string, method string")
    datasets = frame(spark, [("D",)], "dataset_id string")
    got = rows_of(validate.constraint_report({"dataset_files": files, "datasets": datasets}), "kind", "constraint_columns", "key", "n")
    assert got == [("check", "method", "guess", 1), ("foreign_key", "dataset_id", "E", 1), ("unique", "dataset_id,filename", "D|f", 2)]
