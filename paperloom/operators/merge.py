"""Upserts, key assignment, links and status changes, each as one batch over whole tables.

Every function returns the merged frame; the caller writes it to a new path and swaps. A
batch's order is given by an integer ``seq`` column whose values are distinct.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import ARTICLE_IDS
from ..functions.text import strip, strip_tags
from ..session import materialize
from .idjoin import id_anti
from .ranking import first_by, join_same, last_by, lookup, number_rows
from .replay import first_come, groups_of, key_of, openers


def _after(old: DataFrame, new: DataFrame, seq: str) -> DataFrame:
    """Old rows come before every new row."""
    columns = [c for c in new.columns if c != seq]
    return (
        old.withColumn(seq, F.lit(None).cast("bigint"))
        .unionByName(new.select(*columns, F.col(seq).cast("bigint")), allowMissingColumns=True)
        .withColumn(seq, F.coalesce(F.col(seq), F.lit(-(1 << 62))))
    )


def coalesce_upsert(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    seq: str = "seq",
    replaced: Sequence[str] = (),
    longest: Sequence[str] = (),
    kept: Sequence[str] = (),
) -> DataFrame:
    """Apply ``new`` rows to ``old`` in ``seq`` order, as one aggregation per key.

    By default the last non-NULL value of a column wins. ``replaced`` columns take the last
    row's value even if NULL, ``longest`` columns the first of the longest texts, ``kept``
    columns the first non-NULL value. A NULL key never meets another row.
    """
    rows = _after(old, new, seq)
    order = F.col(seq)
    unkeyed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    loose = rows.where(unkeyed).drop(seq)
    aggs = []
    for c in old.columns:
        if c in key or c in replaced:
            continue
        value = F.col(f"`{c}`")
        if c in longest:
            aggs.append(F.max_by(value, F.when(value.isNotNull(), F.struct(F.char_length(value), -order))).alias(c))
        elif c in kept:
            aggs.append(F.min_by(value, F.when(value.isNotNull(), order)).alias(c))
        else:
            aggs.append(F.max_by(value, F.when(value.isNotNull(), order)).alias(c))
    if replaced:
        aggs.append(F.max_by(F.struct(*replaced), order).alias("_last"))
    merged = rows.where(~unkeyed).groupBy(*key).agg(*aggs)
    merged = merged.select(*[F.col("_last")[c].alias(c) if c in replaced else F.col(f"`{c}`") for c in old.columns])
    return merged.unionByName(loose)


def upsert_articles(old: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    """Article upsert by doi: tags leave the title, and only a longer title replaces one."""
    return coalesce_upsert(old, new.withColumn("title", strip_tags(F.col("title"))), ["doi"], seq, longest=["title"])


def upsert_embeddings(old: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    return coalesce_upsert(old, new, ["doi"], seq, replaced=["embedding", "model"])


def upsert_datasets(old: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    return coalesce_upsert(old, new, ["dataset_id"], seq)


def upsert_dataset_files(old: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    return coalesce_upsert(old, new, ["dataset_id", "filename"], seq)


def upsert_classes(old: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    replaced = [c for c in ("classification", "justification", "model") if c in old.columns]
    return coalesce_upsert(old, new, ["archive_path", "file_path"], seq, replaced=replaced)


def update_proteome_files(proteomes: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """Set file path and checksum of known proteomes; unknown ids are ignored, nothing is coalesced."""
    fields = ["local_filepath", "sha256sum"]
    last = last_by(updates.select("proteome_id", *fields, seq), ["proteome_id"], seq)
    row = last.select("proteome_id", F.struct(*fields).alias("_new"))
    out = join_same(proteomes, row, [], "left", exact=["proteome_id"])
    return out.select(*[
        F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in fields else F.col(f"`{c}`")
        for c in proteomes.columns
    ])


def _max_id(df: DataFrame, id_col: str) -> Column:
    return F.coalesce(df.agg(F.max(id_col)).scalar(), F.lit(0)).cast("bigint")


def append_rows(table: DataFrame, rows: DataFrame, id_col: str = "id", seq: str = "seq") -> DataFrame:
    """Append ``rows`` in ``seq`` order with ids that continue those of ``table``."""
    return table.unionByName(_numbered(table, rows, id_col, seq).drop(seq), allowMissingColumns=True)


def _numbered(table: DataFrame, rows: DataFrame, id_col: str, seq: str) -> DataFrame:
    """``rows`` with ids that continue those of ``table``. Numbering reads them three times, so they are written first."""
    numbered = number_rows(materialize(rows), seq, name="_no")
    return numbered.withColumn(id_col, _max_id(table, id_col) + F.col("_no")).drop("_no")


def encode_json(c: Column, is_text: bool = False) -> Column:
    """JSON text of a structured column; text is stored as it is."""
    return c if is_text else F.to_json(c)


def decode_json(c: Column) -> Column:
    """VARIANT of a JSON text; invalid text is NULL."""
    return F.try_parse_json(c)


def append_run(table: DataFrame, rows: DataFrame, json_columns: Sequence[str] = (), id_col: str = "id", seq: str = "seq") -> DataFrame:
    """Append provenance rows, encoding array, map and struct columns as JSON text."""
    kinds = dict(rows.dtypes)
    for c in json_columns:
        if c in kinds:
            rows = rows.withColumn(c, encode_json(F.col(c), kinds[c] == "string"))
    return append_rows(table, rows, id_col, seq)


def assign_keys(
    existing: DataFrame, new: DataFrame, natural_key: Sequence[str], id_col: str, seq: str = "seq"
) -> tuple[DataFrame, DataFrame]:
    """Give each new natural key an id, in order of first appearance.

    Returns the grown dimension table and ``natural_key -> id`` for the rows of ``new``. The
    first row's attributes are kept. First rows and numbered rows are written, so that neither result's plan holds ``new``.
    """
    natural_key = list(natural_key)
    attributes = [c for c in new.columns if c in existing.columns and c != id_col and c not in natural_key]
    given = new.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in natural_key]))
    firsts = materialize(first_by(given.select(*natural_key, *attributes, seq), natural_key, seq))
    fresh = firsts.join(existing.select(*natural_key), natural_key, "left_anti")
    table = existing.unionByName(materialize(_numbered(existing, fresh, id_col, seq).drop(seq)), allowMissingColumns=True)
    return table, table.join(firsts.select(*natural_key), natural_key, "left_semi").select(*natural_key, id_col)


def resolve_grants(existing: DataFrame, new: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Grants are shared by number and agency when both are present; otherwise each row is a new grant.

    Returns the grown table and ``seq -> grant_id``.
    """
    full = (F.coalesce(F.col("grant_number"), F.lit("")) != "") & (F.coalesce(F.col("agency"), F.lit("")) != "")
    shared = F.to_json(F.struct("grant_number", "agency"))
    key = F.when(full, shared).otherwise(F.concat(F.lit("row "), F.col(seq).cast("string")))
    return _resolve(existing, new.withColumn("_key", key), existing.where(full).withColumn("_key", shared), "grant_id", seq)


def _resolve(existing, new, keyed, id_col, seq):
    """Shared tail: new rows carry ``_key``; ``keyed`` is the existing rows that can be met by it. Rows that open an id are written, before and after they are numbered."""
    known = keyed.groupBy("_key").agg(F.min(id_col).alias("_known"))
    attributes = [c for c in existing.columns if c != id_col and c in new.columns]
    fresh = first_by(new.select("_key", *attributes, seq), ["_key"], seq).join(known.select("_key"), "_key", "left_anti")
    numbered = materialize(_numbered(existing, fresh, id_col, seq))
    table = existing.unionByName(numbered.select(*attributes, id_col), allowMissingColumns=True)
    ids = known.unionByName(numbered.select("_key", F.col(id_col).alias("_known")))
    assigned = join_same(new.select(seq, "_key"), ids, [], exact=["_key"]).select(seq, F.col("_known").alias(id_col))
    return table, assigned


def resolve_mesh(existing: DataFrame, new: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """MeSH terms by UI, else by name among terms without a UI. Returns table and ``seq -> mesh_term_id``.

    In-batch order counts: a term with a UI meets a UI-less namesake only if that one came first.
    """
    ui, name = F.col("descriptor_ui"), F.col("descriptor_name")
    has_ui = F.coalesce(ui, F.lit("")) != ""
    by_ui, by_name = F.concat(F.lit("ui "), ui), F.concat(F.lit("name "), name)
    known_ui = existing.where(has_ui).select(F.col("descriptor_ui").alias("_u"), F.lit(True).alias("_ui_known")).distinct()
    # A stored term without UI counts as seen before the batch.
    bare = existing.where(ui.isNull()).select(name.alias("_n"), F.lit(-1).cast("bigint").alias("_t"))
    bare = bare.unionByName(new.where(~has_ui).select(name.alias("_n"), F.col(seq).cast("bigint").alias("_t")))
    bare = bare.groupBy("_n").agg(F.min("_t").alias("_bare_at"))
    rows = lookup(new, known_ui, F.when(has_ui, ui), "_u")
    rows = lookup(rows, bare, name, "_n")
    opens = has_ui & F.col("_ui_known").isNull() & (F.col("_bare_at").isNull() | (F.col(seq) < F.col("_bare_at")))
    opened = rows.where(opens).groupBy(ui.alias("_u2")).agg(F.min(seq).alias("_ui_at"))
    rows = lookup(rows, opened, F.when(has_ui, ui), "_u2")
    use_ui = has_ui & (F.col("_ui_known").isNotNull() | (F.col("_ui_at") <= F.col(seq)))
    keyed_new = rows.withColumn("_key", F.when(F.coalesce(use_ui, F.lit(False)), by_ui).otherwise(by_name))
    # A row that meets a name key never brings its UI along.
    keyed_new = keyed_new.withColumn("descriptor_ui", F.when(F.startswith("_key", F.lit("ui ")), ui))
    keyed_old = existing.withColumn("_key", F.when(has_ui, by_ui).when(ui.isNull(), by_name)).where(F.col("_key").isNotNull())
    return _resolve(existing, materialize(keyed_new.drop("_ui_known", "_bare_at", "_ui_at")), keyed_old, "mesh_term_id", seq)


def resolve_authors(existing: DataFrame, new: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Authors by ORCID, else by equal names where one side has no ORCID, else new.

    Returns the grown table and ``seq -> author_id``, as if rows came one by one in ``seq`` order: a new
    author is one as soon as its first row is through. A NULL last name equals no other.
    """
    new = new.withColumn("author_orcid", F.nullif(F.col("author_orcid"), F.lit("")))
    orcid = F.col("author_orcid")
    name = F.when(F.col("last_name").isNotNull(), key_of(F.lit("name"), F.col("last_name"), F.col("first_name"), F.col("initials")))
    by_orcid = existing.where(orcid.isNotNull()).groupBy(key_of(F.lit("orcid"), orcid).alias("_so")).agg(F.min("author_id").alias("_by_orcid"))
    names = existing.where(F.col("last_name").isNotNull()).groupBy(name.alias("_sn")).agg(
        F.min("author_id").alias("_any"), F.min(F.when(orcid.isNull(), F.col("author_id"))).alias("_bare")
    )
    rows = new.withColumn("_o", F.when(orcid.isNotNull(), key_of(F.lit("orcid"), orcid))).withColumn("_n", name)
    rows = lookup(lookup(rows, by_orcid, F.col("_o"), "_so"), names, F.col("_n"), "_sn")
    rows = rows.withColumn("_known", F.coalesce("_by_orcid", F.when(orcid.isNull(), F.col("_any"))))
    # A name that is stored without an ORCID waits for rows whose ORCID nobody has by then.
    rows = materialize(rows.withColumn("_waits", F.when(orcid.isNotNull(), F.col("_bare"))).drop("_by_orcid", "_any", "_bare"))
    unmet = rows.where(F.col("_known").isNull()).drop("_known")
    alone = F.col("_o").isNull() & F.col("_n").isNull()
    # Rows of one name and ORCID can open an author only with the first of them.
    pairs = unmet.where(~alone & F.col("_waits").isNull()).groupBy(F.col("_o").alias("orcid"), F.col("_n").alias("name")).agg(F.min(seq).cast("bigint").alias("seq"))
    first = openers(pairs).unionByName(unmet.where(alone).select(F.col(seq).cast("bigint").alias("seq"))).select(F.col("seq").alias("_first"))
    opened = number_rows(unmet.join(first, F.col(seq) == F.col("_first")).drop("_first", "_waits"), seq, name="_no")
    opened = materialize(opened.withColumn("author_id", _max_id(existing, "author_id") + F.col("_no")).drop("_no"))
    attributes = [c for c in existing.columns if c != "author_id" and c in new.columns]
    table = existing.unionByName(opened.select(*attributes, "author_id"), allowMissingColumns=True)

    def earliest(authors, key, to):
        return authors.groupBy(F.col(key).alias(f"_k{to}")).agg(F.min(seq).alias(f"_at{to}"), F.min("author_id").alias(f"_id{to}"))

    found = lookup(unmet, earliest(opened.where("_o is not null"), "_o", "o"), F.col("_o"), "_ko")
    found = lookup(found, earliest(opened.where("_n is not null"), "_n", "n"), F.when(orcid.isNull(), F.col("_n")), "_kn")
    found = lookup(found, earliest(opened.where("_o is null and _n is not null"), "_n", "b"), F.when(orcid.isNotNull(), F.col("_n")), "_kb")
    found = lookup(found, opened.where(alone).select(F.col(seq).alias("_ks"), F.col("author_id").alias("_ids")), F.when(alone, F.col(seq)), "_ks")
    # An author that was opened later was not there yet.
    hits = [F.when(F.col(f"_at{to}") <= F.col(seq), F.col(f"_id{to}")) for to in "onb"]
    assigned = found.select(seq, F.coalesce(hits[0], F.col("_waits"), *hits[1:], F.col("_ids")).alias("author_id"))
    return table, rows.where(F.col("_known").isNotNull()).select(seq, F.col("_known").alias("author_id")).unionByName(assigned)


def add_links(
    existing: DataFrame,
    new: DataFrame,
    payload: Sequence[str],
    seq: str = "seq",
    null_safe: Sequence[str] | None = None,
    ids: Sequence[str] = ARTICLE_IDS,
    id_col: str | None = None,
    consistent: bool = False,
) -> DataFrame:
    """Insert-or-ignore of link rows: no two rows share an identifier and the payload.

    NULL identifiers never clash. ``null_safe`` switches to one existence test on those
    columns in which NULL equals NULL. Rows are taken in ``seq`` order: a row counts only if
    no earlier row that counts clashes with it. Rows that are first in all of their groups settle
    nearly everything at once; conflicts that hang on other open rows are replayed in order,
    component by component. With ``id_col`` new rows are numbered after the existing ones. ``consistent`` promises that
    rows which share an identifier share all three; one aggregation is then enough.
    """
    payload = list(payload)

    def grown(rows):
        if id_col is not None:
            return append_rows(existing, rows, id_col, seq)
        return existing.unionByName(rows.drop(seq), allowMissingColumns=True)

    if null_safe is not None:
        key = [*null_safe, *payload]
        firsts = first_by(new, key, seq)
        fresh = join_same(firsts, existing.select(*key).distinct().withColumn("_old", F.lit(True)), key, "left")
        return grown(fresh.where(F.col("_old").isNull()).drop("_old"))

    present = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in ids])
    # Of equal rows only the first can count, so copies are gone before anything is joined.
    firsts = first_by(new.where(present), [*ids, *payload], seq)
    waiting = id_anti(firsts, existing, ids, also=payload)
    loose = new.where(~present)
    if consistent:
        return grown(waiting.unionByName(first_by(loose, [*ids, *payload], seq)))
    waiting = materialize(waiting)
    counted = first_come(groups_of(waiting, ids, payload, seq)).select(F.col("seq").alias("_counted"))
    return grown(waiting.join(counted, F.col(seq) == F.col("_counted"), "left_semi").unionByName(loose))


def replace_descriptors(old: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    """Each new descriptor removes those with its first present identifier and model, then is added."""
    kind = F.coalesce(*[F.when(F.coalesce(F.col(k), F.lit("")) != "", k) for k in ARTICLE_IDS])
    value = F.coalesce(*[F.nullif(F.col(k), F.lit("")) for k in ARTICLE_IDS])
    removers = new.select(kind.alias("_kind"), value.alias("_value"), F.col("model").alias("_model"), F.col(seq).alias("_at"))
    removers = removers.where(F.col("_kind").isNotNull()).groupBy("_kind", "_value", "_model").agg(F.max("_at").alias("_last"))
    rows = _after(old, new, seq)
    for k in ARTICLE_IDS:
        by = removers.where(F.col("_kind") == k).select("_value", "_model", F.col("_last").alias(f"_last_{k}"))
        rows = lookup(rows, by, F.col(k), "_value", (F.col("model"), "_model"))
    last = F.greatest(*[F.col(f"_last_{k}") for k in ARTICLE_IDS])
    return rows.where(last.isNull() | (last <= F.col(seq))).select(*old.columns)


# For each new status, the statuses it may follow and how they are named in errors.
TRANSITIONS = {
    "in_progress": (("approved",), "only 'approved' requests can be marked as in_progress"),
    "implemented": (("approved", "in_progress"), "only 'approved' or 'in_progress' requests can be marked as implemented"),
    "incomplete": (("approved", "in_progress"), "only 'approved' or 'in_progress' requests can be marked as incomplete"),
}


def apply_status(requests: DataFrame, proposals: DataFrame, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Apply status proposals ``(request_id, new_status, status_reason)``, at most one per request.

    Returns one result row per proposal (success or the error text) and the changed table.
    """
    now = F.current_timestamp() if now is None else now
    current = requests.select(F.col("id").alias("_id"), F.col("request_status").alias("previous_status"))
    p = proposals.join(current, F.col("request_id") == F.col("_id"), "left")
    new, old = F.col("new_status"), F.col("previous_status")
    no_reason = (new == "incomplete") & (strip(F.coalesce(F.col("status_reason"), F.lit(""))) == "")
    allowed = reduce(lambda a, b: a | b, [(new == s) & old.isin(*before) for s, (before, _) in TRANSITIONS.items()])
    rule = F.coalesce(*[F.when(new == s, text) for s, (_, text) in TRANSITIONS.items()])
    error = (
        F.when(~new.isin(*TRANSITIONS), F.concat(F.lit("Unknown status: "), new))
        # The texts of all errors.
        .when(no_reason, "status_reason is required when marking a request as incomplete")
        .when(F.col("_id").isNull(),
              F.concat(F.lit("Feature request with ID "), F.col("request_id").cast("string"), F.lit(" not found")))
        .when(old == new, F.concat(F.lit("Feature request is already marked as "), new))
        .when(~F.coalesce(allowed, F.lit(False)),
              F.concat(F.lit("Cannot mark request as "), new, F.lit(": current status is '"), old, F.lit("', but "), rule))
    )
    results = p.select(
        "request_id", error.isNull().alias("success"), "previous_status",
        F.when(error.isNull(), new).alias("new_status"),
        F.when(new == "incomplete", strip(F.col("status_reason"))).otherwise(F.col("status_reason")).alias("status_reason"),
        error.alias("error"),
    )
    done = results.where("success").select(
        F.col("request_id").alias("_id"), F.col("new_status").alias("_status"), F.col("status_reason").alias("_reason")
    )
    joined = requests.join(done, F.col("id") == F.col("_id"), "left")
    changed, moved = F.col("_status").isNotNull(), F.col("_status")
    values = {
        "request_status": F.coalesce(moved, F.col("request_status")),
        "status_reason": F.when(moved.isin("in_progress", "incomplete"), F.col("_reason")),
        "assigned_time": F.when(moved == "in_progress", now),
        "updated_at": F.when(changed, now),
    }
    out = []
    for c in requests.columns:
        if c == "request_status":
            out.append(values[c].alias(c))
        elif c == "status_reason":
            out.append(F.when(moved.isin("in_progress", "incomplete"), F.col("_reason")).otherwise(F.col(c)).alias(c))
        elif c in values:
            out.append(F.coalesce(values[c].cast(requests.schema[c].dataType), F.col(c)).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return results, joined.select(*out)


def backfill_dates(
    articles: DataFrame, snapshot: DataFrame, overwrite: bool = False, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fill publication dates from ``snapshot(pmid, publication_date, error)``, one row per pmid.

    Only articles with a pmid and, unless ``overwrite``, without a date are looked at. An
    article whose pmid the snapshot lacks counts as a failed fetch. Returns articles and counters.
    """
    pmid, stored = F.col("pmid"), F.col("publication_date")
    eligible = pmid.isNotNull() if overwrite else pmid.isNotNull() & stored.isNull()
    if limit is not None:
        chosen = articles.where(eligible).orderBy(*ARTICLE_IDS).limit(limit).select("pmid").withColumn("_chosen", F.lit(True))
        articles = join_same(articles, chosen, [], "left", exact=["pmid"])
        eligible = eligible & F.coalesce(F.col("_chosen"), F.lit(False))
    found = snapshot.select(
        F.col("pmid").alias("_pmid"), F.struct(F.col("publication_date").alias("d"), F.col("error").alias("e")).alias("_s")
    )
    rows = lookup(articles, found, F.when(eligible & (pmid != ""), pmid), "_pmid")
    status = (
        F.when(~eligible, "not_selected")
        .when(pmid == "", "no_pmid")
        .when(F.col("_s").isNull() | F.col("_s.e").isNotNull(), "fetch_failed")
        .when(F.col("_s.d").isNull(), "no_date_found")
        .otherwise("updated")
    )
    rows = rows.withColumn("_status", status)
    out = rows.select(*[
        F.when(F.col("_status") == "updated", F.col("_s.d")).otherwise(stored).alias(c) if c == "publication_date" else F.col(f"`{c}`")
        for c in articles.columns if c != "_chosen"
    ])
    counters = rows.agg(
        F.count_if(F.col("_status") != "not_selected").alias("total_articles"),
        *[F.count_if(F.col("_status") == s).alias(s) for s in ("updated", "no_pmid", "no_date_found", "fetch_failed")],
    )
    return out, counters
