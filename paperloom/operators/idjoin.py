"""Joins on "any of doi, pmid, pmcid is equal".

Written as one OR condition, Spark can only compare all pairs. Here each identifier gets its
own equi-join, and a pair found by an earlier identifier is left out of the later ones, so
the parts can simply be appended: no de-duplication and no row numbers are needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import ARTICLE_IDS


def _spread(df: DataFrame, key: str) -> Column:
    """Join key in which NULLs are spread out instead of meeting in one task; they match nothing."""
    others = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    return F.coalesce(F.col(f"`{key}`").cast("string"), F.concat(F.lit("\u0000"), F.xxhash64(*others).cast("string")))


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def _by_identifier(df: DataFrame, prefix: str, ids: Sequence[str]) -> DataFrame:
    """One row per identifier that is present, with ``{prefix}kind`` and ``{prefix}id``."""
    entries = [F.struct(F.lit(i).alias("kind"), F.col(f"{prefix}{k}").cast("string").alias("id")) for i, k in enumerate(ids)]
    present = F.explode(F.filter(F.array(*entries), lambda e: e["id"].isNotNull()))
    rows = df.withColumn("_at", present)
    return rows.withColumns({f"_{prefix}kind": F.col("_at.kind"), f"_{prefix}id": F.col("_at.id")}).drop("_at")


def id_pairs(left: DataFrame, right: DataFrame, ids: Sequence[str] = ARTICLE_IDS) -> DataFrame:
    """All pairs with an equal identifier, each pair once; columns ``l_*`` and ``r_*``.

    Both sides are exchanged once, by kind and value of their identifiers. A pair that agrees in
    several is kept at the first.
    """
    a, b = _by_identifier(_renamed(left, "l_"), "l_", ids), _by_identifier(_renamed(right, "r_"), "r_", ids)
    met = a.join(b, (F.col("_l_kind") == F.col("_r_kind")) & (F.col("_l_id") == F.col("_r_id")))
    for i, key in enumerate(ids[:-1]):
        met = met.where((F.col("_l_kind") <= i) | ~F.coalesce(F.col(f"l_{key}") == F.col(f"r_{key}"), F.lit(False)))
    return met.drop("_l_kind", "_l_id", "_r_kind", "_r_id")


def id_left(left: DataFrame, right: DataFrame, ids: Sequence[str] = ARTICLE_IDS) -> DataFrame:
    """The pairs of id_pairs, and each row of ``left`` without a pair once, with NULL ``r_*``.

    A row of ``left`` comes to the join once for each identifier it has and once for itself; that last one meets nothing
    and stays if none of the others met anything. So pairs and rows without one come out of the same join.
    """
    a = _renamed(left, "l_").withColumn("_row", F.monotonically_increasing_id())
    alone = F.struct(F.lit(-1).alias("kind"), F.concat(F.lit("\u0000"), F.col("_row").cast("string")).alias("id"))
    entries = [F.struct(F.lit(i).alias("kind"), F.col(f"l_{k}").cast("string").alias("id")) for i, k in enumerate(ids)]
    a = a.withColumn("_at", F.explode(F.filter(F.array(alone, *entries), lambda e: e["id"].isNotNull())))
    a = a.withColumns({"_l_kind": F.col("_at.kind"), "_l_id": F.col("_at.id")}).drop("_at")
    b = _by_identifier(_renamed(right, "r_"), "r_", ids)
    met = a.join(b, (F.col("_l_kind") == F.col("_r_kind")) & (F.col("_l_id") == F.col("_r_id")), "left")
    pair = F.col("_r_kind").isNotNull()
    met = met.where(pair | (F.col("_l_kind") < 0))
    for i, key in enumerate(ids[:-1]):
        met = met.where(~pair | (F.col("_l_kind") <= i) | ~F.coalesce(F.col(f"l_{key}") == F.col(f"r_{key}"), F.lit(False)))
    met = met.withColumn("_any", F.max(pair).over(Window.partitionBy("_row")))
    return met.where(pair | ~F.col("_any")).drop("_l_kind", "_l_id", "_r_kind", "_r_id", "_row", "_any")


def id_anti(left: DataFrame, right: DataFrame, ids: Sequence[str] = ARTICLE_IDS, also: Sequence[str] = ()) -> DataFrame:
    """Rows of ``left`` that share no identifier (and equal ``also`` columns) with ``right``."""
    out = left
    for key in ids:
        known = right.where(F.col(key).isNotNull()).select(
            F.col(key).cast("string").alias("_id"), *[F.col(c).alias(f"_{c}") for c in also]
        ).distinct()
        test = F.col("_key") == F.col("_id")
        for c in also:
            test = test & F.col(f"`{c}`").eqNullSafe(F.col(f"_{c}"))
        out = out.withColumn("_key", _spread(out, key)).join(known, test, "left_anti").drop("_key")
    return out


def id_semi(left: DataFrame, right: DataFrame, ids: Sequence[str] = ARTICLE_IDS) -> DataFrame:
    """Rows of ``left`` that share an identifier with ``right``."""
    out, hits = left, []
    for i, key in enumerate(ids):
        known = right.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_id")).distinct()
        flag = known.withColumn(f"_hit{i}", F.lit(True))
        out = out.withColumn("_key", _spread(out, key)).join(flag, F.col("_key") == F.col("_id"), "left").drop("_key", "_id")
        hits.append(F.col(f"_hit{i}"))
    return out.where(F.coalesce(*hits)).select(*left.columns)


def id_join(left: DataFrame, right: DataFrame, how: str = "inner", ids: Sequence[str] = ARTICLE_IDS) -> DataFrame:
    """Any-identifier join. ``inner`` and ``left`` give ``l_*``/``r_*`` columns; ``semi``/``anti`` keep ``left``."""
    if how == "semi":
        return id_semi(left, right, ids)
    if how == "anti":
        return id_anti(left, right, ids)
    if how == "inner":
        return id_pairs(left, right, ids)
    if how != "left":
        raise ValueError(f"unsupported join type: {how}")
    return id_left(left, right, ids)


def id_lookup(left: DataFrame, right: DataFrame, columns: Sequence[str], prefix: str = "", ids: Sequence[str] = ARTICLE_IDS) -> DataFrame:
    """First hit by doi, then pmid, then pmcid: adds ``columns`` of ``right``, and ``matched_by``.

    Each identifier is unique in ``right``; where it is not, one row is chosen by its values.
    """
    out = left
    for i, key in enumerate(ids):
        row = F.struct(*[F.col(f"`{c}`") for c in columns])
        table = right.where(F.coalesce(F.col(key) != "", F.lit(False))).groupBy(F.col(key).cast("string").alias("_id")).agg(
            F.max(row).alias(f"_row{i}")
        )
        out = out.withColumn("_key", _spread(out, key)).join(table, F.col("_key") == F.col("_id"), "left").drop("_key", "_id")
    rows = [F.col(f"_row{i}") for i in range(len(ids))]
    hit = F.coalesce(*rows)
    by = F.coalesce(*[F.when(r.isNotNull(), key) for r, key in zip(rows, ids)])
    return out.select(
        *[F.col(f"`{c}`") for c in left.columns], *[hit[c].alias(prefix + c) for c in columns], by.alias("matched_by")
    )


def pending_extraction(articles: DataFrame, facts: Sequence[DataFrame], model: str, limit: int | None = None) -> DataFrame:
    """Articles with full text and no fact of ``model`` in any fact table, newest first.

    ``NOT EXISTS (doi = … OR pmid = … OR pmcid = …)`` over five tables equals three anti joins
    against the identifiers of all five.
    """
    done = reduce(
        DataFrame.unionByName, [f.where(F.col("model") == model).select(*ARTICLE_IDS) for f in facts]
    )
    out = id_anti(articles.where(F.col("article_filepath").isNotNull()), done)
    if "created_at" in out.columns:
        out = out.orderBy(F.desc("created_at"), *ARTICLE_IDS)
    return out if limit is None else out.limit(limit)


def has_extraction(facts: Sequence[DataFrame], model: str, doi=None, pmid=None, pmcid=None) -> DataFrame:
    """One row, ``found``: whether any fact of ``model`` exists for the article."""
    given = {"doi": doi, "pmid": pmid, "pmcid": pmcid}
    tests = [F.col(k) == v for k, v in given.items() if v is not None]
    hit = reduce(lambda a, b: a | b, tests) if tests else F.lit(False)
    rows = reduce(DataFrame.unionByName, [f.where((F.col("model") == model) & hit).select("model") for f in facts])
    return rows.limit(1).agg((F.count("*") > 0).alias("found"))


def id_conflicts(new: DataFrame, articles: DataFrame) -> DataFrame:
    """One row per disagreement between new metadata and the stored article it meets.

    The reference record is the first hit by doi, pmid, pmcid. Reported are other hits with
    another doi, and identifiers that differ from the reference record.
    """
    out = new.select(*ARTICLE_IDS)
    for key in ARTICLE_IDS:
        row = F.struct(*ARTICLE_IDS)
        table = articles.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_id")).agg(F.max(row).alias(f"by_{key}"))
        out = out.withColumn("_key", _spread(out, key)).join(table, F.col("_key") == F.col("_id"), "left").drop("_key", "_id")
    ref = F.coalesce(*[F.col(f"by_{k}") for k in ARTICLE_IDS])
    out = out.withColumn("_ref", ref)

    def issue(kind, key, seen, stored, test):
        return F.when(test, F.struct(F.lit(kind).alias("issue"), F.lit(key).alias("id_type"), seen.alias("seen"), stored.alias("stored")))

    issues = [
        issue("other_article", k, F.col(k), F.col(f"by_{k}")["doi"],
              F.col(f"by_{k}").isNotNull() & ~F.col("_ref")["doi"].eqNullSafe(F.col(f"by_{k}")["doi"]))
        for k in ARTICLE_IDS
    ] + [
        issue("id_differs", k, F.col(k), F.col("_ref")[k],
              (F.col(k) != "") & (F.col("_ref")[k] != "") & (F.col(k) != F.col("_ref")[k]))
        for k in ARTICLE_IDS
    ]
    found = F.filter(F.array(*issues), lambda x: x.isNotNull())
    return out.select(*ARTICLE_IDS, F.explode(found).alias("i")).select(*ARTICLE_IDS, "i.*")
