"""URL verdicts: a rule list, then association rules that FP-growth mines from labelled URLs."""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_BAD, _GOOD = "label=bad", "label=good"


def host(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; empty without '://'."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host, up to '?', '#' or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def listed(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits, else nulls.

    A rule fits its host and all subdomains if the path starts with the rule's path. Of equally long
    rules the first in the list wins.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens: scheme, each host label with the labels after it told apart, path words, query keys. Numbers become '#'."""
    lower = F.lower(F.coalesce(url, F.lit("")))
    marked = lambda pattern, mark, of: F.transform(F.regexp_extract_all(of, F.lit(pattern), F.lit(1)), lambda t: F.concat(F.lit(mark), t))
    numbers = F.regexp_replace(path(lower), r"\d+", "#")
    query = F.regexp_extract(lower, r"\?([^#]*)", 1)
    parts = [
        marked(r"^([a-z][a-z0-9+.-]*)://", "scheme=", lower), marked(r"([^.\-:@]+)", "host=", host(lower)), marked(r"\.([^.:]+)(?::\d+)?$", "top=", host(lower)),
        marked(r"([\p{L}\p{N}#]+)", "path=", numbers), marked(r"(?:^|&)([^=&]+)", "query=", query),
    ]
    return F.array_distinct(F.concat(*parts))


def mine(labelled: DataFrame, support: float = 0.002, confidence: float = 0.6, lift: float = 2.0, deviations: float = 3.0) -> DataFrame:
    """Rules (antecedent, key, confidence, support) from rows (tokens, bad).

    All labelled rows are mined. A rule says that URLs with all its tokens are bad; it is kept if its
    confidence and lift reach the bounds and no rule with fewer of its tokens is as confident. Where so
    many rows are bad that no rule can reach the lift, a rule may instead leave at most 1 / ``lift`` of
    the share of good rows, if its bad rows are ``deviations`` standard deviations more than that many
    rows drawn from all would hold. ``key`` is its rarest token. No labels, or none of either kind, give no rules.
    """
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "antecedent array<string>, key string, confidence double, support double")
    rows = labelled.where("bad is not null").select(F.concat("tokens", F.array(F.when(F.col("bad") > 0, _BAD).otherwise(_GOOD))).alias("items"))
    rows = materialize(rows, "url-items")
    n, bad = rows.agg(F.count("*"), F.count_if(F.array_contains("items", _BAD))).first()
    if not bad:
        return empty
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(rows)
    single = F.col("consequent")[0] == _BAD
    kept = F.col("lift") >= lift
    if bad < n and bad * lift > n:
        base = bad / n
        covered = F.col("support") / F.col("confidence") * n
        significant = (F.col("confidence") - base) * F.sqrt(covered) >= deviations * (base * (1 - base)) ** 0.5
        kept = kept | ((1 - F.col("confidence") <= (1 - base) / lift) & significant)
    found = materialize(model.associationRules.where(single & kept).select(F.sort_array("antecedent").alias("antecedent"), "confidence", "support"), "url-rules")
    frequent = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    spread = found.select("antecedent", F.explode("antecedent").alias("token")).join(frequent, "token")
    keys = spread.groupBy("antecedent").agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    rules = materialize(found.join(keys, "antecedent"), "url-rules")
    shorter = match(rules.select(F.col("antecedent").alias("tokens"), F.col("confidence").alias("own")), rules)
    beaten = shorter.where((F.size("antecedent") < F.size("tokens")) & (F.col("confidence") >= F.col("own"))).select(F.col("tokens").alias("antecedent")).distinct()
    return materialize(rules.join(beaten, "antecedent", "left_anti").select(*empty.columns), "url-rules")


def match(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows with a ``tokens`` column joined with the rules whose tokens they all have.

    The index holds each rule under its rarest token only, so a row meets few rules it does not fit.
    """
    hits = rows.withColumn("key", F.explode("tokens")).join(rules, "key").drop("key")
    return hits.where(F.size(F.array_except("antecedent", "tokens")) == 0)


def judge(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]], **bounds) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, antecedent (of the mined rule that decided, or null).

    ``labelled`` has url and bad (1 or 0). Pages that no listed rule fits are blocked if a mined rule
    fits them, else allowed; of several mined rules the most confident is named. Distinct URLs are
    judged once, so repeated ones cost nothing more. Null or malformed URLs have an empty host and
    path and are allowed. Null ids and repeated rows are kept as they are; other columns are ignored.
    """
    mined = mine(labelled.select(tokens(F.col("url")).alias("tokens"), "bad"), **bounds)
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    known = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).withColumns({"rule": rule, "listed": verdict})
    open_ = known.where("listed is null and url is not null").select("url").distinct().withColumn("tokens", tokens(F.col("url")))
    best = match(open_, mined).groupBy("url").agg(F.max_by("antecedent", F.struct("confidence", "support", "antecedent")).alias("antecedent"))
    out = known.join(best, "url", "left")
    verdict = F.coalesce("listed", F.when(F.col("antecedent").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("listed").isNull(), F.col("antecedent")).alias("antecedent"))
