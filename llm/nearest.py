"""Exact nearest neighbours of binary codes by incremental multi-index hashing."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BITS, SEGMENTS = 64, 4
SEGMENT_BITS = BITS // SEGMENTS


def binary_code(vector: Column) -> Column:
    """64-bit code: bit i says whether entry i is positive. Null, and missing entries count as 0; a null vector has no code."""
    bits = F.transform(vector, lambda x, i: F.when((x > 0) & (i < BITS) & ~F.isnan(x), F.expr("1L")).otherwise(F.expr("0L")))
    weighted = F.zip_with(bits, F.sequence(F.lit(0), F.size(vector) - 1), lambda b, i: F.call_function("shiftleft", b, i % BITS))
    return F.when(F.size(vector) > 0, F.aggregate(weighted, F.expr("0L"), lambda a, b: a.bitwiseOR(b))).when(vector.isNotNull(), F.expr("0L"))


def segment(code: Column, number: Column) -> Column:
    return F.call_function("shiftrightunsigned", code, (number * SEGMENT_BITS).cast("int")).bitwiseAND((1 << SEGMENT_BITS) - 1).cast("int")


def nearest(queries: DataFrame, rows: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, neighbor_id, distance, rank): the k rows with the smallest Hamming distance to each query.

    Both inputs have id and code. A row is no neighbour of a query with its id. Ties are cut by id;
    ranks begin at 1. Fewer rows than k give fewer neighbours. Null ids and null codes take no part;
    repeated rows count once. Columns other than id and code are ignored.

    Codes are indexed by their 16-bit segments. In round r every query that is still open probes, in
    each segment, the values r bits away. After it all codes within 4r + 3 are known, since two codes
    further apart in every segment differ in at least 4(r + 1) bits. A query closes as soon as its kth
    distance is covered by that. Equal codes are one entry of the index, with their k + 1 smallest
    ids, which is all a result can use; so neither a code of many rows nor a query repeated as a code
    multiplies.
    """
    distinct = rows.where("id is not null and code is not null").select("id", "code").distinct()
    ranked = distinct.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("n") <= k + 1)
    # The own row of a query may be among them, hence one more than k.
    codes = materialize(ranked.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)))
    sizes = codes.select("code", F.size("ids").alias("rows"))
    index = codes.select("code", F.col("ids")[0].alias("first"), numbers.alias("segment")).withColumn("value", segment(F.col("code"), F.col("segment")))
    index = materialize(index, "code-index")
    asked = materialize(queries.where("id is not null and code is not null").select("id", "code").distinct(), "asked")
    open_ = asked.select(F.col("code").alias("q")).distinct()
    n_codes, best = codes.count(), None
    for r in range(SEGMENT_BITS + 1):
        masks = [sum(1 << b for b in flips) for flips in combinations(range(SEGMENT_BITS), r)]  # 12,870 at most
        probes = open_.withColumn("segment", numbers).withColumn("mask", F.explode(F.expr(f"array({','.join(map(str, masks))})")))
        probes = probes.withColumn("value", segment(F.col("q"), F.col("segment")).bitwiseXOR(F.col("mask"))).drop("mask")
        # Merged, because the planner takes the exploded probes for as small as the queries and would broadcast them.
        hits = probes.hint("merge").join(index, ["segment", "value"]).withColumn("distance", F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).cast("int"))
        if r:
            hits = hits.where(F.col("bound").isNull() | (F.col("distance") <= F.col("bound")))
        # A code counts where it is met first: in the first segment that is r bits away, if none is closer.
        gaps = [F.bit_count(segment(F.col("q").bitwiseXOR(F.col("code")), F.lit(s))) for s in range(SEGMENTS)]
        seen = reduce(Column.__or__, [(g < r) | ((g == r) & (F.col("segment") > s)) for s, g in enumerate(gaps)])
        hits = hits.where(~seen).select("q", "code", "first", "distance")
        hits = hits if best is None else hits.unionByName(best)
        # Among the k + 1 nearest codes, by distance and smallest id, are the k + 1 nearest rows.
        order = F.row_number().over(Window.partitionBy("q").orderBy("distance", "first"))
        best = materialize(hits.withColumn("n", order).where(F.col("n") <= k + 1).drop("n"), "near-codes")
        upto = best.join(sizes, "code").withColumn("upto", F.sum("rows").over(Window.partitionBy("q").orderBy("distance")))
        upto = upto.groupBy("q").agg(F.min(F.when(F.col("upto") > k, F.col("distance"))).alias("bound"), F.count("*").alias("found"))
        done = (F.col("bound") < SEGMENTS * (r + 1)) | (F.col("found") >= n_codes)
        open_ = asked.select(F.col("code").alias("q")).distinct().join(upto, "q", "left").where(~F.coalesce(done, F.lit(False))).select("q", "bound")
        open_ = materialize(open_, "open-queries")
        if not open_.head(1):
            break
    found = asked.select(F.col("id").alias("query_id"), F.col("code").alias("q")).join(best, "q").join(codes, "code")
    found = found.select("query_id", "distance", F.explode("ids").alias("neighbor_id")).where("query_id <> neighbor_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "neighbor_id", "distance", "rank")
