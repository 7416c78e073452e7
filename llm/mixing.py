"""Mixing sources to target weights by balanced sampling (the cube method)."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that one task moves at a time.
CHUNK = 256


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, documents, target) from (source, source_size, documents).

    Sources by code point, null last, get the weights in turn and share ``share`` times the total. No
    target exceeds ``most`` times its source's size; the excess goes to the others by weight until
    none is above. That is target = min(most * size, level * weight) for one level: sources are
    ordered by most * size / weight, and the level is the first at which those after it stay below
    their limit. Works on one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit_per_weight", "number")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumn("number", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")))
    rows = rows.withColumn("limit", F.col("source_size") * F.lit(most)).withColumn("limit_per_weight", F.col("limit") / F.col("weight"))
    rows = rows.withColumn("rest", F.sum("source_size").over(Window.partitionBy()) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    rows = rows.withColumn("open", F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("level", F.when(F.col("rest") / F.col("open") <= F.col("limit_per_weight"), F.col("rest") / F.col("open")))
    rows = rows.withColumn("level", F.first("level", ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least("limit", F.col("weight") * F.coalesce("level", F.lit(float("inf"))))
    return rows.select("source", "source_size", "documents", target.alias("target"))


def flight(size: np.ndarray, chance: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Moves inclusion probabilities to 0 or 1 while their sum and their size-weighted sum stay.

    Three fractional units at a time: the direction (s2 - s3, s3 - s1, s1 - s2) lies in the null space
    of both constraints; the step is as long as possible to one of its two ends, drawn so that each
    probability is kept in expectation. Two units of equal size need no third. At most two units, of
    different sizes, stay fractional.
    """
    chance, edge = chance.copy(), 1e-9
    held: list[int] = []
    for i in range(len(chance)):
        if not edge < chance[i] < 1 - edge:
            chance[i] = round(chance[i])
            continue
        held.append(i)
        while len(held) > 1:
            equal = next(((j, k) for a, j in enumerate(held) for k in held[a + 1 :] if size[j] == size[k]), None)
            if equal:
                units, way = list(equal), (1.0, -1.0)
            elif len(held) == 3:
                units = held
                s = [float(size[j]) for j in units]
                way = (s[1] - s[2], s[2] - s[0], s[0] - s[1])
                top = max(map(abs, way))
                way = tuple(w / top for w in way)
            else:
                break
            p = [chance[j] for j in units]
            up = min((1 - q) / w if w > 0 else q / -w for q, w in zip(p, way) if w)
            down = min(q / w if w > 0 else (1 - q) / -w for q, w in zip(p, way) if w)
            step = up if draw[i] * (up + down) < down else -down
            for j, q, w in zip(units, p, way):
                q += step * w
                chance[j] = 0.0 if q <= edge else 1.0 if q >= 1 - edge else q
            left = [j for j in held if 0 < chance[j] < 1]
            if len(left) == len(held):  # rounding: settle the unit that is nearest to an end
                j = min(left, key=lambda k: min(chance[k], 1 - chance[k]))
                chance[j] = round(chance[j])
                left.remove(j)
            held = left
    return chance


def _fly(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["spot", "size"])
    draw = (group["spot"].to_numpy().view(np.uint64) >> np.uint64(11)) / 2.0**53
    group = group.drop(columns="chunk", errors="ignore")
    return group.assign(chance=flight((group["size"] * group["count"]).to_numpy(), group["chance"].to_numpy(), draw))


def _land(group: pd.DataFrame) -> pd.DataFrame:
    """The last one or two fractional units of a source are rounded.

    Of all roundings, with at most one settled unit of the chunk turned over as well, the one nearest
    to the wanted words is taken, then the one nearest to the wanted number of documents.
    """
    group = _fly(group)
    size, chance = (group["size"] * group["count"]).to_numpy(np.float64), group["chance"].to_numpy().copy()
    open_ = np.flatnonzero((chance > 0) & (chance < 1))
    if len(open_):
        turn = np.append(1 - 2 * np.round(chance), 0.0)  # what turning a unit over adds; the last entry turns none
        turn[open_] = 0
        best = None
        for way in range(1 << len(open_)):
            chosen = np.array([way >> i & 1 for i in range(len(open_))], np.float64)
            words = np.abs(size[open_] @ (chosen - chance[open_]) + turn * np.append(size, 0.0))
            documents = np.abs((chosen - chance[open_]).sum() + turn)
            at = int(np.lexsort((documents, words))[0])
            if best is None or (words[at], documents[at]) < best[:2]:
                best = (words[at], documents[at], chosen, at)
        chance[open_] = best[2]
        if best[3] < len(chance):
            chance[best[3]] += turn[best[3]]
    return group.assign(chance=chance)


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """All rows of ``docs`` plus size (words of the text, null: 0), source_size, target and copies.

    ``copies`` says how often the mix takes the document. Each document of a source is wanted
    target / source_size times: the whole part is given to all, the fraction is its inclusion
    probability. The flight runs in chunks of about CHUNK documents of one source, so that a large
    source is spread; what stays fractional, at most two a chunk, flies again in fewer chunks until
    one chunk a source is left, where at most two documents are rounded. Draws come from hashes of
    the rows, so reruns agree.

    A null source is a source of its own, the last. Documents of size 0 are taken 0 times. Rows with
    the same id, source and text are one unit: all are taken equally often. Columns of ``docs`` stay;
    those with the names of added ones are replaced. An empty table gives no rows.
    """
    spot = F.xxhash64("doc_id", "source", "text")
    units = docs.select("source", word_count("text").alias("size"), spot.alias("spot")).groupBy("source", "size", "spot").count()
    units = materialize(units, "mix-units")
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("count")).alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("documents"))
    wanted = materialize(targets(totals, weights, share, most), "mix-targets")
    plan = wanted.withColumnRenamed("source", "s")
    rows = units.where("size > 0").join(plan, F.col("source").eqNullSafe(F.col("s")))
    rate = F.col("target") / F.col("source_size")
    rows = rows.withColumn("whole", F.floor(rate + 1e-12)).withColumn("chance", F.greatest(rate - F.col("whole"), F.lit(0.0)))
    columns = ["source", "size", "count", "spot", "documents", "whole", "chance"]
    rows = rows.select(*columns)
    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    settled, parts = [], F.ceil(F.col("documents") / CHUNK)
    largest = wanted.agg(F.max("documents")).first()[0] or 0
    while True:
        last = largest <= CHUNK
        chunk = F.lit(0) if last else F.floor(F.shiftrightunsigned(F.xxhash64("spot", F.lit(len(settled))), 33) / 2.0**31 * parts)
        moved = rows.withColumn("chunk", chunk.cast("long")).groupBy("source", "chunk").applyInPandas(_land if last else _fly, schema)
        moved = materialize(moved, "mix-flight")
        fractional = (F.col("chance") > 0) & (F.col("chance") < 1)
        settled.append(moved if last else moved.where(~fractional))
        if last:
            break
        rows = moved.where(fractional)
        largest, parts = -(-largest // CHUNK) * 2, F.ceil(parts * 2 / CHUNK)
    taken = reduce(DataFrame.unionByName, settled)
    taken = taken.select("spot", "size", (F.col("whole") + F.col("chance")).cast("long").alias("copies"))
    out = docs.drop("size", "source_size", "target", "copies", "spot").withColumn("spot", spot).join(taken, "spot", "left").drop("spot")
    out = out.withColumns({"size": F.coalesce("size", F.lit(0).cast("long")), "copies": F.coalesce("copies", F.lit(0).cast("long"))})
    return out.join(plan.select("s", "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
