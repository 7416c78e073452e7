"""Embedding search for many query vectors in one pass over the embeddings.

Queries travel with the tasks in blocks of bounded size; no vector is exchanged. A task multiplies a
block with each Arrow batch and keeps the ``k`` best rows of every query; tasks' bests meet in two levels.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import matrix
from ..session import materialize

#: Bytes of query vectors and their bests that travel in one block, and scores that are held at once.
BLOCK_BYTES = 32 << 20
SCORES = 1 << 22
#: Tasks whose bests meet in the first of two levels.
FAN = 64


def _exact(queries: np.ndarray, rows: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Products of the pairs (q, r), summed in the order of the components, as the expression ``dot`` does it."""
    total = np.zeros(len(q))
    for j in range(queries.shape[1]):
        total += queries[q, j] * rows[r, j]
    return total


class Bests:
    """The k best (score, id) of each query: scores fall, ids rise among equal scores."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.size = np.linalg.norm(queries, axis=1)
        self.score = np.full((len(queries), k), -np.inf)
        self.id = np.empty((len(queries), k), object)

    def take(self, rows: np.ndarray, ids: np.ndarray) -> None:
        """The fast product only chooses pairs that may matter; their scores are then summed in order."""
        length = np.linalg.norm(rows, axis=1)
        fast = self.queries @ rows.T
        # The two sums differ by less than this, whatever their order.
        slack = (4 * rows.shape[1] + 8) * np.finfo(float).eps * np.outer(self.size, length)
        q, r = np.nonzero(fast + slack >= self.score[:, -1:])
        if not len(q):
            return
        score = _exact(self.queries, rows, q, r)
        keep = score >= self.score[q, -1]
        q, r, score = q[keep], r[keep], score[keep]
        changed = np.unique(q)
        old_q, old_at = np.nonzero(np.isfinite(self.score[changed]))
        all_q = np.concatenate([changed[old_q], q])
        all_score = np.concatenate([self.score[changed[old_q], old_at], score])
        all_id = np.concatenate([self.id[changed[old_q], old_at], ids[r]])
        _, by_id = np.unique(all_id.astype(ids.dtype), return_inverse=True)
        order = np.lexsort((by_id, -all_score, all_q))
        all_q, all_score, all_id = all_q[order], all_score[order], all_id[order]
        start = np.searchsorted(all_q, all_q)
        place = np.arange(len(all_q)) - start
        keep = place < self.k
        self.score[changed], self.id[changed] = -np.inf, None
        self.score[all_q[keep], place[keep]] = all_score[keep]
        self.id[all_q[keep], place[keep]] = all_id[keep]


def _task(names: list, queries: np.ndarray, k: int):
    """Rows (task, id, vector) to the task's k best rows of each query."""

    def run(batches):
        bests, task, kinds = Bests(queries, k), None, None
        step = 64  # small at first, so that the bests soon leave out most rows
        for batch in batches:
            kinds = kinds or batch.schema.field(1).type
            if batch.num_rows:
                task = batch.column(0)[0].as_py()
            usable, rows = matrix(batch.column(2), queries.shape[1])
            ids = np.array(batch.column(1).to_pylist(), object)[usable]
            ids = ids.astype(str) if pa.types.is_string(kinds) else ids.astype(np.int64)
            at = 0
            while at < len(rows):
                bests.take(rows[at : at + step], ids[at : at + step])
                at += step
                step = min(4 * step, max(64, SCORES // len(queries)))
        q, place = np.nonzero(np.isfinite(bests.score))
        if len(q):
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * len(q), pa.int32()), pa.array([names[i] for i in q]), pa.array(bests.id[q, place].tolist(), kinds), pa.array(bests.score[q, place])],
                names=["task", "query_id", "id", "score"],
            )

    return run


def _ranked(bests: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return bests.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_many(embeddings: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "id", query_id: str = "query_id", vector: str = "embedding") -> DataFrame:
    """``query_id, id, score, rank``: for each query the ``k`` rows with the highest dot product, ties to the smaller id.

    ids are integers or texts. Rows without an id, and rows or queries whose vector is NULL, holds NULL
    or non-finite components or differs in length from the block's queries, have no score and are left out. Queries
    may share an id; the best rows of all of them are then taken together. Fewer rows than ``k`` give fewer results. Any number of queries
    works: each block of about 32 MB of them reads the embeddings once.
    """
    kind = dict(embeddings.dtypes)[id_col]
    kind = kind if kind == "string" else "bigint"
    query_kind = dict(queries.dtypes)[query_id]
    e = F.col(vector).cast("array<double>")
    asked = queries.select(F.col(query_id).alias("query_id"), e.alias("vector"), F.size(vector).alias("length"))
    whole = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    asked = asked.where(F.col("vector").isNotNull() & (F.col("length") > 0) & F.forall("vector", whole))
    # Blocks are cut by a hash, so that no task sees all queries.
    total = asked.groupBy("length").agg(F.count("*").alias("n")).collect()
    asked = materialize(asked) if total else asked
    rows = embeddings.where(F.col(id_col).isNotNull()).select(F.spark_partition_id().alias("task"), F.col(id_col).cast(kind).alias("id"), e.alias("vector"))
    schema = f"task int, query_id {query_kind}, id {kind}, score double"
    blocks = [(r.length, b, -(-r.n * (8 * r.length + 64 * k) // BLOCK_BYTES)) for r in sorted(total) for b in range(-(-r.n * (8 * r.length + 64 * k) // BLOCK_BYTES))]
    found = []
    for length, b, of in blocks:
        # At most about BLOCK_BYTES, by the count above.
        block = asked.where((F.col("length") == length) & (F.pmod(F.xxhash64("query_id", "vector"), F.lit(of)) == b)).select("query_id", "vector").collect()
        if block:
            part = rows.mapInArrow(_task([r.query_id for r in block], np.array([r.vector for r in block]), k), schema)
            best = _ranked(_ranked(part.withColumn("group", F.floor(F.col("task") / FAN)), k, "query_id", "group"), k, "query_id").select("query_id", "id", "score", "rank")
            # Of many blocks one is held at a time.
            found.append(materialize(best) if len(blocks) > 1 else best)
    if not found:
        return embeddings.sparkSession.createDataFrame([], f"query_id {query_kind}, id {kind}, score double, rank int")
    if len(found) == 1:
        return found[0]
    return _ranked(reduce(DataFrame.unionByName, found).drop("rank"), k, "query_id").select("query_id", "id", "score", "rank")
