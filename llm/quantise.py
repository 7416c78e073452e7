"""Product codes of vectors: exact k-means per part, kept cheap by Drake's and Hamerly's adaptive bounds.

Components become integers, so that every distance is exact. After the first assignment each part
keeps its ``b`` closest codebook entries, an upper bound of the distance to the first, ordered lower
bounds of the distances to the others, and one outer bound for all entries that are not kept. When
the entries move, the bounds move with them; a part whose upper bound stays below the next lower
bound keeps its entry unseen, others compare integers with as few kept entries as the bounds demand,
and only parts that pass the outer bound are held against the whole codebook. Bounds are whole numbers of eighths,
rounded to the safe side, so they never decide a tie.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_parts, lists, materialize

#: Steps of a bound in one unit of distance.
SCALE = 8
#: Distances that are held in memory at once.
CELLS = 1 << 21
FAR = 1 << 60
STATE = "x array<int>, near array<short>, bound array<long>, asked long"


def largest(dimension: int) -> int:
    """Components beyond this are set to it: squares of differences summed over a vector fit a long."""
    return int((2**61 / dimension) ** 0.5)


def integers(vectors: np.ndarray, limit: int) -> np.ndarray:
    return np.clip(np.floor(vectors.astype(np.float64) * 256), -limit, limit).astype(np.int64)


def above(squares: np.ndarray) -> np.ndarray:
    return np.ceil(np.sqrt(squares.astype(np.float64)) * (SCALE * (1 + 1e-12))).astype(np.int64)


def below(squares: np.ndarray) -> np.ndarray:
    return np.floor(np.sqrt(squares.astype(np.float64)) * (SCALE * (1 - 1e-12))).astype(np.int64)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of cells (m, length) to their own entries (m, k, length)."""
    out = np.zeros(entries.shape[:2], np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - entries[:, :, j]) ** 2
    return out


def closest(x: np.ndarray, part: np.ndarray, codebook: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The b closest entries of cells, ties by index, and their bounds: upper, b - 1 lower ones, outer."""
    d = np.empty((len(x), codebook.shape[1]), np.int64)
    for p in np.unique(part):
        rows = np.flatnonzero(part == p)
        total = np.zeros((len(rows), codebook.shape[1]), np.int64)
        for j in range(x.shape[1]):
            total += (x[rows, j, None] - codebook[p, None, :, j]) ** 2
        d[rows] = total
    order = np.argsort(d, axis=1, kind="stable")[:, : b + 1]
    d = np.take_along_axis(d, order, 1)
    bound = np.full((len(x), b + 1), FAR, np.int64)
    bound[:, 0] = above(d[:, 0])
    bound[:, 1 : d.shape[1]] = below(d[:, 1:])
    return order[:, :b], bound


def reassign(x, near, bound, part, codebook, moved, most):
    """Bounds and entries after the codebook moved; also entries needed by each cell (0: none, b: all) and distances taken.

    x (m, length), near (m, b), bound (m, b + 1), part (m); moved (parts, k) and most (parts) are
    upper bounds of the entries' ways. Arrays are changed in place.
    """
    b = near.shape[1]
    way = moved[part[:, None], near]
    bound[:, 0] += way[:, 0]
    bound[:, 1:b] -= way[:, 1:]
    bound[:, b] -= most[part]
    bound[:, 1:] = np.minimum.accumulate(bound[:, :0:-1], axis=1)[:, ::-1]
    need = (bound[:, :1] >= bound[:, 1:]).sum(axis=1)
    loose = np.flatnonzero(need)
    taken = len(loose)
    bound[loose, 0] = above(distances(x[loose], codebook[part[loose], near[loose, 0]][:, None])[:, 0])
    need[loose] = (bound[loose, :1] >= bound[loose, 1:]).sum(axis=1)
    for z in range(1, b):
        rows = np.flatnonzero(need == z)
        if not len(rows):
            continue
        some = np.sort(near[rows, : z + 1], axis=1)
        d = distances(x[rows], codebook[part[rows][:, None], some])
        order = np.argsort(d, axis=1, kind="stable")
        d = np.take_along_axis(d, order, 1)
        near[rows, : z + 1] = np.take_along_axis(some, order, 1)
        bound[rows, 0] = above(d[:, 0])
        bound[rows, 1 : z + 1] = below(d[:, 1:])
        taken += d.size
    rows = np.flatnonzero(need == b)
    for at in range(0, len(rows), max(1, CELLS // codebook.shape[1])):
        some = rows[at : at + max(1, CELLS // codebook.shape[1])]
        near[some], bound[some] = closest(x[some], part[some], codebook, b)
    return need, taken + len(rows) * codebook.shape[1]


def narrowed(near, bound, need, least: int):
    """Keeps as many entries as 99 of 100 cells that the kept ones could settle have needed, ``least`` at least."""
    b = near.shape[1]
    settled = need[need < b]
    wanted = int(np.quantile(settled, 0.99, method="higher")) + 1 if len(settled) else b
    to = min(b, max(least, wanted))
    outer = bound[:, to:].min(axis=1, keepdims=True)
    return near[:, :to], np.concatenate([bound[:, :to], outer], axis=1)


def _pieces(batch: pa.RecordBatch, per_row: int):
    step = max(1, CELLS // per_row)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _batch(piece: pa.RecordBatch, keep: int, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*piece.columns[:keep], *columns.values()], names=[*piece.schema.names[:keep], *columns])


def _state(piece, keep, x, near, bound, asked):
    n = piece.num_rows
    even = lambda a, kind: lists(a.reshape(n, -1).astype(kind).ravel(), np.full(n, a.size // n))
    return _batch(piece, keep, {"x": even(x, np.int32), "near": even(near, np.int16), "bound": even(bound, np.int64), "asked": pa.array(asked)})


def _first(codebook: np.ndarray, limit: int, b: int):
    parts, k, length = codebook.shape

    def run(batches):
        for batch in batches:
            keep = batch.num_columns - 1
            for piece in _pieces(batch, parts * max(k, length)):
                values, _ = list_parts(piece.column(keep))
                x = integers(values, limit).reshape(-1, length)
                near, bound = closest(x, np.tile(np.arange(parts), piece.num_rows), codebook, b)
                yield _state(piece, keep, x, near, bound, np.full(piece.num_rows, parts * k))

    return run


def _again(codebook: np.ndarray, moved: np.ndarray, least: int, last: bool):
    parts, k, length = codebook.shape
    most = moved.max(axis=1)

    def run(batches):
        for batch in batches:
            keep = batch.num_columns - 4
            for whole in _pieces(batch, parts * max(k, length)):
                width = np.diff(list_parts(whole.column(keep + 1))[1])
                for w in np.unique(width):  # rows of one number of kept entries
                    piece = whole.filter(pa.array(width == w))
                    n, b = piece.num_rows, int(w) // parts
                    x = list_parts(piece.column(keep))[0].astype(np.int64).reshape(-1, length)
                    near = list_parts(piece.column(keep + 1))[0].astype(np.int64).reshape(-1, b)
                    bound = list_parts(piece.column(keep + 2))[0].astype(np.int64).reshape(-1, b + 1)
                    part = np.tile(np.arange(parts), n)
                    need, taken = reassign(x, near, bound, part, codebook, moved, most)
                    if not last:
                        near, bound = narrowed(near, bound, need, least)
                        asked = np.zeros(n, np.int64)
                        asked[0] = taken
                        yield _state(piece, keep, x, near, bound, asked)
                        continue
                    code = near[:, 0]
                    error = distances(x, codebook[part, code][:, None]).reshape(n, parts).sum(axis=1)
                    text = [row.tobytes().hex() for row in code.astype(np.uint8).reshape(n, parts)]
                    yield _batch(piece, keep, {"code": pa.array(text, pa.string()), "error": pa.array(error)})

    return run


def _sums(parts: int, k: int, length: int):
    """Per task and used entry: its parts, and each component's sum over them."""

    def run(batches):
        total, count = np.zeros((parts, k, length), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            x = list_parts(batch.column(0))[0].astype(np.int64).reshape(-1, parts, length)
            values, offsets = list_parts(batch.column(1))
            width = np.diff(offsets) // parts
            code = values[(offsets[:-1, None] + np.arange(parts) * width[:, None]).ravel()].reshape(-1, parts)
            at = (np.broadcast_to(np.arange(parts), code.shape), code)
            np.add.at(total, at, x)
            np.add.at(count, at, 1)
        p, e, j = (a.ravel() for a in np.indices(total.shape))
        used = count[p, e] > 0
        columns = [p[used].astype(np.int32), e[used].astype(np.int32), j[used].astype(np.int32), total.ravel()[used], count[p, e][used]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "entry", "position", "total", "n"])

    return run


def _means(state: DataFrame, codebook: np.ndarray) -> np.ndarray:
    """The codebook with each used entry at the floor of its parts' mean; one row for each component of an entry is collected."""
    rows = state.select("x", "near").mapInArrow(_sums(*codebook.shape), "part int, entry int, position int, total long, n long")
    out = codebook.copy()
    for r in rows.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[r.part, r.entry, r.position] = r.total // r.n
    return out


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and has finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.where(F.col(vector).isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(True)))


def product_codes(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2):
    """(codes, codebooks): a frame ``id, label, code, error`` and the integer array (parts, entries, length).

    Rows whose vector is null, or holds null or non-finite components, are left out, and so are vectors
    whose length is not that of the first seed or no multiple of ``parts``. Components become
    floor(256 * x), at most ``largest`` in size. The codebook of each part starts as that part of the ``entries`` rows with the
    smallest ids (ties by vector, null ids last), so there are fewer entries where there are fewer rows.
    Rows that share an id are coded each. ``rounds`` times parts go to their nearest entry (ties to the
    lower index) and entries to the floor of their mean; unused entries stay. No rows give no codes.
    The state of each round is written to the shared folder: lost executors cost a task at most.
    """
    if entries > 256:
        raise ValueError("two hex digits name 256 entries at most")
    rows = usable(rows.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")), "vector")
    kinds = dict(rows.dtypes)
    head = f"id {kinds['id']}, label {kinds['label']}"
    fits = rows.where((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    order = [F.col("id").asc_nulls_last(), "vector"]
    first = fits.orderBy(*order).select(F.size("vector").alias("n")).first()
    if first is None:
        return rows.sparkSession.createDataFrame([], f"{head}, code string, error long"), np.zeros((parts, 0, 0), np.int64)
    fits = fits.where(F.size("vector") == first.n)
    seeds = [r.vector for r in fits.orderBy(*order).limit(entries).collect()]
    limit, length = largest(first.n), first.n // parts
    codebook = np.ascontiguousarray(integers(np.array(seeds), limit).reshape(len(seeds), parts, length).transpose(1, 0, 2))
    k = len(seeds)
    state = materialize(fits.mapInArrow(_first(codebook, limit, max(1, k // 4)), f"{head}, {STATE}"), "codes")
    for done in range(1, rounds + 1):
        new = _means(state, codebook)
        moved = above(((new - codebook) ** 2).sum(axis=2))
        codebook = new
        if done < rounds:
            state = materialize(state.mapInArrow(_again(codebook, moved, max(1, k // 8), False), f"{head}, {STATE}"), "codes")
    coded = state.select("id", "label", "x", "near", "bound", "asked").mapInArrow(_again(codebook, moved, 1, True), f"{head}, code string, error long")
    return materialize(coded, "codes"), codebook


def digest(codebooks: np.ndarray) -> str:
    return sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds label_error, the sum of ``error`` over rows of one label, null labels together; one row a label and task is shuffled."""
    total = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    total = total.select(F.col("label").alias("of"), F.least("total", F.lit(2**63 - 1)).cast("long").alias("label_error"))
    return codes.join(total, F.col("label").eqNullSafe(F.col("of"))).drop("of")
