"""Numbering, first/last rows, cumulative counts and average ranks without one-task windows.

A group (or the whole table) may be far larger than one task should see, so positions are
built in two levels: rows are split into ordered chunks, each chunk is numbered on its own,
and the chunk sizes (a small table) give the offset of each chunk. Chunks of values are the ranges that
a range partitioning makes, so there are as many as the data fills.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Rows per chunk when numbering by an integer sequence: 2 ** CHUNK_BITS.
CHUNK_BITS = 20


def first_by(df: DataFrame, keys: Sequence[str], seq: Column | str) -> DataFrame:
    """The row with the lowest ``seq`` per key, combined on the map side."""
    return _one_by(df, keys, seq, F.min_by)


def last_by(df: DataFrame, keys: Sequence[str], seq: Column | str) -> DataFrame:
    """The row with the highest ``seq`` per key."""
    return _one_by(df, keys, seq, F.max_by)


def _one_by(df, keys, seq, pick):
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    picked = df.groupBy(*keys).agg(pick(row, seq).alias("_row"))
    return picked.select(*[F.col(f"`{k}`") for k in keys], *[F.col("_row")[c].alias(c) for c in rest]).select(
        *[F.col(f"`{c}`") for c in df.columns]
    )


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", exact: Sequence[str] = ()) -> DataFrame:
    """Join in which NULL keys are equal; adds the non-key columns of ``right``.

    ``exact`` keys use plain equality. Right keys are renamed first, because both sides often
    come from the same frame.
    """
    renamed = {k: f"_right_{k}" for k in [*keys, *exact]}
    other = right.select(*[F.col(f"`{c}`").alias(renamed.get(c, c)) for c in right.columns])
    tests = [F.col(f"`{k}`").eqNullSafe(F.col(f"`{renamed[k]}`")) for k in keys]
    spread = exact[:1] if how == "left" else []
    for k in spread:
        left = left.withColumn("_spread", spread_nulls(left, F.col(f"`{k}`")))
        tests.append(F.col("_spread") == F.col(f"`{renamed[k]}`").cast("string"))
    tests += [F.col(f"`{k}`") == F.col(f"`{renamed[k]}`") for k in exact[len(spread):]]
    return left.join(other, reduce(lambda a, b: a & b, tests), how).drop(*renamed.values(), "_spread")


def spread_nulls(df: DataFrame, key: Column) -> Column:
    """``key`` as text, with a text of its own, made from the whole row, for each row that has none."""
    others = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    return F.coalesce(key.cast("string"), F.concat(F.lit("\u0000"), F.xxhash64(*others).cast("string")))


def lookup(left: DataFrame, right: DataFrame, key: Column, right_key: str, *more: tuple[Column, str]) -> DataFrame:
    """Left join on ``key == right_key`` (and ``more`` such pairs), without the right keys.

    Rows whose key is NULL match nothing; instead of meeting in one task they are spread.
    """
    left = left.withColumn("_spread", spread_nulls(left, key))
    test = F.col("_spread") == F.col(right_key).cast("string")
    for k, name in more:
        test = test & (k == F.col(name))
    return left.join(right, test, "left").drop("_spread", right_key, *[name for _, name in more])


def _sum_before(sizes: DataFrame, by: Sequence[str], position: str) -> DataFrame:
    """Add ``_before``: the sum of ``_size`` over smaller positions of the group."""
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy(position)
    total = F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return sizes.withColumn("_before", F.coalesce(total, F.lit(0)))


def number_rows(
    df: DataFrame, seq: str, by: Sequence[str] = (), name: str = "row_no", chunk_bits: int = CHUNK_BITS
) -> DataFrame:
    """1-based position of each row in ``seq`` order inside its ``by`` group.

    ``seq`` holds integers that are distinct inside a group, so a chunk of consecutive
    values never holds more than 2 ** ``chunk_bits`` rows, however large the group. Chunks
    are gathered into blocks of as many chunks, so that sparse sequences are no problem either.
    """
    by = list(by)
    value = F.col(seq).cast("bigint")
    placed = df.withColumn("_block", F.shiftright(value, 2 * chunk_bits)).withColumn("_chunk", F.shiftright(value, chunk_bits))
    chunks = placed.groupBy(*by, "_block", "_chunk").agg(F.count("*").alias("_size"))
    blocks = _sum_before(chunks.groupBy(*by, "_block").agg(F.sum("_size").alias("_size")), by, "_block")
    chunks = _sum_before(chunks, [*by, "_block"], "_chunk").drop("_size")
    blocks = blocks.select(*by, "_block", F.col("_before").alias("_block_before"))
    offsets = join_same(chunks, blocks, by, exact=["_block"]).select(
        *by, "_chunk", (F.col("_before") + F.col("_block_before")).alias("_before")
    )
    inside = Window.partitionBy(*by, "_chunk").orderBy(seq)
    ranked = placed.withColumn("_in_chunk", F.row_number().over(inside))
    return join_same(ranked, offsets, by, exact=["_chunk"]).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_in_chunk") + F.col("_before")).alias(name)
    )


def in_ranges(df: DataFrame, columns: Sequence[str], name: str = "range") -> DataFrame:
    """``df`` in the order of ``columns``, cut into ranges whose number is in ``name``.

    The cut is written, so that later reads see the same ranges. Rows that are equal in ``columns`` share a
    range; there are as many ranges as the rows fill shuffle partitions.
    """
    return materialize(df.repartitionByRange(*[F.col(f"`{c}`") for c in columns]).withColumn(name, F.spark_partition_id()))


def key_in_order(df: DataFrame, columns: Sequence[str], name: str = "row_no") -> DataFrame:
    """Add a distinct bigint that grows in the order of ``columns``, with gaps; the rows are written with it.

    For rows that only have to be kept in order; it takes one exchange and no second read, unlike ``number_in_order``.
    """
    order = [F.col(f"`{c}`") for c in columns]
    return materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()))


def number_in_order(df: DataFrame, columns: Sequence[str], name: str = "row_no") -> DataFrame:
    """Add the 1-based position of each row in the order of ``columns``, whatever their types and values.

    Rows that are equal in ``columns`` get neighbouring numbers.
    """
    ranged = in_ranges(df, columns, "_range")
    offsets = _sum_before(ranged.groupBy("_range").agg(F.count("*").alias("_size")), [], "_range").drop("_size")
    inside = Window.partitionBy("_range").orderBy(*[F.col(f"`{c}`") for c in columns])
    ranked = ranged.withColumn("_in_range", F.row_number().over(inside))
    return join_same(ranked, offsets, [], exact=["_range"]).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_in_range") + F.col("_before")).alias(name))


def cumulative(hist: DataFrame, by: Sequence[str], value: str | Sequence[str], range_col: str, count: str = "n") -> DataFrame:
    """Add ``below``: rows of the group with a smaller value, from a histogram of distinct values."""
    by, value = list(by), [value] if isinstance(value, str) else list(value)
    sizes = hist.groupBy(*by, range_col).agg(F.sum(count).alias("_size"))
    offsets = _sum_before(sizes, by, range_col).drop("_size")
    inside = Window.partitionBy(*by, range_col).orderBy(*value).rowsBetween(Window.unboundedPreceding, -1)
    summed = hist.withColumn("_inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    return join_same(summed, offsets, by, exact=[range_col]).select(
        *[F.col(f"`{c}`") for c in hist.columns], (F.col("_inside") + F.col("_before")).alias("below")
    )


def value_ranks(df: DataFrame, by: Sequence[str], col: str, name: str = "rank") -> DataFrame:
    """``by, col, name``: the 1-based rank of each distinct non-NULL value inside ``by``, ties sharing their mean rank.

    Equal values are counted before anything is ordered, so neither a large group nor a
    very frequent value ends up in one task.
    """
    by = list(by)
    counted = df.where(F.col(f"`{col}`").isNotNull()).groupBy(*by, col).agg(F.count("*").alias("_n"))
    below = cumulative(in_ranges(counted, [*by, col], "_range"), by, col, "_range", "_n")
    return below.select(*by, col, (F.col("below") + (F.col("_n") + 1) / 2).alias(name))


def avg_rank(df: DataFrame, by: Sequence[str], col: str, name: str = "rank") -> DataFrame:
    """Add the 1-based rank of ``col`` inside ``by``, ties sharing their mean rank; NULL values get a NULL rank."""
    return join_same(df, value_ranks(df.select(*by, col), by, col, name), list(by), "left", exact=[col])
