"""Sharding along a Hilbert curve, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits for each dimension: 2 ** (3 * BITS) = 32,768 cells at most for three dimensions.
BITS = 5


def hilbert_index(dimensions: list[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of cells with ``bits``-bit coordinates.

    From the top bit down, the bits of all coordinates name a sub-cube. Seen from the curve's entry
    corner and direction there, its Gray-code rank is the next digit; entry and direction follow from
    the rank. The tables are made from the rule for any number of dimensions.
    """
    n = len(dimensions)
    full = (1 << n) - 1
    gray = [i ^ (i >> 1) for i in range(1 << n)]
    rank = [gray.index(i) for i in range(1 << n)]
    entry = [0] + [gray[2 * ((w - 1) // 2)] for w in range(1, 1 << n)]
    trailing = lambda w: (~w & (w + 1)).bit_length() - 1
    turn = [0] + [(trailing(w - 1) if w % 2 == 0 else trailing(w)) % n for w in range(1, 1 << n)]
    left = lambda x, r: ((x << r) | (x >> (n - r))) & full if r else x
    # One lookup per state (entry, direction) and sub-cube: digit and next state, as one number.
    step = []
    for state in range(n << n):
        e, d = divmod(state, n)
        for cube in range(1 << n):
            shift = (d + 1) % n
            seen = left(cube ^ e, (n - shift) % n)
            w = rank[seen]
            step.append((w << 16) + (e ^ left(entry[w], shift)) * n + (d + turn[w] + 1) % n)
    table = F.array(*map(F.lit, step))
    cubes = [sum(((F.shiftright(x, b).bitwiseAND(1)) * (1 << i) for i, x in enumerate(dimensions)), F.lit(0)) for b in reversed(range(bits))]

    def walk(at: Column, cube: Column) -> Column:
        found = F.element_at(table, (at["state"] * (1 << n) + cube + 1).cast("int"))
        return F.struct((at["index"] * (1 << n) + F.shiftright(found, 16)).cast("long").alias("index"), found.bitwiseAND(0xFFFF).cast("int").alias("state"))

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).cast("int").alias("state"))
    return F.aggregate(F.array(*[c.cast("int") for c in cubes]), start, walk, lambda at: at["index"])


def value_bins(df: DataFrame, column: str, name: str, bits: int = BITS) -> DataFrame:
    """(column, name): values in their order, nulls first, cut into 2**bits runs of about equal rows.

    Works on one row per distinct value, so it is for columns such as sources and languages.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy(F.col(column).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select(F.col(column).alias(f"{name}_value"), F.floor(before * (1 << bits) / F.sum("rows").over(Window.partitionBy())).cast("int").alias(name))


def shard(docs: DataFrame, shards: int = 16, text: str = "text") -> DataFrame:
    """All rows of ``docs`` plus size, text_crc32, curve, shard and slot; shard sizes differ by one row at most.

    Source, language and n_chars are quantised (the first two into runs of equal rows, the last by its
    logarithm), rows are put in the order of the Hilbert curve through these cells, and the order is
    cut into runs of equal length: shard s, slots from 0. Files cut that way hold narrow ranges of all
    three, which lets readers skip most of them for a filter on any.

    The position of a row is found without a total sort: rows per cell and per hashed part of a cell
    (about sqrt(n) rows each) are counted, counts are added up, and rows are numbered within a part.
    A cell with a third of all rows has that many more parts. Null metadata count as lowest values,
    null text as empty. Ties are ordered by id, checksum and size, repeated rows in any way. An empty
    table gives no rows. Columns with the names of added ones are replaced.
    """
    added = ("size", "text_crc32", "curve", "shard", "slot")
    docs = docs.drop(*added)
    bins = [value_bins(docs, c, f"__{c}") for c in ("source", "lang")]
    length = F.least(F.lit((1 << BITS) - 1), F.floor(F.log2(F.greatest(F.coalesce(F.col("n_chars"), F.lit(0)), F.lit(0)) + 1.0) * 1.5).cast("int"))

    def located(df: DataFrame) -> DataFrame:
        for c, b in zip(("source", "lang"), bins):
            df = df.join(b, F.col(c).eqNullSafe(F.col(f"__{c}_value"))).drop(f"__{c}_value")
        df = df.withColumn("curve", hilbert_index([F.col("__source"), F.col("__lang"), length])).drop("__source", "__lang")
        df = df.join(F.broadcast(cells), "curve") if cells is not None else df  # 32,768 rows at most
        return df if cells is None else df.withColumn("__part", F.floor(F.shiftrightunsigned(F.xxhash64("doc_id", "source", "lang", "n_chars"), 33) / 2.0**31 * F.col("__parts")))

    cells = None
    light = docs.select("doc_id", "source", "lang", "n_chars")
    counts = located(light).groupBy("curve").agg(F.count("*").alias("rows"))
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("rows").over(Window.partitionBy())
    cells = counts.select(
        "curve", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__start"), total.alias("__total"),
        F.ceil(F.col("rows") / F.ceil(F.sqrt(total))).alias("__parts"),
    )
    within = Window.partitionBy("curve").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = located(light).groupBy("curve", "__part").agg(F.count("*").alias("rows"))
    parts = parts.select("curve", "__part", F.coalesce(F.sum("rows").over(within), F.lit(0)).alias("__before"))
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = located(docs.withColumns({"size": F.octet_length(whole).cast("long") + 1, "text_crc32": F.crc32(whole.cast("binary"))}))
    rows = rows.join(parts, ["curve", "__part"])
    order = Window.partitionBy("curve", "__part").orderBy("doc_id", "text_crc32", "size")
    rank = F.col("__start") + F.col("__before") + F.row_number().over(order) - 1
    rows = rows.withColumn("__rank", rank)
    low, more = F.floor(F.col("__total") / shards), F.col("__total") % shards
    early = F.col("__rank") < more * (low + 1)
    rows = rows.withColumn("shard", F.when(early, F.floor(F.col("__rank") / (low + 1))).otherwise(more + F.floor((F.col("__rank") - more * (low + 1)) / F.greatest(low, F.lit(1)))).cast("int"))
    rows = rows.withColumn("slot", F.col("__rank") - F.col("shard") * low - F.least(F.col("shard"), more))
    return rows.drop("__part", "__parts", "__start", "__total", "__before", "__rank")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
