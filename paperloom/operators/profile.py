"""Bounded profile of a table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import truncate_cell
from .ranking import cumulative, in_ranges

# Columns with more distinct values than this get no list of top values.
CATEGORICAL_MAX = 50
# Integers up to this size are exact as DOUBLE.
EXACT_LIMIT = float(1 << 53)


def _is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType))


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def profile_table(
    df: DataFrame, max_columns: int | None = None, max_top_values: int = 5, max_cell_chars: int = 80, max_scan_rows: int | None = None
) -> DataFrame:
    """One row per described column: counts, distinct values, numeric statistics, top values.

    NaN counts as missing and an infinite statistic is NULL. ``n_unique`` is -1 for nested
    types. ``top_values`` is filled for non-numeric columns of few distinct values. ``min``, ``max`` and ``median`` are
    DOUBLE; for DECIMAL and BIGINT columns ``min_exact``, ``max_exact`` and ``median_exact`` have all digits as
    text (of an even number of values the lower middle one).

    Everything comes from one pass of plain aggregates and one ``(column, value)`` histogram,
    which is combined before it is shuffled and written once; medians are read off it by
    running counts inside value ranges, so no column is gathered in one task.
    """
    if max_scan_rows is not None:
        df = df.limit(max_scan_rows)
    fields = list(df.schema.fields)[:max_columns]
    short = [f"c{i}" for i in range(len(fields))]
    numeric = [c for c, f in zip(short, fields) if _is_numeric(f.dataType)]
    flat = [c for c, f in zip(short, fields) if not _is_nested(f.dataType)]

    def cell(f):
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            return value.cast("int").cast("double")
        if _is_numeric(f.dataType):
            # NaN is a missing value, and -0.0 is 0.0.
            return F.nanvl(value.cast("double"), F.lit(None).cast("double")) + F.lit(0.0)
        return value

    wide = {c: f for c, f in zip(short, fields) if isinstance(f.dataType, (T.LongType, T.DecimalType))}
    raws = [F.col(f"`{f.name}`").alias(f"{c}_raw") for c, f in wide.items()]
    base = df.select(*[cell(f).alias(c) for c, f in zip(short, fields)], *raws)

    aggs = [F.count("*").alias("rows")]
    for c in wide:
        aggs += [F.min(f"{c}_raw").alias(f"{c}_least"), F.max(f"{c}_raw").alias(f"{c}_most")]
    for c in short:
        aggs.append(F.count(c).alias(f"{c}_n"))
    for c in numeric:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    moments = base.agg(*aggs)

    def stat(c, name):
        if c not in numeric:
            return F.lit(None).cast("double").alias(name)
        v = F.col(f"{c}_{name}")
        return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v).alias(name)

    per_column = [
        F.struct(
            F.lit(i).alias("column_no"),
            truncate_cell(F.lit(f.name), max_cell_chars).alias("name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"{c}_n").alias("non_null"),
            (F.col("rows") - F.col(f"{c}_n")).alias("null_count"),
            F.lit(c in numeric).alias("is_numeric"),
            F.lit(c in flat).alias("_flat"),
            *[stat(c, s) for s in ("min", "max", "mean", "std")],
            *[(F.col(f"{c}_{s}") if c in wide else F.lit(None)).cast("string").alias(f"{n}_exact") for s, n in (("least", "min"), ("most", "max"))],
        )
        for i, (c, f) in enumerate(zip(short, fields))
    ]
    described = moments.select(F.inline(F.array(*per_column)))

    # Histogram of (column, value). Numbers are their own key, except that decimals, and integers
    # beyond the exact range of a double, are told apart by their text and ordered by their whole and
    # fractional parts. Texts are counted by their digest, so that they are not shuffled whole.
    entries = []
    none, whole, part = F.lit(None).cast("string"), F.lit(None).cast("decimal(38,0)"), F.lit(None).cast("decimal(38,38)")

    def entry(i, key, value, shown, whole, part):
        return F.struct(F.lit(i).alias("column_no"), key.alias("key"), value.alias("value"), shown.alias("shown"), whole.alias("whole"), part.alias("part"))

    for i, (c, f) in enumerate(zip(short, fields)):
        if c not in flat:
            continue
        raw = F.col(f"{c}_raw")
        if isinstance(f.dataType, T.DecimalType):
            rest = raw % F.lit(1).cast("decimal(1,0)")
            entries.append(entry(i, raw.cast("string"), F.col(c), none, F.floor(raw).cast("decimal(38,0)"), F.when(rest < 0, rest + 1).otherwise(rest).cast("decimal(38,38)")))
        elif c in wide:
            entries.append(entry(i, F.when(F.abs(F.col(c)) >= EXACT_LIMIT, raw.cast("string")), F.col(c), none, raw.cast("decimal(38,0)"), part))
        elif c in numeric:
            entries.append(entry(i, none, F.col(c), none, whole, part))
        else:
            text = F.col(c).cast("string")
            entries.append(entry(i, F.sha2(text, 256), F.lit(None).cast("double"), truncate_cell(text, max_cell_chars), whole, part))
    cells = base
    hist = (
        cells.select(F.inline(F.array(*entries))).where(F.col("key").isNotNull() | F.col("value").isNotNull())
        # ``shown`` follows from the key; as a grouping column it keeps the aggregation hash-based.
        .groupBy("column_no", "key", "value", "shown", "whole", "part").agg(F.count("*").alias("n"))
    )
    # The histogram is used four times, so it is written once. Its partitions are value ranges;
    # their numbers, fixed by the write, let running counts be taken range by range.
    order = ["value", "whole", "part"]
    hist = in_ranges(hist, ["column_no", *order, "key"])
    distinct = hist.groupBy("column_no").agg(F.count("*").alias("_unique"), F.sum("n").alias("_n"))

    low = F.floor((F.col("_n") - 1) / 2)
    high = F.floor(F.col("_n") / 2)
    exact = F.when(F.col("whole").isNotNull(), F.coalesce("key", F.col("whole").cast("string")))
    numbers = hist.where(F.col("value").isNotNull()).select("column_no", *order, "range", "n", exact.alias("exact"))
    below = cumulative(numbers, ["column_no"], order, "range")
    # ``distinct`` has one row per described column, so it is as small as the schema.
    sized = below.join(F.broadcast(distinct), "column_no")

    def holds(position):
        return (F.col("below") <= position) & (position < F.col("below") + F.col("n"))

    median = sized.where(holds(low) | holds(high)).groupBy("column_no").agg(
        ((F.max(F.when(holds(low), F.col("value"))) + F.max(F.when(holds(high), F.col("value")))) / 2).alias("_median"),
        F.max(F.when(holds(low), F.col("exact"))).alias("_median_exact"),
    )

    few = F.broadcast(distinct.where(F.col("_unique") <= CATEGORICAL_MAX).select("column_no"))
    texts = hist.where(F.col("value").isNull()).join(few, "column_no", "left_semi")
    by_count = Window.partitionBy("column_no").orderBy(F.desc("n"), "shown")
    top = (
        texts.withColumn("_r", F.row_number().over(by_count)).where(F.col("_r") <= max_top_values)
        .groupBy("column_no").agg(F.array_sort(F.collect_list(F.struct("_r", "shown", "n"))).alias("_top"))
        .select("column_no", F.transform("_top", lambda t: F.struct(t["shown"].alias("value"), t["n"].alias("count"))).alias("_top"))
    )
    out = described.join(F.broadcast(distinct), "column_no", "left")
    out = out.join(F.broadcast(median), "column_no", "left").join(F.broadcast(top), "column_no", "left")
    m = F.col("_median")
    return out.select(
        "column_no", "name", "dtype", "non_null", "null_count",
        F.when(F.col("_flat"), F.coalesce("_unique", F.lit(0))).otherwise(-1).cast("bigint").alias("n_unique"),
        "is_numeric", "min", "max", "mean",
        F.when(~F.isnan(m) & (F.abs(m) != float("inf")), m).alias("median"), "std",
        F.coalesce("_top", F.expr("cast(array() as array<struct<value:string,count:bigint>>)")).alias("top_values"),
        "min_exact", "max_exact", F.col("_median_exact").alias("median_exact"),
    )


def example_rows(df: DataFrame, max_columns: int | None = None, max_example_rows: int = 5, max_cell_chars: int = 80) -> DataFrame:
    """A few leading rows, every cell as shortened text."""
    head = df.limit(max_example_rows)
    return head.select(*[truncate_cell(F.col(f"`{c}`"), max_cell_chars).alias(c) for c in df.columns[:max_columns]])


def table_header(
    df: DataFrame, source: str = "table", max_columns: int | None = None, max_scan_rows: int | None = None
) -> DataFrame:
    """One row: shape, whether the row cap was met, and notes on the caps applied."""
    scanned = df if max_scan_rows is None else df.limit(max_scan_rows)
    rows, n_cols = F.count("*"), len(df.columns)
    capped = F.lit(False) if max_scan_rows is None else rows >= max_scan_rows
    # The texts of the two notes.
    row_note = F.when(capped, f"Only the leading {max_scan_rows} rows were scanned; the file may have more.")
    described = n_cols if max_columns is None else min(n_cols, max_columns)
    column_note = F.lit(f"Described the first {described} of {n_cols} columns." if n_cols > described else None)
    return scanned.agg(
        F.lit(source).alias("source"), rows.alias("n_rows"), F.lit(n_cols).alias("n_cols"), capped.alias("rows_truncated"),
        F.lit(described).alias("n_columns_described"),
        F.filter(F.array(row_note, column_note), lambda x: x.isNotNull()).alias("notes"),
    )
