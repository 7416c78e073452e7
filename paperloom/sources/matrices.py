"""Delimited matrices and differential-expression tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cells import optional_number, to_bool, to_number
from ..operators.ranking import last_by

# Columns of a DIA-NN protein-group matrix that are not samples.
DIANN_METADATA = ("Protein.Group", "Protein.Ids", "Protein.Names", "Genes", "First.Protein.Description")
# Id columns and sample prefixes of a MaxQuant protein-group table, best first.
MAXQUANT_IDS = ("Majority protein IDs", "Protein IDs", "id")
MAXQUANT_PREFIXES = ("LFQ intensity ", "Intensity ")
# Cells that a typed column takes for missing.
NOT_THERE = ("", "na", "nan", "n/a", "#n/a", "null", "none")
#: Delimiters of texts whose name does not tell theirs.
DELIMITERS = (",", "\t", ";", "|")


def _separator(path: str, sep: str | None) -> str:
    if sep is not None:
        return sep
    return "," if path.lower().endswith(".csv") else "\t"


def with_position(rows: DataFrame, path: str, position: str, columns: Sequence[Column]) -> DataFrame:
    """``columns`` of the rows of files below ``path``, and what orders them: by file name, then by the place of the split, then inside it.

    The same on every run. A file's number stands for its name, because a row with its whole path is several times as large.
    """
    files = rows.sparkSession.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file"))
    files = files.select("_file", F.row_number().over(Window.orderBy("_file")).alias("_number"))  # a row for each file
    start, row = F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_row")
    placed = rows.select(*columns, F.col("_metadata.file_path").alias("_file"), start, row).join(F.broadcast(files), "_file", "left")
    place = F.struct(F.col("_number").alias("file"), F.col("_start").alias("start"), F.col("_row").alias("row"))
    return placed.withColumn(position, place).drop("_file", "_number", "_start", "_row")


def read_text_table(spark: SparkSession, path: str, sep: str | None = None, multi_line: bool = False,
                    position: str | None = None, surplus: str | None = None) -> DataFrame:
    """All-string table with stripped header cells; a byte-order mark is tolerated.

    All files below ``path`` have the header of the first. Short rows are filled with NULL, blank lines are skipped, of header cells
    with one name the last counts. ``position`` names a column that orders the rows as they stand in
    the files, see with_position. ``surplus`` names a column with the first non-empty cell beyond the
    header; cells beyond it are else left out. Quoted line breaks need ``multi_line``, which reads each
    file in one task.
    """
    options = {"sep": _separator(path, sep), "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": multi_line}
    first = spark.read.options(**options).csv(path).head(1)
    header = [(c or "").lstrip("\ufeff").strip() for c in first[0]] if first else []
    # One column more than the header has takes what is beyond it.
    names = [f"c{i}" for i in range(len(header) + 1)]
    rows = spark.read.options(**options, header=True, enforceSchema=True).csv(path, schema=", ".join(f"{n} string" for n in names))
    last = {name: at for at, name in enumerate(header)}
    columns = [F.col(names[last[name]]).alias(name) for name in dict.fromkeys(header)]
    if surplus is not None:
        columns.append(F.col(names[-1]).alias(surplus))
    return rows.select(*columns) if position is None else with_position(rows, path, position, columns)


def melt_matrix(df: DataFrame, id_col: str | None = None, sample_cols: Sequence[str] | None = None,
                metadata_cols: Sequence[str] = (), strip_prefix: str = "", position: str | None = None, last_rows: bool = False) -> DataFrame:
    """Wide all-string matrix to ``feature_id, sample, value``, and the column ``position`` if one is named.

    With ``last_rows`` only the last row of each feature by ``position`` is taken, before it becomes as many rows as there are samples.
    """
    id_col = df.columns[0] if id_col is None else id_col
    if id_col not in df.columns:
        raise ValueError(f"id_column {id_col!r} not found in {df.columns}")
    if sample_cols is None:
        samples = [c for c in df.columns if c not in (id_col, position) and c not in metadata_cols]
    else:
        samples = [c for c in sample_cols if c in df.columns]
    feature = F.coalesce(F.col(f"`{id_col}`"), F.lit("")).alias("feature_id")
    place = [] if position is None else [F.col(f"`{position}`")]
    if not samples:
        return df.select(feature, F.lit(None).cast("string").alias("sample"), F.lit(None).cast("double").alias("value"), *place).limit(0)
    values = [to_number(F.col(f"`{c}`").cast("string")).alias(f"_value{i}") for i, c in enumerate(samples)]
    rows = df.select(feature, *values, *place)
    if last_rows:
        rows = last_by(rows, ["feature_id"], position)
    cells = F.array(*[F.struct(F.lit(c.removeprefix(strip_prefix)).alias("sample"), F.col(f"_value{i}").alias("value")) for i, c in enumerate(samples)])
    return rows.select("feature_id", F.inline(cells), *place)


def read_matrix(spark: SparkSession, path: str, id_col: str | None = None, sample_cols: Sequence[str] | None = None, sep: str | None = None,
                metadata_cols: Sequence[str] = (), multi_line: bool = False, position: str | None = None, last_rows: bool = False) -> DataFrame:
    """Long matrix of a delimited file; with ``position``, last_by on it gives the last row of a repeated feature.

    With ``last_rows`` the others are left out while rows are still wide.
    """
    table = read_text_table(spark, path, sep, multi_line, position)
    return melt_matrix(table, id_col, sample_cols, metadata_cols, position=position, last_rows=last_rows)


def read_diann_matrix(spark: SparkSession, path: str, id_col: str = "Protein.Group", sample_cols: Sequence[str] | None = None,
                      sep: str | None = None, position: str | None = None, last_rows: bool = False) -> DataFrame:
    return read_matrix(spark, path, id_col, sample_cols, sep, DIANN_METADATA, position=position, last_rows=last_rows)


def read_maxquant_matrix(spark: SparkSession, path: str, id_col: str = MAXQUANT_IDS[0], prefix: str = MAXQUANT_PREFIXES[0],
                         sample_cols: Sequence[str] | None = None, sep: str | None = None, position: str | None = None) -> DataFrame:
    df = read_text_table(spark, path, sep, position=position)
    found = next((c for c in (id_col, *MAXQUANT_IDS) if c in df.columns), None)
    if found is None:
        raise ValueError(f"No usable id column found in {df.columns}")
    if sample_cols is not None:
        return melt_matrix(df, found, sample_cols, position=position)
    # A header cell is stripped, so the bare prefix is the summary column, not a sample.
    for start in (prefix, MAXQUANT_PREFIXES[1]):
        samples = [c for c in df.columns if c.startswith(start) and c != start.strip()]
        if samples:
            return melt_matrix(df, found, samples, strip_prefix=start, position=position)
    return melt_matrix(df, found, [], position=position)


def dep_columns(df: DataFrame, id_col: str = "feature_id", log2fc_col: str | None = "log2fc", pvalue_col: str | None = "pvalue",
                padj_col: str | None = "padj", sig_col: str | None = "significant", position: str | None = None) -> DataFrame:
    """Typed differential-expression table from an all-string one; absent columns are NULL.

    An empty cell of a present significance column means false.
    """
    if id_col not in df.columns:
        raise ValueError(f"id_column {id_col!r} not found in {df.columns}")

    def number(name):
        present = name is not None and name in df.columns
        return optional_number(F.col(f"`{name}`")) if present else F.lit(None).cast("double")

    flag = F.lit(None).cast("boolean")
    if sig_col is not None and sig_col in df.columns:
        flag = to_bool(F.coalesce(F.col(f"`{sig_col}`"), F.lit("")))
    return df.select(
        F.coalesce(F.col(f"`{id_col}`"), F.lit("")).alias("feature_id"), number(log2fc_col).alias("log2fc"),
        number(pvalue_col).alias("pvalue"), number(padj_col).alias("padj"), flag.alias("significant"), *([F.col(f"`{position}`")] if position else []),
    )


def read_dep(spark: SparkSession, path: str, sep: str | None = None, multi_line: bool = False, position: str | None = None, **columns) -> DataFrame:
    """Typed differential-expression table; with ``position``, first_by on it gives the first row of a repeated feature."""
    return dep_columns(read_text_table(spark, path, sep, multi_line, position), position=position, **columns)


def _cells(line: Column, sep: str, n: int) -> Column:
    """The line's cells as an array of ``n`` texts; what is beyond is left out."""
    names = [f"c{i}" for i in range(n)]
    row = F.from_csv(line, ", ".join(f"{c} string" for c in names), {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return F.array(*[row[c] for c in names])


def _float(text: Column) -> Column:
    """A number of a typed table; infinities are values there."""
    word = F.lower(F.trim(text))
    infinite = F.when(word.isin("inf", "+inf", "infinity", "+infinity"), float("inf")).when(word.isin("-inf", "-infinity"), float("-inf"))
    return F.coalesce(infinite, optional_number(text))


def delimiter_and_types(lines: DataFrame, header: str, candidates: Sequence[str] = DELIMITERS) -> tuple[str, list[str], float]:
    """(delimiter, column types, share of lines that fit it) of rows (value), by one aggregate over all lines.

    A delimiter counts if it occurs in the header. Lines are cut by each of those; the one is taken by which most
    lines have as many cells as the header, then the one that gives most cells, then the first
    of the list. A column is boolean, bigint or double if all its cells that are not missing are, else string. With no delimiter at all there is
    one column.
    """

    def count(text: Column, sep: str) -> Column:
        # Delimiters inside quotes are none.
        return F.length(F.regexp_replace(text, '"[^"]*"', "")) - F.length(F.replace(F.regexp_replace(text, '"[^"]*"', ""), F.lit(sep), F.lit("")))

    spark = lines.sparkSession
    wide = spark.range(1).select(*[(count(F.lit(header), s) + 1).alias(f"n{i}") for i, s in enumerate(candidates)]).first()
    open_ = [(i, s, n) for i, (s, n) in enumerate(zip(candidates, wide)) if n > 1] or [(0, candidates[0], 1)]
    value = F.col("value")

    def cut(i: int, sep: str, n: int) -> Column:
        fits = F.struct(F.lit(i).alias("candidate"), F.lit(-1).alias("at"), (count(value, sep) + 1 == n).cast("string").alias("cell"))
        return F.concat(F.array(fits), F.transform(_cells(value, sep, n), lambda c, at: F.struct(F.lit(i).alias("candidate"), at.alias("at"), c.alias("cell"))))

    cells = lines.where((value != header) & (F.trim(value) != "")).select(F.inline(F.concat(*[cut(*c) for c in open_])))
    text = F.trim("cell")
    known = ~F.coalesce(F.lower(text).isin(*NOT_THERE), F.lit(True))
    fits = [F.bool_and(F.when(known, test)) for test in (
        F.lower(text).isin("true", "false"), text.try_cast("bigint").isNotNull() & text.rlike(r"^[+-]?[0-9]+$"), _float(text).isNotNull())]
    found = cells.groupBy("candidate", "at").agg(
        F.avg(F.when(F.col("at") < 0, (F.col("cell") == "true").cast("double"))).alias("share"),
        F.when(fits[0], "boolean").when(fits[1], "bigint").when(fits[2], "double").otherwise("string").alias("kind"),
    ).collect()  # one row for each column and candidate
    share = {r.candidate: r.share for r in found if r["at"] < 0}
    best, sep, n = max(open_, key=lambda c: (share.get(c[0], 1.0), c[2], -c[0]))
    kinds = {r["at"]: r.kind for r in found if r.candidate == best}
    return sep, [kinds.get(at, "string") for at in range(n)], share.get(best, 1.0)


def _typed(df: DataFrame, kinds: Sequence[str]) -> DataFrame:
    def cast(name, kind):
        c = F.col(f"`{name}`")
        if kind == "string":
            return c.alias(name)
        missing = F.lower(F.trim(c)).isin(*NOT_THERE)
        if kind == "double":
            return _float(c).alias(name)
        return F.when(~missing, F.trim(c).try_cast(kind)).alias(name)

    return df.select(*[cast(n, k) for n, k in zip(df.columns, kinds)])


def read_table(spark: SparkSession, path: str, delimiter: str | None = None) -> tuple[DataFrame | None, DataFrame]:
    """A typed table by file name, and a one-row report ``(source, file_type, delimiter, error)``.

    Types, and the delimiter of a text whose name does not tell it, come from one pass over its lines. What cannot
    be read is reported, not raised.
    """
    name = path.lower().rstrip("/").rsplit("/", 1)[-1]
    if ".parquet" in name:
        kind, sep = "parquet", None
    elif ".tsv" in name or ".tab" in name:
        kind, sep = "tsv", delimiter or "\t"
    elif ".csv" in name:
        kind, sep = "csv", delimiter or ","
    else:
        kind, sep = "delimited", delimiter
    frame, error = None, None
    try:
        if kind == "parquet":
            frame = spark.read.parquet(path)
        else:
            lines = spark.read.text(path)
            header = next((r.value for r in lines.where(F.trim("value") != "").head(1)), "")
            sep, kinds, _ = delimiter_and_types(lines, header, DELIMITERS if sep is None else [sep])
            frame = read_text_table(spark, path, sep)
            frame = _typed(frame, kinds) if len(kinds) == len(frame.columns) else frame
    except AnalysisException as exc:
        missing = (exc.getCondition() or "") == "PATH_NOT_FOUND"
        error = f"File not found: {path}" if missing else f"Could not read table: {exc}"
    report = spark.createDataFrame(
        [(path, kind, sep, error)], "source string, file_type string, delimiter string, error string"
    )
    return frame, report
