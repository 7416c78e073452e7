"""File listings, archive members, texts and checksums."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.files import archive_type


def _members(kind: str, content: bytes) -> list[tuple[str, int, bool, bool]]:
    """``(name, size, is_dir, is_file)`` of an archive held in memory; a link is neither."""
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            return [(m.filename, m.file_size, m.is_dir(), not m.is_dir()) for m in archive.infolist()]
    mode = "r:" if kind == "tar" else "r:gz"
    with tarfile.open(fileobj=io.BytesIO(content), mode=mode) as archive:
        return [(m.name, m.size, m.isdir(), m.isfile()) for m in archive]


def archive_members(files: DataFrame) -> DataFrame:
    """Members of the archives in ``files(path, content)``; an unreadable archive gives one error row."""
    archives = files.withColumn("kind", archive_type(F.col("path"))).where(F.col("kind").isNotNull()).select("path", "kind", "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, kind, content in zip(batch["path"], batch["kind"], batch["content"]):
                try:
                    rows += [(path, *member, None) for member in _members(kind, content)]
                except Exception as exc:  # a broken archive must not stop the job
                    rows.append((path, None, None, None, None, f"Failed to read archive: {exc}"))
            yield pd.DataFrame(rows, columns=["path", "name", "size", "is_dir", "is_file", "error"])

    return archives.mapInPandas(read, "path string, name string, size bigint, is_dir boolean, is_file boolean, error string")


def _binary(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)


def list_files(spark: SparkSession, root: str, inspect_archives: bool = True) -> DataFrame:
    """``(path, size_bytes, archive, member)`` of all files below ``root``.

    Archive members get the path ``archive/inner``. Only archives are read; of all other
    files just the listing is used.
    """
    files = _binary(spark, root)
    plain = files.select("path", F.col("length").alias("size_bytes"), F.lit(None).cast("string").alias("archive"),
                         F.lit(None).cast("string").alias("member"))
    if not inspect_archives:
        return plain
    inner = archive_members(files.where(archive_type(F.col("path")).isNotNull()).select("path", "content"))
    inner = inner.where(F.col("error").isNull() & F.col("is_file"))
    return plain.unionByName(inner.select(
        F.concat_ws("/", "path", "name").alias("path"), F.col("size").alias("size_bytes"),
        F.col("path").alias("archive"), F.col("name").alias("member"),
    ))


def archive_contents(members: DataFrame) -> DataFrame:
    """File count and bytes per archive, directories not counted, with the error if unreadable."""
    is_file = F.col("error").isNull() & ~F.col("is_dir")
    return members.groupBy(F.col("path").alias("archive_path")).agg(
        F.count_if(is_file).alias("total_files"), F.coalesce(F.sum(F.when(is_file, F.col("size"))), F.lit(0)).alias("total_size"),
        F.max("error").alias("error"),
    )


def read_texts(spark: SparkSession, root: str) -> DataFrame:
    """``(path, text)`` of whole text files."""
    return spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def file_checksums(spark: SparkSession, root: str) -> DataFrame:
    files = _binary(spark, root)
    return files.select("path", F.col("length").alias("size_bytes"), F.sha2(F.col("content"), 256).alias("sha256sum"))


def schema_report(tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None, table: str | None = None) -> DataFrame:
    """``(table, position, column, type, nullable, is_primary_key)`` of tables known by name."""
    keys = keys or {}
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable, f.name in keys.get(name, []))
        for name, df in sorted(tables.items()) if table is None or name == table
        for i, f in enumerate(df.schema.fields)
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(
        rows, "`table` string, position int, `column` string, type string, nullable boolean, is_primary_key boolean"
    )
