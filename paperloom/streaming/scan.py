"""The scan, file and gate expressions on streams of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.scan import scan_signal


def scan_text_stream(
    spark: SparkSession, folder: str, schema: str | T.StructType = "doc_id bigint, text string", fmt: str = "parquet",
    text: str = "text", files_per_trigger: int = 100,
) -> DataFrame:
    """Injection signal of every text arriving in ``folder``; stateless, so nothing grows with time."""
    stream = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    return scan_signal(stream, text)
