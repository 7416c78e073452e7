"""Session defaults and reliable materialisation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, bring your own with its own checkpoint folder."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paperloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def new_folder(spark: SparkSession) -> str:
    """A folder name of its own below the folder that ``spark.checkpoint.dir`` names.

    Where the setting is missing, a local session gets a temporary folder and a cluster an error, because
    executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="paperloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to a new folder and read it back.

    Used where a frame is expensive or not repeatable (a model call) or is used by an
    iteration. Readers prune columns and rows of what was written. Every call writes a folder of
    its own, which the caller may delete when no frame reads it any more. Columns without a type, which Parquet
    does not store, come back as they were.
    """
    path = new_folder(df.sparkSession)
    untyped = [c for c, kind in df.dtypes if kind == "void"]
    kept = df.drop(*untyped)
    kept.write.parquet(path)
    out = df.sparkSession.read.schema(kept.schema).parquet(path)
    return out.select(*[F.lit(None).alias(c) if c in untyped else F.col(f"`{c}`") for c in df.columns]) if untyped else out
