"""What several training-data operators share: words, reading, shared tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six characters that separate words: space and code points 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the runs of characters outside SPACES; empty for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def count_words(text: Column) -> Column:
    """Number of words as long, without keeping the words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "[ \\t-\\r]+"))).cast("long")


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir where it is set.

    Only a local-mode session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage
    and lets a job survive the loss of any executor."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
