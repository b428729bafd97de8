"""The folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below spark.checkpoint.dir. Only a local-mode session without that
    setting gets a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
