"""A folder that all machines share, for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``; a folder of our own only in local mode, where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="quillon-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/quillon-{label}-{uuid.uuid4().hex}"
