"""A folder that driver and executors share, for tables that a query writes and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; only a single-machine session that has none gets a local one."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    base = held.get() if held.isDefined() else spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="ridgeline-")
    return f"{base}/{name}-{uuid.uuid4().hex}"
