"""Folder for tables written to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path under the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a local session uses a temporary folder; on a cluster the executors
    would not share one, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="papyra-")
    return f"{root.rstrip('/')}/papyra-{name}-{uuid.uuid4().hex}"
