"""Spark session."""

from __future__ import annotations

from pyspark.sql import SparkSession

LOCAL_ENV = "DEV"


def get_session(env: str | None = None, app_name: str = "papyra") -> SparkSession:
    """Session on this machine when ``env`` is ``DEV``, else on the submitter's cluster."""
    builder = SparkSession.builder.appName(app_name)
    if env == LOCAL_ENV:
        builder = builder.master("local[*]")
    return (
        # Push IN lists of up to this many values to Parquet as they are, not as a range.
        builder.config("spark.sql.parquet.pushdown.inFilterThreshold", "100")
        # Where every partition of ids has been measured to be this small, whole rows are kept
        # by a hash join, which need not sort them.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .getOrCreate()
    )
