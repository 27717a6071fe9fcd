"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make the Parquet directory ``path`` readable as table ``name``; repeat after a rewrite.

    The schema is taken from the files. An existing external table is dropped first (its files
    stay), so a changed schema is seen; a managed table is left alone and an error raised, as
    dropping it would delete its data.
    """
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} is not an external table")
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_table(
    spark: SparkSession, name: str, limit: int | None = None, order_by: str = "doc_id"
) -> DataFrame:
    """All rows of a table, or its first ``limit`` rows by ``order_by``."""
    table = spark.table(name)
    return table if limit is None else table.orderBy(order_by).limit(limit)
