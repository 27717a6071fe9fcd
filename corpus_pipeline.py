"""Training-corpus pipeline: each stage is written as Parquet and read again by the next.

The stages keep every column of ``documents`` but the last, which gives packed pieces. Rows are
judged each for itself, by the number of their file and their place in it, so null, repeated and text ids
and columns of any name make no difference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.llm.decontaminate import decontaminate
from papyra.llm.neardup import near_duplicates
from papyra.llm.packing import pack
from papyra.llm.quality_rules import quality_rules
from papyra.llm.secrets import scan_and_redact
from papyra.llm.stored import free_name, numbered_in_place, stored
from papyra.sources.sizes import can_broadcast


def _without(rows: DataFrame, gone: DataFrame, row: str) -> DataFrame:
    """``rows`` without those whose numbers ``gone`` has, which are broadcast if measured to be few."""
    gone = stored(gone.select(row), "gone")
    return rows.join(F.broadcast(gone) if can_broadcast(gone) else gone, row, "left_anti").drop(row)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    row, labels = free_name(docs, "_row"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = numbered_in_place(docs, row)
    return _without(rows, quality_rules(rows, labels, row_col=row).where("not kept"), row)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the first of those with the least id."""
    row = free_name(docs, "_row")
    rows = numbered_in_place(docs, row)
    found = near_duplicates(rows, id_col=row).select(F.col(row).alias("at"), F.col("component_id").alias("group"))
    others = stored(found.where("at <> group"), "others")
    members = others.unionByName(others.select(F.col("group").alias("at"), "group").distinct())
    members = members.join(rows.select(F.col(row).alias("at"), F.col("doc_id").alias("id")), "at")
    # Nulls are greater than any id here.
    place = F.struct(F.col("id").isNull().alias("null"), "id", "at")
    first = members.groupBy("group").agg(F.min(place).alias("first")).select(F.col("first.at").alias("at"))
    return _without(rows, members.join(first, "at", "left_anti").withColumnRenamed("at", row), row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    row, items = free_name(docs, "_row"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = numbered_in_place(docs, row)
    return _without(rows, decontaminate(rows, items, id_col=row).where("contaminated"), row)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by marks in the texts; all documents stay."""
    return scan_and_redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, in sequences of 1024 tokens."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality), ("near_dedup", near_dedup), ("decontamination", decontamination),
    ("secret_scans", secrets), ("packing", packing),
]
# Near-duplicate links and packing have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
