"""Presenting hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.functions import fixed_values as fixed
from papyra.functions.text import shorten
from papyra.operators.summary import summarize
from papyra.sources.scratch import scratch_path
from papyra.sources.sizes import can_broadcast

DISPLAY_COLUMNS = ("title", "summary", "publish_time")


def drop_null_titles(hits: DataFrame) -> DataFrame:
    return hits.na.drop(subset=["title"])


def result_columns(hits: DataFrame) -> DataFrame:
    """Those of the columns shown in a table that ``hits`` has."""
    return hits.select(*[c for c in DISPLAY_COLUMNS if c in hits.columns])


def add_summaries(hits: DataFrame, text_column: str = "abstract") -> DataFrame:
    """Hits that have a title, with a summary of each text.

    The hits are worked out once and stored. A document that is a hit of several queries is
    summarised once: the first of its rows is found by numbers alone, without moving texts.
    """
    spark, path = hits.sparkSession, scratch_path(hits.sparkSession, "hits")
    number = "_hit"
    drop_null_titles(hits).withColumn(number, F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    first = stored.groupBy("doc_id").agg(F.min(number).alias(number)).select(number)
    if can_broadcast(first):
        first = F.broadcast(first)
    texts = stored.join(first, number, "left_semi").select("doc_id", text_column)
    return stored.drop(number).join(summarize(texts, text_column), "doc_id")


def result_records(hits: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One record per hit: title, shortened abstract and summary, url, score and date."""
    return add_summaries(hits).select(
        *keys, "doc_id", "title",
        shorten("abstract", fixed.ABSTRACT_LENGTH).alias("abstract"),
        shorten("summary", fixed.SUMMARY_LENGTH).alias("summary"),
        "url", "score", "publish_time",
    )


def result_count(hits: DataFrame) -> DataFrame:
    """One row: the number of hits that have a title."""
    return drop_null_titles(hits).agg(F.count("*").alias("results"))
