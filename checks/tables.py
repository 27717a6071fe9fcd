"""Views over the given tables, and the patterns that fit their invented words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RELEVANT = "the|ou"
NOISE = "(Publisher|Abstract|Summary|BACKGROUND|INTRODUCTION|thion)"
COVID_TERMS = ["ertion", "the-?n?re"]
VIRUS = "wher|whou"
CORONA = "whst"
SARS = "schst"
PATTERNS = {
    "relevant": RELEVANT, "noise": NOISE, "covid_terms": COVID_TERMS,
    "virus_pattern": VIRUS, "corona_pattern": CORONA, "sars_pattern": SARS,
}
SHORT_STOP_LIST = ("and", "the", "is", "of", "to", "on")
COMMON_QUERY = "are that for es are"
# A plain character or run, and the same with white space beyond ASCII.
WIDE_SPACES = (("e ", "e\u00a0"), ("s ", "s\u2009"), (". ", ".\u3000"), (", ", ",\u202f"))
RARE_QUERY = "Erheed whou, ntwh/tionand!"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers made of documents: ``doc_id, title, abstract, publish_time, authors, url``."""
    doc_id = F.col("doc_id")
    day = F.date_add(F.lit("2019-01-01").cast("date"), (doc_id % 730).cast("int"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(doc_id % 11 != 0, F.split("text", "\n")[0]).alias("title"),
        F.when(doc_id % 13 == 0, "Unknown").when(doc_id % 17 != 0, F.col("text"))
        .alias("abstract"),
        F.when(doc_id % 7 == 0, None).when(doc_id % 5 == 0, "2020")
        .otherwise(F.date_format(day, "yyyy-MM-dd")).alias("publish_time"),
        F.lit(None).cast("string").alias("authors"),
        F.concat(F.lit("http://x/"), doc_id.cast("string")).alias("url"),
    )


def dated_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, publish_time``: dates of orders, 22 years on; some incomplete, missing, unreadable."""
    key = F.col("o_orderkey")
    day = F.date_format(F.add_months("o_orderdate", 22 * 12), "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        key.alias("doc_id"),
        F.when(key % 7 == 0, None).when(key % 5 == 0, F.substring(day, 1, 4))
        .when(key % 19 == 0, F.concat(F.lit("spring "), key.cast("string")))
        .when(key % 23 == 0, F.substring(day, 1, 7)).otherwise(day).alias("publish_time"),
    )
