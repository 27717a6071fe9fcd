"""Cleaning steps. Each takes a DataFrame first, for use with ``df.transform``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.functions import fixed_values as fixed
from papyra.functions.text import matches, normalize_date, remove_matches
from papyra.sources.scratch import scratch_path
from papyra.sources.sizes import can_broadcast


def add_doc_id(df: DataFrame, name: str = "doc_id", key: str | None = None) -> DataFrame:
    """Give each row an id that does not depend on partitioning.

    ``key`` names a unique input column. Without one the id is a hash of the row, after equal
    rows have been merged: those cannot be told apart, and would share the id. Merging starts
    before the shuffle, so each task sends one copy of a row at most.
    """
    if key is not None:
        return df.withColumn(name, F.col(key))
    fields = [
        F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-"))
        for c in df.columns
    ]
    lengths = [F.length(f).cast("string") for f in fields]
    # The lengths keep ("ab", "c") and ("a", "bc") apart. The id is a number, 120 bits of the hash
    # in two halves, so that minima over it are hash-aggregated. It is never null; once Spark
    # knows, joins on it need no null filter, which would work the hash out a second time.
    digest = F.sha2(F.concat_ws(",", *lengths, *fields), 256)
    high, low = (
        F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(19,0)") for start in (1, 16)
    )
    number = (high * F.lit(1 << 60).cast("decimal(19,0)") + low).cast("decimal(38,0)")
    return df.distinct().withColumn(name, F.coalesce(number, F.lit(0).cast("decimal(38,0)")))


def clean_title(df: DataFrame, relevant: str | None = None) -> DataFrame:
    """Blank titles that are null, or short and without a match for ``relevant``."""
    title = F.coalesce("title", F.lit(""))
    relevant = fixed.RELEVANT_TITLE if relevant is None else relevant
    junk = (F.length(title) < fixed.SHORT_TITLE) & ~matches(title, relevant)
    return df.withColumn("title", F.when(junk, "").otherwise(title))


def clean_abstract(df: DataFrame, noise: str | None = None) -> DataFrame:
    """Put the title for a missing abstract and strip the words matching ``noise``."""
    noise = fixed.ABSTRACT_NOISE if noise is None else noise
    abstract = F.nullif(F.col("abstract"), F.lit(fixed.UNKNOWN_ABSTRACT))
    return df.withColumn("abstract", F.coalesce(abstract, "title")).withColumn(
        "abstract", remove_matches("abstract", noise)
    )


def drop_duplicate_texts(
    df: DataFrame, text_column: str = "abstract", id_column: str = "doc_id"
) -> DataFrame:
    """Keep, of the rows with equal text, the one with the lowest id. Ids are unique, not null.

    Copies are found on a hash and an id, partly before the shuffle, so a text shared by a
    third of all rows costs no more than any other. Only texts that have copies leave the
    aggregate; they are stored with their lowest id. If they have been measured to be few, they go
    to where the rows are, and no row is moved. Otherwise all lowest ids are joined by id, which
    spreads the rows evenly.
    """
    spark, text_hash = df.sparkSession, F.coalesce(F.sha2(F.col(text_column), 256), F.lit(""))
    groups = df.groupBy(text_hash.alias("text_hash")).agg(
        F.min(id_column).alias("lowest"), F.count("*").alias("copies")
    )
    path = scratch_path(spark, "copies")
    copied = groups.filter("copies > 1").select("text_hash", "lowest")
    copied.write.parquet(path)
    copied = spark.read.schema(copied.schema).parquet(path)
    if can_broadcast(copied):
        higher = (text_hash == copied["text_hash"]) & (F.col(id_column) > copied["lowest"])
        return df.join(F.broadcast(copied), higher, "left_anti")
    return df.join(groups.select(F.col("lowest").alias(id_column)), id_column, "left_semi")


def fill_nulls(df: DataFrame, columns: Sequence[str] = fixed.NULL_FILLED) -> DataFrame:
    """Empty text for null in those of ``columns`` that ``df`` has."""
    return df.na.fill("", [c for c in columns if c in df.columns])


def format_date(df: DataFrame, date_column: str = "publish_time") -> DataFrame:
    """ISO text for dates; null becomes '' and unreadable text becomes null."""
    return df.withColumn(date_column, normalize_date(date_column))
