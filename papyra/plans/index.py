"""Building and loading a stored BM25 index."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.functions import fixed_values as fixed
from papyra.operators.bm25 import (
    BLOCK_BITS, BUCKETS, Bm25Index, bm25_documents, bm25_stats, bm25_terms, document_postings, posting_blocks,
)
from papyra.sources.files import write_clustered
from papyra.sources.sizes import partitions_for


def build_index(
    corpus: DataFrame,
    path: str,
    text_column: str = "abstract",
    id_column: str = "doc_id",
    stop_words: Iterable[str] = fixed.STOP_WORDS,
    buckets: int = BUCKETS,
    flags: Sequence[str] = (),
) -> Bm25Index:
    """Write the five index tables of a text column of a stored table under ``path``.

    The text is read for its size and then for each document's terms; postings come from the stored
    documents, and blocks, terms and statistics each from the table stored before, so a lost
    executor repeats only its own part. Raise
    ``buckets`` with the corpus: a search reads about one bucket per query term. ``flags`` are
    boolean columns kept beside the postings, so that flagged searches need not read the corpus.

    Every build writes a folder of its own, which counts once its statistics, the last table, are
    there. A build that breaks off therefore leaves the index before it as it was.
    """
    spark, stop_words, flags = corpus.sparkSession, tuple(stop_words), tuple(flags)
    size = corpus.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text_column)), F.lit(0))).first()
    num_docs, partitions = size[0], partitions_for(spark, size[1])
    build = f"{path}/build-{uuid.uuid4().hex}"
    id_type = corpus.schema[id_column].dataType.simpleString()
    documents = bm25_documents(corpus, text_column, id_column, stop_words, flags)
    documents.write.parquet(f"{build}/documents")
    documents = _read(spark, build, "documents", id_type, flags)
    write_clustered(
        document_postings(documents, buckets, flags),
        f"{build}/postings", "bucket", ("term", "doc_id"), partitions, BLOCK_BITS,
    )
    postings = _read(spark, build, "postings", id_type, flags)
    write_clustered(posting_blocks(postings), f"{build}/blocks", "bucket", ("term", "block"), partitions)
    blocks = _read(spark, build, "blocks")
    write_clustered(bm25_terms(blocks, num_docs), f"{build}/terms", "bucket", ("term",), partitions)
    # The settings are kept with the statistics: queries must be tokenised as the texts were.
    stats = bm25_stats(_read(spark, build, "terms"), num_docs).select(
        "*",
        F.lit(id_type).alias("id_type"),
        F.lit(buckets).alias("buckets"),
        F.lit(list(stop_words)).cast("array<string>").alias("stop_words"),
        F.lit(list(flags)).cast("array<string>").alias("flags"),
        F.lit(build).alias("build"), F.current_timestamp().alias("built_at"),
    )
    stats.coalesce(1).write.parquet(f"{build}/stats")
    return load_index(spark, path)


def _read(
    spark: SparkSession, path: str, table: str, id_type: str = "", flags: Sequence[str] = ()
) -> DataFrame:
    """An index table; the schema is given, as a corpus without tokens leaves no files."""
    more = "".join(f", `{flag}` boolean" for flag in flags)
    schema = {
        "documents": f"doc_id {id_type}, dl int, terms array<struct<term:string,tf:bigint>>{more}",
        "postings": f"term string, doc_id {id_type}, tf bigint, dl int{more}, block bigint, bucket int",
        "blocks": "term string, block bigint, n bigint, cf bigint, max_tf bigint, min_dl int, bucket int",
        "terms": "term string, df bigint, cf bigint, raw_idf double, bucket int",
    }
    return spark.read.schema(schema[table]).parquet(f"{path}/{table}")


def load_index(spark: SparkSession, path: str) -> Bm25Index:
    """The last index whose build under ``path`` was finished."""
    builds = spark.read.parquet(f"{path}/build-*/stats")
    settings = builds.orderBy(F.col("built_at").desc(), "build").select(
        "id_type", "buckets", "stop_words", "flags", "build"
    ).first()
    build, flags = settings["build"], tuple(settings["flags"])
    stats = spark.read.parquet(f"{build}/stats")
    return Bm25Index(
        _read(spark, build, "postings", settings["id_type"], flags), _read(spark, build, "blocks"),
        _read(spark, build, "documents", settings["id_type"], flags), _read(spark, build, "terms"), stats,
        settings["buckets"], tuple(settings["stop_words"]), flags,
    )
