"""BM25 (Okapi) as tables.

``documents(doc_id, dl, terms)`` has a row per document, ``postings(bucket, term, doc_id, tf, dl,
block)`` a row per term and document, ``blocks(bucket, term, block, n, cf, max_tf, min_dl)`` a row per
run of a term's postings, ``terms(bucket, term, df, cf, raw_idf)`` a row per term, and
``stats(n, avgdl, mean_idf)`` one row.
``bucket`` is a hash of the term: tables are stored by it, so that a search reads only the
folders of its own terms.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.functions import fixed_values as fixed
from papyra.functions.text import term_counts, tokenize

BUCKETS = 64
# Postings of a block, as a power of two: rows that follow each other in a stored file.
BLOCK_BITS = 10


@dataclasses.dataclass(frozen=True)
class Bm25Index:
    postings: DataFrame
    blocks: DataFrame
    documents: DataFrame
    terms: DataFrame
    stats: DataFrame
    buckets: int
    stop_words: tuple[str, ...]
    flags: tuple[str, ...] = ()


def term_bucket(term: Column | str, buckets: int = BUCKETS) -> Column:
    """Number of the bucket a term belongs to."""
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def index_tokens(
    corpus: DataFrame,
    text_column: str = "abstract",
    stop_words: Iterable[str] = fixed.STOP_WORDS,
) -> DataFrame:
    """Add ``index_tokens``, the token array of any text column."""
    return corpus.withColumn("index_tokens", tokenize(text_column, stop_words))


def bm25_documents(
    corpus: DataFrame,
    text_column: str = "abstract",
    id_column: str = "doc_id",
    stop_words: Iterable[str] = fixed.STOP_WORDS,
    flags: Iterable[str] = (),
) -> DataFrame:
    """``(doc_id, dl, terms, flags)``: a row per document, its terms counted inside the row."""
    tokens = corpus.select(
        F.col(id_column).alias("doc_id"), *flags, tokenize(text_column, stop_words).alias("tokens")
    )
    return tokens.select(
        "doc_id", F.size("tokens").alias("dl"), term_counts("tokens").alias("terms"), *flags
    )


def document_postings(
    documents: DataFrame, buckets: int = BUCKETS, flags: Iterable[str] = ()
) -> DataFrame:
    """A row per term and document, from a row per document. Needs no shuffle."""
    rows = documents.select("doc_id", "dl", *flags, F.inline("terms"))
    return rows.select(
        term_bucket("term", buckets).alias("bucket"), "term", "doc_id", "tf", "dl", *flags
    )


def bm25_postings(
    corpus: DataFrame,
    text_column: str = "abstract",
    id_column: str = "doc_id",
    stop_words: Iterable[str] = fixed.STOP_WORDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """A row per term and document of a text column."""
    return document_postings(bm25_documents(corpus, text_column, id_column, stop_words), buckets)


def posting_blocks(postings: DataFrame) -> DataFrame:
    """A row per block of a term: its postings and occurrences, the highest frequency and the least length.

    No posting of the block adds more to a score than one with these two would, whatever the mean
    length and the weight of the term are.
    """
    return postings.groupBy("bucket", "term", "block").agg(
        F.count("*").alias("n"), F.sum("tf").alias("cf"), F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl")
    )


def bm25_terms(blocks: DataFrame, num_docs: int | Column) -> DataFrame:
    """A row per term, from its blocks: documents, occurrences and the logarithmic weight before its floor."""
    n = F.lit(num_docs)
    counts = blocks.groupBy("bucket", "term").agg(F.sum("n").alias("df"), F.sum("cf").alias("cf"))
    return counts.withColumn("raw_idf", F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))


def bm25_stats(terms: DataFrame, num_docs: int | Column) -> DataFrame:
    """One row: documents (empty ones included), mean document length, mean term weight."""
    n = F.lit(num_docs).cast("bigint")
    return terms.agg(
        n.alias("n"),
        F.coalesce(F.try_divide(F.sum("cf"), n), F.lit(0.0)).alias("avgdl"),
        F.avg("raw_idf").alias("mean_idf"),
    )


def bm25_idf(terms: DataFrame, stats: DataFrame) -> DataFrame:
    """Terms with ``idf``: negative weights become a quarter of the mean weight."""
    floor = fixed.BM25_EPSILON * stats.select("mean_idf").scalar()
    return terms.withColumn(
        "idf", F.when(F.col("raw_idf") < 0, floor).otherwise(F.col("raw_idf"))
    )


def term_score(idf: Column, tf: Column, dl: Column, avgdl: Column) -> Column:
    """What one occurrence of a query term adds to the score of a document."""
    k1, b = fixed.BM25_K1, fixed.BM25_B
    return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
