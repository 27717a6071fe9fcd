"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyra.llm.alignment import align, with_support
from papyra.llm.decontaminate import decontaminate
from papyra.llm.html_text import extract_text
from papyra.llm.importance import resample
from papyra.llm import licences
from papyra.llm.neardup import near_duplicates
from papyra.llm.oracle import ORACLE
from papyra.llm.packing import pack
from papyra.llm.pieces import decode_pieces, encode_pieces
from papyra.llm.quality_classifier import classify
from papyra.llm.quality_rules import quality_rules
from papyra.llm.secrets import BASE_KINDS, scan, span_names
from papyra.llm.token_counts import token_counts
from papyra.llm.toxicity import score, train


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.withColumn("failed_rules", F.array_join("failed_rules", ","))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the licences found, sorted, and the largest share of a template found."""
    found = licences.scan(_table(spark, sf_dir, "documents"), licences.template_table(spark))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"])))
    return found.select(
        "doc_id", F.size(names).cast("long").alias("n_licences"), F.array_join(names, ",").alias("licences"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["percent"])), F.lit(0)).cast("long").alias("percent"),
    )


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source stands for its host, its language there for the path."""
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_counts(_table(spark, sf_dir, "documents"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    count = {kind: F.size(F.filter(spans, _is(kind))).cast("long") for kind in BASE_KINDS}
    return scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", *[n.alias(f"n_{kind}") for kind, n in count.items()],
        F.sha2(span_names(spans, list(BASE_KINDS)), 256).alias("base_sha256"),
        span_names(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
    )


def _is(kind: str):
    return lambda span: span["kind"] == kind


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score(docs, train(docs, _table(spark, sf_dir, "labels")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_pieces(encode_pieces(_table(spark, sf_dir, "documents"))).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = {name: F.size(column).cast("long") for name, column in (
        ("n_a", "a_ids"), ("n_b", "b_ids"), ("n_groups", "a_cuts"), ("n_links", "links"),
    )}
    aligned = align(_table(spark, sf_dir, "documents")).select(
        "doc_id", *[column.alias(name) for name, column in n.items()], "links",
        F.when(n["n_a"] > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
    )
    return with_support(aligned)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_license_scans": op2_license_scans,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_packing": op4_packing,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_html_extraction": op6_html_extraction,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_counts": op8_token_counts,
    "op9_secret_scans": op9_secret_scans,
    "op10_toxicity": op10_toxicity,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

__all__ = ["ORACLE", "QUERIES"]
