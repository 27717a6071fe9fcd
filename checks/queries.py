"""The registered queries: name -> function of a session and the folder of the tables."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from papyra.functions import text as x
from papyra.operators import bm25, clean, results, search, select, tag
from papyra.operators.summary import summarize
from papyra.plans.index import build_index
from papyra.plans.job import JobArguments, prepare_files
from papyra.plans.prepare import prepare_papers
from papyra.sources.files import read_files, write_by_id, write_files
from papyra.sources.scratch import scratch_path
from papyra.sources.tables import read_table, register_table

QUERIES = {}
BUCKETS = 16


def query(function):
    # A trailing underscore keeps a name apart from an imported one.
    QUERIES[function.__name__.rstrip("_")] = function
    return function


# Stored tables are made once per session and folder, as a user would make them once.
@lru_cache(maxsize=None)
def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "prepared")
    write_by_id(prepare_papers(t.papers(spark, sf_dir), **t.PATTERNS), path)
    return spark.read.parquet(path)


@lru_cache(maxsize=None)
def prepared_index(spark: SparkSession, sf_dir: str) -> bm25.Bm25Index:
    return build_index(
        prepared(spark, sf_dir), scratch_path(spark, "index"), buckets=BUCKETS,
        flags=("covid_related",),
    )


@lru_cache(maxsize=None)
def document_index(spark: SparkSession, sf_dir: str) -> bm25.Bm25Index:
    return build_index(
        t.table(spark, sf_dir, "documents"), scratch_path(spark, "index"), "text",
        stop_words=t.SHORT_STOP_LIST, buckets=BUCKETS,
    )


def documents(spark, sf_dir):
    """The documents as a corpus: their text with a title and a flag."""
    return t.table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.split("text", "\n")[0].alias("title"), "lang"
    )


# --- sources and sinks -------------------------------------------------------------------


@query
def scan_papers(spark, sf_dir):
    path = _csv(spark, sf_dir, ["doc_id", "title", "abstract", "publish_time", "url"])
    return read_files(spark, path, "csv", multiLine=True, escape='"')


def _csv(spark, sf_dir, columns):
    """Papers as CSV; abstracts have line breaks, which are quoted."""
    path = scratch_path(spark, "csv")
    t.papers(spark, sf_dir).select(*columns).write.options(header=True, escape='"').csv(path)
    return path


@query
def write_read_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "papers")
    write_files(t.papers(spark, sf_dir), path)
    return read_files(spark, path, "parquet")


@query
def multi_path_scan(spark, sf_dir):
    paths = []
    papers = t.papers(spark, sf_dir).select("doc_id", "title", "abstract", "url")
    for third in range(3):
        paths.append(scratch_path(spark, "papers"))
        write_files(papers.filter(F.col("doc_id") % 3 == third), paths[-1])
    return read_files(spark, paths, "parquet")


@query
def multi_header_scan(spark, sf_dir):
    """Papers in three CSV folders, whose headers differ in order and number of columns."""
    options = {"header": True, "multiLine": True, "escape": '"', "nullValue": "NULL", "emptyValue": ""}
    papers, paths = t.papers(spark, sf_dir), []
    for third, columns in enumerate((
        ("doc_id", "title", "abstract", "url"), ("url", "abstract", "doc_id", "title"),
        ("abstract", "publish_time", "doc_id", "title"),
    )):
        paths.append(scratch_path(spark, "papers"))
        part = papers.filter(F.col("doc_id") % 3 == third).select(*columns)
        keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "quoteAll": True}
        part.write.options(**options, **keep).csv(paths[-1])
    return read_files(spark, paths, "csv", **options).select("doc_id", "title", "abstract", "url", "publish_time")


def _registered(spark, sf_dir, name):
    path = scratch_path(spark, name)
    write_files(t.papers(spark, sf_dir), path)
    register_table(spark, name, path)


@query
def register_table_(spark, sf_dir):
    _registered(spark, sf_dir, "papers_registered")
    return spark.table("papers_registered")


@query
def read_table_limit(spark, sf_dir):
    _registered(spark, sf_dir, "papers_limited")
    return read_table(spark, "papers_limited", limit=100)


@query
def sample_papers(spark, sf_dir):
    papers = t.papers(spark, sf_dir).select("doc_id", "title")
    return select.sample_rows(papers, 0.1, seed=1234, id_column="doc_id")


# --- choosing rows and columns -----------------------------------------------------------


@query
def project_columns(spark, sf_dir):
    return select.project_columns(
        t.papers(spark, sf_dir), ["title", "abstract", "publish_time", "authors", "url"]
    )


@query
def result_columns(spark, sf_dir):
    return results.result_columns(results.add_summaries(t.papers(spark, sf_dir)))


@query
def after_date(spark, sf_dir):
    return select.after(t.dated_papers(spark, sf_dir).transform(clean.format_date), "2022-06-15")


@query
def after_date_with_nulls(spark, sf_dir):
    dated = t.dated_papers(spark, sf_dir).transform(clean.format_date)
    return select.after(dated, "2022-06-15", include_null_dates=True)


@query
def since_cutoff(spark, sf_dir):
    return select.since_cutoff(t.dated_papers(spark, sf_dir).transform(clean.format_date))


@query
def drop_null_titles(spark, sf_dir):
    return results.drop_null_titles(t.papers(spark, sf_dir)).select("doc_id", "title")


@query
def fill_nulls(spark, sf_dir):
    return clean.fill_nulls(t.papers(spark, sf_dir)).select("doc_id", "authors", "abstract")


@query
def result_count(spark, sf_dir):
    return results.result_count(t.papers(spark, sf_dir))


@query
def preview_rows(spark, sf_dir):
    return select.preview(t.papers(spark, sf_dir), 5)


# --- cleaning and tagging ----------------------------------------------------------------


@query
def clean_title(spark, sf_dir):
    return clean.clean_title(t.papers(spark, sf_dir), t.RELEVANT).select("doc_id", "title")


def _clean_papers(spark, sf_dir):
    return (
        t.papers(spark, sf_dir)
        .transform(clean.clean_title, t.RELEVANT)
        .transform(clean.clean_abstract, t.NOISE)
    )


@query
def clean_abstract(spark, sf_dir):
    return _clean_papers(spark, sf_dir).select("doc_id", "abstract")


@query
def dedup_abstract(spark, sf_dir):
    return clean.drop_duplicate_texts(_clean_papers(spark, sf_dir)).select("doc_id", "abstract")


@query
def tag_covid(spark, sf_dir):
    tagged = tag.tag_covid(_clean_papers(spark, sf_dir), covid_terms=t.COVID_TERMS)
    return tagged.select("doc_id", "covid_related")


@query
def tag_virus(spark, sf_dir):
    tagged = tag.tag_virus(_clean_papers(spark, sf_dir), virus_pattern=t.VIRUS)
    return tagged.select("doc_id", "virus_related")


@query
def tag_coronavirus(spark, sf_dir):
    tagged = tag.tag_coronavirus(_clean_papers(spark, sf_dir), corona_pattern=t.CORONA)
    return tagged.select("doc_id", "corona_related")


@query
def tag_sars(spark, sf_dir):
    tagged = tag.tag_covid(_clean_papers(spark, sf_dir), covid_terms=t.COVID_TERMS)
    return tag.tag_sars(tagged, sars_pattern=t.SARS).select("doc_id", "sars_related")


@query
def format_date(spark, sf_dir):
    return clean.format_date(t.dated_papers(spark, sf_dir))


@query
def prepared_papers(spark, sf_dir):
    return prepare_papers(t.papers(spark, sf_dir), **t.PATTERNS)


@query
def prepared_defaults(spark, sf_dir):
    return prepare_papers(t.papers(spark, sf_dir))


@query
def prepare_without_ids(spark, sf_dir):
    """The batch job's own function over CSV without ids, with quoted line breaks."""
    columns = ["title", "abstract", "publish_time", "authors", "url"]
    path = _csv(spark, sf_dir, columns)
    args = JobArguments("", path, "csv", "", options=(("multiLine", "true"), ("escape", '"')))
    return prepare_files(spark, args, **t.PATTERNS).drop("doc_id")


# --- text functions ----------------------------------------------------------------------


@query
def clean_text(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents")
    return docs.select("doc_id", x.clean_text("text").alias("cleaned"))


@query
def tokenize_text(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select("doc_id", x.tokenize("text").alias("t"))
    return docs.select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("tokens")
    )


@query
def shorten_text(spark, sf_dir):
    return t.papers(spark, sf_dir).select(
        "doc_id",
        x.shorten("abstract").alias("default_length"),
        x.shorten("abstract", 300).alias("abstract_length"),
        x.shorten("title", 20).alias("title_length"),
    )


@query
def doi_url(spark, sf_dir):
    kind = F.col("page_id") % 4
    doi = F.when(kind == 0, None).when(kind == 1, "").when(
        kind == 2, F.concat(F.lit("doi.org/"), "url")
    ).otherwise(F.col("url"))
    return t.table(spark, sf_dir, "pages").select("page_id", x.doi_url(doi).alias("link"))


@query
def num_sentences(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents")
    return docs.select("doc_id", x.num_sentences("text").cast("bigint").alias("sentences"))


@query
def unicode_spaces(spark, sf_dir):
    """Tokens, words and sentences of texts in which many spaces are not ASCII."""
    text = F.col("text")
    for plain, wide in t.WIDE_SPACES:
        text = F.replace(text, F.lit(plain), F.lit(wide))
    docs = t.table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return docs.select(
        "doc_id", F.array_join(x.tokenize("text"), " ").alias("tokens"),
        x.num_words("text").cast("bigint").alias("words"),
        x.num_sentences("text").cast("bigint").alias("sentences"),
        F.array_join(x.summary_sentences("text"), "|").alias("parts"),
    )


# --- BM25 index --------------------------------------------------------------------------


@query
def index_tokens(spark, sf_dir):
    turns = bm25.index_tokens(t.table(spark, sf_dir, "conversations"), "text")
    return turns.select("conv_id", "turn", F.array_join("index_tokens", " ").alias("tokens"))


@query
def bm25_postings(spark, sf_dir):
    postings = bm25.bm25_postings(
        t.table(spark, sf_dir, "documents"), "text", stop_words=t.SHORT_STOP_LIST
    )
    return postings.select("term", "doc_id", "tf", F.col("dl").cast("bigint").alias("dl"))


@query
def bm25_stats(spark, sf_dir):
    stats = document_index(spark, sf_dir).stats
    return stats.select(
        "n", F.round("avgdl", 6).alias("avgdl"), F.round("mean_idf", 6).alias("mean_idf")
    )


@query
def bm25_idf(spark, sf_dir):
    index = document_index(spark, sf_dir)
    terms = bm25.bm25_idf(index.terms, index.stats)
    return terms.select("term", "df", F.round("idf", 6).alias("idf"))


@query
def search_no_tokens(spark, sf_dir):
    corpus = documents(spark, sf_dir).withColumn("text", F.regexp_replace("text", r"\S+", "--"))
    index = build_index(corpus, scratch_path(spark, "index"), "text", buckets=1)
    return search.search_topk(index, corpus, t.COMMON_QUERY)


# --- ranked search -----------------------------------------------------------------------


@query
def bm25_scores(spark, sf_dir):
    index = document_index(spark, sf_dir)
    scores = search.bm25_scores(index, documents(spark, sf_dir), t.COMMON_QUERY)
    return scores.select("doc_id", F.round("score", 6).alias("score"))


@query
def search_topk(spark, sf_dir):
    index = document_index(spark, sf_dir)
    hits = search.search_topk(index, documents(spark, sf_dir), t.COMMON_QUERY)
    return hits.select("doc_id", F.round("score", 6).alias("score"))


@query
def search_flag_filter(spark, sf_dir):
    hits = search.search_topk(
        prepared_index(spark, sf_dir), prepared(spark, sf_dir), t.RARE_QUERY, flag="covid_related"
    )
    return hits.select("doc_id", F.round("score", 6).alias("score"))


@query
def search_distinct_titles(spark, sf_dir):
    docs = documents(spark, sf_dir)
    hits = search.search_topk(document_index(spark, sf_dir), docs, t.COMMON_QUERY, 50)
    hits = search.distinct_titles(search.attach_documents(hits, docs))
    return hits.select("doc_id", "title", F.round("score", 6).alias("score"))


def _search(spark, sf_dir):
    return search.search(prepared_index(spark, sf_dir), prepared(spark, sf_dir), t.RARE_QUERY)


@query
def search_(spark, sf_dir):
    return _search(spark, sf_dir)


def _queries(spark, sf_dir):
    return t.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def _search_batch(spark, sf_dir):
    return search.search_batch(
        prepared_index(spark, sf_dir), prepared(spark, sf_dir), _queries(spark, sf_dir)
    )


@query
def search_batch(spark, sf_dir):
    hits = _search_batch(spark, sf_dir)
    return hits.select("qid", F.col("rank").cast("bigint").alias("rank"), "doc_id", "title", "score")


# --- summaries and results ---------------------------------------------------------------


@query
def summarize_docs(spark, sf_dir):
    return summarize(t.table(spark, sf_dir, "documents"), "text")


@query
def search_results(spark, sf_dir):
    return results.result_records(_search(spark, sf_dir))


@query
def search_batch_results(spark, sf_dir):
    return results.result_records(_search_batch(spark, sf_dir), ("qid",))

