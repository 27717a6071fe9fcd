"""Properties of the physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from papyra.operators import clean, search
from papyra.operators.bm25 import bm25_postings
from papyra.operators.summary import summarize
from papyra.plans.index import build_index
from papyra.plans.prepare import prepare_papers
from papyra.sources.files import write_by_id


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").withColumnRenamed("text", "abstract")


@pytest.fixture(scope="module")
def index(docs, tmp_path_factory):
    flagged = docs.withColumn("flagged", F.col("doc_id") % 2 == 0)
    return build_index(flagged, str(tmp_path_factory.mktemp("index")), buckets=8, flags=["flagged"])


@pytest.fixture(scope="module")
def plans(spark, docs, index):
    papers = docs.select(
        "doc_id", F.lit("t").alias("title"), "abstract", F.lit("2020").alias("publish_time"),
        F.lit("u").alias("url"), F.lit("a").alias("authors"), F.lit("unused").alias("journal"),
    )
    queries = spark.range(3).select(F.col("id").alias("qid"), F.lit("some words").alias("text"))
    return {
        "prepare": plan(prepare_papers(papers)),
        "dedup": plan(clean.drop_duplicate_texts(docs.select("doc_id", "abstract"))),
        "postings": plan(bm25_postings(docs)),
        "parts": plan(search.score_parts(index, search.query_words(index, "thinor blees"), "flagged")),
        "batch": plan(search.batch_topk(index, docs, queries)),
        "attach": plan(search.attach_documents(
            spark.createDataFrame([(1, 2.0)], "doc_id long, score double"), docs
        )),
        "summary": plan(summarize(docs)),
    }


def test_no_python_in_rows_and_no_cross_joins(plans):
    for name, text in plans.items():
        for node in ("ArrowEval", "BatchEval", "NestedLoop", "Cartesian"):
            assert node not in text, (name, node)
        # Ranking sentences to convergence, and queries against documents, are worked out in tasks.
        assert name in ("summary", "batch") or "Pandas" not in text and "InArrow" not in text


def test_postings_need_no_shuffle(plans):
    assert "Exchange" not in plans["postings"]


def test_plain_words_are_looked_for_without_a_pattern(plans):
    """Nor does a pattern cut words; the noise pattern is left to texts that hold one of its words."""
    assert "Contains(abstract" in plans["prepare"] and "RLIKE virus" not in plans["prepare"]
    for line in plans["prepare"].splitlines():
        assert line.count("regexp_replace(") == line.count(" THEN regexp_replace(")
    assert ", -1)" in plans["postings"] and "split(" in plans["postings"]
    assert "+|--" not in plans["postings"]


def test_dedup_moves_no_rows_when_copies_are_few(plans, docs, monkeypatch):
    assert "BroadcastHashJoin" in plans["dedup"]
    assert not any("hashpartitioning" in line for line in plans["dedup"].splitlines())
    monkeypatch.setattr(clean, "can_broadcast", lambda df: False)
    text = plan(clean.drop_duplicate_texts(docs.select("doc_id", "abstract")))
    assert "partial_min" in text and "SortAggregate" not in text
    assert "LeftSemi" in text and "LeftAnti" not in text


def test_prepare_reads_only_what_it_writes(plans):
    for line in plans["prepare"].splitlines():
        if "ReadSchema" in line:
            assert "lang" not in line and "n_chars" not in line


def test_single_search_prunes_folders_and_row_groups(plans):
    text = plans["parts"]
    assert "EqualTo(flagged,true)" in text or "flagged" in text.split("PushedFilters")[-1]
    assert "PartitionFilters: [bucket" in text.replace("isnotnull(bucket", "bucket")
    assert "In(term, [blees,thinor])" in text


def test_batch_ranks_before_the_shuffle(plans):
    """Nothing but each task's best hits of each query is exchanged, and only for the ranking."""
    assert plans["batch"].count("WindowGroupLimit") == 2
    assert plans["batch"].count("Exchange hashpartitioning(qid") == 1
    assert plans["batch"].count("Exchange ") == 1


def test_documents_are_looked_up_by_id(plans):
    assert "PushedFilters: [EqualTo(doc_id,1)" in plans["attach"] or \
        "(doc_id, [1])" in plans["attach"] or "EqualTo(doc_id,1)" in plans["attach"]


def test_lookup_skips_files(spark, docs, tmp_path):
    """Of a table stored by id, the scan reads the files of the ids only."""
    path = str(tmp_path / "corpus")
    write_by_id(docs, path, partitions=20)
    ids = [3, 50, 51]
    hits = spark.createDataFrame([(i, 1.0) for i in ids], "doc_id long, score double")
    found = search.attach_documents(hits, spark.read.parquet(path))
    assert sorted(r["doc_id"] for r in found.collect()) == ids
    leaves, rows = [found._jdf.queryExecution().executedPlan().executedPlan()], []
    while leaves:
        leaf = leaves.pop()
        if "QueryStage" in leaf.nodeName():
            leaf = leaf.plan()
        if leaf.nodeName().startswith("Scan parquet"):
            rows.append(leaf.metrics().apply("numOutputRows").value())
        children = leaf.children()
        leaves += [children.apply(i) for i in range(children.size())]
    assert len(rows) == 1 and rows[0] <= 40 < docs.count()


def test_rows_without_ids_are_hash_aggregated(docs):
    papers = docs.select(F.lit("t").alias("title"), "abstract", F.lit("2020").alias("publish_time"), F.lit("u").alias("url"))
    text = plan(prepare_papers(papers))
    assert "SortAggregate" not in text


def test_summary_moves_the_text_once(docs):
    """The text is exchanged by document, and read twice from that one exchange."""
    summaries = summarize(docs)
    summaries.collect()
    final = plan(summaries).split("== Initial Plan ==")[0].splitlines()
    exchanges = [line for line in final if "Exchange hashpartitioning" in line]
    texts = [line for line in exchanges if "REPARTITION" in line or "ReusedExchange" in line]
    assert len(texts) == 2 and sum("ReusedExchange" in line for line in texts) == 1
    # The third moves the scores of sentences.
    assert len(exchanges) == 3
