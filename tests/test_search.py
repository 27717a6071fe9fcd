"""BM25 search against a plain Okapi implementation."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from papyra.operators import search as s
from papyra.operators.bm25 import bm25_terms
from papyra.plans.index import build_index, load_index

WORDS = [f"w{i}" for i in range(40)]


def okapi(docs, query, k1=1.5, b=0.75, epsilon=0.25):
    """Scores by document id."""
    n, lengths = len(docs), {i: len(d) for i, d in docs.items()}
    mean = sum(lengths.values()) / n
    df = Counter(w for d in docs.values() for w in set(d))
    raw = {w: math.log(n - f + 0.5) - math.log(f + 0.5) for w, f in df.items()}
    floor = epsilon * sum(raw.values()) / len(raw) if raw else 0
    idf = {w: floor if v < 0 else v for w, v in raw.items()}
    scores = {}
    for i, d in docs.items():
        tf = Counter(d)
        scores[i] = sum(
            idf.get(w, 0) * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * lengths[i] / mean))
            for w in query if tf[w]
        )
    return scores


def best(scores, k, allowed=lambda i: True):
    rows = [(-round(v, 9), i) for i, v in scores.items() if allowed(i)]
    return [(i, -v) for v, i in sorted(rows)[:k]]


def make_docs(seed, n=60, longest=30):
    rng = random.Random(seed)
    docs = {i: [rng.choice(WORDS[: rng.randint(1, 40)]) for _ in range(rng.randint(0, longest))]
            for i in range(n)}
    for i in range(0, n, 3):  # one word in a third of all documents
        docs[i].append("hot")
    return docs


def make_corpus(spark, docs):
    rows = [(i, " ".join(d), f"title {i // 2}", i % 2 == 0) for i, d in docs.items()]
    return spark.createDataFrame(rows, "doc_id long, abstract string, title string, flag boolean")


@pytest.fixture(scope="module")
def docs():
    return make_docs(1)


@pytest.fixture(scope="module")
def corpus(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus") / "c")
    make_corpus(spark, docs).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def index(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    build_index(corpus, path, buckets=4, flags=["flag"])
    return load_index(spark, path)


def pairs(hits):
    return [(r["doc_id"], pytest.approx(r["score"], abs=1e-9)) for r in hits.collect()]


@pytest.mark.parametrize("query", ["w1 w2 w2 hot", "w39", "nothing here", "", "HOT, w3/w4!"])
def test_scores_and_top_k(corpus, index, docs, query):
    words = query.lower().replace(",", "").replace("/", " ").replace("!", "").split()
    expected = okapi(docs, words)
    scores = {r["doc_id"]: r["score"] for r in s.bm25_scores(index, corpus, query).collect()}
    assert scores == pytest.approx(expected, abs=1e-9)
    assert pairs(s.search_topk(index, corpus, query, 7)) == best(expected, 7)
    flagged = best(expected, 7, lambda i: i % 2 == 0)
    assert pairs(s.search_topk(index, corpus, query, 7, "flag")) == flagged
    renamed = corpus.withColumnRenamed("flag", "not_in_the_index")
    assert pairs(s.search_topk(index, renamed, query, 7, "not_in_the_index")) == flagged


@pytest.fixture(scope="module")
def blocked(spark, tmp_path_factory):
    """A corpus in which one word is frequent and one rare, with blocks of eight postings."""
    from papyra.plans import index as plan

    rng = random.Random(4)
    docs = {i: [f"x{rng.randint(0, 300)}" for _ in range(rng.randint(1, 40))] for i in range(900)}
    for i in range(0, 900, 3):
        docs[i] += ["often"] * rng.randint(1, 3)
    for i in range(5, 900, 70):
        docs[i] += ["seldom", "often"][: rng.randint(1, 2)] * rng.randint(1, 2)
    path = tmp_path_factory.mktemp("blocked")
    corpus = make_corpus(spark, docs)
    corpus.write.parquet(f"{path}/c")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(plan, "BLOCK_BITS", 3)
        index = build_index(spark.read.parquet(f"{path}/c"), f"{path}/i", buckets=2, flags=["flag"])
    return docs, spark.read.parquet(f"{path}/c"), index


def test_terms_are_counted_from_blocks(blocked):
    """The many postings are aggregated once, for the blocks; terms follow from these."""
    docs, _, index = blocked
    df = Counter(word for words in docs.values() for word in set(words))
    cf = Counter(word for words in docs.values() for word in words)
    for terms in (index.terms, bm25_terms(index.blocks, len(docs))):
        assert {(r["term"], r["df"], r["cf"]) for r in terms.collect()} == {(w, df[w], cf[w]) for w in cf}


@pytest.mark.parametrize("query, k, pushed", [
    ("often seldom", 5, 1000), ("often", 3, 2), ("seldom", 40, 1000), ("often x1 x2 seldom", 4, 2), ("x7 x8 x9", 500, 1000),
])
def test_skipped_blocks_change_no_hit(blocked, query, k, pushed, monkeypatch):
    docs, corpus, index = blocked
    monkeypatch.setattr(s, "PUSHED_IDS", pushed)
    expected = okapi(docs, query.split())
    assert pairs(s.search_topk(index, corpus, query, k)) == best(expected, k)
    assert pairs(s.search_topk(index, corpus, query, k, "flag")) == best(expected, k, lambda i: i % 2 == 0)


def test_few_postings_of_a_frequent_word_are_read_beside_a_rare_one(blocked):
    _, _, index = blocked
    words = s.query_words(index, "often seldom")
    needed, reached = s.needed_blocks(index, words, s.score_parts(index, words), 5)
    count = lambda df: df.agg(F.sum("n")).first()[0]
    assert reached > 0
    assert count(s.bounded_blocks(index, words)) == index.postings.filter("term in ('often', 'seldom')").count()
    assert count(needed) < count(s.bounded_blocks(index, words)) / 4
    bounds = s.bounded_blocks(index, words).select("term", "block", "bound")
    above = s.score_parts(index, words).join(bounds, ["term", "block"]).filter("part > bound + 1e-12")
    assert above.count() == 0


def test_search_keeps_the_best_of_each_title(corpus, index, docs):
    expected, titles = [], set()
    for i, score in best(okapi(docs, ["hot", "w1"]), 12):
        if i // 2 not in titles:
            titles.add(i // 2)
            expected.append((i, f"title {i // 2}", round(score, 1)))
    rows = s.search(index, corpus, "hot w1", 12).collect()
    assert [(r["doc_id"], r["title"]) for r in rows] == [e[:2] for e in expected]
    assert [r["score"] for r in rows] == pytest.approx([e[2] for e in expected], abs=0.051)
    assert len(rows) <= 12


def test_search_without_matches_lists_the_lowest_ids(corpus, index):
    rows = s.search(index, corpus, "nothing", 4).collect()
    assert [(r["doc_id"], r["score"]) for r in rows] == [(0, 0.0), (2, 0.0)]


def test_large_results_are_joined(corpus, index, docs, monkeypatch):
    expected = s.search(index, corpus, "hot w1", 12).collect()
    monkeypatch.setattr(s, "PUSHED_IDS", 3)
    assert s.search(index, corpus, "hot w1", 12).collect() == expected
    monkeypatch.setattr(s, "can_broadcast", lambda df: False)
    assert s.search(index, corpus, "hot w1", 12).collect() == expected


@pytest.mark.parametrize("small", [True, False])
def test_batch_equals_single_searches(spark, corpus, index, docs, small, monkeypatch):
    monkeypatch.setattr(s, "can_broadcast", lambda df: small)
    texts = {1: "hot w1 w1", 2: "w5 w6 w7", 3: "", 4: "unseen", 5: "hot"}
    queries = spark.createDataFrame(list(texts.items()), "qid long, text string")
    rows = s.batch_topk(index, corpus, queries, 6).orderBy("qid", "rank").collect()
    for qid, text in texts.items():
        got = [(r["doc_id"], pytest.approx(r["score"], abs=1e-9)) for r in rows if r["qid"] == qid]
        assert got == best(okapi(docs, text.split()), 6)
    flagged = s.batch_topk(index, corpus, queries, 6, "flag").collect()
    assert all(r["doc_id"] % 2 == 0 for r in flagged) and len(flagged) == 30
    renamed = corpus.withColumnRenamed("flag", "other")
    assert sorted(s.batch_topk(index, renamed, queries, 6, "other").collect()) == sorted(flagged)
    listed = s.search_batch(index, corpus, queries, 6).collect()
    for qid, text in texts.items():
        single = s.search(index, corpus, text, 6).select("doc_id", "score").collect()
        mine = sorted((r["rank"], r["doc_id"], r["score"]) for r in listed if r["qid"] == qid)
        assert [m[1:] for m in mine] == [tuple(r) for r in single]


@pytest.mark.parametrize("rows", [20, 3])
def test_every_block_of_queries_is_measured(spark, corpus, index, docs, rows, monkeypatch):
    """Blocks are as small as asked for, and queries without known words are in none."""
    seen, measured = [], lambda df: df.count() <= rows
    block = s._block_topk
    monkeypatch.setattr(s, "can_broadcast", measured)
    monkeypatch.setattr(s, "_block_topk", lambda documents, weights, *rest: (
        seen.append([(r["qid"], r["term"]) for r in weights.collect()]), block(documents, weights, *rest)
    )[1])
    texts = {f"q{i}": f"w{i} w{i + 1}" for i in range(8)} | {f"u{i}": "unseen" for i in range(50)} | {None: "none"}
    queries = spark.createDataFrame(list(texts.items()), "qid string, text string")
    found = s.batch_topk(index, corpus, queries, 4).collect()
    assert all(len(part) <= rows for part in seen) and {q for part in seen for q, _ in part} == {f"q{i}" for i in range(8)}
    for qid, text in texts.items():
        got = sorted((r["rank"], r["doc_id"], r["score"]) for r in found if r["qid"] == qid)
        assert [(d, pytest.approx(x, abs=1e-9)) for _, d, x in got] == best(okapi(docs, text.split()), 4)


def test_batch_without_known_words_or_queries(spark, corpus, index):
    queries = spark.createDataFrame([(1, "unseen"), (2, None)], "qid long, text string")
    found = s.batch_topk(index, corpus, queries, 3).collect()
    assert sorted((r["qid"], r["rank"], r["score"]) for r in found) == [(q, k, 0.0) for q in (1, 2) for k in (1, 2, 3)]
    assert s.batch_topk(index, corpus, queries.limit(0), 3).collect() == []


@pytest.mark.parametrize("ids", [[7, 8, 9, 4, 5, 6, 1, 2, 3], [1, 2, 3, 4, 5, 6, 7, 8, 9], list("gihfdeabc")])
def test_zeros_of_later_batches_have_lower_ids(ids):
    ids_of = s.pa.array(ids)
    best = s._Best(3, 3)
    for start in (0, 3, 6):
        # The second document of each batch matches query 2, that of the second batch query 0.
        hits = [0, 2] if start == 3 else [2]
        best.add(ids_of.slice(start, 3), s.np.array([1] * len(hits)), s.np.array(hits), s.np.array([2.0] * len(hits)))
    found = [(r["query"], r["doc_id"], r["score"]) for r in best.table.to_pylist()]
    hit, low = ids[4], sorted(ids)
    assert [r[1:] for r in found if r[0] == 0] == [(hit, 2.0)] + [(i, 0.0) for i in low if i != hit][:2]
    assert [r[1:] for r in found if r[0] == 1] == [(i, 0.0) for i in low[:3]]
    assert [r[1:] for r in found if r[0] == 2] == [(i, 2.0) for i in sorted(ids[1::3])]


def test_batch_over_small_arrow_batches_in_descending_order(spark, corpus, index, docs):
    import dataclasses

    turned = dataclasses.replace(index, documents=index.documents.coalesce(1).sortWithinPartitions(F.desc("doc_id")))
    texts = {1: "unseen", 2: "w39", 3: "hot w1"}
    queries = spark.createDataFrame(list(texts.items()), "qid long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = s.batch_topk(turned, corpus, queries, 12).orderBy("qid", "rank").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for qid, text in texts.items():
        got = [(r["doc_id"], pytest.approx(r["score"], abs=1e-9)) for r in rows if r["qid"] == qid]
        assert got == best(okapi(docs, text.split()), 12)


def test_negative_weights(spark, tmp_path):
    """Words in most documents can make scores negative, which then rank below zero."""
    docs = {0: ["aa", "bb"], 1: ["aa", "bb", "bb"], 2: ["aa"], 3: ["aa", "cc"], 4: ["cc", "bb"],
            5: ["cc", "aa"], 6: []}
    corpus = make_corpus(spark, docs)
    index = build_index(corpus, str(tmp_path / "i"), buckets=2)
    assert index.stats.first()["mean_idf"] < 0
    expected = okapi(docs, ["aa", "bb"])
    assert min(expected.values()) < 0
    assert pairs(s.search_topk(index, corpus, "aa bb", 4)) == best(expected, 4)
    rows = [(1, "aa bb"), (2, "cc")]
    queries = spark.createDataFrame(rows, "qid long, text string")
    hits = s.batch_topk(index, corpus, queries, 4).filter("qid = 1").orderBy("rank")
    assert pairs(hits) == best(expected, 4)


def test_corpus_without_tokens(spark, tmp_path):
    corpus = make_corpus(spark, {0: [], 1: ["--"], 2: ["the"]})
    index = build_index(corpus, str(tmp_path / "i"), buckets=2)
    assert index.stats.select("n", "avgdl", "mean_idf").first() == (3, 0.0, None)
    assert pairs(s.search_topk(index, corpus, "any word")) == [(0, 0), (1, 0), (2, 0)]


def test_text_ids_and_own_stop_words(spark, tmp_path):
    rows = [("b", "alpha the"), ("a", "alpha the"), ("c", "gamma the the"),
            ("d", "delta"), ("e", "delta one more"), ("f", "")]
    corpus = spark.createDataFrame(rows, "doc_id string, abstract string")
    build_index(corpus, str(tmp_path / "i"), stop_words=["gamma"], buckets=2)
    index = load_index(spark, str(tmp_path / "i"))
    assert index.stop_words == ("gamma",)
    assert index.postings.filter("term = 'gamma'").count() == 0
    assert s.search_topk(index, corpus, "alpha", 3).first()["doc_id"] == "a"


def test_hot_word_is_stored_in_its_own_folder(index):
    hot = index.postings.filter("term = 'hot'").select("bucket").distinct().collect()
    assert len(hot) == 1
    assert index.postings.filter("term = 'hot'").agg(F.sum("tf")).first()[0] == 20


def test_hot_bucket_is_split(spark, corpus, tmp_path, monkeypatch):
    """A large bucket is cut into files of term ranges, which meet at one term at most."""
    from papyra.sources import sizes

    monkeypatch.setattr(sizes, "TEXT_PARTITION_BYTES", 25)
    index = build_index(corpus, str(tmp_path / "i"), buckets=1)
    files = index.postings.groupBy(F.input_file_name()).agg(F.min("term"), F.max("term")).collect()
    ranges = sorted(tuple(f)[1:] for f in files)
    assert len(ranges) > 10
    assert all(left[1] <= right[0] for left, right in zip(ranges, ranges[1:]))
    hot = index.postings.filter("term = 'hot'")
    assert hot.count() == 20 and hot.select(F.input_file_name()).distinct().count() > 1


def test_a_build_that_breaks_off_leaves_the_last_index(spark, corpus, tmp_path, monkeypatch):
    from papyra.plans import index as plan

    build_index(corpus, str(tmp_path / "i"), buckets=2)
    monkeypatch.setattr(plan, "bm25_stats", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build_index(corpus.limit(3), str(tmp_path / "i"), buckets=2)
    monkeypatch.undo()
    assert load_index(spark, str(tmp_path / "i")).stats.first()["n"] == 60
    build_index(corpus.limit(3), str(tmp_path / "i"), buckets=2)
    assert load_index(spark, str(tmp_path / "i")).stats.first()["n"] == 3


def test_broadcast_is_measured(spark, monkeypatch):
    from papyra.sources import sizes

    df = spark.range(10).selectExpr("id", "repeat('x', 100) AS term")
    assert sizes.can_broadcast(df)
    monkeypatch.setattr(sizes, "BROADCAST_TEXT_BYTES", 999)
    assert not sizes.can_broadcast(df)
    monkeypatch.setattr(sizes, "BROADCAST_ROWS", 9)
    assert not sizes.can_broadcast(df.select("id"))


def test_batch_scores_documents_in_bounded_slices(index, corpus, spark, monkeypatch):
    """Few at a time, and whatever the slices are, the same hits come out."""
    queries = spark.createDataFrame(
        [(1, "often seldom"), (2, "often"), (3, "seldom"), (4, "unheard")], "qid long, text string"
    )
    whole = sorted(s.batch_topk(index, corpus, queries, 4).collect())
    for size in (1, 7, 40):
        monkeypatch.setattr(s, "SLICE_ENTRIES", size)
        assert sorted(s.batch_topk(index, corpus, queries, 4).collect()) == whole
