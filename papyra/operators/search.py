"""Ranked keyword search over a BM25 index."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from papyra.functions import fixed_values as fixed
from papyra.functions.text import tokenize
from papyra.operators.bm25 import Bm25Index, bm25_idf, term_bucket, term_score
from papyra.sources.scratch import scratch_path
from papyra.sources.sizes import can_broadcast

# So many ids at most are pushed to a scan; the join after it is the same for any number.
PUSHED_IDS = 1_000
# Sums of doubles depend on the order of addition. Scores are ranked to this many decimals, so
# that equal ones stay equal and the tie goes to the lower id.
RANK_DECIMALS = 9
# Bounds and scores that differ by less than rounding may are taken for equal.
SLACK = 1e-6
# In batch search, the documents that a task scores at once have so many words of queries, each counted
# once for a query, and so many pairs with a query; or they are one.
SLICE_ENTRIES = 1_000_000


def query_terms(queries: DataFrame, index: Bm25Index) -> DataFrame:
    """``(qid, bucket, term, repeats)`` for ``queries(qid, text)``: a repeated word counts."""
    terms = queries.select("qid", F.explode(tokenize("text", index.stop_words)).alias("term"))
    counted = terms.groupBy("qid", "term").agg(F.count("*").alias("repeats"))
    return counted.withColumn("bucket", term_bucket("term", index.buckets))


def query_weights(index: Bm25Index, wanted: DataFrame, terms: DataFrame) -> DataFrame:
    """``(qid, bucket, term, weight)`` of the query terms that the index holds."""
    wanted = F.broadcast(wanted) if can_broadcast(wanted) else wanted
    return bm25_idf(terms, index.stats).join(wanted, ["bucket", "term"]).select(
        "qid", "bucket", "term", (F.col("idf") * F.col("repeats")).alias("weight")
    )


def query_words(index: Bm25Index, query_text: str) -> DataFrame:
    """``(bucket, term, weight)`` of the words of one query text that the index holds.

    The words are known before planning and go into the filters of the index tables: the bucket
    picks the folders and the term the files and row groups, which lie in the order of terms.
    """
    spark = index.stats.sparkSession
    query = spark.range(1).select(F.lit(0).alias("qid"), F.lit(query_text).alias("text"))
    wanted = query_terms(query, index)
    rows = wanted.collect()  # the words of one query text
    terms = index.terms.filter(_among(rows))
    found = query_weights(index, spark.createDataFrame(rows, wanted.schema), terms).drop("qid")
    return spark.createDataFrame(found.collect(), found.schema)


def _among(words: Sequence[Row]) -> Column:
    """Whether a row of an index table is about one of these words."""
    return F.col("bucket").isin(sorted({r["bucket"] for r in words})) & F.col("term").isin(
        sorted(r["term"] for r in words)
    )


def score_parts(index: Bm25Index, words: DataFrame, flag: str | None = None) -> DataFrame:
    """``(bucket, term, block, doc_id, part)``: what each word adds to the score of each document.

    A ``flag`` kept in the index is a filter as well.
    """
    postings = index.postings.filter(_among(words.collect()))
    if flag is not None:
        postings = postings.filter(F.col(flag))
    avgdl = index.stats.select("avgdl").scalar()
    part = term_score(F.col("weight"), F.col("tf"), F.col("dl"), avgdl)
    return postings.join(F.broadcast(words), ["bucket", "term"]).select(
        "bucket", "term", "block", "doc_id", part.alias("part")
    )


def _scores(parts: DataFrame) -> DataFrame:
    score = F.round(F.sum("part"), RANK_DECIMALS)
    return parts.groupBy("doc_id").agg(score.alias("score"))


def bm25_scores(index: Bm25Index, corpus: DataFrame, query_text: str) -> DataFrame:
    """``(doc_id, score)`` of every document, zeros included."""
    zeros = corpus.select("doc_id", F.lit(0.0).alias("part"))
    return _scores(score_parts(index, query_words(index, query_text)).select("doc_id", "part").unionByName(zeros))


def best_first() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc()]


def search_topk(
    index: Bm25Index,
    corpus: DataFrame,
    query_text: str,
    num_results: int = fixed.NUM_RESULTS,
    flag: str | None = None,
) -> DataFrame:
    """``(doc_id, score)`` of the best documents; ties go to the lower id.

    There are ``num_results`` rows even when fewer documents match: the rest score zero, and only
    then is the corpus read for ids. With ``flag``, a boolean column of ``corpus``, only flagged
    documents are listed; term weights remain those of the whole corpus. A flag that the index
    keeps is filtered there.

    Postings are read by blocks. The ``num_results`` blocks with the highest bounds give a score that
    the last hit reaches at least; a block is skipped if, with the best of all other words added,
    none of its documents can reach it. What a skipped block adds to the score of a document found
    elsewhere is looked up for those documents that can still be hits.
    """
    stored_flag = flag if flag in index.flags else None
    ids = corpus.filter(F.col(flag)) if flag is not None else corpus
    ids = ids.select("doc_id")
    words = query_words(index, query_text)
    parts = score_parts(index, words, stored_flag)
    if flag is not None and stored_flag is None:
        parts = parts.join(ids, "doc_id", "left_semi")
    scored = _scores(_hopeful_parts(index, words, parts, num_results))
    best = scored.filter(F.col("score") > 0).orderBy(*best_first()).limit(num_results)
    rows = best.collect()  # no more than the hits asked for
    if len(rows) < num_results:
        # So few matches that no block was skipped: all that match are scored.
        zeros = ids.join(scored, "doc_id", "left_anti").orderBy("doc_id").limit(num_results)
        zeros = zeros.select("doc_id", F.lit(0.0).alias("score"))
        best = scored.unionByName(zeros).orderBy(*best_first()).limit(num_results)
        rows = best.collect()
    return corpus.sparkSession.createDataFrame(rows, best.schema)


def bounded_blocks(index: Bm25Index, words: DataFrame) -> DataFrame:
    """``(bucket, term, block, n, bound)``: the most that a posting of each block adds to a score."""
    avgdl = index.stats.select("avgdl").scalar()
    bound = term_score(F.col("weight"), F.col("max_tf"), F.col("min_dl"), avgdl)
    blocks = index.blocks.filter(_among(words.collect())).join(F.broadcast(words), ["bucket", "term"])
    return blocks.select("bucket", "term", "block", "n", F.greatest(bound, F.lit(0.0)).alias("bound"))


def needed_blocks(index: Bm25Index, words: DataFrame, parts: DataFrame, num_results: int) -> tuple[DataFrame, float]:
    """The blocks in which hits must be looked for, and a score that the last hit reaches at least.

    Words are put in order of their highest bound, ``most``. A document's score is at most the bound
    of the block with its first word and ``most`` of the words after that one; the block is needed
    if this reaches the score of the last hit. While fewer than ``num_results`` documents are known
    to score, that is 0 and all blocks are needed.
    """
    blocks = bounded_blocks(index, words)
    first = blocks.orderBy(F.desc("bound"), "term", "block").limit(num_results).collect()
    # As many rows as hits are asked for.
    first = index.stats.sparkSession.createDataFrame(first, blocks.schema)
    begun = _in_blocks(parts, first).groupBy("doc_id").agg(F.sum("part").alias("score")).filter(
        F.col("score") > 0
    ).orderBy(F.desc("score")).limit(num_results).collect()
    reached = begun[-1]["score"] if len(begun) == num_results else 0.0
    # A row per word of the query.
    most = blocks.groupBy("term").agg(F.max("bound").alias("most")).orderBy("most", "term").collect()
    rest, after = [], 0.0
    for word in most:
        rest.append((word["term"], word["most"], after))
        after += word["most"]
    rest = index.stats.sparkSession.createDataFrame(rest, "term string, most double, after double")
    blocks = blocks.join(F.broadcast(rest), "term").withColumn("all_most", F.lit(after))
    return blocks.filter(F.col("bound") + F.col("after") >= reached - SLACK).drop("after"), reached


def _in_blocks(parts: DataFrame, blocks: DataFrame) -> DataFrame:
    """``parts`` of ``blocks``, with the other columns of these; so few that they can be are pushed to the scan."""
    numbers = blocks.select("block").distinct().limit(PUSHED_IDS + 1).collect()
    if len(numbers) <= PUSHED_IDS:
        parts = parts.filter(_any_of("block", sorted(r["block"] for r in numbers)))
        blocks = F.broadcast(blocks)  # At most that number, for each word of a query.
    return parts.join(blocks.drop("n", "bound"), ["bucket", "term", "block"])


def _hopeful_parts(index: Bm25Index, words: DataFrame, parts: DataFrame, num_results: int) -> DataFrame:
    """All parts of every document that may be among the best; others may be missing."""
    if any(word["weight"] < 0 for word in words.collect()):
        return parts  # A part may lower a score, so no score is reached before all parts are known.
    needed, reached = needed_blocks(index, words, parts, num_results)
    if not reached:
        return parts
    # What words without a needed block would add at most is still open for a document.
    limit = F.sum("part") + F.first("all_most") - F.sum("most")
    seen = _in_blocks(parts, needed).groupBy("doc_id").agg(limit.alias("limit"))
    candidates = seen.filter(F.col("limit") >= reached - SLACK).select("doc_id")
    few = candidates.limit(PUSHED_IDS + 1).collect()
    if len(few) <= PUSHED_IDS:
        return parts.filter(_any_of("doc_id", sorted(r["doc_id"] for r in few)))
    return parts.join(candidates, "doc_id", "left_semi")


def batch_topk(
    index: Bm25Index,
    corpus: DataFrame,
    queries: DataFrame,
    num_results: int = fixed.NUM_RESULTS,
    flag: str | None = None,
) -> DataFrame:
    """``(qid, rank, doc_id, score)``: ``search_topk`` for each row of ``queries(qid, text)``.

    The index keeps each document's terms in one row, so a document's score for every query is
    added up where the row is read, zeros included, and each task sends on its best
    ``num_results`` per query: no pair of query and document crosses the network. The weights of
    the query terms, with the ids of their queries, go to all tasks; so many that they have not
    been measured to be small are worked through in parts, each of which has, or is one query. Queries without a
    word that the index holds need no document read: they get the lowest ids.
    """
    spark, path = corpus.sparkSession, scratch_path(corpus.sparkSession, "weights")
    query_weights(index, query_terms(queries, index), index.terms).select("qid", "term", "weight").write.parquet(path)
    weights = spark.read.parquet(path)
    known = weights.select(F.col("qid").alias("_known")).distinct()
    blocks = 1

    def part_of(block: int) -> DataFrame:
        return weights.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == block)

    def divisible(part: DataFrame) -> bool:
        return not can_broadcast(part) and len(part.select("qid").distinct().limit(2).collect()) > 1

    while any(divisible(part_of(block)) for block in range(blocks)):
        blocks *= 2
    documents = index.documents
    if flag in index.flags:
        documents = documents.filter(F.col(flag))
    elif flag is not None:
        documents = documents.join(corpus.filter(F.col(flag)).select("doc_id"), "doc_id", "left_semi")
    avgdl = index.stats.first()["avgdl"]
    # No more rows than the hits asked for.
    lowest = [r["doc_id"] for r in documents.select("doc_id").orderBy("doc_id").limit(num_results).collect()]
    lowest = F.array(*map(F.lit, lowest)).cast(ArrayType(documents.schema["doc_id"].dataType))
    best = queries.select("qid").distinct().join(known, F.col("qid").eqNullSafe(F.col("_known")), "left_anti").select(
        "qid", F.explode(lowest).alias("doc_id"), F.lit(0.0).alias("score")
    )
    for block in range(blocks):
        if not part_of(block).isEmpty():
            best = best.unionByName(_block_topk(documents, part_of(block), avgdl, num_results))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(*best_first()))
    return best.withColumn("rank", rank).filter(F.col("rank") <= num_results).select(
        "qid", "rank", "doc_id", "score"
    )


def _block_topk(documents: DataFrame, weights: DataFrame, avgdl: float, num_results: int) -> DataFrame:
    """The best of each task's documents for each query; what is collected was measured."""
    kinds = {f.name: f.dataType.simpleString() for f in weights.schema} | {
        f.name: f.dataType.simpleString() for f in documents.schema
    }
    found = weights.orderBy("term", "qid").toArrow().combine_chunks()
    names = pc.unique(found["qid"])
    terms, first = np.unique(found["term"].to_numpy().astype(object), return_index=True)
    query = pc.index_in(found["qid"], value_set=names).to_numpy().astype(np.int64)
    weight = found["weight"].to_numpy()
    bounds = np.append(first, len(found))

    repeats = np.diff(bounds)
    known_terms = pa.array(terms, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(names), num_results)
        for batch in batches:
            lists = batch.column(2)
            place = pc.fill_null(pc.index_in(lists.flatten().field(0), value_set=known_terms), -1).to_numpy()
            tf = lists.flatten().field(1).to_numpy()
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            # What the documents up to each add to scores: a value for each query with the word.
            entries = np.append(0, np.cumsum(np.where(place < 0, 0, repeats[place])))[ends]
            start = 0
            while start < len(batch):
                before = entries[start - 1] if start else 0
                end = int(np.searchsorted(entries, before + SLICE_ENTRIES, side="right"))
                end = max(min(end, start + SLICE_ENTRIES // len(names)), start + 1)
                inside = slice(ends[start - 1] if start else 0, ends[end - 1])
                sizes = np.diff(ends[start:end], prepend=inside.start)
                part = batch.slice(start, end - start)
                best.add(part.column(0), *scores(part.column(1).to_numpy(), sizes, place[inside], tf[inside]))
                start = end
        yield from best.batches(names)

    def scores(dl: np.ndarray, sizes: np.ndarray, place: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows, queries and scores of the documents of a slice that have words of a query."""
        known = np.flatnonzero(place >= 0)
        term, row = place[known], np.repeat(np.arange(len(dl)), sizes)[known]
        count = repeats[term]
        entry = np.repeat(bounds[term] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        of = np.repeat(np.arange(len(term)), count)
        part = term_score(weight[entry], tf[known].astype(np.float64)[of], dl[row][of], avgdl)
        pair = row[of] * len(names) + query[entry]
        cells = len(dl) * len(names)
        total = np.round(np.bincount(pair, part, cells), RANK_DECIMALS)
        found = np.bincount(pair, minlength=cells) > 0
        if len(dl) > num_results:
            # Where enough documents of the slice match, only those that reach the last of them count.
            table = total.reshape(len(dl), len(names))
            least = np.partition(table, len(dl) - num_results, axis=0)[len(dl) - num_results]
            found &= ((table >= least) | (least <= 0)).ravel()
        at = np.flatnonzero(found)
        return at // len(names), at % len(names), total[at]

    schema = f"qid {kinds['qid']}, doc_id {kinds['doc_id']}, score double"
    return documents.select("doc_id", "dl", "terms").mapInArrow(run, schema)


class _Best:
    """The best documents of one task for each query."""

    def __init__(self, queries: int, num_results: int):
        self.queries, self.num_results, self.table = queries, num_results, None

    def add(self, ids: pa.Array, row: np.ndarray, query: np.ndarray, score: np.ndarray) -> None:
        """Take the matches of a batch of documents, and its zeros where matches are few."""
        order = pc.sort_indices(ids).to_numpy().astype(np.int64)
        # The zeros of this batch add nothing where the last row kept is a match, or a zero of a lower id.
        full = np.zeros(self.queries, dtype=bool)
        if self.table is not None:
            of, kept = self.table["query"].to_numpy(), self.table["score"].to_numpy()
            last = np.arange(len(of)) - np.searchsorted(of, of) == self.num_results - 1
            lower = pc.fill_null(pc.less(self.table["doc_id"], pc.min(ids)), False).to_numpy()
            full[of[last & ((kept > 0) | (kept == 0) & lower)]] = True
            # Matches below the last row kept cannot be among the best.
            least = np.full(self.queries, -np.inf)
            least[of[last & (kept > 0)]] = kept[last & (kept > 0)]
            hopeful = score >= least[query]
            row, query, score = row[hopeful], query[hopeful], score[hopeful]
        by_query = np.argsort(query, kind="stable")
        rows_of = row[by_query]
        starts = np.searchsorted(query[by_query], np.arange(self.queries + 1))
        more_row, more_query = [row], [query]
        for short in np.flatnonzero(~full):
            matched = np.zeros(len(ids), dtype=bool)
            matched[rows_of[starts[short] : starts[short + 1]]] = True
            zeros = order[~matched[order]][: self.num_results]
            more_row.append(zeros)
            more_query.append(np.full(len(zeros), short))
        rows, queries = np.concatenate(more_row), np.concatenate(more_query)
        scores = np.concatenate((score, np.zeros(len(rows) - len(score))))
        fresh = pa.table({"query": queries, "score": scores, "doc_id": ids.take(pa.array(rows))})
        table = fresh if self.table is None else pa.concat_tables([self.table, fresh])
        ranked = table.take(pc.sort_indices(
            table, sort_keys=[("query", "ascending"), ("score", "descending"), ("doc_id", "ascending")]
        ))
        of = ranked["query"].to_numpy()
        place = np.arange(len(of)) - np.searchsorted(of, of)
        self.table = ranked.take(pa.array(np.flatnonzero(place < self.num_results))).combine_chunks()

    def batches(self, names: pa.Array) -> Iterator[pa.RecordBatch]:
        if self.table is not None and len(self.table):
            found = pa.table({
                "qid": names.take(self.table["query"].combine_chunks()),
                "doc_id": self.table["doc_id"], "score": self.table["score"],
            })
            yield from found.to_batches(max_chunksize=10_000)


def distinct_titles(hits: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The best hit of each title (per ``keys``) among the few rows that a top k has left."""
    place = F.row_number().over(Window.partitionBy(*keys, "title").orderBy(*best_first()))
    return hits.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def attach_documents(hits: DataFrame, corpus: DataFrame) -> DataFrame:
    """Add document columns to hits, which are read twice.

    The ids of up to ``PUSHED_IDS`` hits also go to the scan as equalities, which skip the files
    and row groups without them: nearly all, when the table was stored by id (``write_by_id``).
    """
    rows = hits.select("doc_id").distinct().limit(PUSHED_IDS + 1).collect()
    if len(rows) <= PUSHED_IDS:
        corpus = corpus.filter(_any_of("doc_id", sorted(r["doc_id"] for r in rows)))
    return corpus.join(F.broadcast(hits) if can_broadcast(hits) else hits, "doc_id")


def _any_of(column: str, values: list) -> Column:
    """Equalities in a balanced tree: unlike a long IN list, all scans take them as they are."""
    if len(values) <= 1:
        return F.col(column) == values[0] if values else F.lit(False)
    half = len(values) // 2
    return _any_of(column, values[:half]) | _any_of(column, values[half:])


def search(
    index: Bm25Index,
    corpus: DataFrame,
    query_text: str,
    num_results: int = fixed.NUM_RESULTS,
    flag: str | None = None,
) -> DataFrame:
    """The best hits with their document columns and ``score`` to one decimal, best first.

    Titles are made distinct after the limit, so fewer than ``num_results`` may come back.
    """
    hits = search_topk(index, corpus, query_text, num_results, flag)
    listed = distinct_titles(attach_documents(hits, corpus)).orderBy(*best_first())
    return listed.withColumn("score", F.bround("score", 1))


def search_batch(
    index: Bm25Index,
    corpus: DataFrame,
    queries: DataFrame,
    num_results: int = fixed.NUM_RESULTS,
    flag: str | None = None,
    hits_path: str | None = None,
) -> DataFrame:
    """``search`` for each row of ``queries(qid, text)``, with the ``rank`` of each hit.

    The hits (ids and scores) are first stored in ``hits_path``, or in a scratch folder.
    """
    spark = corpus.sparkSession
    hits_path = hits_path or scratch_path(spark, "hits")
    batch_topk(index, corpus, queries, num_results, flag).write.mode("overwrite").parquet(hits_path)
    hits = attach_documents(spark.read.parquet(hits_path), corpus)
    return distinct_titles(hits, ["qid"]).withColumn("score", F.bround("score", 1))
