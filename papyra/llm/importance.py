"""Importance resampling of a corpus towards a target, by bit-sliced sums of bucket gains."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from papyra.llm.batches import text_slices
from papyra.llm.stored import stored

BUCKETS = 10_000
MIN_WORDS = 20
# Bytes of runs of characters other than [^\x00-\x2F\x3A-\x60\x7B-\x7F], after A-Z are lower-cased.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# Documents whose bit planes are held at a time, and features whose buckets a task remembers.
_PLANE_ROWS = 512
_REMEMBERED = 500_000
_POSITION_BITS = 33


class _Buckets(dict):
    """Bucket of each feature, worked out when it is first met."""

    def __init__(self, buckets: int):
        super().__init__()
        self._buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        self[feature] = found = crc32(feature) % self._buckets
        return found


def _features(text: str | None, max_words: int) -> tuple[int, list[bytes]]:
    """Number of words, and all runs of up to ``max_words`` words."""
    words = _WORD.findall((text or "").encode().lower())
    found = list(words)
    for size in range(2, max_words + 1):
        found += map(b" ".join, zip(*(words[place:] for place in range(size))))
    return len(words), found


def _bucket_arrays(texts: Sequence[str | None], known: _Buckets, max_words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    n_words, arrays = np.zeros(len(texts), dtype=np.int64), []
    for place, text in enumerate(texts):
        n_words[place], found = _features(text, max_words)
        arrays.append(np.fromiter(map(known.__getitem__, found), dtype=np.int64, count=len(found)))
    return n_words, arrays


def bucket_counts(
    texts: DataFrame, text_col: str = "text", max_words: int = 1, buckets: int = BUCKETS
) -> DataFrame:
    """``bucket, n``: features of all whole texts by hash bucket; empty buckets are left out.

    Each task sums up its rows first, so that it sends on one row for each bucket at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets, dtype=np.int64)
        for part in text_slices(batches, 0):
            for found in _bucket_arrays(part.column(0).to_pylist(), known, max_words)[1]:
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    given = texts.select(F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(
    docs: DataFrame, target: DataFrame, text_col: str = "text", target_text_col: str = "text",
    max_words: int = 1, buckets: int = BUCKETS,
) -> np.ndarray:
    """For each bucket, a thousand times the log of its smoothed share in the target over that in ``docs``.

    Rounded down to whole numbers. What reaches the driver is one count for each bucket and side.
    """

    def counts(texts: DataFrame, column: str) -> np.ndarray:
        n = np.zeros(buckets)
        for row in bucket_counts(texts, column, max_words, buckets).collect():
            n[row["bucket"]] = row["n"]
        return n

    s, t = counts(docs, text_col), counts(target, target_text_col)
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def gain_planes(gains: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """``(factor, bits)``: two's-complement bit planes of whole numbers, as 64-bit words.

    A number is the sum of the factors of the planes in which its bit is set; the last plane, the
    sign, has a negative factor.
    """
    size = 1
    while gains.size and (gains.min() < -(1 << size - 1) or gains.max() >= 1 << size - 1):
        size += 1
    everywhere = np.arange(len(gains))
    return [
        (-(1 << bit) if bit == size - 1 else 1 << bit, _bit_rows(everywhere[gains >> bit & 1 == 1], 1, len(gains))[0])
        for bit in range(size)
    ]


def _bit_rows(places: np.ndarray, rows: int, width: int) -> np.ndarray:
    """Bit rows of ``width`` bits, in 64-bit words; ``places`` are the set bits, row by row, increasing."""
    words = -(-width // 64)
    planes = np.zeros(rows * words, dtype=np.uint64)
    if len(places):
        word = places // width * words + places % width // 64
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        bits = np.uint64(1) << (places % width % 64).astype(np.uint64)
        planes[word[starts]] = np.bitwise_or.reduceat(bits, starts)
    return planes.reshape(rows, words)


def bit_sliced_weights(documents: Sequence[np.ndarray], planes: Sequence[tuple[int, np.ndarray]], buckets: int) -> np.ndarray:
    """Sum of the gains of each document's buckets, repeats counted.

    Bit ``j`` of all bucket counts of a document is one row of ``buckets`` bits. The common bits of
    that row and a plane of the gains are counted; each stands for ``2**j`` times the plane's factor.
    """
    weights = np.zeros(len(documents), dtype=np.int64)
    owners = np.repeat(np.arange(len(documents)), [len(found) for found in documents])
    if not len(owners):
        return weights
    held, counts = np.unique(owners * buckets + np.concatenate(documents), return_counts=True)
    for power in range(int(counts.max()).bit_length()):
        places = held[counts >> power & 1 == 1]
        if not len(places):
            continue
        rows, dense = np.unique(places // buckets, return_inverse=True)
        counted = _bit_rows(dense * buckets + places % buckets, len(rows), buckets)
        for factor, plane in planes:
            common = np.bitwise_count(counted & plane).sum(axis=1, dtype=np.int64)
            weights[rows] += common * (factor << power)
    return weights


def weigh(
    docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_words: int = 1
) -> DataFrame:
    """``id_col, n_words, n_features, weight`` for each row of ``docs``, in the task that reads it."""
    buckets, planes = len(gains), gain_planes(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(buckets)
        for part in text_slices(batches, most_rows=_PLANE_ROWS):
            n_words, found = _bucket_arrays(part.column(1).to_pylist(), known, max_words)
            weights = bit_sliced_weights(found, planes, buckets)
            columns = (n_words, np.array([len(one) for one in found], dtype=np.int64), weights)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *map(pa.array, columns)], names=["id", "n_words", "n_features", "weight"]
            )

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = StructType([given.schema["id"]] + [StructField(n, LongType()) for n in ("n_words", "n_features", "weight")])
    return given.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    percent: int = 10, min_words: int = MIN_WORDS, seed: str = "2024", max_words: int = 1, buckets: int = BUCKETS,
) -> DataFrame:
    """``id_col, n_features, weight, score, rank, n_words``: a draw of documents that resemble ``target``.

    Features are runs of one to ``max_words`` words, dealt to ``buckets`` by a hash; a document's
    ``weight`` is the sum of its features' gains. ``score`` adds Gumbel noise that depends on seed
    and id only, so that the highest scores are a draw without replacement. Of the documents with
    ``min_words`` words, ``percent`` in a hundred (rounded down) are drawn and numbered by
    descending score, then increasing id; the ``rank`` of all others is null.

    The text is read twice, once to count and once to weigh; no text is shuffled. The order is found
    by one range shuffle of numbers, in which a row's own number ends the key: neither ties nor
    repeated ids gather in a task. Ranks are positions inside a partition after the counts of the
    partitions before it.

    Null and empty texts have no features, and weight 0. A null id counts as the empty string and
    comes last among equal scores; repeated ids are ranked each for itself, in stored order. No
    documents, no rows; an empty target has only the smoothing.
    """
    gains = bucket_gains(docs, target, text_col, target_text_col, max_words, buckets)
    weighed = weigh(docs, gains, id_col, text_col, max_words).withColumnRenamed(id_col, "id")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    hashed = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((hashed + 0.5) / 4294967296.0)))
    scored = stored(weighed.select(
        "id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score"),
        (F.col("n_words") >= min_words).alias("fit"), F.monotonically_increasing_id().alias("row"),
    ), "scored")
    drawn = percent * scored.where("fit").count() // 100
    ordered = scored.orderBy(F.desc("fit"), F.desc("score"), F.asc_nulls_last("id"), "row")
    ordered = stored(ordered.drop("row", "fit").withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", _POSITION_BITS)
    # One row for each partition of the sorted table.
    parts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))
    position = F.col("before") + F.col("at").bitwiseAND((1 << _POSITION_BITS) - 1) + 1
    return ordered.withColumn("part", part).join(F.broadcast(parts), "part").select(
        F.col("id").alias(id_col), "n_features", "weight", "score",
        F.when(position <= drawn, position).alias("rank"), "n_words",
    )
