"""Alignment of two tokenizers' encodings of the same texts by common byte ends."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from papyra.llm.batches import text_slices
from papyra.llm.bpe import rank_vocabulary
from papyra.llm.pieces import MODEL, SPACE
from papyra.llm.stored import stored

# A pair of ids as one number: the first id times this, and the second.
PAIR = 1 << 32
# Pairs with at least one link in so many count as frequent, so there are at most so many of them.
FREQUENT = 1 << 16
_SLICE_BYTES, _SLICE_ROWS = 1 << 20, 10_000
# Tokens of A after which a long document may be entered once more.
_LANE = 256
# Characters of a longer text that are encoded at a time by the piece model.
_PART = 1 << 16
# A text that normalisation would change.
_PROBE = "  \ufb01\t a "


def common_ends(a_ends: Sequence[np.ndarray], b_ends: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, a, b)``: which tokens of A and B end together, by document and in order.

    ``a_ends`` and ``b_ends`` are the increasing byte ends of each document's tokens, both with the
    same last one.
    """
    a_bounds, b_bounds = _bounds(map(len, a_ends)), _bounds(map(len, b_ends))
    if not a_bounds[-1]:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    before = _bounds(int(ends[-1]) if len(ends) else 0 for ends in a_ends)
    a_flat, b_flat = (np.concatenate([e + n for e, n in zip(ends, before)]) for ends in (a_ends, b_ends))
    a, b = _lockstep(a_flat, b_flat, a_bounds)
    document = np.searchsorted(a_bounds, a, side="right") - 1
    return document, a - a_bounds[document], b - b_bounds[document]


def _bounds(counts: Iterable[int]) -> np.ndarray:
    """Where runs of these lengths begin when they stand in a row, and where the last one ends."""
    return np.concatenate(([0], np.cumsum(np.fromiter(counts, dtype=np.int64))))


def _lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of A and of B that end together; byte ends run on through all documents.

    One state vector holds both pointers of every document. In each step the token that ends first
    is passed, or both where they end together, which is a link and a cut; what is through leaves
    the vector. So that a long document does not go on alone, it is entered at more places, each
    right behind a common end.
    """
    a = np.unique(np.concatenate((a_bounds, np.arange(0, len(a_ends), _LANE))))
    a = a[(a > 0) & (a < len(a_ends))]
    before = np.searchsorted(b_ends, a_ends[a - 1])
    common = b_ends[before] == a_ends[a - 1]
    a, b = np.append(0, a[common]), np.append(0, before[common] + 1)
    a_stop = np.append(a[1:], len(a_ends))
    partner = np.full(len(a_ends), -1, dtype=np.int64)
    while len(a):
        a_end, b_end = a_ends[a], b_ends[b]
        both = a_end == b_end
        partner[a[both]] = b[both]
        a = a + (a_end <= b_end)
        b = b + (b_end <= a_end)
        going = a < a_stop
        if not going.all():
            a, b, a_stop = a[going], b[going], a_stop[going]
    linked = np.flatnonzero(partner >= 0)
    return linked, partner[linked]


def _joined(entries: pa.Array, numbers: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """The entries with these numbers in a row, and where each begins and the last one ends."""
    if not len(numbers):
        return pa.py_buffer(b""), np.zeros(1, dtype=np.int64)
    taken = entries.take(pa.array(numbers, pa.int64()))
    return taken.buffers()[2], np.frombuffer(taken.buffers()[1], dtype=np.int64)[: len(numbers) + 1]


class _Ranks:
    """Ids of whole texts after one more space from a byte-level vocabulary, by the library itself."""

    def __init__(self, path: str | None = None):
        self._encoding, ranks = rank_vocabulary(path)
        #: What each id stands for.
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        for entry, number in ranks.items():
            self.token_bytes[number] = entry

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [self._encoding.encode_to_numpy(" " + text) for text in texts]


class _Pieces:
    """Ids of whole texts from a piece model, by the library itself."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
        pieces = list(map(self._model.id_to_piece, range(self._model.get_piece_size())))
        #: What each id stands for.
        self.token_bytes = [
            bytes([int(piece[1:-1], 16)]) if self._model.is_byte(number) else piece.replace(SPACE, " ").encode()
            for number, piece in enumerate(pieces)
        ]
        # Where no piece goes on with a space after another character, and one space is put before
        # each text and nothing else is changed, a text may be encoded in parts that begin at spaces.
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces)
        probe = b"".join(map(self.token_bytes.__getitem__, self._model.encode(_PROBE)))
        whole = crossing or probe != b" " + _PROBE.encode()
        self._bound = None if whole else re.compile(f"(?<=[^ {SPACE}]) (?=.)", re.DOTALL)

    def _parts(self, text: str) -> list[str]:
        """``text`` cut into parts of bounded length, each without the space that it begins with."""
        parts, start = [], 0
        while self._bound and len(text) - start > _PART:
            bound = self._bound.search(text, start + _PART)
            if not bound:
                break
            parts.append(text[start : bound.start()])
            start = bound.end()
        return parts + [text[start:]]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        parts = map(self._parts, texts)
        return [
            np.fromiter(chain.from_iterable(map(self._model.encode, some)), dtype=np.int32) for some in parts
        ]


class _Side:
    """The tokens of many documents in a row, for one vocabulary; ``entries`` are its ids' bytes."""

    def __init__(self, entries: pa.Array, ids: Sequence[np.ndarray]):
        self.ids, self.bounds = np.concatenate(ids).astype(np.int64), _bounds(map(len, ids))
        self.raw, self.offsets = _joined(entries, self.ids)

    def raw_of(self, place: int) -> bytes:
        start, stop = self.offsets[self.bounds[place : place + 2]].tolist()
        return self.raw.slice(start, stop - start).to_pybytes()

    def keep(self, kept: np.ndarray) -> None:
        """Leaves only the tokens of some of the documents; the others have none then."""
        counts = np.diff(self.bounds)
        tokens = np.repeat(kept, counts)
        self.ids, lengths = self.ids[tokens], np.diff(self.offsets)[tokens]
        self.bounds, self.ends = _bounds(np.where(kept, counts, 0)), np.cumsum(lengths)


class _GroupText:
    """Groups as texts, put together from the ids' numbers with the sign that follows each."""

    def __init__(self, a_size: int, b_size: int):
        self._size = max(a_size, b_size)
        # An id inside its side of a group, the last of A's side, the last of B's, the last of all.
        self._shown = pa.array(
            [f"{number}{sign}" for sign in (",", "|", ";", "") for number in range(self._size)], pa.large_string()
        )

    def __call__(self, a: _Side, b: _Side, a_last: np.ndarray, b_last: np.ndarray) -> pa.Array:
        """One text for each document; ``a_last`` and ``b_last`` are the last tokens of the groups."""
        a_ends, b_ends = np.zeros(len(a.ids), dtype=np.int64), np.zeros(len(b.ids), dtype=np.int64)
        a_ends[a_last], b_ends[b_last] = 1, 1
        # Before an id of A stand the ids of B of all groups before its own; before one of B, those
        # of A of the groups up to its own.
        a_groups, b_groups = np.cumsum(a_ends) - a_ends, np.cumsum(b_ends) - b_ends
        signs = 2 * b_ends
        signs[b.bounds[1:][np.diff(b.bounds) > 0] - 1] += 1
        shown = np.zeros(len(a.ids) + len(b.ids), dtype=np.int64)
        shown[np.arange(len(a.ids)) + np.append(0, b_last + 1)[a_groups]] = a.ids + a_ends * self._size
        shown[np.arange(len(b.ids)) + np.append(a_last + 1, 0)[b_groups]] = b.ids + signs * self._size
        text, offsets = _joined(self._shown, shown)
        offsets = pa.py_buffer(offsets[a.bounds + b.bounds])
        return pa.LargeStringArray.from_buffers(len(a.bounds) - 1, offsets, text).cast(pa.string())


class _Vocabularies:
    """Both sides' encoders, their ids' bytes and the groups' texts."""

    def __init__(self, a_path: str | None, b_path: str | None):
        self._encoders = _Ranks(a_path), _Pieces(b_path)
        sizes = [len(encoder.token_bytes) for encoder in self._encoders]
        self._entries = [pa.array(encoder.token_bytes, pa.large_binary()) for encoder in self._encoders]
        self.show = _GroupText(*sizes)

    def sides(self, texts: Sequence[str]) -> Iterator[_Side]:
        for encoder, entries in zip(self._encoders, self._entries):
            yield _Side(entries, encoder.encode(texts))


@lru_cache(maxsize=2)
def _vocabularies(a_path: str | None = None, b_path: str | None = None) -> _Vocabularies:
    """Kept by the worker for its later tasks."""
    return _Vocabularies(a_path, b_path)


def _lists(bounds: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A column of lists, which lie in a row in ``values``."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    a_vocabulary: str | None = None, b_vocabulary: str | None = None,
) -> DataFrame:
    """``id_col, a_ids, b_ids, a_cuts, b_cuts, links, groups`` for each row of ``docs``.

    A space and the text are encoded by the byte-level vocabulary A (a rank file), the text by the
    piece model B, which puts the space there itself. ``a_cuts`` and ``b_cuts`` count the tokens
    before each byte offset at which tokens of both end: what lies between two cuts is a group. Two
    tokens are linked where they end together, so each cut ends one group and makes one link, given
    in ``links`` as A's id times ``PAIR`` plus B's. ``groups`` shows the groups as a text,
    ``a1,a2|b1;a3|b2``.

    All arrays and that text are empty where the text is null or empty, or where the bytes of either side's tokens
    are not those of the space and the text (B shows U+2581 as a space). Null and repeated ids are
    kept, each row for itself; no documents, no rows. Texts are whole; each is aligned in the task
    that reads it, many in lockstep.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _vocabularies(a_vocabulary, b_vocabulary)
        for part in text_slices(batches, 1, _SLICE_BYTES, _SLICE_ROWS):
            texts = [text or "" for text in part.column(1).to_pylist()]
            a, b = both.sides(texts)
            kept = np.array([
                text != "" and b" " + text.encode() == a.raw_of(place) == b.raw_of(place)
                for place, text in enumerate(texts)
            ])
            a.keep(kept)
            b.keep(kept)
            a_last, b_last = _lockstep(a.ends, b.ends, a.bounds) if len(a.ids) else (a.ids, b.ids)
            bounds = np.searchsorted(a_last, a.bounds)
            a_cuts, b_cuts = (
                last + 1 - np.repeat(side.bounds[:-1], np.diff(bounds)) for side, last in ((a, a_last), (b, b_last))
            )
            yield pa.RecordBatch.from_arrays([
                part.column(0), _lists(a.bounds, a.ids, pa.int32()), _lists(b.bounds, b.ids, pa.int32()),
                _lists(bounds, a_cuts, pa.int32()), _lists(bounds, b_cuts, pa.int32()),
                _lists(bounds, a.ids[a_last] * PAIR + b.ids[b_last], pa.int64()), both.show(a, b, a_last, b_last),
            ], names=names)
        # The worker stays for later tasks; what it does not use goes back.
        pa.default_memory_pool().release_unused()

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    whole = ArrayType(IntegerType())
    schema = StructType(
        [given.schema["id"]] + [StructField(name, whole) for name in ("a_ids", "b_ids", "a_cuts", "b_cuts")]
        + [StructField("links", ArrayType(LongType())), StructField("groups", StringType())]
    )
    names = schema.names
    return given.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def link_counts(aligned: DataFrame) -> DataFrame:
    """``link, n, best``: how often each pair of ids is linked in the corpus.

    ``best`` tells whether no other pair with the same id of B has more links. The counts are summed
    up before they are shuffled; what is broadcast is one number for each id of B at most.
    """
    counts = stored(
        aligned.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("n")), "links"
    ).withColumn("b", F.col("link") % PAIR)
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "b").select("link", "n", (F.col("n") == F.col("most")).alias("best"))


def with_support(aligned: DataFrame) -> DataFrame:
    """``aligned`` without ``links``, but with ``n_best`` and ``count_sum``.

    These are, for each row, the number of links that are best for their id of B, and the sum of the
    corpus-wide counts of all its links; 0 without links. Frequent pairs, of which there are
    ``FREQUENT`` at most at any size, are looked up by broadcast; the links of the others, none of
    which has more than its share of the rows, are shuffled by pair. The names ``_row`` and
    ``links`` must not be used otherwise.
    """
    aligned = stored(aligned.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    counts = stored(link_counts(aligned), "link_counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = F.col("n") * FREQUENT >= F.lit(total)
    each = aligned.select("_row", F.explode("links").alias("link"))
    looked_up = each.join(F.broadcast(counts.where(frequent)), "link", "left")
    sums = [F.sum("n").alias("count_sum"), F.sum(F.col("best").cast("long")).alias("n_best")]
    often = looked_up.where("n is not null").groupBy("_row").agg(*sums)
    seldom = looked_up.where("n is null").select("_row", "link").join(
        counts.where(~frequent), "link"
    ).groupBy("_row").agg(*sums)
    both = often.unionByName(seldom).groupBy("_row").agg(
        F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best")
    )
    return aligned.drop("links").join(both, "_row", "left").drop("_row").fillna(0, ["count_sum", "n_best"])
