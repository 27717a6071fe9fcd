"""Packing of token sequences by the sum-of-squares rule."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from papyra.llm.bpe import Encoder

WINDOW = 1024
END_ID = 0
_NUMBERS = ("start", "length", "doc_tokens", "sequence_id", "offset")
# Documents that a task encodes together.
READ_ROWS = 500
# Sequences of one task are numbered from its partition number times this.
TASK_SEQUENCES = 1 << 40


class SumOfSquares:
    """Places pieces into windows so that few windows stay partly filled.

    ``counts[level]`` is the number of open windows filled to ``level``. A piece goes to the level
    for which the sum of the squared counts becomes least; the lower level wins a tie. Level 0
    stands for a new window. Counts near each other mean that a partner of any size is at hand.
    """

    def __init__(self, window: int, first_sequence: int):
        self.window = window
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(window)]
        self._next = first_sequence

    def new_sequence(self) -> int:
        self._next += 1
        return self._next - 1

    def place(self, size: int) -> tuple[int, int]:
        """Sequence and offset for a piece of ``size`` tokens, less than a window."""
        counts, room = self.counts, self.window - size
        # Change of the sum, halved: leaving level h gives 1/2 - n(h), reaching h + size gives
        # 1/2 + n(h + size); a full window is no longer counted.
        change = counts[size : self.window] - counts[:room] + 1.0
        change[0] = counts[size] + 0.5
        change[1:][counts[1:room] == 0] = np.inf
        level = int(change.argmin())
        if counts[room] and 0.5 - counts[room] <= change[level]:
            level = room
        if level:
            sequence = self.open[level].pop()
            counts[level] -= 1
        else:
            sequence = self.new_sequence()
        if level + size < self.window:
            counts[level + size] += 1
            self.open[level + size].append(sequence)
        return sequence, level


class Packer:
    """Pieces of documents, in rows ``(id, start, length, doc_tokens, sequence, offset, ids)``."""

    def __init__(self, window: int, first_sequence: int):
        self._rule = SumOfSquares(window, first_sequence)
        self._waiting: dict[int, list[tuple]] = {}
        self.window = window

    def add(self, number: int | None, ids: np.ndarray) -> Iterator[tuple]:
        """Pieces that can be given out: those of windows that are full now."""
        window, total = self.window, len(ids)
        whole = total - total % window
        for start in range(0, whole, window):
            yield number, start, window, total, self._rule.new_sequence(), 0, ids[start : start + window].tobytes()
        if whole < total:
            size = total - whole
            sequence, offset = self._rule.place(size)
            pieces = self._waiting.setdefault(sequence, [])
            pieces.append((number, whole, size, total, sequence, offset, ids[whole:].tobytes()))
            if offset + size == window:
                yield from self._waiting.pop(sequence)

    def finish(self) -> Iterator[tuple]:
        """Pieces of the windows left open, joined and cut anew into full windows.

        What then remains is less than a window; it is cut into sequences whose lengths are powers
        of two, which are not padded.
        """
        sequences = sorted(self._waiting)
        pieces = [piece for sequence in sequences for piece in self._waiting[sequence]]
        rest = sum(piece[2] for piece in pieces)
        capacities = [self.window] * (rest // self.window)
        remains = rest % self.window
        capacities += [1 << bit for bit in range(self.window.bit_length()) if remains >> bit & 1][::-1]
        names = iter(sequences)
        sequence, room, offset, cut = -1, 0, 0, iter(capacities)
        for number, start, size, total, _, _, ids in pieces:
            done = 0
            while done < size:
                if not room:
                    room, offset = next(cut), 0
                    sequence = next(names, None)
                    sequence = self._rule.new_sequence() if sequence is None else sequence
                taken = min(room, size - done)
                yield (
                    number, start + done, taken, total, sequence, offset,
                    ids[4 * done : 4 * (done + taken)],
                )
                done, room, offset = done + taken, room - taken, offset + taken
        self._waiting = {}


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
    )


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    batch = []
    for row in rows:
        batch.append(row)
        if len(batch) == 1024:
            yield _record_batch(batch, schema)
            batch = []
    if batch:
        yield _record_batch(batch, schema)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, end_id: int = END_ID, vocabulary: str | None = None,
) -> DataFrame:
    """``id_col, start, length, doc_tokens, sequence_id, offset, ids``: one row for each piece.

    A document is its token ids and ``end_id``; ``ids`` holds a piece's ids as little-endian
    unsigned 32-bit numbers. Documents longer than a window first fill windows of their own; the
    remainder, and any shorter document, goes whole to the fill level that the sum-of-squares rule
    chooses. At the end of a task its few open windows are cut anew into full ones and a rest in
    powers of two, so that nothing has to be padded. Each task packs the rows it reads, in order:
    no shuffle, memory for one batch and the open windows, and the same result when it is repeated.

    A null text is an empty document, of ``end_id`` alone. Ids may be null or repeat: each row is
    packed for itself. An empty table gives no pieces. ``window`` must be a power of two.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        packer = Packer(window, TaskContext.get().partitionId() * TASK_SEQUENCES)
        end = np.array([end_id], dtype="<u4")
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        kinds = [("id", first.schema.field(0).type), *[(name, pa.int64()) for name in _NUMBERS], ("ids", pa.binary())]

        def rows() -> Iterator[tuple]:
            for batch in chain([first], batches):
                for start in range(0, len(batch), READ_ROWS):
                    part = batch.slice(start, READ_ROWS)
                    texts = [text or "" for text in part.column(1).to_pylist()]
                    for number, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                        yield from packer.add(number, np.concatenate((ids, end)).astype("<u4", copy=False))
            yield from packer.finish()

        yield from _batches(rows(), pa.schema(kinds))

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = StructType(
        [given.schema["id"]] + [StructField(name, LongType()) for name in _NUMBERS] + [StructField("ids", BinaryType())]
    )
    packed = given.mapInArrow(run, schema)
    return packed.withColumnRenamed("id", id_col)
