"""Token counts of fields and sections by offsets of one encoding of the whole document."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from papyra.llm.bpe import Encoder
from papyra.llm.packing import READ_ROWS

RULES = ("first", "most")
_NUMBERS = ("section", "start", "stop", "n_tokens", "n_crossing", "doc_tokens")


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens, and tokens that cross a boundary, for each section.

    ``ends`` are the byte ends of the tokens, which begin at 0 and lie without gaps; ``bounds`` the
    byte bounds of the sections, also without gaps. Both sorted, so the interval join is a search.
    """
    starts = np.concatenate(([0], ends))[:-1]
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends, side="left") - 1
    owner = first.copy()
    crossing = np.flatnonzero(last > first)
    if rule == "most":
        for token in crossing.tolist():
            sections = np.arange(first[token], last[token] + 1)
            shared = np.minimum(bounds[sections + 1], ends[token]) - np.maximum(bounds[sections], starts[token])
            owner[token] = sections[int(shared.argmax())]
    n = len(bounds) - 1
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def token_counts(
    docs: DataFrame, fields: Sequence[str] = ("text",), id_col: str = "doc_id", section_break: str = "\n",
    field_break: str = "\n\n", rule: str = "first", vocabulary: str | None = None,
) -> DataFrame:
    """``id_col, field, section, start, stop, n_tokens, n_crossing, doc_tokens``: a row per section.

    A document is its ``fields`` in order with ``field_break`` between them, and is encoded once,
    whole. A section is a run of a field up to and including its ``section_break``; the field break
    belongs to the last section before it. ``start`` and ``stop`` are code points of the document,
    stop exclusive. Tokens are mapped by their byte offsets, which are exact in a byte-level
    vocabulary even inside a character. A token that lies in several sections counts whole for the
    one with its first byte (``rule="first"``) or with most of its bytes, the earliest of equals
    (``rule="most"``), and is one of ``n_crossing`` there. So a document's ``n_tokens`` add up to
    ``doc_tokens``.

    A null field is an empty one; an empty field still has one section, of no tokens unless its
    break has some. Null and repeated ids are kept, each row for itself. No documents, no rows.
    Every document is counted in the task that reads it; nothing is shuffled.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    names, mark, gap = list(fields), section_break.encode(), field_break.encode()

    def sections(texts: Sequence[bytes]) -> tuple[list[str], list[int], list[int]]:
        """Field and number of each section, and the byte bounds."""
        field_of, numbers, bounds, at = [], [], [0], 0
        for place, (name, raw) in enumerate(zip(names, texts)):
            pieces = raw.split(mark)
            for number, piece in enumerate(pieces):
                at += len(piece) + (len(mark) if number < len(pieces) - 1 else 0)
                field_of.append(name)
                numbers.append(number)
                bounds.append(at)
            if place < len(names) - 1:
                at += len(gap)
                bounds[-1] = at
        return field_of, numbers, bounds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in (b.slice(start, READ_ROWS) for b in batches for start in range(0, len(b), READ_ROWS)):
            ids = batch.column(0).to_pylist()
            columns = [batch.column(1 + i).to_pylist() for i in range(len(names))]
            parts = [[(value or "").encode() for value in row] for row in zip(*columns)]
            whole = [gap.join(row) for row in parts]
            encoded = encoder.encode([raw.decode() for raw in whole])
            kinds = [("id", batch.schema.field(0).type), ("field", pa.string()), *[(name, pa.int64()) for name in _NUMBERS]]
            out: list[list] = [[] for _ in kinds]
            for number, raw, row, tokens in zip(ids, whole, parts, encoded):
                field_of, numbers, bounds = sections(row)
                at = np.array(bounds, dtype=np.int64)
                counts, crossing = attribute(np.cumsum(encoder.token_bytes[tokens]), at, rule)
                letters = np.frombuffer(raw, dtype=np.uint8)
                points = np.concatenate(([0], np.cumsum((letters & 0xC0) != 0x80)))[at]
                n = len(numbers)
                for column, values in zip(out, (
                    [number] * n, field_of, numbers, points[:-1].tolist(), points[1:].tolist(),
                    counts.tolist(), crossing.tolist(), [len(tokens)] * n,
                )):
                    column.extend(values)
            arrays = [pa.array(column, kind) for column, (_, kind) in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(kinds))

    given = docs.select(
        F.col(id_col).alias("id"),
        *[F.col(name).cast("string").alias(f"field_{i}") for i, name in enumerate(names)],
    )
    schema = StructType([
        given.schema["id"], StructField("field", StringType()), *[StructField(name, LongType()) for name in _NUMBERS]
    ])
    return given.mapInArrow(run, schema).withColumnRenamed("id", id_col)
