"""Encoding and decoding with SentencePiece BPE models, through a table of last tokens.

In a BPE encoding, neighbours decide: a sequence of tokens is the encoding of its text exactly if
every two tokens in a row are the encoding of their own joined text. So each prefix of a text has
one last token: of the tokens that end there, the one which is compatible with the last token of
the prefix before it. The table of these is filled from left to right with an automaton's matches,
and the tokens are read from it backwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from papyra.llm.batches import list_column, text_slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
# Chunks, their characters and pairs that a worker remembers; longer chunks are encoded alone.
_CHUNKS, _CHARACTERS, _PAIRS, _CHUNK_LENGTH = 300_000, 16_000_000, 500_000, 48
# Characters of texts, and chunks, that are worked on together.
_BLOCK, _TOGETHER = 1 << 20, 20_000
# Slots of the table in which pairs are looked up many at a time.
_SLOTS = 1 << 20
# A text that normalisation would change.
_PROBE = "  ﬁ\t "


class _Numbers(dict):
    """Number of each chunk, given when it is first met; ``fresh`` lists those since it was emptied."""

    def __init__(self, chunks: Sequence[str] = ()):
        super().__init__(zip(chunks, range(len(chunks))))
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.fresh.append(chunk)
        return number


class _Pairs(dict):
    """Whether a token can follow another; the first of a pair is -1 at the start of a text."""

    def __init__(self, test):
        super().__init__()
        self._test = test

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= _PAIRS:
            self.clear()
        self[pair] = found = self._test(*pair)
        return found


class PieceModel:
    """A SentencePiece BPE model with byte fallback and no normalisation.

    The library only reads the model file. Spaces become U+2581, and one is put before the text.
    """

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
        if model.decode(model.encode(_PROBE)) != _PROBE or "".join(model.encode_as_pieces("a")) != f"{SPACE}a":
            raise ValueError("only models that add one space and do not change the text are known")
        size = model.get_piece_size()
        self._pieces = [model.id_to_piece(number) for number in range(size)]
        reserved = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        ordinary = [i for i in range(size) if not reserved[i]]
        self._ids = {self._pieces[i]: i for i in ordinary}
        self._scores = {self._pieces[i]: model.get_score(i) for i in ordinary}
        self._bytes = [0] * 256
        #: What each token stands for: bytes, and the surface of a token without any.
        self.token_bytes = [piece.replace(SPACE, " ").encode() for piece in self._pieces]
        for i in range(size):
            if model.is_byte(i):
                value = int(self._pieces[i][1:-1], 16)
                self._bytes[value], self.token_bytes[i] = i, bytes([value])
            elif reserved[i]:
                self.token_bytes[i] = model.decode([i]).encode() if model.is_unknown(i) else b""
        self._is_byte = np.array([model.is_byte(i) for i in range(size)])
        self._is_control = np.array([model.is_control(i) for i in range(size)])
        self.byte_lengths = np.array([len(raw) for raw in self.token_bytes], dtype=np.int64)
        self._automaton = ahocorasick.Automaton()
        for piece, number in self._ids.items():
            self._automaton.add_word(piece, number)
        self._automaton.make_automaton()
        self._piece_lengths = np.array([len(piece) for piece in self._pieces], dtype=np.int64)
        self._known_characters = {c for piece in self._ids for c in piece}
        if not self._known_characters <= self._ids.keys():
            raise ValueError("every character of a piece must be a piece")
        # No piece goes on with a space after another character, or holds a line end that is no
        # piece itself, so none crosses these bounds.
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self._ids)
        lines = "".join(c for c in "\t\n\r" if c not in self._known_characters)
        inside = f"[^{SPACE}{lines}]"
        self._chunk = re.compile("(?s).+" if crossing else f"{SPACE}+{inside}*|{inside}+|(?s:.)")
        self._compatible = _Pairs(self._pair_holds)
        self._slot_pairs, self._slot_holds = np.full(_SLOTS, -1, dtype=np.int64), np.zeros(_SLOTS, dtype=bool)
        self._numbers, self._characters = _Numbers(), 0
        self._flat, self._lengths = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        self._met = np.zeros(0, dtype=np.int64)

    def _forget(self) -> None:
        """Keeps only the chunks that were met more than once since the last time, if they are few."""
        kept = np.flatnonzero(self._met > 1)
        names = list(self._numbers)
        names = [names[number] for number in kept.tolist()]
        self._characters = sum(map(len, names))
        if len(kept) > _CHUNKS // 2 or self._characters > _CHARACTERS // 2:
            kept, names, self._characters = kept[:0], [], 0
        self._flat, self._lengths = self._ids_of(kept), self._lengths[kept]
        self._numbers, self._met = _Numbers(names), np.zeros(len(kept), dtype=np.int64)

    def _ids_of(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of the chunks with these numbers in a row."""
        counts = self._lengths[numbers]
        begins = (np.cumsum(self._lengths) - self._lengths)[numbers]
        stops = np.cumsum(counts)
        total = int(stops[-1]) if len(stops) else 0
        return self._flat[np.arange(total) + np.repeat(begins - (stops - counts), counts)]

    def _merged(self, text: str) -> list[str]:
        """Plain BPE of a short text: the best-scored pair is joined first, the left one of equals."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [a + b for a, b in zip(parts, parts[1:])]
            scores = [self._scores.get(pair) for pair in pairs]
            known = [score for score in scores if score is not None]
            if not known:
                break
            place = scores.index(max(known))
            parts[place : place + 2] = [pairs[place]]
        return parts

    def _pair_holds(self, before: int, token: int) -> bool:
        expected = [self._pieces[token]] if before < 0 else [self._pieces[before], self._pieces[token]]
        return self._merged("".join(expected)) == expected

    def _last_tokens(self, text: str) -> list[tuple[int, int]]:
        """For each prefix of ``text``, but the empty one, its last token and that token's start.

        All characters must be known.
        """
        compatible, table, filled = self._compatible, [], 0
        for end, token in self._automaton.iter(text):
            if end < filled:
                continue
            start = end + 1 - len(self._pieces[token])
            if compatible[table[start - 1][0] if start else -1, token]:
                table.append((token, start))
                filled += 1
        return table

    def _encode_one(self, chunk: str) -> list[int]:
        """Ids of one chunk of any length; no merge takes part in an unknown character."""
        ids: list[int] = []
        start = 0
        for place in [i for i, c in enumerate(chunk) if c not in self._known_characters] + [len(chunk)]:
            table, end, found = self._last_tokens(chunk[start:place]), place - start, []
            while end:
                token, end = table[end - 1]
                found.append(token)
            ids += found[::-1]
            ids += [self._bytes[value] for value in chunk[place : place + 1].encode()]
            start = place + 1
        return ids

    def _holds(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``_compatible`` for many pairs; those met lately are found without leaving the arrays."""
        size = len(self._pieces) + 1
        pair = (before + 1) * size + token
        slot = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64) % _SLOTS
        missing = np.unique(pair[self._slot_pairs[slot] != pair])
        holds = self._slot_holds[slot]
        if len(missing):
            found = np.array([self._compatible[x // size - 1, x % size] for x in missing.tolist()], dtype=bool)
            fresh = self._slot_pairs[slot] != pair
            holds[fresh] = found[np.searchsorted(missing, pair[fresh])]
            self._slot_pairs[slot[fresh]], self._slot_holds[slot[fresh]] = pair[fresh], holds[fresh]
        return holds

    def _encode_many(self, chunks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``chunks`` in a row, and how many each has; all characters must be known.

        One run of the automaton finds the matches of all chunks. The tables of last tokens are then
        filled for all of them at once, by the end of the match inside its chunk, and so are the
        ways back.
        """
        if not chunks:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        joined = "\0".join(chunks)
        found = np.fromiter(chain.from_iterable(self._automaton.iter(joined)), dtype=np.int64).reshape(-1, 2)
        end, token = found[:, 0], found[:, 1]
        start = end + 1 - self._piece_lengths[token]
        sizes = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        stops = np.cumsum(sizes + 1) - 1
        begins = stops - sizes
        head = begins[np.searchsorted(stops, end)]
        order = np.arange(len(end))
        choice = order - np.maximum.accumulate(np.where(np.diff(end, prepend=-1) > 0, order, 0))
        wave = ((end - head) * (int(choice.max()) + 1) + choice).astype(np.uint16)
        order = np.argsort(wave, kind="stable")
        last, back = np.full(len(joined), -1, dtype=np.int64), np.zeros(len(joined), dtype=np.int64)
        for matches in np.split(order, np.flatnonzero(np.diff(wave[order])) + 1):
            matches = matches[last[end[matches]] < 0]
            first = start[matches]
            before = np.where(first == head[matches], -1, last[first - 1])
            matches = matches[self._holds(before, token[matches])]
            last[end[matches]], back[end[matches]] = token[matches], start[matches]
        which, place = np.arange(len(chunks)), stops.copy()
        counts, steps = np.zeros(len(chunks), dtype=np.int64), []
        while len(which):
            steps.append((which, last[place - 1]))
            counts[which] += 1
            place = back[place - 1]
            going = place > begins[which]
            which, place = which[going], place[going]
        ids = np.zeros(counts.sum(), dtype=np.int32)
        ends = np.cumsum(counts)
        for step, (which, tokens) in enumerate(steps):
            ids[ends[which] - 1 - step] = tokens
        return ids, counts

    def _learn(self) -> None:
        """Encodes the chunks that have just got a number."""
        chunks, self._numbers.fresh = self._numbers.fresh, []
        flat, lengths = [self._flat], [self._lengths]
        for start in range(0, len(chunks), _TOGETHER):
            some, known = chunks[start : start + _TOGETHER], self._known_characters
            short = np.array([len(c) <= _CHUNK_LENGTH and known.issuperset(c) for c in some])
            counts = np.zeros(len(some), dtype=np.int64)
            ids, counts[short] = self._encode_many([c for c, many in zip(some, short.tolist()) if many])
            if not short.all():
                alone = [self._encode_one(some[place]) for place in np.flatnonzero(~short).tolist()]
                counts[~short] = list(map(len, alone))
                together, ids = ids, np.zeros(counts.sum(), dtype=np.int32)
                from_many = np.repeat(short, counts)
                ids[from_many], ids[~from_many] = together, list(chain.from_iterable(alone))
            flat.append(ids)
            lengths.append(counts)
        self._flat, self._lengths = np.concatenate(flat), np.concatenate(lengths)
        self._met = np.concatenate((self._met, np.zeros(len(chunks), dtype=np.int64)))
        self._characters += sum(map(len, chunks))

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each whole text, without begin and end; a chunk that repeats is encoded once."""
        found, block, size = [], [], 0
        for text in texts:
            if block and size + len(text) > _BLOCK:
                found += self._encode_block(block)
                block, size = [], 0
            block.append(text)
            size += len(text)
        return found + self._encode_block(block)

    def _encode_block(self, texts: Sequence[str]) -> list[np.ndarray]:
        if len(self._numbers) > _CHUNKS or self._characters > _CHARACTERS:
            self._forget()
        parts = [self._chunk.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        sizes = np.array([len(part) for part in parts], dtype=np.int64)
        met = map(self._numbers.__getitem__, chain.from_iterable(parts))
        numbers = np.fromiter(met, dtype=np.int64, count=sizes.sum())
        if self._numbers.fresh:
            self._learn()
        self._met += np.bincount(numbers, minlength=len(self._met))
        bounds = np.concatenate(([0], np.cumsum(self._lengths[numbers])))[np.cumsum(sizes)]
        return np.split(self._ids_of(numbers), bounds[:-1]) if texts else []

    def decode(self, ids: np.ndarray) -> str:
        """Text of ``ids``: bytes in a row are read as UTF-8, the space put before a text goes."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self._pieces)):
            raise ValueError("ids must lie in the vocabulary")
        control = self._is_control[ids]
        if control.all():
            return ""
        pieces = list(map(self.token_bytes.__getitem__, ids.tolist()))
        first = int(control.argmin())
        if self._pieces[ids[first]].startswith(SPACE):
            pieces[first] = pieces[first][1:]
        if not control.any():
            try:
                return b"".join(pieces).decode()
            except UnicodeDecodeError:
                pass
        return self._decode_runs(self._is_byte[ids], pieces)

    @staticmethod
    def _decode_runs(is_byte: np.ndarray, pieces: Sequence[bytes]) -> str:
        """Each run of byte tokens is read for itself; a byte that is no UTF-8 becomes U+FFFD."""
        bounds = np.concatenate(([0], np.flatnonzero(np.diff(is_byte)) + 1, [len(pieces)]))
        out = []
        for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            raw = b"".join(pieces[start:stop])
            while raw:
                try:
                    out.append(raw.decode())
                    break
                except UnicodeDecodeError as error:
                    out.append(raw[: error.start].decode() + "�")
                    raw = raw[error.start + 1 :]
        return "".join(out)


@lru_cache(maxsize=2)
def piece_model(path: str | None = None) -> PieceModel:
    """The model at ``path``, kept by the worker for its later tasks."""
    return PieceModel(path)


def encode_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """``id_col, ids``: token ids of each row's whole text, as the model file ``vocabulary`` gives them.

    No begin or end ids; strings of special tokens are ordinary text. Null and empty texts have no
    ids; null and repeated ids are kept, each row for itself; no documents, no rows. Every row is
    encoded in the task that reads it. A text of any length is encoded whole, in time linear in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(vocabulary)
        for part in text_slices(batches):
            ids = model.encode([text or "" for text in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), list_column(ids, pa.int32())], names=["id", "ids"])

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = StructType([given.schema["id"], StructField("ids", ArrayType(IntegerType()))])
    return given.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_pieces(
    tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None
) -> DataFrame:
    """``id_col, ids, text``: the text of each row's ids.

    Null ids, and nulls among them, stand for no token. Begin and end ids have no text, the unknown
    id has the library's mark; an id outside the vocabulary is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(vocabulary)
        for part in (b.slice(start, 500) for b in batches for start in range(0, len(b), 500)):
            texts = []
            for ids in part.column(1):
                found = np.zeros(0, np.int64) if not ids.is_valid else ids.values.drop_null().to_numpy(zero_copy_only=False)
                texts.append(model.decode(found))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string())], names=["id", "ids", "text"]
            )

    given = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    schema = StructType([given.schema["id"], StructField("ids", ArrayType(IntegerType())), StructField("text", StringType())])
    return given.mapInArrow(run, schema).withColumnRenamed("id", id_col)
