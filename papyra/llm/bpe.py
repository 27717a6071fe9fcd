"""Token ids of whole texts from a public byte-level vocabulary, fast on running text.

In the vocabulary's splitting rule a space begins a new piece unless white space stands before it.
A text without such double white space is therefore cut at its spaces, and of all texts of a batch
each distinct chunk, with its leading space, is encoded once. Any other text is encoded whole. The
ids are those that the ``tokenizers`` library gives for ``byte_bpe_50k.json``; chunks are encoded
with the same vocabulary's rank file, which is faster.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Sequence

import numpy as np

from papyra.llm.words import byte_hashes

RANKS = "byte_bpe_50k.tiktoken"
# Chunks remembered by one task; the store is emptied when it is full.
REMEMBERED = 250_000
_BLOCK_BYTES = 1 << 20
_WIDE_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")


def ranks_path() -> str:
    """Where the default vocabulary lies on the machine that runs the task."""
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def rank_vocabulary(path: str | None = None):
    """The encoding of a rank file by the library, and the id of each entry's bytes."""
    import public_tokenizers
    import tiktoken

    with open(path or ranks_path(), "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ), ranks


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids; one object serves one task."""

    def __init__(self, path: str | None = None):
        self._encoding, ranks = rank_vocabulary(path)
        #: How many bytes of text each id stands for.
        self.token_bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for piece, rank in ranks.items():
            self.token_bytes[rank] = len(piece)
        self._forget()

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {}
        self._ids, self._lengths = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._encoding.encode_ordinary(text), dtype="<u4")

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text, whole; special tokens' strings are ordinary text."""
        result: list[np.ndarray | None] = [None] * len(texts)
        block, size = [], 0
        for place, text in enumerate(texts):
            if (
                not text.strip() or text[0].isspace() or text[-1].isspace()
                or _WIDE_SPACE.search(text) or "  " in text or "\n " in text or "\t " in text
                or "\r " in text or "\x0b " in text or "\x0c " in text
            ):
                result[place] = self._whole(text)
                continue
            raw = text.encode()
            if block and size + len(raw) > _BLOCK_BYTES:
                self._encode_block(block, result)
                block, size = [], 0
            block.append((place, raw))
            size += len(raw)
        if block:
            self._encode_block(block, result)
        return result

    def _encode_block(self, block: list[tuple[int, bytes]], result: list) -> None:
        if len(self._known) > REMEMBERED:
            self._forget()
        joined = b" ".join(raw for _, raw in block) + b" "
        letters = np.frombuffer(joined, dtype=np.uint8)
        ends = np.flatnonzero(letters == 32)
        starts = np.concatenate(([0], ends[:-1] + 1))
        lengths = ends - starts
        text_ends = np.cumsum([len(raw) + 1 for _, raw in block])
        first_chunk = np.concatenate(([0], np.searchsorted(ends, text_ends - 1) + 1))
        hashes = byte_hashes(letters, starts, lengths)
        hashes[first_chunk[:-1]] ^= np.uint64(0x5851F42D4C957F2D)
        _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        if not self._same(letters, starts, lengths, one[which]):
            for place, raw in block:
                result[place] = self._whole(raw.decode())
            return
        heads = np.zeros(len(starts), dtype=bool)
        heads[first_chunk[:-1]] = True
        chunks = [
            (b"" if head else b" ") + joined[start:end]
            for start, end, head in zip(starts[one].tolist(), ends[one].tolist(), heads[one].tolist())
        ]
        known = self._known
        entries = list(map(known.get, chunks))
        if None in entries:
            fresh = [chunk for chunk, entry in zip(chunks, entries) if entry is None]
            encoded = [self._encoding.encode_ordinary(chunk.decode()) for chunk in fresh]
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            self._ids = np.concatenate((self._ids, np.fromiter((i for ids in encoded for i in ids), dtype="<u4")))
            self._lengths = np.concatenate((self._lengths, np.fromiter(map(len, encoded), dtype=np.int64)))
            entries = list(map(known.get, chunks))
        entries = np.array(entries, dtype=np.int64)[which]
        begins = np.cumsum(self._lengths) - self._lengths
        counts = self._lengths[entries]
        total = np.cumsum(counts)
        shift = begins[entries] - (total - counts)
        ids = self._ids[np.arange(total[-1]) + np.repeat(shift, counts)]
        bounds = np.concatenate(([0], total))[first_chunk]
        for number, (place, _) in enumerate(block):
            result[place] = ids[bounds[number] : bounds[number + 1]]

    @staticmethod
    def _same(letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray, like: np.ndarray) -> bool:
        """Whether each chunk has the very bytes of the chunk whose number ``like`` gives."""
        if (lengths != lengths[like]).any():
            return False
        inside = np.flatnonzero(letters != 32).astype(np.int32)
        moved = np.repeat((starts[like] - starts).astype(np.int32), lengths)
        return bool((letters[inside] == letters[inside + moved]).all())
