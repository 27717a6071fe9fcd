"""Words, shingles and their hashes for a batch of texts, computed on whole byte arrays.

Words are runs of bytes other than ASCII white space, after A-Z are lower-cased. Hashes have 64
bits and depend on nothing but the bytes, so every task computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SHINGLE_WORDS = 5
_BLOCK_BYTES = 1 << 20
_SPACES = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public SplitMix64 generator: spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed))


_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(_SPACES)] = False
_BYTE = random_words(256, 1)
_BASE = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)


def blocks(texts: Sequence[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about a megabyte, lower-cased, each with the number of its first text."""
    first, block, size = 0, [], 0
    for number, text in enumerate(texts):
        raw = b"" if text is None else text.encode().lower()
        if block and size + len(raw) > _BLOCK_BYTES:
            yield first, block
            first, block, size = number, [], 0
        block.append(raw)
        size += len(raw)
    if block:
        yield first, block


def hash_words(raw: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``raw``, and the offsets at which each text's words begin."""
    joined = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    inside = _IS_WORD[joined]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
    starts, ends = edges[::2], edges[1::2]
    text_ends = np.cumsum([len(x) + 1 for x in raw])
    offsets = np.concatenate(([0], np.searchsorted(starts, text_ends)))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), offsets
    return byte_hashes(joined, starts, ends - starts), offsets


def byte_hashes(letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes; runs are given in order and have at least one byte."""
    powers = np.cumprod(np.full(lengths.max(), _BASE))
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum(), dtype=np.int32) - np.repeat(first.astype(np.int32), lengths)
    values = _BYTE[letters[np.repeat(starts.astype(np.int32), lengths) + place]] * powers[place]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct hashes of the ``n``-word shingles; of the whole sequence if it is shorter."""
    n = min(n, len(words))
    if not n:
        return words
    count = len(words) - n + 1
    total = np.full(count, np.uint64(n))
    for place in range(n):
        total = mix(total * _BASE + words[place : place + count])
    return np.unique(total)
