"""Hashed terms of texts: lower-cased words and their beginnings."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from papyra.llm.words import byte_hashes

BITS = 18
PREFIXES = (4, 5, 6, 7, 8)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True


def hashed_terms(
    raw: Sequence[bytes], bits: int = BITS, wanted: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(terms, counts, offsets)``: the distinct hashed terms of each text and their counts.

    ``raw`` are texts in lower case. A word is a run of ASCII letters and non-ASCII bytes; its terms
    are itself and its beginnings of so many bytes as ``PREFIXES`` has, each marked with its kind.
    ``wanted`` tells for each hashed term whether it is looked for.
    """
    letters = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    inside = _LETTER[letters]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    text_ends = np.cumsum([len(x) + 1 for x in raw])
    owner = np.searchsorted(text_ends, starts, side="right")
    keys = []

    def add(hashes: np.ndarray, owners: np.ndarray) -> None:
        found = hashes >> np.uint64(64 - bits)
        if wanted is not None:
            chosen = wanted[found]
            found, owners = found[chosen], owners[chosen]
        keys.append((owners.astype(np.uint64) << np.uint64(bits)) | found)

    if len(starts):
        add(byte_hashes(letters, starts, lengths), owner)
    for size in PREFIXES:
        long = lengths > size
        if long.any():
            hashes = byte_hashes(letters, starts[long], np.full(long.sum(), size))
            add(hashes * np.uint64(2 * size + 1), owner[long])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(raw) + 1, np.int64)
    both, counts = np.unique(np.concatenate(keys), return_counts=True)
    owners = (both >> np.uint64(bits)).astype(np.int64)
    terms = (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    return terms, counts, np.searchsorted(owners, np.arange(len(raw) + 1))
