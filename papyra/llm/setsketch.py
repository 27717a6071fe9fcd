"""SetSketch registers: exponentially spaced truncated minima of hashed sets.

An element's value for one register is exponentially distributed; the register keeps the least
value over the set, on a logarithmic scale with base ``BASE``, cut to 0..255. Registers of a union
are the larger of the parts' registers, so sketches merge; registers of similar sets are often
equal, so they can be banded; and how many are larger, equal or smaller gives the similarity of two
sets of known sizes by maximum likelihood.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from papyra.llm.words import random_words

BANDS = 30
BAND_ROWS = 5
REGISTERS = BANDS * BAND_ROWS
BASE = 1.1
RATE = 20.0
_FACTORS = random_words(REGISTERS, 7) | np.uint64(1)
_CHUNK = 2048


def sketch(elements: np.ndarray) -> bytes:
    """One byte for each register; of an empty set, zeros."""
    if not len(elements):
        return bytes(REGISTERS)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max)
    for start in range(0, len(elements), _CHUNK):
        values = elements[start : start + _CHUNK, None] * _FACTORS[None, :]
        np.minimum(least, values.min(axis=0), out=least)
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(value) / math.log(BASE)), 0, 255).astype(np.uint8).tobytes()


def merge(left: bytes, right: bytes) -> bytes:
    """Sketch of the union of two sets."""
    return np.maximum(np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)).tobytes()


def band_keys(registers: Column) -> Column:
    """A 64-bit key for each band of ``BAND_ROWS`` registers."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.xxhash64(band, F.substring(registers, band * BAND_ROWS + 1, F.lit(BAND_ROWS))),
    )


def _larger(x: np.ndarray) -> np.ndarray:
    """Chance that one register is larger, for a share ``x`` of the union only on that side."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


def likely_similarity(
    larger: np.ndarray, equal: np.ndarray, smaller: np.ndarray, left: np.ndarray, right: np.ndarray
) -> np.ndarray:
    """Jaccard similarity of largest likelihood, given register counts and both set sizes.

    The likelihood has a single peak, which a ternary search finds for all pairs at once.
    """
    u, v = left / (left + right), right / (left + right)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def likelihood(j: np.ndarray) -> np.ndarray:
        more, less = _larger(u - v * j), _larger(v - u * j)
        tiny = 1e-12
        return (
            larger * np.log(np.maximum(more, tiny)) + smaller * np.log(np.maximum(less, tiny))
            + equal * np.log(np.maximum(1 - more - less, tiny))
        )

    for _ in range(20):
        third = (high - low) / 3
        left_better = likelihood(low + third) > likelihood(high - third)
        low, high = np.where(left_better, low, low + third), np.where(left_better, high - third, high)
    return (low + high) / 2


def _similarity(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    x = np.frombuffer(b"".join(a), np.uint8).reshape(len(a), REGISTERS)
    y = np.frombuffer(b"".join(b), np.uint8).reshape(len(b), REGISTERS)
    larger, smaller = (x > y).sum(axis=1), (x < y).sum(axis=1)
    return pd.Series(likely_similarity(
        larger, REGISTERS - larger - smaller, smaller,
        n_a.to_numpy(np.float64), n_b.to_numpy(np.float64),
    ))


def estimated_similarity(a: Column, b: Column, n_a: Column, n_b: Column) -> Column:
    """Joint maximum-likelihood estimate for pairs of sketches of sets of sizes ``n_a``, ``n_b``."""
    return F.pandas_udf(_similarity, "double")(a, b, n_a, n_b)
