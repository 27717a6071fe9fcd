"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.llm.labels import agreed_labels
from papyra.llm.terms import BITS, hashed_terms
from papyra.llm.words import blocks
from papyra.sources.sizes import can_broadcast

# Labelled rows the machine is fitted on at most, those with the least hash of their id. Terms are
# counted on all labelled rows.
TRAINING_ROWS = 20_000
# A term takes part if at least so many labelled texts hold it. How it stands in toxic texts by
# itself does not matter, since it may only count beside another one.
LEAST_TEXTS = 4
THRESHOLD = 0.3
_FOLDS, _HELD_OUT = 4, 2


@dataclass
class FactorizationMachine:
    """``bias + linear . x + sum over pairs of (v_i . v_j) x_i x_j``, as a probability."""

    terms: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    @property
    def wanted(self) -> np.ndarray:
        mask = np.zeros(1 << BITS, dtype=bool)
        mask[self.terms] = True
        return mask

    def scores(self, terms: np.ndarray, counts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of texts that hold ``terms`` (each one of ``self.terms``)."""
        place = np.searchsorted(self.terms, terms)
        n, rank = len(offsets) - 1, self.factors.shape[1]
        owner = np.repeat(np.arange(n), np.diff(offsets))
        x = values(counts)
        each = self.factors[place] * x[:, None]
        sums = np.stack([np.bincount(owner, each[:, f], n) for f in range(rank)], axis=1)
        squares = np.bincount(owner, (each**2).sum(axis=1), n)
        z = self.bias + np.bincount(owner, self.linear[place] * x, n) + ((sums**2).sum(axis=1) - squares) / 2
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def values(counts: np.ndarray) -> np.ndarray:
    return 0.3 * np.log1p(counts)


def fit(
    terms: np.ndarray, counts: np.ndarray, offsets: np.ndarray, labels: np.ndarray, chosen: np.ndarray,
    rank: int = 4, epochs: int = 15, steps: int = 3000, rate: float = 0.1, shrink: float = 1e-3,
    toxic_weight: float = 3.0, batch: int = 64, seed: int = 0, sparse: float = 0.05, spread: float = 0.2,
) -> FactorizationMachine:
    """Logistic loss, AdaGrad steps over shuffled batches; ``terms`` are numbers into ``chosen``.

    The bias starts from the share of label 1, of which each row counts ``toxic_weight`` times,
    since a missed one costs more. There are ``epochs`` rounds at least, and as many
    more as make up ``steps``, so that few rows are learned as well as many. Each step also takes
    weights towards zero by ``sparse``, so that of many terms those that tell nothing drop out.
    """
    random = np.random.default_rng(seed)
    linear, factors = np.zeros(len(chosen)), random.normal(0, spread, (rank, len(chosen)))
    share = min(max(labels.mean(), 1e-6), 1 - 1e-6) if len(labels) else 0.5
    bias, past_bias = float(np.log(share / (1 - share))), 1e-8
    epochs = max(epochs, -(-steps // max(1, -(-len(labels) // batch))))
    # First steps are not larger than those for gradients of 0.3.
    past_linear, past_factors = np.full(len(chosen), 0.1), np.full(factors.shape, 0.1)
    order = np.arange(len(labels))

    def stepped(weight: np.ndarray, slope: np.ndarray, past: np.ndarray) -> np.ndarray:
        size = rate / np.sqrt(past)
        moved = weight - size * slope
        return np.sign(moved) * np.maximum(np.abs(moved) - size * sparse, 0)

    for _ in range(epochs):
        random.shuffle(order)
        for start in range(0, len(order), batch):
            rows = order[start : start + batch]
            sizes = offsets[rows + 1] - offsets[rows]
            owner = np.repeat(np.arange(len(rows)), sizes)
            at = np.repeat(offsets[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            term, x = terms[at], values(counts[at])
            each = factors[:, term] * x
            sums = np.stack([np.bincount(owner, one, len(rows)) for one in each])
            squares = np.bincount(owner, (each**2).sum(axis=0), len(rows))
            z = bias + np.bincount(owner, linear[term] * x, len(rows)) + ((sums**2).sum(axis=0) - squares) / 2
            miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[rows]
            miss *= np.where(labels[rows] == 1, toxic_weight, 1.0)
            pull = miss[owner] * x
            used, which = np.unique(term, return_inverse=True)
            slope = np.bincount(which, pull, len(used)) + shrink * linear[used]
            past_linear[used] += slope**2
            linear[used] = stepped(linear[used], slope, past_linear[used])
            for f in range(rank):
                slope = np.bincount(which, pull * (sums[f][owner] - each[f]), len(used)) + shrink * factors[f, used]
                past_factors[f, used] += slope**2
                factors[f, used] = stepped(factors[f, used], slope, past_factors[f, used])
            past_bias += miss.sum() ** 2
            bias -= rate * miss.sum() / np.sqrt(past_bias)
    left = (linear != 0) | (factors != 0).any(axis=0)
    return FactorizationMachine(chosen[left], bias, linear[left], factors[:, left].T)


def _texts_with(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts that hold each term, added up over a batch."""
    for batch in batches:
        texts = np.zeros(1 << BITS, np.int64)
        for _, raw in blocks(list(batch["text"])):
            texts += np.bincount(hashed_terms(raw)[0], minlength=1 << BITS)
        held = np.flatnonzero(texts)
        yield pd.DataFrame({"term": held, "texts": texts[held]})


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", training_rows: int = TRAINING_ROWS, rank: int = 4,
) -> FactorizationMachine:
    """A machine learned from the labelled rows outside the held-out fold.

    Terms of fewer than ``LEAST_TEXTS`` labelled texts are left out by a grouped count; what comes
    to the driver is bounded by the ``2 ** BITS`` hashed terms. The machine is then fitted to all
    other terms of at most ``training_rows`` labelled texts. Rows without id, text or a label of 0 or 1 teach
    nothing, nor do ids with both labels; without labels of both classes every text gets the share of toxic labels (0 if none).
    """
    marks = agreed_labels(labels, id_col, label_col, "toxic")
    marks = marks.where(fold(F.col("id")) != _HELD_OUT)
    sizes = {row["toxic"]: row["count"] for row in marks.groupBy("toxic").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    nothing = np.zeros(0, dtype=np.int64)
    if not n_toxic or not n_other:
        share = n_toxic / max(1, n_toxic + n_other)
        odds = np.log(max(share, 1e-12)) - np.log(max(1 - share, 1e-12))
        return FactorizationMachine(nothing, float(odds), np.zeros(0), np.zeros((0, rank)))
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    given = given.where("text is not null")
    near = F.broadcast(marks) if can_broadcast(marks) else marks
    counted = (
        given.join(near, "id").select("text").mapInPandas(_texts_with, "term long, texts long")
        .groupBy("term").agg(F.sum("texts").alias("texts"))
    ).where(F.col("texts") >= LEAST_TEXTS)
    chosen = np.sort(counted.select("term").toArrow()["term"].to_numpy())
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[chosen] = True
    sample = marks.orderBy(F.xxhash64("id"), "id").limit(training_rows)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, labels_of = batch["id"].to_numpy(), batch["toxic"].to_numpy()
            for first, raw in blocks(list(batch["text"])):
                terms, counts, offsets = hashed_terms(raw, wanted=wanted)
                cut = offsets[1:-1]
                yield pd.DataFrame({
                    "id": ids[first : first + len(raw)], "toxic": labels_of[first : first + len(raw)],
                    "terms": np.split(terms.astype(np.int32), cut), "counts": np.split(counts.astype(np.int32), cut),
                })

    rows = given.join(F.broadcast(sample), "id").select("id", "toxic", "text").mapInPandas(
        features, "id long, toxic int, terms array<int>, counts array<int>"
    ).toArrow()
    rows = rows.take(pc.sort_indices(rows["id"])).combine_chunks()
    lengths = pc.list_value_length(rows["terms"]).to_numpy()
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    terms = np.searchsorted(chosen, pc.list_flatten(rows["terms"]).to_numpy())
    counts = pc.list_flatten(rows["counts"]).to_numpy()
    return fit(terms, counts, offsets, rows["toxic"].to_numpy().astype(np.float64), chosen, rank)


def fold(id_column):
    """Which of four folds an id is in: the checksum of its decimal digits."""
    return F.crc32(id_column.cast("string").cast("binary")) % _FOLDS


def score(
    docs: DataFrame, machine: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id_col, held_out, score, predicted`` for each row of ``docs``, from its text alone.

    Null and empty texts have no terms and get the machine's bias; null and repeated ids are kept,
    each row for itself (a null id is not held out).
    """
    wanted = machine.wanted

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["id"]
            for first, raw in blocks(list(batch["text"])):
                found = machine.scores(*hashed_terms(raw, wanted=wanted))
                yield pd.DataFrame({"id": ids.iloc[first : first + len(raw)].to_numpy(), "score": found})

    # Ids go through pandas as text, since it keeps no integers beside nulls.
    given = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = given.mapInPandas(run, "id string, score double").withColumn(
        "id", F.col("id").cast(docs.schema[id_col].dataType)
    )
    return scored.select(
        F.col("id").alias(id_col), F.coalesce(fold(F.col("id")) == _HELD_OUT, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
