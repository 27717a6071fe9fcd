"""Numbers of the toxicity machine and of the quality classifier against plain loops."""

import math
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest

from papyra.llm import quality_classifier, toxicity

SIGMOID = lambda z: 1 / (1 + math.exp(-z))
LOGIT = lambda p: math.log(p) - math.log(1 - p)


def machine_score(text, bias, linear, factors):
    """One text, ``{term: count}``, by a loop over all pairs of its terms."""
    x = {term: 0.3 * math.log1p(count) for term, count in text.items()}
    z = bias + sum(linear[i] * x[i] for i in x)
    z += sum(float(np.dot(factors[i], factors[j])) * x[i] * x[j] for i in x for j in x if i < j)
    return SIGMOID(z)


def flat(texts):
    return (
        np.array([t for text in texts for t in sorted(text)], dtype=np.int64),
        np.array([text[t] for text in texts for t in sorted(text)], dtype=np.int64),
        np.concatenate(([0], np.cumsum(list(map(len, texts))))).astype(np.int64),
    )


def random_texts(random, terms, n):
    return [{int(t): int(random.integers(1, 9)) for t in random.choice(terms, random.integers(0, len(terms)), False)} for _ in range(n)]


def test_scores_equal_a_loop_over_pairs():
    random = np.random.default_rng(1)
    terms = np.array([2, 5, 9, 40, 77])
    linear, factors = random.normal(size=5), random.normal(size=(5, 3))
    texts = [{}, *random_texts(random, terms, 40)]
    found = toxicity.FactorizationMachine(terms, -0.7, linear, factors).scores(*flat(texts))
    by_term = dict(zip(terms.tolist(), linear)), dict(zip(terms.tolist(), factors))
    assert found == pytest.approx([machine_score(text, -0.7, *by_term) for text in texts], abs=1e-12)


def test_a_step_of_the_fit_equals_a_loop():
    random = np.random.default_rng(2)
    texts = [{i: 1 for i in range(6)}, *random_texts(random, np.arange(6), 11)]
    labels = np.array([1.0, 0, 0, 1, 0, 0, 0, 1, 0, 0, 1, 0])
    rate, shrink, weight = 0.1, 1e-3, 3.0
    machine = toxicity.fit(
        *flat(texts), labels, np.arange(6), rank=2, epochs=1, steps=1, rate=rate, shrink=shrink, toxic_weight=weight,
        batch=12, seed=5, sparse=0.0,
    )
    factors = np.random.default_rng(5).normal(0, 0.2, (2, 6)).T
    bias = LOGIT(labels.mean())
    slope, slopes, total = np.zeros(6), np.zeros((6, 2)), 0.0
    for text, label in zip(texts, labels):
        miss = (machine_score(text, bias, np.zeros(6), factors) - label) * (weight if label else 1)
        total += miss
        x = {term: 0.3 * math.log1p(count) for term, count in text.items()}
        for i in x:
            slope[i] += miss * x[i]
            for j in x:
                if i != j:
                    slopes[i] += miss * x[i] * x[j] * factors[j]
    slopes += shrink * factors
    assert machine.bias == pytest.approx(bias - rate * total / math.sqrt(1e-8 + total**2))
    assert machine.linear == pytest.approx(-rate * slope / np.sqrt(0.1 + slope**2))
    assert machine.factors == pytest.approx(factors - rate * slopes / np.sqrt(0.1 + slopes**2))


def weights_by_loop(paths):
    """Global rate and prior weights from ``(host, path, n, s)``."""
    hosts = defaultdict(lambda: [0, 0.0])
    for host, _, n, s in paths:
        hosts[host][0] += n
        hosts[host][1] += s
    total = sum(n for n, _ in hosts.values())
    rate = sum(s for _, s in hosts.values()) / total

    def weight(excess, room):
        return 1 / min(max(excess / room if room > 0 else 0.0, 1e-4), 0.99) - 1

    spread = sum(n * (s / n - rate) ** 2 for n, s in hosts.values()) / (rate * (1 - rate))
    free = len(hosts) - 1
    host = weight(spread - free, total - sum(n * n for n, _ in hosts.values()) / total - free)
    spread = room = 0.0
    for name, _, n, s in paths:
        n_host, s_host = hosts[name]
        centre = (s_host + host * rate) / (n_host + host)
        spread += n * (s / n - centre) ** 2 / (centre * (1 - centre))
        room += n * n / n_host
    free = len(paths) - len(hosts)
    return rate, host, weight(spread - free, total - room - free), hosts


PATHS = [
    ("a", "x", 90, 80.5), ("a", "y", 40, 8.0), ("b", "x", 30, 29.0), ("b", "z", 5, 0.5), ("c", "x", 1, 1.0),
    ("d", "x", 60, 6.0), ("d", "y", 55, 50.0), ("e", "", 2, 1.0),
]


def test_shrinkage_equals_a_loop(spark):
    for paths in (PATHS, PATHS[:1], [(h, p, 10, 5.0) for h, p, *_ in PATHS]):
        found, _ = quality_classifier.shrinkage(spark.createDataFrame(paths, "host string, path string, n long, s double"))
        assert (found.rate, found.host, found.path) == pytest.approx(weights_by_loop(paths)[:3], rel=1e-9)


def test_classifier_rates_and_scores_equal_a_loop(spark):
    import random

    rng = random.Random(4)
    rows, labels = [], {}
    for i in range(240):
        good = rng.random() < (0.9 if i % 3 else 0.3)
        words = [f"w{rng.randrange(400 if good else 12)}" for _ in range(rng.randrange(5, 60))]
        rows.append((i, " ".join(words), f"l{i % 2}", f"s{i % 3}"))
        if i % 4 != 1:
            labels[i] = int(good)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    marks = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    found = {r.doc_id: r for r in quality_classifier.classify(docs, marks).collect()}
    used = {i: label for i, label in labels.items() if crc32(str(i).encode()) % 4 != 2}
    prior = sum(used.values()) / len(used)
    r = {i: used.get(i, SIGMOID(found[i].evidence + LOGIT(prior))) for i in found}
    sums = defaultdict(lambda: [0, 0.0])
    for i, _, path, host in rows:
        sums[host, path][0] += 1
        sums[host, path][1] += r[i]
    rate, host_weight, path_weight, hosts = weights_by_loop([(*site, *both) for site, both in sums.items()])
    for i, _, path, host in rows:
        (n, s), (n_host, s_host) = sums[host, path], hosts[host]
        host_rate = (s_host - r[i] + host_weight * rate) / (n_host - 1 + host_weight)
        path_rate = (s - r[i] + path_weight * host_rate) / (n - 1 + path_weight)
        score = SIGMOID(found[i].evidence + LOGIT(path_rate))
        assert (found[i].host_rate, found[i].path_rate, found[i].score) == pytest.approx((host_rate, path_rate, score), rel=1e-6)
        assert found[i].kept == (found[i].score >= 0.5)
