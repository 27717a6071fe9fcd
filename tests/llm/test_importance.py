import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from papyra.llm.importance import bit_sliced_weights, bucket_gains, gain_planes, resample

DOCS = "doc_id long, text string, weight string"
LONG = " ".join(f"word{i % 700} The tail" for i in range(9000))


def features(text, most):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, buckets=10_000, percent=10, least=20, most=1):
    bucket = lambda feature: crc32(feature.encode()) % buckets
    s = Counter(bucket(f) for _, text in docs for f in features(text, most)[1])
    t = Counter(bucket(f) for text in target for f in features(text, most)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        for b in s
    }
    rows = []
    for number, text in docs:
        n_words, found = features(text, most)
        name = f"2024:{'' if number is None else number}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        weight = sum(gain[bucket(f)] for f in found)
        rows.append([number, len(found), weight, weight + noise, n_words >= least])
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = {id(r): i + 1 for i, r in enumerate(fit[: percent * len(fit) // 100])}
    return sorted((tuple(r[:4]) + (ranks.get(id(r)),) for r in rows), key=repr)


def drawn(spark, docs, target, partitions=3, **options):
    given = spark.createDataFrame([(i, t, "x") for i, t in docs], DOCS).repartition(partitions)
    other = spark.createDataFrame([(t,) for t in target], "text string")
    rows = resample(given, other, **options).select("doc_id", "n_features", "weight", "score", "rank").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture(scope="module")
def docs():
    texts = [" ".join(f"w{(i * k) % 37} The É{i}" for k in range(5 + i % 9)) for i in range(80)]
    edge = [None, "", "one", "a\x00b,C", LONG, texts[0], texts[0], "日本 語 " * 12]
    return [(i, text) for i, text in enumerate(texts + edge)] + [(None, texts[3]), (7, texts[7])]


def test_draw_equals_brute_force(spark, docs):
    target = ["w1 w2 w3 the THE", "É5 語", None, ""]
    assert drawn(spark, docs, target) == brute(docs, target)
    assert drawn(spark, docs, target, percent=63, min_words=9, max_words=3, buckets=97) == brute(
        docs, target, 97, 63, 9, 3
    )


def test_empty_tables(spark, docs):
    assert drawn(spark, [], ["a b"]) == []
    assert drawn(spark, docs, []) == brute(docs, [])


def test_copies_of_one_row_are_all_ranked(spark):
    text = " ".join(map(str, range(30)))
    found = drawn(spark, [(5, text)] * 200 + [(6, text)], ["1 2"], percent=50)
    assert sorted(r[4] for r in found if r[4]) == list(range(1, 101))


def test_text_ids_beside_columns_named_like_results(spark):
    given = spark.createDataFrame([("b", "1 2", 1, 2), ("a", "1 2", 1, 2)], "key string, text string, score int, id int")
    found = resample(given, given, id_col="key", percent=100, min_words=1)
    assert found.columns[0] == "key" and {r.key for r in found.collect()} == {"a", "b"}
    assert sorted(r["rank"] for r in found.collect()) == [1, 2]


def test_bit_planes_give_exact_sums():
    rng = np.random.default_rng(5)
    for buckets in (1, 63, 64, 65, 1000):
        gains = rng.integers(-9000, 9000, buckets)
        documents = [rng.integers(0, buckets, n) for n in (0, 1, 7, 300, 5000)]
        planes = gain_planes(gains)
        assert bit_sliced_weights(documents, planes, buckets).tolist() == [int(gains[d].sum()) for d in documents]
    assert bit_sliced_weights([np.zeros(3, int)], gain_planes(np.zeros(1, int)), 1).tolist() == [0]


def test_gains_of_unseen_buckets(spark):
    docs = spark.createDataFrame([("a a b",)], "text string")
    gains = bucket_gains(docs, docs.where(F.lit(False)), buckets=50)
    assert gains[crc32(b"a") % 50] < gains[crc32(b"b") % 50] < gains.max()
