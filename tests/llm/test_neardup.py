import random

import numpy as np
from pyspark.sql import functions as F

from papyra.llm.components import components
from papyra.llm.neardup import near_duplicates
from papyra.llm.setsketch import REGISTERS, likely_similarity, merge, sketch
from papyra.llm.words import hash_words, mix, shingle_hashes

SCHEMA = "doc_id long, text string"


def brute_force(rows):
    """``doc_id -> (n_shingles, component)`` by comparing all pairs."""
    sets = {}
    for number, text in rows:
        words = bytes((text or "").encode()).lower().split()
        if len(words) < 5:
            sets[number] = {tuple(words)} if words else set()
        else:
            sets[number] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    parent = {n: n for n in sets}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    numbers = sorted(sets)
    for i, a in enumerate(numbers):
        for b in numbers[:i]:
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if union and 100 * both >= 75 * union:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {n: (len(sets[n]), root(n)) for n in numbers}


def families(seed, groups=12, copies=9):
    """Texts with exact copies, and copies with more and more words changed."""
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((8, 40, 120)))]
        for copy in range(copies):
            changed = list(words)
            for _ in range(copy * len(words) // 80):
                changed[rng.randrange(len(words))] = f"x{rng.randrange(4000)}"
            rows.append(" ".join(changed))
            if copy % 4 == 0:
                rows.append("  ".join(changed).upper())
    rng.shuffle(rows)
    return list(enumerate(rows, start=5))


def test_equals_brute_force(spark):
    rows = families(1) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "ONE\ttwo"), (1005, "a b c d e " * 900)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    expected = brute_force(rows)
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_hot_family_without_a_common_centre(spark):
    """Neighbours in a chain are linked, ends are not; many members share buckets."""
    words = [f"w{i}" for i in range(60)]
    rows = []
    for step in range(40):
        changed = list(words)
        changed[step] = f"x{step}"
        words = changed if step % 2 else words
        rows.append((step, " ".join(changed)))
    found = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {n: c for n, (_, c) in brute_force(rows).items()}


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    rows = [(2**60 + 1, "a b c d e f", 1), (2**60 + 1, "a b c d e f", 2), (None, "a b c d e f", 3), (7, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int").withColumn("n", F.lit(1)).withColumn("id", F.lit("z"))
    found = sorted(map(tuple, near_duplicates(docs).collect()), key=str)
    big = 2**60 + 1
    assert found == sorted([(big, 2, big, True), (big, 2, big, True), (None, 2, None, True), (7, 0, 7, True)], key=str)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sketches_merge_and_estimate():
    a, b = mix(np.arange(1, 1001, dtype=np.uint64)), mix(np.arange(151, 1151, dtype=np.uint64))
    assert merge(sketch(a), sketch(b)) == sketch(np.union1d(a, b))
    x, y = (np.frombuffer(sketch(s), np.uint8) for s in (a, b))
    larger, smaller = np.array([(x > y).sum()]), np.array([(x < y).sum()])
    n = np.array([1000.0])
    guess = likely_similarity(larger, REGISTERS - larger - smaller, smaller, n, n)[0]
    assert abs(guess - 850 / 1150) < 0.12


def test_words_are_split_at_ascii_space_only():
    words, offsets = hash_words(["a\x0bb c\x1dd".encode(), b"", b" a "])
    assert np.diff(offsets).tolist() == [2, 0, 1] and words[0] == words[2]
    assert len(shingle_hashes(words[:0])) == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)]
    parent = {n: n for pair in links for n in pair}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert {r.id: r.component for r in found} == {n: root(n) for n in linked} and len(found) == len(linked)
