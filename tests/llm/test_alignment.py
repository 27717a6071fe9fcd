import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from papyra.llm import alignment, queries
from papyra.llm.alignment import align, common_ends, with_support
from papyra.llm.pieces import decode_pieces, encode_pieces, piece_model

TEXTS = [
    None, "", " ", "  a", "a  b", "▁x a▁", "<s> <unk> <0x41> <|endoftext|>", "a\x00b\r\n\tc", "日本 語 😀",
    "ÀÉ é ﬁ ﻿ � \U000e0001", "word " * 3000 + "end", "a" * 5000, "it's 12345 {}[]();", "tail\n", "\n\n  \n",
    "clever tokens tokenization", "clever tokens tokenization",
]
SHA = lambda text: hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("ab ▁theを\n\té<>0x4", max_size=60)))
def test_encoding_equals_the_library(library, text):
    model = piece_model()
    ids = model.encode([text])[0]
    assert ids.tolist() == library.encode(text)
    assert model.decode(ids) == library.decode(ids.tolist())


@settings(max_examples=400, deadline=None)
@given(st.text("ab ▁th\n\té<>", max_size=80), st.integers(1, 9))
def test_encoding_in_parts_equals_the_library(library, text, part):
    encoder = alignment._vocabularies()._encoders[1]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(alignment, "_PART", part)
        assert encoder.encode([text])[0].tolist() == library.encode(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999), st.sampled_from([1, 2, 259, 28705])), max_size=9))
def test_decoding_any_ids_equals_the_library(library, ids):
    assert piece_model().decode(np.array(ids, dtype=np.int64)) == library.decode(ids)


def test_whole_table_equals_the_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.QUERIES["op12_sentencepiece"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = library.encode(texts[row.doc_id] or "")
        assert tuple(row)[1:] == (len(ids), SHA(",".join(map(str, ids))), SHA(library.decode(ids)))


def test_rows_of_encoding_and_decoding(spark, library):
    rows = [(str(i % 5) if i else None, text, i) for i, text in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, ids int").repartition(3)
    found = decode_pieces(encode_pieces(docs))
    assert found.columns == ["doc_id", "ids", "text"]
    expected = [(number, library.encode(text or ""), text) for number, text, _ in rows]
    expected = sorted(repr((number, ids, library.decode(ids))) for number, ids, _ in expected)
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected
    assert encode_pieces(docs.where("false")).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 1318])], "doc_id int, ids array<int>")
    assert [r.text for r in decode_pieces(odd).orderBy("doc_id").collect()] == ["", "", "x"]


def aligned_by_sets(text, tokenizer, library):
    """Both id lists, and the ends they share, by plain sets; nothing where the bytes differ."""
    if not text:
        return [], [], []
    letters = {c: b for b, c in byte_letters().items()}
    a = tokenizer.encode(" " + text, add_special_tokens=False)
    a_bytes = [bytes(letters[c] for c in token) for token in a.tokens]
    b = library.encode(text)
    b_bytes = [
        bytes([int(library.id_to_piece(i)[1:-1], 16)]) if library.is_byte(i)
        else library.id_to_piece(i).replace("▁", " ").encode() for i in b
    ]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], [], []
    ends = lambda tokens: {end: i for i, end in enumerate(np.cumsum([len(t) for t in tokens]).tolist())}
    x, y = ends(a_bytes), ends(b_bytes)
    return a.ids, b, [(x[end], y[end]) for end in sorted(x.keys() & y.keys())]


def byte_letters():
    """The published characters for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


def expected_rows(texts, tokenizer, library):
    found = [aligned_by_sets(text, tokenizer, library) for text in texts]
    counts = Counter((a[i], b[j]) for a, b, ends in found for i, j in ends)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = []
    for a, b, ends in found:
        links = [(a[i], b[j]) for i, j in ends]
        bounds = [(-1, -1)] + ends
        groups = ";".join(
            ",".join(map(str, a[i + 1 : k + 1])) + "|" + ",".join(map(str, b[j + 1 : m + 1]))
            for (i, j), (k, m) in zip(bounds, ends)
        )
        rows.append((
            len(a), len(b), len(ends), len(links), sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links), SHA(groups) if a else "",
        ))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_brute_force_on_the_table(spark, sf_dir, tokenizer, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    found = queries.QUERIES["op13_tokenizer_alignment"](spark, sf_dir).orderBy("doc_id").select(COLUMNS).collect()
    assert list(map(tuple, found)) == expected_rows([d.text for d in docs], tokenizer, library)


def test_query_equals_brute_force_on_odd_texts(spark, tmp_path, tokenizer, library):
    rows = [(i if i % 4 else None, text, "x") for i, text in enumerate(TEXTS)]
    given_docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string").repartition(3)
    given_docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op13_tokenizer_alignment"](spark, str(tmp_path))
    expected = expected_rows(TEXTS, tokenizer, library)
    assert sorted(map(tuple, found.select(COLUMNS).collect())) == sorted(expected)
    assert sorted(repr(r.doc_id) for r in found.collect()) == sorted(repr(r[0]) for r in rows)


def test_rare_pairs_are_looked_up_by_shuffle(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    aligned = align(docs).select("doc_id", "links")
    often = sorted(map(tuple, with_support(aligned).collect()))
    monkeypatch.setattr("papyra.llm.alignment.FREQUENT", 100)
    assert sorted(map(tuple, with_support(aligned).collect())) == often
    assert with_support(aligned.where(F.lit(False))).count() == 0


def test_lockstep_equals_sets():
    rng = np.random.default_rng(3)
    documents = []
    for total in (0, 1, 2, 9, 40, 1000, 3):
        cut = lambda: np.append(np.flatnonzero(rng.random(max(total - 1, 0)) < 0.4) + 1, total)[: max(total, 0)]
        documents.append((cut(), cut()) if total else (np.zeros(0, int), np.zeros(0, int)))
    found = [[] for _ in documents]
    for document, a, b in zip(*common_ends(*zip(*documents))):
        found[document].append((a, b))
    for (a, b), links in zip(documents, found):
        both = sorted(set(a.tolist()) & set(b.tolist()))
        assert links == [(a.tolist().index(end), b.tolist().index(end)) for end in both]
