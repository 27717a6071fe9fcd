from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from papyra.llm.bpe import Encoder
from papyra.llm.packing import SumOfSquares, pack
from papyra.llm.token_counts import attribute, token_counts

ODD = [
    "a  b", "  a", "a \n b", "x\n y", "a\tb", " ", "", "a <|endoftext|> b", "foo \nbar\n", "é  ü  x", "a　 b",
    "a b c", "tail ", "tail\n", "x", "it's ok", "日本 語 text", "emoji 😀 x\x00 y", "a\x1c b", "l  m n",
    "word " * 3000 + "end", "1 22 333 4444", "Token = \"04dbebab91\" thhantou",
]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_encoder_equals_the_tokenizers_library(tokenizer):
    encoder = Encoder()
    for texts in (ODD, ODD[::-1], [ODD[4]]):
        expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids.tolist() for ids in encoder.encode(texts)] == expected


def packed(spark, rows, partitions=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(partitions)
    return pack(docs).collect()


def test_round_trip_and_padding(spark, tokenizer):
    texts = ODD + [" ".join(f"w{i}" for i in range(n)) for n in (5, 300, 341, 342, 700, 2000)] + [None]
    rows = [(i, text, "x") for i, text in enumerate(texts)]
    pieces = packed(spark, rows)
    sequences, whole = defaultdict(list), defaultdict(dict)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        whole[p.doc_id][p.start] = (ids, p.doc_tokens)
    for number, text, _ in rows:
        ids = [i for start in sorted(whole[number]) for i in whole[number][start][0]]
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert {n for _, n in whole[number].values()} == {len(ids)}
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024 and end & (end - 1) == 0


def test_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "a b", "x"), (3, "c", "x"), (3, "c", "x"), (3, None, None)]
    pieces = packed(spark, rows, 1)
    assert sorted((str(p.doc_id), p.length) for p in pieces) == [("3", 1), ("3", 2), ("3", 2), ("None", 3)]
    assert packed(spark, []) == []


def test_sum_of_squares_prefers_the_level_with_most_windows():
    rule = SumOfSquares(10, 0)
    assert [rule.place(6) for _ in range(3)] == [(0, 0), (1, 0), (2, 0)]
    sequence, offset = rule.place(4)
    assert offset == 6 and rule.counts[6] == 2
    # Three more windows at level 4 would cost more squares than filling one at 6.
    assert rule.place(4)[1] == 6


def test_attribution_rules():
    ends, bounds = np.array([2, 5, 9, 10]), np.array([0, 3, 3, 10])
    counts, crossing = attribute(ends, bounds, "first")
    assert counts.tolist() == [2, 0, 2] and crossing.tolist() == [1, 0, 0]
    counts, crossing = attribute(ends, bounds, "most")
    assert counts.tolist() == [1, 0, 3] and crossing.tolist() == [0, 0, 1]


def test_token_counts_of_fields(spark, tokenizer):
    rows = [(1, "a title", "first line\nsecond ñ line\n"), (2, None, "x"), (None, "t", None), (1, "", "日本\n語")]
    docs = spark.createDataFrame(rows, "doc_id long, title string, text string")
    for rule in ("first", "most"):
        found = token_counts(docs, ["title", "text"], rule=rule, section_break="\n").collect()
        assert sum(r.n_tokens for r in found) == sum(
            len(tokenizer.encode(f"{t or ''}\n\n{x or ''}", add_special_tokens=False).ids) for _, t, x in rows
        )
    assert [(r.field, r.section, r.start, r.stop) for r in found if r.doc_id == 1][:4] == [
        ("title", 0, 0, 9), ("text", 0, 9, 20), ("text", 1, 20, 34), ("text", 2, 34, 34),
    ]
    assert token_counts(docs.limit(0)).collect() == []


def counted_by_loop(rows, rule, tokenizer):
    """Every row of the token counts, by one look at each token's bytes."""
    sizes = Encoder().token_bytes
    for number, text in rows:
        raw = (text or "").encode()
        bounds, at = [0], 0
        pieces = raw.split(b"\n")
        for i, piece in enumerate(pieces):
            at += len(piece) + (i < len(pieces) - 1)
            bounds.append(at)
        tokens = [int(sizes[i]) for i in tokenizer.encode(text or "", add_special_tokens=False).ids]
        counts, crossing, start = [0] * len(pieces), [0] * len(pieces), 0
        for size in tokens:
            inside = [len(set(range(start, start + size)) & set(range(bounds[k], bounds[k + 1]))) for k in range(len(pieces))]
            held = [k for k, n in enumerate(inside) if n]
            owner = held[0] if rule == "first" else max(held, key=lambda k: (inside[k], -k))
            counts[owner] += 1
            crossing[owner] += len(held) > 1
            start += size
        points = [len(raw[:b].decode()) for b in bounds]
        for k in range(len(pieces)):
            yield number, "text", k, points[k], points[k + 1], counts[k], crossing[k], len(tokens)


@pytest.mark.parametrize("rule", ["first", "most"])
def test_token_counts_equal_a_loop(spark, tokenizer, rule):
    rows = [(i if i % 5 else None, text) for i, text in enumerate([*ODD, None, "", "\n\n\n  \n", "é\n\n日\n", "a\n\n\n\nb" * 20])]
    rows = [(i, text) for i, text in rows if text is None or len(text) < 2000]
    docs = spark.createDataFrame([(i, text, "x") for i, text in rows], "doc_id long, text string, section string")
    found = sorted(map(tuple, token_counts(docs.repartition(3), rule=rule).collect()), key=repr)
    assert found == sorted(counted_by_loop(rows, rule, tokenizer), key=repr)


def test_token_counts_of_a_very_long_text(spark, tokenizer):
    text = "some line of words\n" * 20_000
    rows = token_counts(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    total = len(tokenizer.encode(text, add_special_tokens=False).ids)
    assert len(rows) == 20_001 and sum(r.n_tokens for r in rows) == total == rows[0].doc_tokens
