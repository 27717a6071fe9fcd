"""Text functions against plain Python."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from papyra.functions import fixed_values as fixed
from papyra.functions import text as x


def evaluate(spark, texts, *columns):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    return [r[1:] for r in sorted(df.select("i", *columns).collect())]


def python_tokens(text):
    text = "".join(" " if c == "/" else c for c in text.lower() if c not in fixed.REMOVED_CHARACTERS)
    for separator in ("--", *"!@#$&[]{}\"*«»‘„"):
        text = text.replace(separator, " ")
    return [w for w in text.split() if len(w) > 1 and w not in fixed.STOP_WORDS and is_token(w)]


def is_token(word):
    """A year first, or a letter a-z and then nothing but letters, digits, "_" and "-"."""
    if word[:2] in ("19", "20") and len(word) >= 4 and all(c in "0123456789" for c in word[2:4]):
        return True
    return word[0] in "abcdefghijklmnopqrstuvwxyz" and all(c.isalnum() or c in "_-" for c in word)


ALPHABET = "aB1-9 20./'\"!()é\nthe_\u00a0\u2009\u202f\u3000"


def test_unicode_spaces_part_words_and_sentences(spark):
    for space in "\u00a0\u2009\u202f\u3000\x0b\x85":
        texts = [f"covid{space}vaccine", f"One thing here.{space}Two things here. Three."]
        got = evaluate(
            spark, texts, x.tokenize("s").alias("t"), x.num_words("s").alias("w"),
            x.num_sentences("s").alias("n"), x.clean_text("s").alias("c"),
        )
        assert got[0][:3] == (["covid", "vaccine"], 2, 1) and got[0][3] == "covid vaccine"
        assert got[1][1:3] == (7, 3)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=1, max_size=40))
def test_tokens_and_counts(spark, texts):
    tokens = x.tokenize("s")
    for text, (got, counts) in zip(
        texts, evaluate(spark, texts, tokens.alias("t"), x.term_counts(tokens).alias("c"))
    ):
        assert got == python_tokens(text)
        assert {(c["term"], c["tf"]) for c in counts} == set(Counter(got).items())


def test_token_rules(spark):
    texts = [
        "2019-nCoV covid-19 1999 2020a IL-6 naïve a_b x", "19 6-il a+b -x β-lactam 日本 2100 20ab",
        "It's (SARS)/MERS; \"flu\" the cannot", None, "",
    ]
    got = [r[0] for r in evaluate(spark, texts, x.tokenize("s").alias("t"))]
    assert got == [
        ["2019-ncov", "covid-19", "1999", "2020a", "il-6", "naïve", "a_b"], [],
        ["sars", "mers", "flu"], [], [],
    ]


def test_long_runs_of_separators(spark):
    text = "alpha " + "!@ --" * 100_000 + " beta" + "." * 100_000
    assert evaluate(spark, [text], x.tokenize("s").alias("t"))[0][0] == ["alpha", "beta"]


def test_patterns_of_plain_words(spark):
    """Words of a pattern are found and removed as by the pattern: the leftmost first, and once."""
    texts = ["Abstracthion, Abstract", "AbsSummarytract", "thithionon", "abstract Sum mary", "Summmary ac", "", None]
    for pattern, words in (
        ("(Abstract|Summary|thion)", True), ("thion|Abstract", True), ("Sum+ary", False), ("(a|b)(c|d)", False),
        ("(Abstract|Sum.ary)", False), ("a|b?c", False),
    ):
        assert bool(x.plain_words(pattern)) is words
        removed, found = x.remove_matches("s", pattern), x.matches("s", pattern)
        assert evaluate(spark, texts, removed.alias("r"), found.alias("f")) == [
            (None, None) if t is None else (re.sub(pattern, "", t), bool(re.search(pattern, t))) for t in texts
        ]


def test_own_stop_words(spark):
    got = evaluate(spark, ["the flu the"], x.tokenize("s", ("flu",)).alias("t"))
    assert got[0][0] == ["the", "the"]
    assert evaluate(spark, ["the flu"], x.tokenize("s", ()).alias("t"))[0][0] == ["the", "flu"]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text("abé ", max_size=12)), min_size=1, max_size=30))
def test_shorten(spark, texts):
    for text, (got,) in zip(texts, evaluate(spark, texts, x.shorten("s", 5).alias("t"))):
        text = text or ""
        assert got == (text[:5] + "..." if len(text) > 5 else text)


def test_doi_url(spark):
    texts = [None, "", "doi.org/10.1/a", "10.1/a"]
    got = [r[0] for r in evaluate(spark, texts, x.doi_url("s").alias("t"))]
    assert got == ["#", "#", "http://doi.org/10.1/a", "http://doi.org/10.1/a"]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("aB. !\n?", max_size=30), min_size=1, max_size=40))
def test_sentences(spark, texts):
    pattern = re.compile(r"(\S.+?[.!?])(?=\s+|$)|(\S.+?)(?=[\n]|$)")
    columns = x.num_sentences("s").alias("n"), x.sentences("s").alias("all")
    for text, (number, found) in zip(texts, evaluate(spark, texts, *columns)):
        expected = [m.group().rstrip() for m in pattern.finditer(text)]
        assert number == len(expected) and found == expected


def test_abbreviations_do_not_end_summary_sentences(spark):
    got = evaluate(spark, ["Dr. No came. He left e.g. today."], x.summary_sentences("s").alias("t"))
    assert got[0][0] == ["Dr. No came.", "He left e.g. today."]


def test_no_sentences(spark):
    assert evaluate(spark, [None, ""], x.num_sentences("s").alias("n")) == [(0,), (0,)]


def test_normalize_date(spark):
    texts = [None, "2020", "2020-3", "2020-03-04", "soon", ""]
    got = [r[0] for r in evaluate(spark, texts, x.normalize_date("s").alias("t"))]
    assert got == ["", "2020-01-01", "2020-03-01", "2020-03-04", None, None]


def test_score_rounding_is_half_even(spark):
    row = spark.range(1).select(*[F.bround(F.lit(v), 1) for v in (2.25, 0.25, 0.35)]).first()
    assert tuple(row) == (2.2, 0.2, 0.4)
