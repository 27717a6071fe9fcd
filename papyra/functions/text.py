"""Text functions on columns. All are built from Spark functions: no Python runs per row."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from papyra.functions import fixed_values as fixed

# Stands between an abbreviation and the next word while sentences are cut.
_JOINER = "\u0001"


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row.

    Inside the lambda of an array function, a plain column expression would be worked out
    again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def clean_text(text: Column | str, separators: str = "") -> Column:
    """Lower-case, without punctuation; a slash and any white space beyond ASCII become a space.

    So do the characters of ``separators``.
    """
    to_space = fixed.SPACE_CHARACTER + fixed.UNICODE_SPACES + separators
    return F.translate(
        F.lower(as_column(text)), to_space + fixed.REMOVED_CHARACTERS, " " * len(to_space)
    )


def has_any(text: Column | str, parts: Iterable[str]) -> Column:
    """Whether one of ``parts`` stands in ``text``."""
    return reduce(Column.__or__, [as_column(text).contains(part) for part in parts])


def plain_words(pattern: str) -> list[str]:
    """The words of a pattern that is nothing but words with ``|`` between; none for any other.

    To look for such words one by one takes a fraction of the time of the pattern.
    """
    words = r"[A-Za-z0-9]+(?:\|[A-Za-z0-9]+)*"
    found = re.fullmatch(rf"\((?P<inside>{words})\)|{words}", pattern)
    return (found["inside"] or found[0]).split("|") if found else []


def matches(text: Column | str, pattern: str) -> Column:
    """``rlike``, without a pattern where it is but words."""
    words = plain_words(pattern)
    return has_any(text, words) if words else as_column(text).rlike(pattern)


def remove_matches(text: Column | str, pattern: str) -> Column:
    """``text`` without what ``pattern`` matches; where it is but words, only texts with one are rewritten."""
    text, words = as_column(text), plain_words(pattern)
    if not words:
        return F.regexp_replace(text, pattern, "")
    # Most characters begin none of the words, which is seen at once.
    begins = "".join(sorted({word[0] for word in words}))
    return F.when(has_any(text, words), F.regexp_replace(text, f"(?=[{begins}])(?:{pattern})", "")).otherwise(text)


def plain_spaces(text: Column | str) -> Column:
    """White space beyond ASCII as plain spaces; few texts have any, and only they are rewritten.

    Each such character is looked for by itself, which takes a fraction of the time of a pattern, and
    those beyond ASCII only where a text has more bytes than characters.
    """
    text, spaces = as_column(text), fixed.UNICODE_SPACES
    wide = (F.octet_length(text) != F.length(text)) & has_any(text, [c for c in spaces if not c.isascii()])
    found = wide | has_any(text, [c for c in spaces if c.isascii()])
    return F.when(found, F.translate(text, spaces, " " * len(spaces))).otherwise(text)


def tokenize(
    text: Column | str,
    stop_words: Iterable[str] = fixed.STOP_WORDS,
    pattern: str = fixed.TOKEN_PATTERN,
) -> Column:
    """Array of the index tokens of ``text``, in order, repeats kept; null text has none.

    All separators of one character become spaces along with cleaning, at no cost of their own, so
    that words are cut at single spaces, without a pattern.
    """
    stop_words = sorted(set(stop_words))

    def is_token(word: Column) -> Column:
        keep = F.length(word) >= fixed.MIN_TOKEN_LENGTH
        if stop_words:
            keep &= ~word.isin(stop_words)
        return keep & word.rlike(pattern)

    def without_dashes(spaced: Column) -> Column:
        dashes = spaced.contains(fixed.TOKEN_DASHES)
        return F.when(dashes, F.replace(spaced, F.lit(fixed.TOKEN_DASHES), F.lit(" "))).otherwise(spaced)

    words = F.split(let(clean_text(text, fixed.TOKEN_SEPARATORS), without_dashes), " ")
    return F.coalesce(F.filter(words, is_token), F.array().cast("array<string>"))


def term_counts(tokens: Column | str) -> Column:
    """Array of ``struct(term, tf)``, one per distinct token, in term order.

    Counting happens inside the row: equal tokens stand together in the sorted array, and the
    distance between two starts is a count. So term frequencies need no shuffle.
    """

    def starts(ordered: Column) -> Column:
        def start(token: Column, i: Column) -> Column:
            return F.when(~token.eqNullSafe(F.get(ordered, i - 1)), i)

        return F.array_compact(F.transform(ordered, start))

    def counts(ordered: Column) -> Column:
        def count(starts: Column) -> Column:
            def run(start: Column, k: Column) -> Column:
                end = F.coalesce(F.get(starts, k + 1), F.size(ordered))
                return F.struct(F.get(ordered, start).alias("term"), (end - start).cast("bigint").alias("tf"))

            return F.transform(starts, run)

        return let(starts(ordered), count)

    return let(F.sort_array(as_column(tokens)), counts)


def shorten(text: Column | str, length: int = fixed.SHORTEN_LENGTH) -> Column:
    """The first ``length`` characters, with ``...`` when something was cut; null becomes ''."""
    text = as_column(text)
    cut = F.concat(F.substring(text, 1, length), F.lit("..."))
    return F.coalesce(F.when(F.length(text) > length, cut).otherwise(text), F.lit(""))


def doi_url(doi: Column | str) -> Column:
    """Link for a DOI; ``#`` when there is none."""
    doi = as_column(doi)
    return (
        F.when(doi.isNull() | (doi == ""), "#")
        .when(doi.startswith("doi.org"), F.concat(F.lit("http://"), doi))
        .otherwise(F.concat(F.lit("http://doi.org/"), doi))
    )


def _split_sentences(text: Column) -> Column:
    """Array of the sentences of a text whose spaces are plain; null text has none."""
    found = F.regexp_extract_all(text, F.lit(fixed.SENTENCE_PATTERN), F.lit(0))
    found = F.transform(found, lambda s: F.regexp_replace(s, r"\s+$", ""))
    return F.coalesce(found, F.array().cast("array<string>"))


def sentences(text: Column | str) -> Column:
    """Array of the sentences of ``text``; null text has none."""
    return _split_sentences(plain_spaces(text))


def num_sentences(text: Column | str) -> Column:
    """Number of sentences; 0 for null or empty text."""
    return F.coalesce(
        F.regexp_count(plain_spaces(text), F.lit(fixed.SENTENCE_PATTERN)), F.lit(0)
    )


def summary_sentences(text: Column | str) -> Column:
    """As ``sentences``, but none ends after an abbreviation such as ``Dr.`` or ``e.g.``."""
    text = plain_spaces(text)
    for abbreviation in (fixed.TITLE_ABBREVIATION, fixed.LETTER_ABBREVIATION):
        text = F.regexp_replace(text, abbreviation, f"$1{_JOINER}$2")
    # The spaces are plain by now; asking again would work the text out several times.
    return F.transform(
        _split_sentences(text), lambda s: F.when(s.contains(_JOINER), F.translate(s, _JOINER, " ")).otherwise(s)
    )


def num_words(text: Column | str) -> Column:
    """Number of words between white space."""
    return F.regexp_count(plain_spaces(text), F.lit(r"\S+"))


def normalize_date(date: Column | str) -> Column:
    """ISO text of a date given as text; null becomes '' and unreadable text becomes null."""
    text = as_column(date).cast("string")
    return F.when(text.isNull(), "").otherwise(text.try_cast("date").cast("string"))
