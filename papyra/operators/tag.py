"""Topic tags: boolean columns that are never null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.functions import fixed_values as fixed
from papyra.functions.text import matches


def _never_null(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def tag_covid(
    df: DataFrame,
    date_column: str = "publish_time",
    abstract_column: str = "abstract",
    covid_terms: Sequence[str] | None = None,
) -> DataFrame:
    """True for papers that are recent or undated, or that name one of the terms.

    Dates are compared as text, before they are normalised: ``2020`` is recent, ``2019`` is not.
    """
    if isinstance(covid_terms, str):
        raise TypeError("covid_terms is a list of patterns, not one string")
    terms = fixed.COVID_TERMS if covid_terms is None else covid_terms
    date = F.col(date_column).cast("string")
    recent = (date > fixed.COVID_TAG_DATE) | date.isNull()
    mentioned = matches(abstract_column, "|".join(terms))
    return df.withColumn("covid_related", _never_null(recent | mentioned))


def tag_virus(
    df: DataFrame, abstract_column: str = "abstract", virus_pattern: str | None = None
) -> DataFrame:
    pattern = fixed.VIRUS_PATTERN if virus_pattern is None else virus_pattern
    return df.withColumn("virus_related", _never_null(matches(abstract_column, pattern)))


def tag_coronavirus(
    df: DataFrame, abstract_column: str = "abstract", corona_pattern: str | None = None
) -> DataFrame:
    pattern = fixed.CORONA_PATTERN if corona_pattern is None else corona_pattern
    return df.withColumn("corona_related", _never_null(matches(abstract_column, pattern)))


def tag_sars(
    df: DataFrame, abstract_column: str = "abstract", sars_pattern: str | None = None
) -> DataFrame:
    """True where the pattern matches and ``covid_related``, which must be there, is false."""
    pattern = fixed.SARS_PATTERN if sars_pattern is None else sars_pattern
    mentioned = matches(abstract_column, pattern)
    return df.withColumn("sars_related", _never_null(~F.col("covid_related") & mentioned))
