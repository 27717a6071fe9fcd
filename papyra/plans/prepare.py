"""From raw paper metadata to the prepared table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from papyra.functions import fixed_values as fixed
from papyra.operators.clean import (
    add_doc_id, clean_abstract, clean_title, drop_duplicate_texts, fill_nulls, format_date,
)
from papyra.operators.select import project_columns
from papyra.operators.tag import tag_coronavirus, tag_covid, tag_sars, tag_virus


def prepare_papers(
    df: DataFrame,
    columns: Sequence[str] = fixed.PREPARED_COLUMNS,
    abstract_column: str = "abstract",
    date_column: str = "publish_time",
    relevant: str | None = None,
    noise: str | None = None,
    covid_terms: Sequence[str] | None = None,
    virus_pattern: str | None = None,
    corona_pattern: str | None = None,
    sars_pattern: str | None = None,
    id_column: str = "doc_id",
) -> DataFrame:
    """Clean, de-duplicate, tag and date-normalise papers.

    Rows are told apart by ``id_column``; where ``df`` lacks it, a hash of the row is used. The
    id is kept in the result. The only wide steps are those of the de-duplication: cleaning
    runs before them and tagging after, on the surviving rows.
    """
    if id_column not in df.columns:
        df = add_doc_id(df, id_column)
    return (
        df.transform(clean_title, relevant)
        .transform(clean_abstract, noise)
        .transform(drop_duplicate_texts, "abstract", id_column)
        .transform(fill_nulls)
        .transform(tag_covid, date_column, abstract_column, covid_terms)
        .transform(tag_virus, abstract_column, virus_pattern)
        .transform(tag_coronavirus, abstract_column, corona_pattern)
        .transform(tag_sars, abstract_column, sars_pattern)
        .transform(format_date, date_column)
        .transform(project_columns, [id_column, *(c for c in columns if c != id_column)])
    )
