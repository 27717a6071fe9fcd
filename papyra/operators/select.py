"""Choosing rows and columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyra.functions import fixed_values as fixed

SAMPLE_STEPS = 1 << 32


def project_columns(
    df: DataFrame, columns: Sequence[str] = fixed.PREPARED_COLUMNS
) -> DataFrame:
    return df.select(*columns)


def sample_rows(
    df: DataFrame, fraction: float, seed: int = 0, id_column: str | None = None
) -> DataFrame:
    """Keep each row with probability ``fraction``.

    With ``id_column`` the choice depends on the id and the seed alone, so it is the same
    however the rows are partitioned; without it, Spark's sampling depends on the partitions.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    if id_column is None:
        return df.sample(fraction=fraction, seed=seed)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string")))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.filter(draw < F.lit(int(fraction * SAMPLE_STEPS)))


def after(
    df: DataFrame,
    date: str,
    include_null_dates: bool = False,
    date_column: str = "publish_time",
    blank_as_null: bool = False,
) -> DataFrame:
    """Rows dated ``date`` or later, with those without a date if asked for.

    Prepared papers hold '' for a missing date and null for an unreadable one, so
    ``include_null_dates`` alone keeps the unreadable ones; ``blank_as_null`` adds the missing.
    """
    column = F.col(date_column)
    keep = column >= date
    if include_null_dates:
        keep |= column.isNull()
        if blank_as_null:
            keep |= column == ""
    return df.filter(keep)


def since_cutoff(df: DataFrame, include_null_dates: bool = False, **kwargs) -> DataFrame:
    """``after`` with the fixed date for recent papers."""
    return after(df, fixed.RECENT_DATE, include_null_dates, **kwargs)


def preview(df: DataFrame, n: int = 5, order_by: str = "doc_id") -> DataFrame:
    """The first ``n`` rows by ``order_by``."""
    return df.orderBy(order_by).limit(n)
