"""Labels of documents, one for each id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def agreed_labels(labels: DataFrame, id_col: str, label_col: str, name: str) -> DataFrame:
    """``id, name``: the label, 0 or 1, of each id whose labels all agree.

    Rows without an id or with another label tell nothing; ids with both labels are left out, so
    the result does not depend on the order of rows.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    marks = marks.where("id is not null and label in (0, 1)").groupBy("id").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    )
    return marks.where("low = high").select("id", F.col("low").alias(name))
