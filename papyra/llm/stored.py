"""Tables written to the shared folder to cut lineage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from papyra.sources.scratch import scratch_path
from papyra.sources.sizes import can_broadcast

# A file has fewer rows than this power of two.
_PLACE_BITS = 40


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (names differ by more than case)."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, row: str) -> DataFrame:
    """``df`` with a number of its own for each row in ``row``, stored so that it stays the same."""
    return stored(df.withColumn(row, F.monotonically_increasing_id()), "numbered")


def numbered_in_place(df: DataFrame, row: str) -> DataFrame:
    """``numbered`` for a table just read from Parquet files, without writing it again.

    A row's number is that of its file, in order of names, and its place there, which stay the same
    however often the files are read. Only the names of the files are gathered. A table without
    files, or with so many that their names have not been measured to be few, is stored as above.
    """
    name, place = free_name(df, "_file"), free_name(df, "_place")
    try:
        placed = df.select(
            "*", F.col("_metadata.file_path").alias(name), F.col("_metadata.row_index").alias(place)
        )
    except AnalysisException:
        return numbered(df, row)
    files = placed.groupBy(name).agg(F.lit(0).alias("no"))
    # One row for each file.
    files = stored(files.withColumn("no", F.row_number().over(Window.orderBy(name)).cast("long")), "files")
    if not can_broadcast(files):
        return numbered(df, row)
    number = F.shiftleft("no", _PLACE_BITS) + F.col(place)
    return placed.join(F.broadcast(files), name).select(*df.columns, number.alias(row))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written under ``spark.checkpoint.dir`` and read again.

    Unlike a cache or a local checkpoint, what is written there outlives any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
