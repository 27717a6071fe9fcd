"""Reading and writing files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


# First lines are read in jobs of so many tasks, one for each file.
HEADER_TASKS = 200


def read_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_format: str,
    schema: StructType | str | None = None,
    **options,
) -> DataFrame:
    """The rows of a file, a directory, a glob or a list of those.

    Text formats are read with a header and every column as a string. Quoted fields with line
    breaks need ``multiLine=True`` (such files cannot be split, so each is read by one task) and, as
    a rule, ``escape='"'``. CSV files with headers are read as ``read_header_groups`` does, every
    other format by one scan.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if file_format == "csv" and str(options.get("header", True)).lower() == "true":
        return read_header_groups(spark, paths, schema, **options)
    reader = spark.read.format(file_format).option("header", True).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths)


def read_header_groups(
    spark: SparkSession, paths: Sequence[str], schema: StructType | str | None = None, **options
) -> DataFrame:
    """CSV files whose headers may differ in the order and number of their columns.

    A scan takes the names of all its files from one header, so files are grouped by their first
    line, each group is scanned by its own header, and the scans are joined by name: a column that
    a file lacks is null there. ``schema`` names the columns wanted and their types; its columns
    are found by name too, and others are left out. Empty files have no rows; without any header the
    result has the columns of ``schema`` or none.
    """
    groups = header_groups(spark, paths, **options)
    wanted = spark.createDataFrame([], schema or "").schema
    kinds = {field.name: field.dataType for field in wanted}
    whole = None if schema is None and groups else spark.createDataFrame([], wanted)
    for files in groups:
        reader = spark.read.format("csv").options(**options).option("header", True)
        scan = reader.load(files)
        if schema is not None:
            held = StructType([StructField(c, kinds.get(c, StringType())) for c in scan.columns])
            scan = reader.schema(held).load(files).select([c for c in wanted.names if c in held.names])
        whole = scan if whole is None else whole.unionByName(scan, allowMissingColumns=True)
    return whole


def header_groups(spark: SparkSession, paths: Sequence[str], **options) -> list[list[str]]:
    """The files under ``paths``, grouped by their first line, in the order of these lines.

    Each first line is read by a task of its own, which reads no further; the driver gets these lines
    and the names of the files.
    """
    listing = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup", "lineSep")}
    # A session of its own, so that each file is one split, whose first line is the file's.
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "9000000000000000")
    reader = session.read.options(**listing)
    files = [_literal(file) for file in sorted(reader.text(list(paths)).inputFiles())]
    groups: dict[str, list[str]] = {}
    for start in range(0, len(files), HEADER_TASKS):
        some = files[start : start + HEADER_TASKS]
        lines = [
            reader.text(file).limit(1).select(F.lit(place).alias("place"), "value") for place, file in enumerate(some)
        ]
        for row in reduce(DataFrame.union, lines).collect():
            groups.setdefault(row["value"].rstrip("\r"), []).append(some[row["place"]])
    return [sorted(groups[line]) for line in sorted(groups)]


def _literal(uri: str) -> str:
    """The path pattern that stands for just the file with this address."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def write_files(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as a Parquet directory, replacing what is there."""
    df.write.mode(mode).parquet(path)


def write_clustered(
    df: DataFrame, path: str, cluster_by: str, sort_by: Sequence[str], partitions: int, block_bits: int | None = None
) -> None:
    """Write ``df`` as Parquet, one directory per value of ``cluster_by``, sorted inside.

    Rows are dealt out by ranges of ``cluster_by`` and ``sort_by``, so the files of a directory
    hold ranges that do not overlap, and one hot value (a term in every third document) is spread
    over as many files as its rows need, since the last sort column tells its rows apart. With
    ``block_bits``, a column ``block`` numbers runs of so many rows, as a power of two.
    """
    keys = (cluster_by, *sort_by)
    dealt = df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    if block_bits is not None:
        dealt = dealt.withColumn("block", F.shiftright(F.monotonically_increasing_id(), block_bits))
    dealt.write.mode("overwrite").partitionBy(cluster_by).parquet(path)


def write_by_id(df: DataFrame, path: str, id_column: str = "doc_id", partitions: int | None = None) -> None:
    """Write ``df`` as Parquet in files of id ranges that do not overlap, sorted inside.

    A filter on a few ids then reads few files' row groups; others are skipped by their statistics.
    """
    count = [partitions] if partitions else []
    df.repartitionByRange(*count, id_column).sortWithinPartitions(id_column).write.mode("overwrite").parquet(path)
