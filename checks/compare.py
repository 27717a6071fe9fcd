"""Compare every registered query with its SQL: ``python -m checks.compare DIR [NAME ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def difference(spark_result: DataFrame, connection, sql: str) -> str | None:
    """What differs, columns sorted by name and rows in any order; None when nothing does."""
    relation = connection.sql(sql)
    columns = sorted(relation.columns)
    if columns != sorted(spark_result.columns):
        return f"columns {sorted(spark_result.columns)} and {columns}"
    kinds = {"string": "VARCHAR", "int": "INTEGER"}
    types = {c: kinds.get(kind, kind.upper()) for c, kind in spark_result.dtypes}
    other_types = {c: str(kind) for c, kind in zip(relation.columns, relation.types)}
    if types != other_types:
        return f"types {types} and {other_types}"
    mine = sorted(map(repr, map(tuple, spark_result.select(*columns).collect())))
    theirs = sorted(map(repr, relation.select(*columns).fetchall()))
    if mine == theirs:
        return None
    only_mine, only_theirs = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
    return (
        f"{len(mine)} and {len(theirs)} rows, {len(only_mine)} and {len(only_theirs)} differ:"
        f" {[r[:300] for r in only_mine[:2]]} {[r[:300] for r in only_theirs[:2]]}"
    )


def main(sf_dir: str, names: list[str]) -> None:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = connect(sf_dir), oracle()
    for name in names or list(QUERIES):
        start = time.time()
        try:
            result = difference(QUERIES[name](spark, sf_dir), connection, sql[name])
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26} {time.time() - start:6.1f} s  {result or 'equal'}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
