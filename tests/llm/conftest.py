from pathlib import Path

import duckdb
import pytest


@pytest.fixture(scope="session")
def rows_of_sql(sf_dir):
    """Rows that DuckDB gives for a statement over the small tables, columns sorted by name."""
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")

    def run(sql):
        found = connection.sql(sql)
        columns = sorted(found.columns)
        return columns, sorted(map(repr, found.select(*columns).fetchall()))

    return run
