from __future__ import annotations

import duckdb
import pytest

from tallywood.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture
def same_as_sql(spark, folder):
    """Compare a query to its SQL over the small tables."""

    def compare(name: str) -> None:
        connection = duckdb.connect()
        for t in TABLES:
            connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        result = connection.execute(ORACLES[name])
        columns = [c[0] for c in result.description]
        expected = result.fetchall()
        found = QUERIES[name](spark, folder)
        assert sorted(found.columns) == sorted(columns)
        rows = [tuple(r) for r in found.select(*columns).collect()]
        assert sorted(rows, key=repr) == sorted(expected, key=repr)

    return compare
