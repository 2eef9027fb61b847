"""Driver queries of the training-data operators against their DuckDB SQL."""

import duckdb
import pytest

from feedloom.llm.oracle import ORACLE
from feedloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def rows(records):
    return sorted(repr(tuple(None if v is None else v for v in r)) for r in records)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[key](spark, SF)
    names = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(names)} FROM ({ORACLE[key]})").fetchall()
    assert rows(tuple(r) for r in df.select(*names).collect()) == rows(want)
