"""Queries of the subpackage that have SQL give DuckDB's rows on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from terrafold.llm import queries

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = queries.queries()[name](spark, str(DATA))
    found = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(str([r[names.index(c)] for c in sorted(names)]) for r in found.fetchall())
    assert sorted(str([r[c] for c in sorted(names)]) for r in df.collect()) == want
