"""Every query with SQL gives DuckDB's rows on the smallest tables; the others run."""

from pathlib import Path

import duckdb
import pytest

from terrafold import plans

DATA = Path("/root/testdata/sf0.001")


def plain(x):
    if isinstance(x, (list, tuple)):
        return [plain(v) for v in x]
    return x.isoformat() if hasattr(x, "isoformat") else x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, str(DATA))
    rows = df.collect()
    if name not in plans.SQL:
        assert rows
        return
    found = duck.execute(plans.SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr([plain(r[names.index(c)]) for c in sorted(names)]) for r in found.fetchall())
    assert sorted(repr([plain(r[c]) for c in sorted(names)]) for r in rows) == want
