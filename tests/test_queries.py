"""Every registered query that has SQL gives what DuckDB gives for it."""

import duckdb
import pytest

from quillmill.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, DATA)
    got = df.collect()
    if name not in ORACLE_SQL:
        assert got
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cursor = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr(tuple(dict(zip(names, row, strict=True))[c] for c in sorted(names))) for row in cursor.fetchall())
    assert sorted(repr(tuple(r[c] for c in sorted(names))) for r in got) == want
