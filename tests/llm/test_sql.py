"""The corpus queries against their SQL on the smallest tables, and the SQL's hash against the library's."""

import random
from collections import Counter
from pathlib import Path

import duckdb
import pytest
import xxhash

from quadrel.llm import queries, simhash_sql

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    found = con.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = Counter(tuple(r[names.index(c)] for c in columns) for r in found.fetchall())
    assert want and Counter(tuple(r[c] for c in columns) for r in df.collect()) == want


def test_hash_in_sql_is_the_librarys():
    r = random.Random(1)
    texts = {"".join(r.choice("abc déß日 ") for _ in range(k % 120 + 1)) for k in range(600)}
    con = duckdb.connect()
    con.execute("CREATE TABLE shingles (shingle VARCHAR)")
    con.executemany("INSERT INTO shingles VALUES (?)", [(t,) for t in texts])
    got = con.execute(f"WITH {simhash_sql._hashed()} SELECT shingle, h FROM hashed").fetchall()
    assert dict(got) == {t: xxhash.xxh64(t.encode(), seed=42).intdigest() for t in texts}
