"""Every query of the engine against its SQL, on the smallest tables."""

from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import duckdb
import pytest

from quadrel.plans import catalog, operator_catalog  # noqa: F401

DATA = Path("/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark", "pages", "conversations")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_queries_equal_their_sql(spark):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")

    def plain(rows):
        return Counter(str(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in rows)

    def check(name):
        df = catalog.QUERIES[name](spark, str(DATA))
        columns = sorted(df.columns)
        got = plain(tuple(r[c] for c in columns) for r in df.collect())
        found = con.cursor().execute(catalog.ORACLES[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns, name
        want = plain(tuple(r[names.index(c)] for c in columns) for r in found.fetchall())
        return None if got == want else (name, list((got - want))[:2], list((want - got))[:2])

    with ThreadPoolExecutor(3) as pool:
        wrong = [x for x in pool.map(check, sorted(catalog.ORACLES)) if x]
    assert not wrong


def test_patterns_without_a_shared_variable_are_refused(spark):
    from quadrel.plans import sparql

    quads = spark.createDataFrame([("g", "<a>", "<p>", '"1"'), ("g", "<b>", "<q>", '"2"')], "g string, s string, p string, o string")
    with pytest.raises(sparql.SparqlError):
        sparql.select(quads, "SELECT ?x ?y WHERE { ?x <p> ?v . ?y <q> ?w }")
    assert sparql.select(quads, "SELECT ?x ?y WHERE { VALUES ?y { 1 2 } ?x <p> ?v }").count() == 2
    plan = sparql.select(quads, "SELECT DISTINCT ?x WHERE { ?x <p> ?v . ?x <q> ?w }")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
