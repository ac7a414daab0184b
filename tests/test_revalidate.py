"""Reports brought up to date after edits, against full validation; the pace of a service's calls."""

import random
import time
from collections import Counter

import pytest

from quadrel.operators import repair
from quadrel.plans import shacl

SHAPES = """
@prefix sh: <http://www.w3.org/ns/shacl#> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> . @prefix : <http://x/> .
:Deep a sh:NodeShape ; sh:property [ sh:path :to ; sh:node :Named ] .
:Named a sh:NodeShape ; sh:property [ sh:path :name ; sh:minCount 1 ; sh:datatype xsd:string ] .
:A a sh:NodeShape ; sh:targetClass :T ; sh:property [ sh:path :to ; sh:class :T ; sh:maxCount 2 ] , [ sh:path :deep ; sh:node :Deep ] .
:B a sh:NodeShape ; sh:targetSubjectsOf :name ; sh:property [ sh:path :to ; sh:minCount 1 ; sh:severity sh:Warning ] .
:C a sh:NodeShape ; sh:targetObjectsOf :to ; sh:class :T .
:D a sh:NodeShape ; sh:targetNode :n0 ; sh:property [ sh:path :name ; sh:minCount 1 ] .
"""


def rows(df):
    return Counter(map(tuple, df.select(*shacl.REPORT).collect()))


def test_a_report_brought_up_to_date_is_the_full_report(spark):
    r = random.Random(2)
    node = lambda: f"<http://x/n{r.randrange(7)}>"
    kind = "<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>"

    def triple():
        p = r.choice(("type", "to", "to", "deep", "name"))
        g = f"g{r.randrange(4)}"
        if p == "type":
            return g, node(), kind, r.choice(("<http://x/T>", "<http://x/U>"))
        return g, node(), f"<http://x/{p}>", r.choice(('"n"', '"1"^^http://www.w3.org/2001/XMLSchema#integer')) if p == "name" else node()

    shapes = shacl.read_shapes(SHAPES)
    assert max(map(shacl.reach, shapes)) == 3
    frame = lambda quads: spark.createDataFrame(sorted(quads), "g string, s string, p string, o string").coalesce(1)
    have = {triple() for _ in range(90)}
    report = shacl.validate(frame(have), shapes)
    for step in (1, 2):
        gone = set(r.sample(sorted(have), r.choice((0, 2, 9)))) | ({q for q in have if q[0] == "g1"} if step == 2 else set())
        new = (have - gone) | {triple() for _ in range(r.choice((0, 2, 6)))} | ({("g9", "<http://x/n3>", "<http://x/to>", "<http://x/n4>")} if step == 1 else set())
        again = spark.createDataFrame(shacl.revalidate(frame(have), frame(new), report, shapes).collect(), report.schema)
        assert rows(again) == rows(shacl.validate(frame(new), shapes))
        have, report = new, again


def test_unchanged_graphs_are_not_looked_at(spark):
    quads = [(f"g{i}", "<http://x/n1>", "<http://x/name>", '"n"') for i in range(20)]
    old = spark.createDataFrame(quads, "g string, s string, p string, o string")
    new = spark.createDataFrame([*quads[1:], ("g0", "<http://x/n2>", "<http://x/name>", '"n"')], old.schema)
    found = sorted(map(tuple, shacl.affected(old, new, shacl.read_shapes(SHAPES)).collect()))
    assert found == [("g0", '"n"'), ("g0", "<http://x/n0>"), ("g0", "<http://x/n1>"), ("g0", "<http://x/n2>")]


def test_a_cluster_keeps_its_pace(spark, tmp_path):
    """Calls of all lanes, some failing, some asked again, are counted by their times."""
    folder = str(tmp_path)

    def client(text):
        at = time.time()
        with open(f"{folder}/{at}-{text[:2].strip()}-{random.random()}", "w"):
            pass
        if text.startswith("5 "):
            raise TimeoutError("busy")
        return "no object" if text.startswith("7 ") else '{"a": 1}'

    df = spark.createDataFrame([(i, f"{i} prompt") for i in range(24)], "k int, prompt string")
    asked = repair.ask(df, "prompt", client, lambda p, reply, n: p, waits=[0], limited=(TimeoutError,), per_second=8, lanes=4)
    got = asked.collect()
    assert len(got) == 24 and sum(x.error is not None for x in got) == 2
    times = sorted(float(f.name.split("-")[0]) for f in tmp_path.iterdir())
    assert len(times) == 22 + 2 + 3
    for i, t in enumerate(times):
        assert sum(t <= u < t + 1 for u in times[i:]) <= 8 + 4  # a lane's last call of a second and its first of the next
    assert times[-1] - times[0] > 2


def test_graphs_of_customers_are_read_from_customers_and_held_by_graph(spark):
    """No other table is read for them, and what meets within a graph needs no further exchange."""
    from pathlib import Path

    from quadrel.plans import operator_catalog

    sf_dir = "/root/testdata/sf0.001"
    if not Path(sf_dir).exists():
        pytest.skip("no test tables")
    quads = operator_catalog._customer_graphs(spark, sf_dir)
    read = quads._jdf.queryExecution().analyzed().toString()
    assert "c_custkey" in read and "o_custkey" not in read and "p_partkey" not in read
    assert quads.count() == quads.select("g", "s", "p", "o").distinct().count() > 0
    plan = quads.select("g", "s", "p", "o").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan and "Exchange" not in plan.split("InMemoryTableScan")[0]
    quads.unpersist()
