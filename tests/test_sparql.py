import pytest
from pyspark.sql import functions as F

from quadrel.functions import terms as T
from quadrel.plans import sparql
from quadrel.sources.turtle import parse

DATA = """
@prefix : <http://x/> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
:a a :Model ; rdfs:label "Alpha"@en, "Alfa"@de ; :size 3 ; :score "0.5"^^xsd:float ; :uses :d1, :d2 .
:b a :Model ; rdfs:label "Beta" ; :size 2.0 ; :score 7 ; :uses :d1 .
:c a :Model ; :size "many" ; :uses :d3 .
:d1 a :Set ; :name "one" . :d2 a :Set ; :name "two" . :d3 a :Other .
"""
HEAD = "PREFIX : <http://x/> PREFIX rdfs: <http://www.w3.org/2000/01/rdf-schema#>\n"


@pytest.fixture(scope="module")
def quads(spark):
    triples = [("g1", *t) for t in parse(DATA).triples] + [("g2", "<http://x/a>", "<http://x/size>", f'"3"^^{T.XSD}integer')]
    return spark.createDataFrame(triples, "g string, s string, p string, o string").cache()


def ask(quads, text):
    found = sparql.select(quads, HEAD + text)
    return [tuple(r) for r in found.select(*[F.coalesce(T.lexical(F.col(c)), F.col(c)).alias(c) for c in found.columns]).collect()]


def test_default_graph_is_a_set(quads):
    assert ask(quads, "SELECT ?s WHERE { ?s :size 3 }") == [("http://x/a",)]
    assert sorted(ask(quads, "SELECT ?g WHERE { GRAPH ?g { :a :size 3 } }")) == [("g1",), ("g2",)]
    assert ask(quads, "SELECT (COUNT(*) AS ?n) WHERE { ?s ?p ?o }")[0][0] == "20"


def test_optional_filter_stands_in_the_condition(quads):
    got = ask(quads, 'SELECT ?m ?l WHERE { ?m a :Model OPTIONAL { ?m rdfs:label ?l FILTER(LANG(?l) = "" || LANGMATCHES(LANG(?l), "EN")) } } ORDER BY ?m')
    assert got == [("http://x/a", "Alpha"), ("http://x/b", "Beta"), ("http://x/c", None)]


def test_terms_are_not_numbers_but_compare_as_such(quads):
    assert ask(quads, "SELECT ?m WHERE { ?m :size 2 }") == []
    assert ask(quads, "SELECT ?m WHERE { ?m :size ?n FILTER(?n = 2) }") == [("http://x/b",)]
    assert ask(quads, "SELECT ?m WHERE { ?m :size ?n FILTER(?n < 10) } ORDER BY DESC(?n)") == [("http://x/a",), ("http://x/b",)]
    assert ask(quads, "SELECT ?n WHERE { ?m :size ?n } ORDER BY ?n") == [("2.0",), ("3",), ("many",)]


def test_errors_leave_variables_unbound(quads):
    got = ask(quads, 'SELECT ?m ?x ?y WHERE { ?m a :Model ; :size ?n BIND(IF(?n > 2.5, "big", "small") AS ?x) BIND(COALESCE(?z, STR(?n)) AS ?y) } ORDER BY ?m')
    assert got == [("http://x/a", "big", "3"), ("http://x/b", "small", "2.0"), ("http://x/c", None, "many")]


def test_values_in_replace_contains(quads):
    got = ask(quads, 'SELECT ?n WHERE { VALUES ?m { :a :b } ?m :uses ?d BIND(REPLACE(STR(?d), "^.*[#/]", "") AS ?n) FILTER(CONTAINS(STR(?d), "d1")) } ')
    assert got == [("d1",), ("d1",)]
    assert ask(quads, 'SELECT ?m WHERE { ?m :uses ?d FILTER(?d IN (:d2, :d3)) } ORDER BY ?m') == [("http://x/a",), ("http://x/c",)]


def test_group_having_aggregates(quads):
    got = ask(quads, "SELECT ?d (COUNT(DISTINCT ?m) AS ?n) (SUM(?s) AS ?t) (MAX(?s) AS ?x) WHERE { ?m :uses ?d ; :score ?s } GROUP BY ?d HAVING (COUNT(?m) > 1) ORDER BY DESC(?n)")
    assert got == [("http://x/d1", "2", "7.5", "7")]


def test_union_minus_limit_offset(quads):
    assert len(ask(quads, "SELECT ?x WHERE { { ?x a :Set } UNION { ?x a :Other } }")) == 3
    assert ask(quads, "SELECT ?x WHERE { ?x a :Model MINUS { ?x :uses :d1 } }") == [("http://x/c",)]
    assert ask(quads, "SELECT ?x WHERE { ?x a :Model } ORDER BY ?x LIMIT 1 OFFSET 1") == [("http://x/b",)]
    assert len(ask(quads, "SELECT DISTINCT ?c WHERE { ?x a ?c } ORDER BY ?c")) == 3


def test_what_is_refused(quads):
    with pytest.raises(sparql.SparqlError):
        ask(quads, "SELECT ?x WHERE { ?m a :Model OPTIONAL { ?m :no ?x } ?x a :Set }")
    for bad in ("SELECT ?x WHERE { ?x", "SELECT ?x { ?x nope:a 1 }", "SELECT ?x { ?x :a 1 FILTER(FOO(?x)) }"):
        with pytest.raises((sparql.SparqlError, IndexError)):
            ask(quads, bad)


def test_patterns_read_only_their_columns(spark, tmp_path):
    from quadrel.operators.quadstore import lift

    spark.createDataFrame([(1, "a", "b", 2.0)], "k int, x string, y string, z double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    quads = lift(df, "t", F.col("k"), {"x": (F.col("x"), None), "y": (F.col("y"), None), "z": (F.col("z"), T.XSD + "double")})
    plan = sparql.select(quads, "PREFIX e: <http://example.org/> SELECT ?v WHERE { ?s e:x ?v }", unique=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "ReadSchema: struct<k:int,x:string>" in plan or "struct<x:string>" in plan


def test_paths_equal_a_plain_closure(spark):
    import random

    r = random.Random(5)
    edges = {(r.randrange(12), r.randrange(12)) for _ in range(14)} | {(20, 21), (21, 20), (30, 30)}
    rows = [("<g>", f"<n{a}>", "<in>", f"<n{b}>") for a, b in edges] + [("<g>", "<n1>", "<name>", '"one"'), ("<h>", "<n0>", "<in>", "<n99>"), ("<h>", "<n20>", "<in>", "<n21>")]
    quads = spark.createDataFrame(rows, "g string, s string, p string, o string")
    pairs = {(f"<n{a}>", f"<n{b}>") for a, b in edges} | {("<n0>", "<n99>")}
    closed = set(pairs)
    while more := {(a, d) for a, b in closed for c, d in pairs if b == c} - closed:
        closed |= more
    terms = {x for _, s, _, o in rows for x in (s, o)}
    ask = lambda text: sorted(map(tuple, sparql.select(quads, text).collect()))
    assert ask("SELECT ?a ?b WHERE { ?a <in>+ ?b }") == sorted(closed)
    assert ask("SELECT ?a ?b WHERE { ?a <in>* ?b }") == sorted(closed | {(t, t) for t in terms})
    assert ask("SELECT ?b WHERE { <n20> <in>+ ?b }") == [("<n20>",), ("<n21>",)]
    assert ask("SELECT ?a WHERE { ?a <in>* <n99> }") == sorted({(a,) for a, b in closed if b == "<n99>"} | {("<n99>",)})
    assert ask("SELECT ?a ?n WHERE { ?a <in>+ ?b . ?b <name> ?n }") == sorted((a, '"one"') for a, b in closed if b == "<n1>")
    assert ask("SELECT ?a ?b WHERE { GRAPH <h> { ?a <in>+ ?b } }") == [("<n0>", "<n99>"), ("<n20>", "<n21>")]
    assert ask("SELECT ?a WHERE { ?a <in>+ ?a }") == sorted((a,) for a, b in closed if a == b)
    with pytest.raises(sparql.SparqlError):
        ask("SELECT ?a WHERE { ?a ?p+ ?b }")
