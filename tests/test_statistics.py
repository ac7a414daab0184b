"""Orders of joins from characteristic sets: what they estimate, what they choose, what that saves."""

import itertools
import random

import pytest

from quadrel.plans import sparql
from quadrel.plans.statistics import Statistics

CHAIN = 'SELECT ?o ?c WHERE { ?o <status> "F" ; <by> ?c . ?c <in> ?n . ?n <of> ?r ; <name> "n1" . ?r <called> "r1" }'


@pytest.fixture(scope="module")
def quads(spark):
    rows = [("g", f"<o{i}>", "<status>", '"F"' if i % 2 else '"O"') for i in range(4000)]
    rows += [("g", f"<o{i}>", "<by>", f"<c{i % 400}>") for i in range(4000)]
    rows += [("g", f"<c{i}>", "<in>", f"<n{i % 20}>") for i in range(400)]
    rows += [("g", f"<n{i}>", "<of>", f"<r{i % 5}>") for i in range(20)] + [("g", f"<n{i}>", "<name>", f'"n{i}"') for i in range(20)]
    rows += [("g", f"<r{i}>", "<called>", f'"r{i}"') for i in range(5)]
    return spark.createDataFrame(rows, "g string, s string, p string, o string").repartition(4).cache()


def shuffled(df):
    """(rows, records that its exchanges wrote)."""
    rows = df.collect()
    total, ahead = 0, [df._jdf.queryExecution().executedPlan()]
    while ahead:
        node = ahead.pop()
        metric = node.metrics().get("shuffleRecordsWritten")
        total += metric.get().value() if metric.isDefined() else 0
        ahead += [node.children().apply(i) for i in range(node.children().size())]
    return sorted(map(tuple, rows)), total


def test_a_chain_shuffles_fewer_rows_by_statistics(spark, quads):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = Statistics.gather(quads)
        as_written, before = shuffled(sparql.select(quads, CHAIN, unique=True))
        by_figures, after = shuffled(sparql.select(quads, CHAIN, unique=True, statistics=found))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert as_written == by_figures and len(by_figures) == 200
    assert after < 0.8 * before, (after, before)


def test_estimates_of_stars_are_exact_where_sets_are_kept(quads):
    found = Statistics.gather(quads)
    v, t = (lambda n: ("var", n)), (lambda x: ("term", x))
    assert found.rows([(v("o"), t("<status>"), v("x")), (v("o"), t("<by>"), v("c"))]) == pytest.approx(4000)
    assert found.rows([(v("o"), t("<status>"), t('"F"'))]) == pytest.approx(2000)
    assert found.rows([(v("n"), t("<of>"), v("r")), (v("n"), t("<status>"), v("x"))]) == 0
    assert found.rows([(v("o"), t("<by>"), v("c")), (v("c"), t("<in>"), v("n"))]) == pytest.approx(4000)
    assert found.subjects == 4425


def test_the_order_is_the_cheapest_of_all_and_connected(quads):
    found = Statistics.gather(quads)
    v, t = (lambda n: ("var", n)), (lambda x: ("term", x))
    patterns = [(v("o"), t("<status>"), t('"F"')), (v("o"), t("<by>"), v("c")), (v("c"), t("<in>"), v("n")), (v("n"), t("<of>"), v("r")), (v("r"), t("<called>"), t('"r1"'))]

    def cost(order):
        picked = [patterns[i] for i in order]
        return sum(found.rows([x]) for x in picked) + sum(found.rows(picked[:k]) for k in range(2, len(picked) + 1))

    def connected(order):
        return all({x[1] for x in patterns[i] if x[0] == "var"} & {x[1] for j in order[:k] for x in patterns[j] if x[0] == "var"} for k, i in enumerate(order) if k)

    ways = [w for w in itertools.permutations(range(5)) if connected(w)]
    got = found.order(patterns)
    assert connected(got) and cost(got) == pytest.approx(min(map(cost, ways)))
    many = [(v(f"x{i}"), t("<by>"), v(f"x{i + 1}")) for i in range(12)]
    assert sorted(found.order(many)) == list(range(12))


def test_rare_sets_and_objects_are_kept_as_averages(spark, monkeypatch):
    from quadrel.plans import statistics

    monkeypatch.setattr(statistics, "SETS", 3)
    monkeypatch.setattr(statistics, "OBJECTS", 2)
    r = random.Random(1)
    rows = {("g", f"<s{i}>", f"<p{r.randint(0, 2)}>", f'"{r.randint(0, 9)}"') for i in range(300) for _ in range(3)}
    found = Statistics.gather(spark.createDataFrame(sorted(rows), "g string, s string, p string, o string"))
    for p in ("<p0>", "<p1>", "<p2>"):
        assert sum(n.get(p, 0) for _, _, n in found.sets) == sum(x[2] == p for x in rows) == found.triples[p]
    assert 0 < found.share("<p0>", '"unheard"') < 1


def test_an_empty_store_has_an_order_too(spark):
    empty = spark.createDataFrame([], "g string, s string, p string, o string")
    assert sparql.select(empty, CHAIN, statistics=Statistics.gather(empty)).count() == 0
