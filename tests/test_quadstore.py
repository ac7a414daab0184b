"""The store against a set of quads: whole operations, versions, failures, writers that overtake each other."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quadrel.operators import quadstore
from quadrel.operators.quadstore import Overtaken, QuadStore

SCHEMA = "g string, s string, p string, o string"


def rows(df):
    return sorted(tuple(r) for r in df.select("g", "s", "p", "o").collect())


def quads(spark, found):
    return spark.createDataFrame(list(found), SCHEMA)


def test_random_operations_equal_a_set(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quadstore, "FOLDERS", 2)
    r = random.Random(6)
    store = QuadStore(spark, str(tmp_path / "s"), keep={"keep/a", "keep/b"}, buckets=4)
    have: set = set()
    names = ["keep/a", "keep/b", *(f"g/{i}" for i in range(8)), "g/é x=1"]
    states = []
    for step in range(14):
        new = {(r.choice(names), f"s{r.randint(0, 3)}", "p", str(r.randint(0, 3))) for _ in range(r.choice((0, 1, 6, 20)))}
        touched = {q[0] for q in new}
        does = r.choice(("append", "replace_one", "replace_all", "clear", "clear_others")) if step else "append"
        if does == "clear":
            asked = r.sample(names, 3)
            assert store.clear(*asked) == [g for g in asked if g in {q[0] for q in have}]
            have = {q for q in have if q[0] not in asked}
        elif does == "clear_others":
            others = sorted({q[0] for q in have} - store.keep)
            assert [x.g for x in store.clear_others().collect()] == others
            have = {q for q in have if q[0] in store.keep}
        else:
            store.load(quads(spark, [*new, *list(new)[:2]]), does)
            left = {"append": have, "replace_one": {q for q in have if q[0] not in touched}, "replace_all": {q for q in have if q[0] in store.keep - touched}}[does]
            have = left | new
        assert rows(store.read()) == sorted(have), does
        states.append((max(store.versions(), default=0), sorted(have)))
    for version, then in states:
        if version:
            assert rows(store.read(version)) == then
    some = sorted({q[0] for q in have})[:2]
    assert rows(store.graph(*some)) == sorted(q for q in have if q[0] in some)
    assert store.vacuum() > 0 and rows(store.read()) == sorted(have) and len(store.versions()) == 1


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "s"))
    store.replace(quads(spark, [("g", "a", "p", "1")]))
    bad = quads(spark, [("g", "b", "p", "2"), ("h", "b", "p", "2")]).withColumn("o", F.expr("CAST(raise_error('broken') AS string)"))
    for mode in ("append", "replace_one", "replace_all"):
        with pytest.raises(Exception, match="broken"):
            store.load(bad, mode)
        assert rows(store.read()) == [("g", "a", "p", "1")] and store.versions() == [1]


def test_a_reader_keeps_its_version(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "s"))
    store.replace(quads(spark, [("g", "a", "p", "1")]))
    seen = store.read()
    store.replace(quads(spark, [("g", "b", "p", "2")]))
    store.clear("g")
    assert rows(seen) == [("g", "a", "p", "1")] and rows(store.read()) == []
    with pytest.raises(ValueError, match="no such version"):
        store.read(9)


def test_an_overtaken_writer_starts_anew(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    one, two = QuadStore(spark, path), QuadStore(spark, path)
    one.append(quads(spark, [("g", "a", "p", "1")]))
    commit, once = QuadStore._commit, []

    def overtaken(self, manifest):
        if self is one and not once:
            once.append(1)
            two.append(quads(spark, [("g", "a", "p", "2"), ("h", "x", "p", "1")]))
        commit(self, manifest)

    monkeypatch.setattr(QuadStore, "_commit", overtaken)
    one.append(quads(spark, [("g", "a", "p", "2"), ("g", "a", "p", "3")]))
    assert rows(one.read()) == [("g", "a", "p", "1"), ("g", "a", "p", "2"), ("g", "a", "p", "3"), ("h", "x", "p", "1")]
    monkeypatch.setattr(QuadStore, "_commit", commit)
    with pytest.raises(Overtaken):
        one._commit({"version": 1, "buckets": 64, "folders": {}})


def test_many_graphs_make_few_folders(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "s"), keep={"g/7"})
    store.replace(spark.range(100_000).selectExpr("concat('g/', id) AS g", "'s' AS s", "'p' AS p", "string(id) AS o"))
    assert store.read().select("g").distinct().count() == 100_000
    assert sum(1 for x in Path(tmp_path).rglob("*") if x.is_dir()) < 80
    store.load(quads(spark, [("new", "s", "p", "o")]))
    assert rows(store.read()) == [("g/7", "s", "p", "7"), ("new", "s", "p", "o")]


def test_an_empty_store(spark, tmp_path):
    store = QuadStore(spark, str(tmp_path / "s"), keep={"k"})
    assert not store.exists() and rows(store.read()) == [] and store.clear("g") == []
    assert store.clear_others().count() == 0 and store.graphs().count() == 0
    store.load(quads(spark, []), "append")
    assert rows(store.read()) == []
