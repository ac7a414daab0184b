"""Both ways of ranking against a plain ranker."""

import math
import random
from collections import Counter

import pytest

from quadrel.operators import retrieval


def plain(queries, passages, top):
    held = {i: t.split() for i, t in passages}
    df = Counter(t for w in held.values() for t in set(w))
    out = []
    for q, text in queries:
        scored = []
        for i, w in held.items():
            score = sum(k * math.log(1 + (len(held) + 1) / (df[t] + 1)) for t, k in Counter(text.split()).items() if t in w)
            if score:
                scored.append((-round(score / (1 + max(0, len(w) - 120) / 500), 9), i))
        out += [(q, i, k) for k, (_, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("way", ["tasks", "tokens"])
def test_ranking_equals_a_plain_ranker(spark, monkeypatch, way):
    r = random.Random(4)
    words = [f"w{i:03}" for i in range(120)]
    heavy = [1 / (i + 1) for i in range(120)]
    passages = [(i, " ".join(r.choices(words, heavy, k=r.choice((0, 3, 30, 200, 900))))) for i in range(700)]
    passages += [(1000 + i, passages[i][1]) for i in range(60)]  # ties
    queries = [(f"q{i}", " ".join(r.choices(words, k=r.randint(1, 12)))) for i in range(40)] + [("none", "unheard"), ("empty", ""), ("common", "w000 w001 w000")]
    monkeypatch.setattr(retrieval, "BLOCK", 64)
    monkeypatch.setattr(retrieval, "COMMON", 20)
    monkeypatch.setattr(retrieval, "HELD", 10_000 if way == "tasks" else 5)
    q = spark.createDataFrame(queries, "query string, text string")
    p = spark.createDataFrame(passages, "id long, text string").repartition(5)
    for top in (1, 4, 50):
        got = sorted((x["query"], x["id"], x["rank"]) for x in retrieval.rank(q, p, top, expanded=False).collect())
        assert got == plain(queries, passages, top)


def test_few_candidates_among_a_common_tokens_passages(spark, monkeypatch):
    """A common token's passages are many times a later block's candidates, and their lengths aren't in the order of rows."""
    r = random.Random(6)
    words = [f"w{i:05}" for i in range(60_000)]
    lengths = [r.choice((20, 40, 60, 150, 200)) for _ in range(3000)]
    passages = [(i, " ".join([*(["cc"] if r.random() < 0.6 else []), *r.choices(words, k=n)])) for i, n in enumerate(lengths)]
    queries = [(f"q{i}", " ".join([*["cc"] * 4, *r.choices(words, k=3)])) for i in range(40)]
    monkeypatch.setattr(retrieval, "BLOCK", 1024)
    q = spark.createDataFrame(queries, "query string, text string")
    p = spark.createDataFrame(passages, "id long, text string").coalesce(1)
    got = sorted((x["query"], x["id"], x["rank"]) for x in retrieval.rank(q, p, 4, expanded=False).collect())
    assert got == plain(queries, passages, 4)


def test_a_task_hands_on_its_best_only(spark):
    p = spark.range(4000).selectExpr("id", "concat('aa w', id % 7) AS text").repartition(3)
    q = spark.createDataFrame([(i, f"aa w{i}") for i in range(5)], "query long, text string")
    found = retrieval.rank(q, p, 3, expanded=False)
    plan = found._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("MapInArrow") == 1 and "regexp_extract_all" not in plan
    assert found.count() == 15


def test_scopes_are_ranked_each_for_itself(spark):
    p = spark.createDataFrame([("a", 1, "red green"), ("a", 2, "red"), ("b", 3, "red blue"), ("b", 4, "blue")], "doc string, id long, text string")
    q = spark.createDataFrame([("a", 1, "red green"), ("b", 1, "blue red")], "doc string, query long, text string")
    got = sorted((x["doc"], x["query"], x["id"], x["rank"]) for x in retrieval.rank(q, p, 2, expanded=False, scope=["doc"]).collect())
    assert got == [("a", 1, 1, 1), ("a", 1, 2, 2), ("b", 1, 3, 1), ("b", 1, 4, 2)]


def test_null_texts_and_empty_tables(spark):
    p = spark.createDataFrame([(1, None), (2, "gate")], "id long, text string")
    q = spark.createDataFrame([("x", None), ("y", "gate"), (None, "gate")], "query string, text string")
    assert sorted((str(x["query"]), x["id"]) for x in retrieval.rank(q, p, 2, expanded=False).collect()) == [("None", 2), ("y", 2)]
    assert retrieval.rank(q.limit(0), p, 2).count() == 0 and retrieval.rank(q, p.limit(0), 2).count() == 0
