"""Citations in nested documents, against a plain walk over each document."""

import copy
import json
import random
import re

import pytest

from quadrel.operators import refine, tree

STOP = "a an and are as be by does for from how if in is it its of only or return such that the this to used value what which with item null name exact reported".split()
CLASSES = {"Dataset": "d.ttl", "MachineLearningArchitecture": "m.ttl", "Known": "k.ttl"}


def tokens(text):
    text = re.sub("(?<=[a-z0-9])(?=[A-Z])", " ", text).replace("_", " ").lower()
    return {t for t in re.findall("[a-z0-9]+", text) if len(t) > 1 and t not in STOP}


def sentence(text, hint):
    found = [s.strip() for s in re.split(r"(?<=[.!?])\s+|\s*;\s*", text) if s.strip()]
    return max(found, key=lambda s: len(tokens(s) & tokens(hint)))[:350] if found else text[:300].strip()


def cite(evidence, pattern, chunks):
    return next((chunks[i] for i in re.findall(pattern, evidence) if i in chunks), None)


def walk(node, chunks, classes, path=()):
    """The refined document, in place."""
    if isinstance(node, list):
        for i, x in enumerate(node):
            walk(x, chunks, classes, (*path, str(i)))
    if not isinstance(node, dict):
        return
    if {"value", "evidence"} <= node.keys():
        said = node["evidence"] or ""
        said = said if isinstance(said, str) else json.dumps(said)
        if known := cite(said, r"\b(?:M-HYP|HY-HYP)-\d+\b", chunks):
            page = known["id"].startswith("M-HYP")
            said = node["evidence"] = f"{'Model page' if page else 'YAML'} [{known['id']}]: {known['text']}"
            if page and known["source"]:
                node["source"] = known["source"]
        if path and path[-1] in refine.CLASS_FIELDS and classes:
            stated = node["value"] if isinstance(node["value"], str) else ""
            name = stated.split(":")[-1]
            if name not in classes:
                dotted = ".".join(path).lower()
                marks = {"hyperparameter": "MachineLearningHyperparameter", "dataset": "Dataset", "backbone": "MachineLearningArchitecture", "head": "MachineLearningArchitecture", "architecture": "MachineLearningArchitecture"}
                name = node["value"] = next((c for m, c in marks.items() if m in dotted and c in classes), None)
            if name in classes:
                said = node["evidence"] = f"Ontology {classes[name]} [O-CLASS-CATALOG]: {name} is declared rdf:type owl:Class."
        pages = {i: c for i, c in chunks.items() if c["kind"] == "pdf"}
        if page := cite(said, r"\b(?:P\d+-C\d+|Y\d+|O-[A-Za-z0-9_]+-\d+)\b", pages):
            value = node["value"]
            quote = sentence(page["text"], f"{value if value is None or isinstance(value, str) else json.dumps(value)} {said}")
            mark = "'" if '"' in quote else '"'
            node["evidence"] = f"PDF p. {page['page']} [{page['id']}]: {mark}{quote}{mark}"
            if page["source"]:
                node["source"] = page["source"]
    for k, x in node.items():
        walk(x, chunks, classes, (*path, k))


def chunk(i, kind, text, page=None, source=None):
    return {"id": i, "kind": kind, "page": page, "text": text, "source": source}


def random_document(r, depth=0):
    kind = r.random()
    if depth > 4 or kind < 0.15:
        return r.choice([None, True, 0, 7, -2, "", "text", "é \"q\" \\ \n 漢", [], {}, 0.5])
    if kind < 0.5:
        evidence = r.choice(["see P1-C1.", "P9-C9 then P2-C1", "M-HYP-1 and HY-HYP-2", "HY-HYP-2", "nothing", "", None, ["P1-C1"], "xP1-C1", "M-HYP-3", "éP1-C1", "Y1 P2-C1"])
        value = r.choice(["ns:Known", "ns:Unheard", "Dataset", None, "the gate, opened twice", random_document(r, depth + 1)])
        return {"value": value, "evidence": evidence, **({"source": random_document(r, depth + 2)} if r.random() < 0.3 else {}), **({"note": random_document(r, depth + 1)} if r.random() < 0.3 else {})}
    if kind < 0.7:
        return [random_document(r, depth + 1) for _ in range(r.randint(0, 12))]
    keys = ["ontology_class", "backbone_ontology_class", "head_ontology_class", "datasets", "a.b", "Architecture", "x y", "ä\"", "value", "evidence", ""]
    return {k: random_document(r, depth + 1) for k in r.sample(keys, r.randint(0, 5))}


def canonical(x):
    return json.dumps(x, sort_keys=True)


@pytest.mark.parametrize("classes", [CLASSES, {"Other": "o.ttl"}, {}])
def test_refined_documents_equal_a_plain_walk(spark, classes):
    r = random.Random(len(classes))
    docs, passages, want = [], [], {}
    for doc in range(150):
        data = random_document(r)
        held = [
            chunk("P1-C1", "pdf", 'It begins. The gate opened twice; "Known" text.', 4, r.choice([None, "http://x/p.pdf"])), chunk("P2-C1", "pdf", "  ", 5), chunk("Y1", "yaml", "a = 1"),
            chunk("M-HYP-1", "model_page", "lr = 0.1", None, r.choice([None, "", "http://page"])), chunk("HY-HYP-2", "yaml", "batch = 2"), chunk("M-HYP-3", "model_page", "see P1-C1 for it"),
        ]
        held = r.sample(held, r.randint(0, 6))
        docs.append((doc, json.dumps(data)))
        passages += [(doc, c["id"], c["kind"], c["page"], c["text"], c["source"]) for c in held]
        walk(plain := copy.deepcopy(data), {c["id"]: c for c in held}, classes)
        want[doc] = canonical(plain)
    df = spark.createDataFrame([*docs, (900, None), (901, "{no json")], "doc long, text string")
    chunks = spark.createDataFrame(passages, "doc long, id string, kind string, page int, text string, source string")
    catalog = spark.createDataFrame(list(classes.items()), "class string, file string")
    got = {x.doc: x.document for x in refine.refine(df, chunks, catalog).selectExpr("doc", "to_json(document) AS document").collect()}
    assert got.pop(900) is None and got.pop(901) is None
    assert sum(want[d] != canonical(json.loads(t)) for d, t in docs) > 30
    for doc, text in docs:
        assert canonical(json.loads(got[doc])) == want[doc], text


def test_documents_come_back_whole(spark):
    r = random.Random(8)
    docs = [(i, json.dumps(random_document(r))) for i in range(200)] + [(1000, "[" * 40 + "]" * 40), (1001, '{"a": ' * 30 + "1" + "}" * 30)]
    df = spark.createDataFrame(docs, "doc long, text string").selectExpr("doc", "parse_json(text) AS document")
    places = tree.nodes(df, "doc", "document")
    leaves = places.where(tree.is_leaf(places["value"])).selectExpr("doc", "path", "to_json(value) AS json")
    got = {x.doc: x.t for x in tree.assemble(leaves, "doc").selectExpr("doc", "to_json(document) AS t").collect()}
    assert {d: canonical(json.loads(t)) for d, t in got.items()} == {d: canonical(json.loads(t)) for d, t in docs}


def test_documents_are_never_broadcast(spark):
    """Tables that grow with the documents are small on disk, and far larger where they are broadcast."""
    df = spark.createDataFrame([(i, '{"a": {"value": "x", "evidence": "P1-C1", "source": {"b": 1}}}') for i in range(50)], "doc long, text string")
    chunks = spark.createDataFrame([(i, "P1-C1", "pdf", 1, "The x.", None) for i in range(50)], "doc long, id string, kind string, page int, text string, source string")
    found = refine.refine(df, chunks, spark.createDataFrame([], "class string, file string"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.selectExpr("to_json(document) AS d").distinct().count() == 1


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc long, text string")
    chunks = spark.createDataFrame([], "doc long, id string, kind string, page int, text string, source string")
    assert refine.refine(df, chunks, spark.createDataFrame([], "class string, file string")).count() == 0
