import json

import pytest
from pyspark.sql import functions as F

from quadrel.functions import slug as S
from quadrel.functions import terms as T
from quadrel.functions import values as V
from quadrel.operators import flatten, mapping, merge, quadstore, repair, resolve, retrieval
from quadrel.sources import documents as D
from quadrel.sources import html
from quadrel.streaming import graph


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_slugs(spark):
    t = lambda f, x: f(F.lit(x))
    assert tuple(one(spark, t(S.slug, " κ_SRME (Å) "), t(S.slug, None), t(S.slug, "!!"), t(S.slug_plain, "κ SRME"), t(S.slug_extracted, "κ Å"), t(S.slug_site, "κ SRME ω"), t(S.slug_site, "!"), t(S.canonical_key, "A_b C"))) == (
        "kappa_srme_angstrom", "unknown", "unknown", "srme", "kappa", "κ_srme_omega", "unnamed", "a-b-c")
    assert tuple(one(spark, S.scoped_id(F.lit("M 1"), F.lit(None), F.lit("x=1e-5")), S.scoped_resource(F.lit("m"), F.lit("m_a"), "fold"), S.scoped_resource(F.lit("m"), F.lit("a_fold"), "fold"), S.local_name(F.lit("a:b:C")), S.metric_unit(F.lit("MAE")), S.metric_unit(F.lit("κ")), S.canonical_task(F.lit("Discovery")), S.canonical_task(F.lit("My Task")))) == (
        "m_1_x_1e_5", "m_a_fold", "m_a_fold", "C", "eV/atom", "dimensionless", "thermodynamic_stability_classification_task", "my_task")
    assert tuple(one(spark, S.paper_url(F.lit("https://arxiv.org/abs/1.2")), S.paper_url(F.lit("https://arxiv.org/html/1.2v1/")), S.paper_url(F.lit("")), S.model_selector(F.lit("a/Orb-v3.yml")), S.model_selector(F.lit("https://x/models/Orb v3/")), S.model_selector(F.lit("orb_v3_model_extraction.json")))) == (
        "https://arxiv.org/pdf/1.2.pdf", "https://arxiv.org/pdf/1.2v1.pdf", None, "orb_v3", "orb_v3", "orb_v3")
    assert tuple(one(spark, S.contents_api_url(F.lit("https://github.com/o/r/tree/-/a/b")), S.files_route(F.lit("x.yaml")), S.files_route(F.lit("https://github.com/o/r/tree/m/p")), S.files_route(F.lit("http://p")), S.parse_created(F.lit("2020-01-02"), F.lit("x")), S.parse_created(F.lit(None).cast("string"), F.lit("Jun 1, 2012")), S.cell_number(F.lit(None).cast("string"), F.lit("N/A")), S.cell_number(F.lit("12.7"), F.lit("x")), S.cell_bool(F.lit("background: lightcoral")))) == (
        "https://api.github.com/repos/o/r/contents/a/b?ref=main", "file", "api", "page", "2020-01-02", "Jun 1, 2012", None, 12, False)


def test_values(spark):
    cases = ['{"value": null, "evidence": "e", "source": "http://s"}', '{"a": 1}', "[1, 2]", '"  "', "0", "null", "true", "1.5", '"1.5e3"', '"+7"']
    df = spark.createDataFrame([(c,) for c in cases], "t string").select("t", F.parse_json("t").alias("v"))
    rows = df.select(
        F.to_json(V.get_value(F.col("v"))).alias("value"), V.get_evidence(F.col("v")).alias("evidence"), V.get_source(F.col("v")).alias("source"),
        F.size(V.normalized_list(F.col("v"))).alias("n"), V.is_meaningful(F.col("v")).alias("ok"), T.variant_literal(F.col("v")).alias("l"),
    ).collect()
    assert [r.ok for r in rows] == [False, True, True, False, True, False, True, True, True, True]
    assert rows[0].evidence == "e" and rows[0].source == "http://s" and rows[1].value == '{"a":1}'
    assert [r.n for r in rows] == [1, 1, 2, 1, 1, 0, 1, 1, 1, 1]
    assert [r.l and r.l.rsplit("#", 1)[-1] for r in rows[6:]] == ["boolean", "float", "float", '"+7"']
    got = one(spark, V.first_json(F.lit('```json\n{"a": {"b": 1}} tail } ```')), V.greedy_json(F.lit("x {\"a\": 1} y")), V.turtle_of_reply(F.lit("so:\n```turtle\n<a> <b> <c> .\n```")), V.turtle_of_reply(F.lit("hm @prefix x: <y> .")))
    assert str(got.c0) == '{"a":{"b":1}}' and str(got.c1) == '{"a":1}' and got.c2 == "<a> <b> <c> ." and got.c3 == "@prefix x: <y> ."


def test_sections():
    of = lambda section, name, **kw: [n for n, _ in flatten.members(section, flatten.section_rule(name, **kw))]
    assert of([{"name": {"value": "a"}}, {"id": "b"}, 3], "architectures") == ["a", "b"]
    assert of({"architecture_loop": {"x": {}, "y": 1}, "z": {}}, "architectures") == ["x"]
    assert of({"architectures": ["p", {"id": "q"}], "p": {"k": 1}, "r": {}, "note": "text", "none": None}, "architectures") == ["p", "q", "r", "note"]
    assert of({"architecture_loop": [{"item": "x"}]}, "architectures") == []
    assert of({"architecture_loop": [{"item": "x"}]}, "architectures", retrieval=True) == ["x"]
    assert of({"hyperparameters": [{"parameter": "lr", "value": 1}, "bs"], "bs": {"value": 2}, "cutoff": {"value": 6}, "components": {"value": 1}}, "hyperparameters") == ["lr", "bs", "cutoff"]
    assert of({"training_runs": ["r1"], "r1": {"optimizer": 1}, "r2": {"x": 1}, "r3": {"type": "Pretraining run"}, "datasets": {"epochs": 1}}, "training_runs") == ["r1", "r3"]
    assert of({"tasks": {"t": {}, "u": 1}, "v": {}}, "benchmark_tasks") == ["t"]
    assert of({"evaluation_runs": {"value": 1, "a": {}}, "b": {}}, "evaluation_runs") == ["a"]
    assert of({"evaluation_runs": ["e"], "e": {}, "folds": {}, "more": {}}, "evaluation_runs") == ["e", "more"]


def test_flattening(spark):
    doc = {"discovery": {"full": {"F1": 0.9, "MAE": 0.02, "x": 1, "flag": True, "text": "1", "pred_file": {"a": 1}}}, "l": [1, 2], "o": {}, "big": [[1], 2]}
    df = spark.createDataFrame([(json.dumps(doc),), ("{",), (None,)], "t string")
    leaves = df.select(flatten.metric_leaf_rows("t").alias("r")).collect()
    assert [tuple(x) for x in leaves[0].r] == [(["discovery", "full"], "F1", 0.9), (["discovery", "full"], "MAE", 0.02), (["discovery", "full"], "x", 1.0)] and leaves[1].r is None and leaves[2].r is None
    facts = [tuple(x) for x in df.select(flatten.fact_rows("t").alias("r")).first().r]
    assert ("l", "[1, 2]") in facts and ("big[0]", "[1]") in facts and ("big[1]", "2") in facts and not any(p.startswith("o") for p, _ in facts)
    hp = one(spark, flatten.hyperparameter_rows(F.lit('{"opt": {"lr": 1}, "e": [1]}'))).c0
    assert [tuple(x) for x in hp] == [("hyperparams.opt.lr", "lr", "opt", "1"), ("hyperparams.e", "e", None, "[1]")]
    q = one(spark, flatten.question_rows(F.lit('{"a": {"question": "Q", "variable": "v", "b": [{"question": "R", "variable": "w", "source": "yaml"}]}}'))).c0
    assert [(x.id, x.path, x.source) for x in q] == [("a", "a", "document"), ("0", "a.b.0", "yaml")]
    made = flatten.entities(spark.createDataFrame([(1, '{"architectures": ["p"], "p": {"value": 3}}')], "doc int, t string"), "t", "architectures")
    assert [(r.doc, r.ordinal, r.name) for r in made.collect()] == [(1, 0, "p")]
    rows = spark.createDataFrame([("M", "discovery", ["full"], k) for k in ("F1", "MAE", "x")] + [("M", "phonons", ["a", "b"], "κ_SRME")] * 2, "model string, family string, path array<string>, key string")
    routed = {(r.task.split("_")[0], r.result, r.evidence) for r in flatten.routed_metrics(rows).collect()}
    assert ("phonon", "m_matbench_discovery_phonon_thermal_conductivity_contribution_phonons_a_b_kappa_srme", "metrics.phonons.a.b.κ_SRME") in routed and len(routed) == 3


def test_chunks_tokens_and_ranking(spark):
    tokens = one(spark, retrieval.tokenize(F.lit("MachineLearningHyperparameter of the run_id x é1a"))).c0
    assert tokens == ["machine", "learning", "hyperparameter", "run", "id", "1a"]
    chunks = one(spark, retrieval.chunk_text(F.lit("aaaa\n\n bb  b \ncccc\ndd"), 10), retrieval.chunk_text(F.lit("x" * 50 + "\ny"), 10), retrieval.chunk_text(F.lit("")), retrieval.chunk_text(F.lit(None).cast("string")))
    assert chunks.c0 == ["aaaa bb b", "bb b cccc", "cccc dd"] and chunks.c1 == ["x" * 50, "x" * 50 + " y"] and chunks.c2 == [] and chunks.c3 == []
    best = one(spark, retrieval.best_sentence(F.lit("One two. Three four five! four; two"), F.lit("four five")), retrieval.best_sentence(F.lit("  "), F.lit("x")))
    assert best.c0 == "Three four five!" and best.c1 == ""
    passages = spark.createDataFrame([("a", "alpha beta"), ("b", "alpha " * 3 + "word" + " filler" * 300), ("c", "gamma"), ("d", "alpha beta")], "id string, text string")
    queries = spark.createDataFrame([(1, "alpha alpha beta"), (2, "nothing")], "query int, text string")
    got = [(r["query"], r["id"], r["rank"]) for r in retrieval.rank(queries, passages, 3, expanded=False).orderBy("query", "rank").collect()]
    assert got == [(1, "a", 1), (1, "d", 2), (1, "b", 3)]
    assert "learning rate" in one(spark, retrieval.expand(F.lit("Hyperparameters of it"))).c0
    packed = retrieval.packets((1, retrieval.rank(queries, passages, 2, False)), (0, retrieval.rank(queries, passages.where("id = 'd'"), 1, False))).collect()
    assert [(r["query"], r["ids"]) for r in packed] == [(1, ["d", "a"])]


def test_pages(spark):
    page = """<html><body><h1>A <b>title</b></h1><script>no</script><section class="links"><a href="/models/b#x" title="Paper">P</a></section>
      <a href='c.yml'>files</a><p>one</p><p></p><p>two</p><table><tr><th>Name ↑</th><th>N</th><th>Ok</th><th>When</th></tr>
      <tr><td> a  b <a href="/d">x</a></td><td data-sort-value="12.0">12k</td><td style="color:lightgreen">y</td><td><span title="2020-01-02">t</span></td></tr></table></body>"""
    df = spark.createDataFrame([(1, "http://h/m/p?q", page), (2, "http://h/z", None), (3, "http://h/y", "<a href='/models/a'>q</a> <p>unclosed")], "k int, url string, html string")
    assert [r.link for r in html.link_set(df, "html", "url", "/models/").collect()] == ["http://h/models/a", "http://h/models/b"]
    links = df.select("k", html.section_link(html.links_of("html"), "paper").alias("x")).orderBy("k").collect()
    assert [r.x for r in links] == ["/models/b#x", None, None]
    row = html.dataset_rows(df, "html").select("row", html.typed_cell(F.col("cells"), "name").alias("a"), html.typed_cell(F.col("cells"), "n", "number").alias("b"), html.typed_cell(F.col("cells"), "ok", "bool").alias("c"), html.typed_cell(F.col("cells"), "when", "date").alias("d"), html.typed_cell(F.col("cells"), "name", "href").alias("e")).collect()
    assert [tuple(r) for r in row] == [(0, "a b x", 12, True, "2020-01-02", "/d")]
    context = html.task_context(df, "html", 2).orderBy("k").collect()
    assert (context[0].title, context[0].context) == ("A title", "one") and context[2].context == "unclosed"
    text = df.select(html.readable_text("html").alias("t"), html.title_of(F.col("html")).alias("h")).collect()
    assert text[0].t.startswith("A title P files") and "no" not in text[0].t.split() and text[0].h == "A title" and text[1].t == ""


def test_documents(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.yml").write_text("model_key: 'Orb V3' # c\ndate_added: 2024-01-02\nn: {m: [1, 2]}\n")
    (tmp_path / "b.yaml").write_text('model_key: orb-v3\ndate_added: "2025-01-02"\n')
    (tmp_path / "c.yml").write_text(": [")
    files = D.read_yaml(spark, str(tmp_path), recursive=True)
    assert {r.file: r.json is not None for r in files.collect()} == {"x.yml": True, "b.yaml": True, "c.yml": False}
    assert [(r.key, str(r.date)) for r in D.official_metadata(files).collect()] == [("orb-v3", "2025-01-02")]
    pages = spark.createDataFrame([("a", 1, "x" * 10), ("a", 2, " "), ("a", 3, "y" * 50), ("a", 4, "z")], "k string, page int, text string")
    assert D.joined_pages(pages, "k", "page", "text", 40).first().text == "[page 1]\n" + "x" * 10 + "\n\n[page 3]\n" + "y" * 12
    ok = one(spark, D.evaluated_variant(F.lit("x eval:evaluatesModelVariant archind:a_variant ; eval:evaluatesModelVariant archind:a_variant .")), D.first_pages(F.array(F.lit("a"), F.lit(" "), F.lit("b")), 2))
    assert ok.c0 == "a_variant" and ok.c1 == "a\n\nb"
    with pytest.raises(Exception, match="expected one variant"):
        one(spark, D.evaluated_variant(F.lit("none")))


def test_store(spark, tmp_path):
    q = lambda rows: spark.createDataFrame(rows, "g string, s string, p string, o string")
    store = quadstore.QuadStore(spark, str(tmp_path / "s"), keep={"http://o/1"})
    store.replace(q([("http://o/1", "a", "p", "1"), ("g/2", "a", "p", "1"), ("g/2", "a", "p", "1")]))
    store.append(q([("g/2", "a", "p", "1"), ("g/3", "b", "p", "2")]))
    rows = lambda: sorted(tuple(r) for r in store.read().collect())
    assert rows() == [("g/2", "a", "p", "1"), ("g/3", "b", "p", "2"), ("http://o/1", "a", "p", "1")]
    for _ in range(2):  # replacing again changes nothing
        store.replace(q([("g/2", "c", "p", "3")]))
    assert ("g/2", "c", "p", "3") in rows() and len(rows()) == 3
    assert [r.g for r in store.clear_others().collect()] == ["g/2", "g/3"] and rows() == [("http://o/1", "a", "p", "1")]
    store.load(q([("g/4", "x", "p", "1")]))
    store.load(q([("g/5", "x", "p", "1")]), "replace_one")
    store.load(q([("g/6", "x", "p", "1")]))
    assert [r.g for r in store.graphs().collect()] == ["g/6", "http://o/1"]


def test_stream_of_graph_versions(spark, tmp_path):
    rows = [(1, "g", "a", "p", "1"), (2, "g", "a", "p", "2"), (1, "h", "a", "p", "1")]
    spark.createDataFrame(rows, "version int, g string, s string, p string, o string").write.parquet(str(tmp_path / "in"))
    store = quadstore.QuadStore(spark, str(tmp_path / "s"))
    stream = spark.readStream.schema("version int, g string, s string, p string, o string").parquet(str(tmp_path / "in"))
    graph.upsert(stream, store, str(tmp_path / "c")).awaitTermination(60)
    assert sorted((r.g, r.o) for r in store.read().collect()) == [("g", "2"), ("h", "1")]


def test_resolve_merge_repair(spark):
    urls = spark.createDataFrame([("orb_v3", "http://x/orb.yml", 0), ("orb_v3", "http://x/orb-v3.yml", 1), ("orb_v3", "http://x/orb_v3.yaml", 2)], "key string, url string, ordinal int")
    assert resolve.pick_url(urls).first().url == "http://x/orb-v3.yml"
    aliases = F.array(F.lit("orb_v3"))
    assert tuple(one(spark, *[resolve.is_target(F.lit(x), aliases) for x in ("Orb v3", "orb", "orb_v3_b", "orbit")])) == (True, True, True, False)
    known = resolve.by_slug(spark.createDataFrame([("A b",), ("new",)], "name string"), spark.createDataFrame([("a_B", "urn:1")], "name string, iri string"), "urn:x/").orderBy("name").collect()
    assert [(r.name, r.iri, r.known) for r in known] == [("A b", "urn:1", True), ("new", "urn:x/new", False)]
    a, b = spark.createDataFrame([(1, "x"), (2, " ")], "k int, v string"), spark.createDataFrame([(2, "y"), (3, "z")], "k int, v string")
    assert sorted(tuple(r) for r in merge.filled(a, b, ["k"], "v").collect()) == [(1, "x"), (2, "y"), (3, "z")]
    assert sorted(tuple(r) for r in merge.shallow_merge(a, b, ["k"]).collect()) == [(1, "x"), (2, " "), (3, "z")]
    assert tuple(one(spark, *[repair.is_too_short(F.lit(o), F.lit(n)) for o, n in ((100, 79), (100, 80), (19, 0), (20, 16), (20, 15))])) == (True, False, False, False, True)
    assert sum(repair.retry_waits()) == 630


def test_repair_loop(spark, tmp_path):
    from itertools import count

    from quadrel.plans.shacl import read_shapes

    shapes = read_shapes("@prefix sh: <http://www.w3.org/ns/shacl#> . <urn:S> sh:targetClass <urn:C> ; sh:property [ sh:path <urn:p> ; sh:minCount 1 ] .")
    rows = [("good", "<urn:a>", T.TYPE, "<urn:C>"), ("good", "<urn:a>", "<urn:p>", "1"), ("bad", "<urn:b>", T.TYPE, "<urn:C>"), ("lost", "<urn:b>", T.TYPE, "<urn:C>")]
    rows += [("lost", "<urn:b>", "<urn:q>", str(i)) for i in range(30)]

    def fix(broken, report):
        added = report.where("component = 'minCount'").select("g", F.col("focus").alias("s"), F.col("path").alias("p"), F.lit('"1"').alias("o"))
        return broken.where("g = 'bad'").unionByName(added)

    number = count()

    def keep(df):
        path = str(tmp_path / str(next(number)))
        df.write.parquet(path)
        return spark.read.parquet(path)

    quads, verdicts = repair.repair(spark.createDataFrame(rows, "g string, s string, p string, o string"), shapes, fix, keep, rounds=2)
    assert {r.g: r.conforms for r in verdicts.collect()} == {"good": True, "bad": True, "lost": False}
    assert quads.where("g = 'lost'").count() == 31


def test_mapping(spark):
    rows = spark.createDataFrame([("m", "M", 5, None), ("m", "M", 5, None)], "k string, l string, n int, u string")
    made = mapping.statements(rows, F.lit("g"), mapping.model_rules("urn:i/", "urn:c/", F.col("k"), F.col("l"), F.col("n"), F.col("u")), F.lit("http://paper"))
    assert mapping.quads(made).count() == 8 and mapping.annotations(made).count() == 2
    assert mapping.annotations(made).first().source == "http://paper"
    more = mapping.statements(rows, F.lit("g"), mapping.architecture_rules("urn:i/", "urn:c/", F.col("k"), F.lit("Net 1"), F.lit("arch:GraphNet"), F.lit(64), F.lit(None).cast("int")))
    assert {r.o for r in more.collect()} >= {"<urn:c/GraphNet>", f'"64"^^{T.XSD}integer'}


def test_model_graph(spark):
    from quadrel.operators.modelgraph import Dialect, ModelGraph, Namespaces

    doc = {
        "model": {"family": {"value": "Orb", "evidence": "p1"}, "variant": "orb v3", "parameter_number": {"value": 25, "evidence": "p2", "source": "http://s"}},
        "architectures": [{"name": "Net", "ontology_class": "arch:GraphNet", "hidden_dimension": 64, "components": ["Gate"], "hyperparameters": [{"name": "lr", "value": 0.1, "evidence": "p3"}]}],
        "training": {"training_runs": ["r1"], "r1": {"type": "PretrainingRun", "datasets": {"value": ["MPtrj", "OMat 24"], "evidence": "p4"}, "optimizer": "Adam", "initialized_from": "orb v2"}},
        "datasets": {"MPtrj": {"type": "TrainingDataset", "number_of_samples": 5, "labelling_method": "DFT"}},
        "evaluation": {"evaluation_runs": {"e1": {"task": "discovery", "metric_results": ["mae"], "folds": ["f"]}}, "metric_results": {"mae": {"value": 0.02, "metric_type": "MAE"}}, "tasks": {"discovery": {"type": "ClassificationTask"}}},
    }
    docs = spark.createDataFrame([("g", "orb_v3", "Orb v3", json.dumps(doc), "http://paper"), ("g2", "m", "M", "{}", None), ("g3", "n", "N", None, None)], "g string, model string, label string, json string, paper string")
    n = Namespaces()
    i = lambda x: f"<{n.individuals}{x}>"
    plain = ModelGraph(docs).statements().cache()
    of = {(r.s, r.p[1:-1].rsplit("#", 1)[-1], r.o) for r in plain.collect()}
    assert (i("orb_family"), "hasVariant", i("orb_v3_variant")) in of
    assert (i("orb_v3_variant"), "hasMachineLearningArchitecture", i("orb_v3_net_architecture")) in of
    assert (i("orb_v3_net_model_variant"), "hasMachineLearningArchitecture", i("orb_v3_net_architecture")) in of
    assert {(i("r1"), "usesDataset", i("mptrj")), (i("r1"), "usesDataset", i("omat_24")), (i("r1"), "usesOptimizer", i("adam")), (i("r1"), "initializedFromModelMaterialization", i("orb_v2_materialization"))} <= of
    assert (i("r1_lr_value"), "value", f'"0.1"^^{T.XSD}float') in of or any(s == i("r1_lr_value") and p.endswith("value") for s, p, _ in of)
    assert (i("mptrj"), "type", f"<{n.train}TrainingDataset>") in of and (i("mptrj"), "type", f"<{n.data}LabeledDataset>") in of
    assert (i("e1_evaluation_run"), "evaluatesTask", i("thermodynamic_stability_classification_task")) in of
    assert (i("mae_metric_result"), "hasMetricType", i("mae_metric_type")) in of
    sourced = plain.where("evidence = 'p2'").first()
    assert sourced.source == "http://s" and plain.where("evidence = 'p4'").first().source == "http://paper"
    scoped = {(r.s, r.o) for r in ModelGraph(docs, dialect=Dialect(retrieval=True)).statements().collect()}
    assert (i("orb_v3_r1"), i("mptrj")) in scoped and (i("orb_v3_e1_evaluation_run"), i("orb_v3_mae_metric_result")) in scoped


def test_page_hyperparameters_and_named_data():
    text = 'About. Hyperparams lr: 0.1 layers: [1, {"a": 2}] act: silu and more: x Dependencies torch: 2'
    assert flatten.page_hyperparameters(text) == {"lr": 0.1, "layers": [1, {"a": 2}], "act": "silu and", "more": "x"}
    assert flatten.page_hyperparameters(None) == flatten.page_hyperparameters("no such heading") == {}
    assert flatten.named_data({"runs": {"a": {"x": 1}}, "b": {"y": 2}, "run_loop": {"c": {"z": 3}}}, "runs", "c") == {"z": 3}
    assert flatten.named_data(None, "runs", "a") == {}


def test_rows_are_dealt_to_tasks_of_bounded_size(spark, monkeypatch, tmp_path):
    """A table of one part is worked on by as many tasks as its rows ask for, however small it is on disk."""
    from quadrel.plans import operator_catalog
    from quadrel.sources import documents

    monkeypatch.setattr(documents, "TASK_ROWS", 500)
    spark.range(6000).selectExpr("id AS p_partkey", "'a' AS p_name").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    rows = operator_catalog.parts(spark, str(tmp_path))
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and rows.rdd.getNumPartitions() == 12 and max(sizes) < 750
    assert documents.dealt(spark.range(0), "id").count() == 0 and documents.dealt(spark.range(3), "id").count() == 3


def test_terms_of_statements_are_worked_out_once_and_their_set_in_bounded_tasks(spark):
    """A subject of several rules is one column below the explosion, however many rules name it; the set's tasks are as many as asked for."""
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, None, "z")], "id int, name string, note string")
    node = T.iri(F.concat(F.lit("urn:"), F.upper("name")))
    rules = [
        *mapping.individual(node, "urn:Thing", F.col("name")), mapping.Rule(node, "urn:note", T.literal(F.col("note")), F.col("note"), F.lit("own")),
        mapping.Rule(node, "urn:id", T.literal(F.col("id"), T.XSD + "integer"), F.concat(F.lit("row "), F.col("id").cast("string"))),
    ]
    made = mapping.statements(rows, F.lit("g"), rules, F.lit("list"))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("upper(") == 1
    assert made.columns == ["g", "s", "p", "o", "evidence", "source"]
    found = {(r.s, r.p, r.o, r.evidence, r.source) for r in made.collect()}
    assert len(found) == 9 and {s for s, *_ in found} == {"<urn:A>", "<urn:B>"}
    assert {x[3:] for x in found if x[1] == "<urn:note>"} == {("x", "own")} and {x[3:] for x in found if x[1] == "<urn:id>"} == {("row 1", "list"), ("row 2", "list")}
    # Nothing but the quads' own columns is worked out for quads.
    assert "row " not in mapping.quads(made)._jdf.queryExecution().optimizedPlan().toString()
    whole = mapping.quads(made.unionByName(made), 5)
    assert whole.count() == 9 and whole._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(g") == 1
    assert ", 5), REPARTITION_BY_NUM" in whole._jdf.queryExecution().executedPlan().toString()


def test_long_texts_are_dealt_by_their_length(spark, monkeypatch):
    from quadrel.sources import documents

    monkeypatch.setattr(documents, "TASK_CHARS", 1000)
    rows = spark.range(200).selectExpr("id", "IF(id = 7, NULL, repeat('x', 50))  AS text").coalesce(1)
    dealt = documents.dealt_by_length(rows, "text", "id")
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum(F.length("text")).alias("n")).collect()]
    assert sum(sizes) == 9950 and dealt.rdd.getNumPartitions() == 10 and max(sizes) < 2500
    assert documents.dealt_by_length(rows.where("id < 0"), "text", "id").count() == 0


def test_a_pages_tree_goes_before_the_next_is_read():
    """Elements refer to each other both ways; without unlinking they wait for the collection of cycles."""
    import gc

    from quadrel.sources import html

    page = "<html><body>" + "<div><p>a <b>b</b></p></div>" * 50
    gc.collect()
    gc.disable()
    try:
        texts = [html.read(page, html._readable) for _ in range(20)]
        left = sum(isinstance(x, html.Node) for x in gc.get_objects())
    finally:
        gc.enable()
    assert set(texts) == {" ".join(["a b"] * 50)} and left == 0


def test_mapping_and_flattening_deal_their_parts(spark, monkeypatch, tmp_path):
    """A table of parts in one file is mapped and flattened by as many tasks as its rows ask for."""
    from quadrel.plans import operator_catalog
    from quadrel.sources import documents

    monkeypatch.setattr(documents, "TASK_ROWS", 500)
    part = spark.range(6000).selectExpr("id AS p_partkey", "'a' AS p_name", "'b' AS p_brand", "1 AS p_size", "CAST(2 AS DOUBLE) AS p_retailprice")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    made = operator_catalog.QUERIES["mapping_rules"](spark, str(tmp_path))
    assert ", 12), REPARTITION_BY_NUM" in made._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in made.collect()] == [(6000 * 6 + 2, 6000)]
    assert operator_catalog.QUERIES["yaml_flatten_nested"](spark, str(tmp_path)).rdd.getNumPartitions() == 12


def test_facts_make_no_encoder_for_a_leaf_and_keep_their_order(monkeypatch):
    """A document's leaves, by a plain recursion; making an encoder for each took longer than reading the document."""

    def plain(path, x):
        if not isinstance(x, (dict, list)) or isinstance(x, list) and len(x) <= 12 and not any(isinstance(y, (dict, list)) for y in x):
            return [(path.removeprefix("."), json.dumps(x, ensure_ascii=False))]
        steps = [(f".{k}", y) for k, y in x.items()] if isinstance(x, dict) else [(f"[{i}]", y) for i, y in enumerate(x)]
        return [f for step, y in steps for f in plain(path + step, y)]

    documents = [
        5, None, "é ", [], {}, [[]], [{}, [[1, [2]], 3]], list(range(12)), list(range(13)), {"": {"": 1, ".": [None, True]}}, {"a.b": {"[0]": 1.5e300, "c": {}}},
        {"a": {"b": "x", "o": {}}, "l": [1, "x", None], "m": [[1], {"z": [{"y": list(range(14))}, {}]}], "e": []},
    ]
    stated, made, of = [plain("", d) for d in documents], [], json.JSONEncoder
    monkeypatch.setattr(json, "JSONEncoder", lambda *a, **kw: made.append(1) or of(*a, **kw))
    assert [flatten.facts(d) for d in documents] == stated and not made
