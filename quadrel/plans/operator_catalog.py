"""A query for each operator below the query languages: fields, names, sections, graphs, sources, stores, repair.

Inputs are made of the star schema's rows by templates, several forms by the key; the SQL
states the answer of each form from the columns.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrel.functions import slug as S
from quadrel.functions import terms as T
from quadrel.functions import values as V
from quadrel.operators import flatten, mapping, merge, modelgraph, quadstore, refine, repair, resolve, retrieval, sitegraph
from quadrel.plans import shacl, sparql
from quadrel.plans.catalog import _SHAPES, EX, ORACLES, PREFIXES, QUERIES, answered, faulty_customers, lifted, query, table
from quadrel.sources import documents as D
from quadrel.sources import html, sinks, turtle, turtle_split
from quadrel.streaming import graph as streaming

# --- templates over the parts: @k@ key, @A@ name, @B@ brand, @n@ size, @a@ and @b@ the slugs of name and brand

_SLUG_SQL = "trim(regexp_replace(lower(trim({0})), '[^a-z0-9]+', '_', 'g'), '_')"
_TOKENS = {"@k@": "CAST(p_partkey AS VARCHAR)", "@A@": "p_name", "@B@": "p_brand", "@n@": "CAST(p_size AS VARCHAR)", "@a@": _SLUG_SQL.format("p_name"), "@b@": _SLUG_SQL.format("p_brand")}


def filled(text: str) -> Column:
    """A template's text for a part."""
    out = F.lit(text)
    columns = {"@k@": F.col("p_partkey").cast("string"), "@A@": F.col("p_name"), "@B@": F.col("p_brand"), "@n@": F.col("p_size").cast("string"), "@a@": S.slug_plain(F.col("p_name")), "@b@": S.slug_plain(F.col("p_brand"))}
    for token, value in columns.items():
        if token in text:
            out = F.replace(out, F.lit(token), value)
    return out


def filled_sql(expression: str) -> str:
    for token, value in _TOKENS.items():
        expression = f"replace({expression}, '{token}', {value})"
    return expression


def quoted(text) -> str:
    return "NULL" if text is None else f"CAST({text} AS DOUBLE)" if isinstance(text, float) else str(text) if isinstance(text, int) else "'" + text.replace("'", "''") + "'"


def by_form(forms: list[str]) -> Column:
    """The template of a part's form, by its key."""
    out = F
    for i, text in enumerate(forms):
        out = out.when(F.col("p_partkey") % len(forms) == i, filled(text))
    return out


def rows_sql(names: list[str], rows: list[list[tuple]], texts: set[str]) -> str:
    """SQL of the rows that each form gives; the columns in ``texts`` are templates."""
    values = ", ".join("(" + ", ".join(map(quoted, (form, *row))) + ")" for form, found in enumerate(rows) for row in found)
    columns = ", ".join(f"{filled_sql(n)} AS {n}" if n in texts else n for n in names)
    return f"SELECT p_partkey AS key, {columns} FROM part JOIN (VALUES {values}) v(form, {', '.join(names)}) ON p_partkey % {len(rows)} = form"


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dealt(table(spark, sf_dir, "part"), "p_partkey")


def forms_query(name: str, forms: list[tuple[str, list[tuple]]], names: list[str], texts: set[str], run: Callable[[DataFrame], DataFrame]) -> None:
    """Register a query over documents (key, text) by form; ``run`` gives (key, *names)."""

    def ask(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(parts(spark, sf_dir).select(F.col("p_partkey").alias("key"), by_form([f for f, _ in forms]).alias("text"))).select("key", *names)

    QUERIES[name] = ask
    ORACLES[name] = rows_sql(names, [found for _, found in forms], texts)


def column_query(name: str, source: str, columns: Callable[[], dict[str, Column]], sql: str) -> None:
    """Register a query that is a projection of one table."""
    QUERIES[name] = lambda spark, sf_dir: table(spark, sf_dir, source).select(*[c.alias(k) for k, c in columns().items()])
    ORACLES[name] = sql


# --- fields

_FIELDS = ['{"value": "@A@", "evidence": "page @n@", "source": "http://x/@k@"}', '"@A@"', '["@A@", "@B@"]', '{"value": null, "evidence": "none", "source": "no url"}', "null", '"  "', '{"a": @n@}']


def _field_query(name: str, out: str, of: Callable[[Column], Column], answers: list) -> None:
    forms = [(f, [(a,)]) for f, a in zip(_FIELDS, answers, strict=True)]
    texts = {out} if any(isinstance(a, str) for a in answers) else set()
    forms_query(name, forms, [out], texts, lambda docs: docs.select("key", of(F.parse_json("text")).alias(out)))


_field_query("get_value", "json", lambda v: F.coalesce(F.to_json(V.get_value(v)), F.lit("null")), ['"@A@"', '"@A@"', '["@A@","@B@"]', "null", "null", '"  "', '{"a":@n@}'])
_field_query("get_evidence", "evidence", V.get_evidence, ["page @n@", None, None, "none", None, None, None])
_field_query("get_source", "source", V.get_source, ["http://x/@k@", None, None, None, None, None, None])
_field_query("normalize_list", "members", lambda v: F.size(V.normalized_list(v)), [1, 1, 2, 1, 0, 1, 1])
_field_query("has_meaningful_value", "meaningful", lambda v: V.is_meaningful(v).cast("int"), [1, 1, 1, 0, 0, 0, 1])
forms_query(
    "variant_literals",
    [("@n@", [('"@n@"^^' + T.XSD + "integer",)]), ("1.5", [('"1.5"^^' + T.XSD + "float",)]), ("true", [('"true"^^' + T.XSD + "boolean",)]), ('"@A@"', [('"@A@"',)]), ('" 7 "', [('"7"^^' + T.XSD + "integer",)])],
    ["term"], {"term"}, lambda docs: docs.select("key", T.variant_literal(F.parse_json("text")).alias("term")),
)

# --- names and text

column_query("local_name", "customer", lambda: {"key": F.col("c_custkey"), "name": S.local_name(F.when(F.col("c_custkey") % 2 == 1, F.concat(F.lit("ex:"), "c_mktsegment", F.lit(":"), "c_name")).otherwise(F.col("c_name")))}, "SELECT c_custkey AS key, c_name AS name FROM customer")
column_query(
    "slug_extracted", "part", lambda: {"key": F.col("p_partkey"), "slug": S.slug_extracted(F.concat(F.lit(" κ "), "p_brand", F.lit(" Å "), "p_name"))},
    "SELECT p_partkey AS key, " + _SLUG_SQL.format("replace(lower(' κ ' || p_brand || ' Å ' || p_name), 'κ', 'kappa')") + " AS slug FROM part",
)
column_query(
    "slug_site", "part", lambda: {"key": F.col("p_partkey"), "slug": S.slug_site(F.when(F.col("p_partkey") % 3 == 0, "!!").otherwise(F.concat("p_brand", F.lit(" ω–É "), "p_name")))},
    r"SELECT p_partkey AS key, CASE WHEN p_partkey % 3 = 0 THEN 'unnamed' ELSE trim(regexp_replace(replace(lower(p_brand || ' ω–É ' || p_name), 'ω', 'omega'), '[^\p{L}\p{N}]+', '_', 'g'), '_') END AS slug FROM part",
)
column_query(
    "class_or_default", "part", lambda: {"key": F.col("p_partkey"), "class": S.class_or_default("urn:c#", F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("ns:"), "p_brand")), "Thing")},
    "SELECT p_partkey AS key, 'urn:c#' || CASE WHEN p_partkey % 3 = 0 THEN 'Thing' ELSE p_brand END AS class FROM part",
)
column_query(
    "dataset_class", "part", lambda: {"key": F.col("p_partkey"), "class": S.dataset_class_or_default("urn:d#", "urn:t#", F.when(F.col("p_partkey") % 3 == 0, "train:TrainingDataset").when(F.col("p_partkey") % 3 == 1, "data:LabeledDataset"))},
    "SELECT p_partkey AS key, CASE p_partkey % 3 WHEN 0 THEN 'urn:t#TrainingDataset' WHEN 1 THEN 'urn:d#LabeledDataset' ELSE 'urn:d#Dataset' END AS class FROM part",
)
_ALIASES = [("Discovery", "thermodynamic_stability_classification_task"), ("Hull distance-regression", "convex_hull_distance_regression_task"), ("Phonons", "phonon_thermal_conductivity_contribution_task"), ("geo opt", "relaxed_structure_matching_rmsd_task"), ("My Task", "my_task")]
column_query(
    "canonical_task", "customer", lambda: {"key": F.col("c_custkey"), "task": S.canonical_task(F.element_at(F.array(*[F.lit(a) for a, _ in _ALIASES]), (F.col("c_custkey") % 5 + 1).cast("int")))},
    "SELECT c_custkey AS key, CASE c_custkey % 5 " + " ".join(f"WHEN {i} THEN '{t}'" for i, (_, t) in enumerate(_ALIASES)) + " END AS task FROM customer",
)
forms_query(
    "paper_url",
    [("https://arxiv.org/abs/@k@", [("https://arxiv.org/pdf/@k@.pdf",)]), ("https://arxiv.org/html/@k@v1/", [("https://arxiv.org/pdf/@k@v1.pdf",)]), ("https://x.org/@k@", [("https://x.org/@k@",)]), ("", [(None,)])],
    ["url"], {"url"}, lambda docs: docs.select("key", S.paper_url(F.col("text")).alias("url")),
)
forms_query(
    "page_cells_text", [("  @A@\n\t @B@ ↑ ", [("@A@ @B@ ↑", "@A@ @B@")]), ("\u00a0@A@▼", [("@A@▼", "@A@")])],
    ["collapsed", "header"], {"collapsed", "header"}, lambda docs: docs.select("key", S.collapsed(F.col("text")).alias("collapsed"), S.header_text(F.col("text")).alias("header")),
)
column_query(
    "cell_number", "part",
    lambda: {"key": F.col("p_partkey"), "number": S.cell_number(F.when(F.col("p_partkey") % 4 == 0, F.col("p_retailprice").cast("string")).when(F.col("p_partkey") % 4 == 3, "abc"), F.when(F.col("p_partkey") % 4 == 2, F.concat("p_size", F.lit(" "))).otherwise(F.lit("N/A")))},
    "SELECT p_partkey AS key, CASE p_partkey % 4 WHEN 0 THEN CAST(trunc(p_retailprice) AS BIGINT) WHEN 2 THEN CAST(p_size AS BIGINT) END AS number FROM part",
)
column_query(
    "cell_bool", "part", lambda: {"key": F.col("p_partkey"), "yes": S.cell_bool(F.when(F.col("p_partkey") % 3 == 0, "color: lightgreen").when(F.col("p_partkey") % 3 == 1, "background:lightcoral;").otherwise("")).cast("int")},
    "SELECT p_partkey AS key, CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS yes FROM part",
)


def _created() -> dict[str, Column]:
    form, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    title = F.when(form == 0, F.date_format(day, "yyyy-MM-dd")).when(form == 1, F.concat(F.lit("Mon, "), F.date_format(day, "MMM d, yyyy"))).when(form == 2, F.date_format(day, "MMM d, yyyy"))
    text = F.when(form == 3, F.concat(F.lit(" v"), F.col("o_orderkey").cast("string")))
    return {"key": F.col("o_orderkey"), "created": S.parse_created(title, text)}


column_query(
    "parse_created", "orders", _created,
    "SELECT o_orderkey AS key, CASE o_orderkey % 4 WHEN 2 THEN strftime(o_orderdate, '%b %-d, %Y') WHEN 3 THEN 'v' || o_orderkey ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS created FROM orders",
)
forms_query(
    "model_selector", [("a/b/@B@.yml", [("@b@",)]), ("https://x/models/@B@/", [("@b@",)]), ("@B@_model_extraction.json", [("@b@",)]), (" @B@ ", [("@b@",)])],
    ["model"], {"model"}, lambda docs: docs.select("key", S.model_selector(F.col("text")).alias("model")),
)
forms_query("graph_name", [("@k@.X.TTL", [("urn:graph:@k@.x",)]), ("A@k@", [("urn:graph:a@k@",)])], ["g"], {"g"}, lambda docs: docs.select("key", turtle.graph_name(F.col("text"), "urn:graph:").alias("g")))
forms_query(
    "first_json", [('```json\n{"a": {"b": @n@}} tail } ```', [('{"a":{"b":@n@}}',)]), ("no object", [(None,)]), ('x {"a": 1} y {"b": 2}', [('{"a":1}',)])],
    ["json"], {"json"}, lambda docs: docs.select("key", F.to_json(V.first_json(F.col("text"))).alias("json")),
)
forms_query(
    "greedy_json", [('so {"a": "@A@"} ends', [('{"a":"@A@"}',)]), ('{"a": @n@}', [('{"a":@n@}',)]), ('x {"a": 1} y {"b": 2}', [(None,)])],
    ["json"], {"json"}, lambda docs: docs.select("key", F.to_json(V.greedy_json(F.col("text"))).alias("json")),
)
forms_query(
    "turtle_of_reply", [("so:\n```turtle\n<a> <b> @n@ .\n``` end", [("<a> <b> @n@ .",)]), ("hm @prefix x: <y> . x:a x:b @n@ .\n", [("@prefix x: <y> . x:a x:b @n@ .",)]), ("ah @base <u> .", [("@base <u> .",)]), (" <a> <b> <c> . ", [("<a> <b> <c> .",)])],
    ["text"], {"text"}, lambda docs: docs.select("key", V.turtle_of_reply(F.col("text")).alias("text")),
)
forms_query(
    "page_hyperparameters",
    [("About. Hyperparams lr: 0.@n@1 layers: [1, {\"a\": 2}] name: @A@ more: x Dependencies torch: 2", [(0, "lr", "0.@n@1"), (1, "layers", '[1, {"a": 2}]'), (2, "name", '"@A@"'), (3, "more", '"x"')]), ("Hyperparameters: none stated here", []), ("no heading lr: 1", [])],
    ["place", "name", "value"], {"value"},
    lambda docs: docs.select("key", F.explode(flatten.page_hyperparameter_rows("text")).alias("f")).select("key", F.col("f.place").alias("place"), "f.name", "f.value"),
)
forms_query(
    "best_sentence", [("First one. @A@ is here! other; end", [("@A@ is here!",)]), (" @B@ costs; the @A@ doesn't", [("the @A@ doesn't",)]), ("no match. none", [("no match.",)])],
    ["sentence"], {"sentence"}, lambda docs: docs.select("key", retrieval.best_sentence(F.col("text"), F.lit("what is here doesn't matter")).alias("sentence")),
)
column_query(
    "first_pages", "part", lambda: {"key": F.col("p_partkey"), "text": D.first_pages(F.array("p_name", F.lit(" "), "p_brand", "p_type"), 2)},
    "SELECT p_partkey AS key, p_name || chr(10) || chr(10) || p_brand AS text FROM part",
)


@query(r"""
SELECT s_suppkey AS key, 'papers/' || s_suppkey || '.pdf' AS evidence, CASE WHEN s_suppkey % 2 = 0 THEN '<http://paper/' || s_suppkey || '>' ELSE '<http://own/' || s_suppkey || '>' END AS source FROM supplier
""")
def provenance_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey").cast("string")
    path = F.concat(F.lit("C:\\base\\papers\\"), k, F.lit(".pdf"))
    notes = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), path.alias("evidence"), F.when(F.col("s_suppkey") % 2 == 0, T.literal(path)).otherwise(F.concat(F.lit("<http://own/"), k, F.lit(">"))).alias("source")
    )
    return repair.normalized_provenance(notes, F.lit("C:\\base"), F.concat(F.lit("http://paper/"), F.col("key").cast("string"))).select("key", "evidence", "source")


# --- flattening

forms_query(
    "metric_leaves_nested",
    [
        ('{"a": {"full": {"F1": 0.5, "MAE": @n@, "flag": true, "text": "1", "pred_file": {"x": 1}}}, "l": [1]}', [("a.full", "F1", 0.5), ("a.full", "MAE", None)]),
        ('{"F1": 2, "b": {"pred_col": 3, "c": {"d": -1.5}}}', [("", "F1", 2.0), ("b.c", "d", -1.5)]),
        ("[1, 2]", []),
    ],
    ["path", "name", "value"], set(),
    lambda docs: docs.select("key", F.explode(flatten.metric_leaf_rows("text")).alias("x")).select("key", F.array_join("x.path", ".").alias("path"), F.col("x.key").alias("name"), F.when(F.col("x.key") != "MAE", F.col("x.value")).alias("value")),
)
_LONG = "[" + ", ".join(map(str, range(13))) + "]"
forms_query(
    "yaml_flatten_nested",
    [
        ('{"a": {"b": "@A@", "o": {}}, "l": [1, "x", null], "m": [[1], {"z": @n@}]}', [("a.b", '"@A@"'), ("l", '[1, "x", null]'), ("m[0]", "[1]"), ("m[1].z", "@n@")]),
        ('{"big": ' + _LONG + ', "e": []}', [*[(f"big[{i}]", str(i)) for i in range(13)], ("e", "[]")]),
    ],
    ["path", "value"], {"value"}, lambda docs: docs.select("key", F.explode(flatten.fact_rows("text")).alias("f")).select("key", "f.path", "f.value"),
)
forms_query(
    "hyperparameter_facts", [('{"opt": {"lr": @n@, "sub": {"x": [1]}}, "e": "@A@"}', [("hyperparams.opt.lr", "lr", "opt", "@n@"), ("hyperparams.opt.sub.x", "x", "opt", "[1]"), ("hyperparams.e", "e", None, '"@A@"')]), ("{}", [])],
    ["path", "name", "category", "value"], {"value"}, lambda docs: docs.select("key", F.explode(flatten.hyperparameter_rows("text")).alias("f")).select("key", "f.path", "f.name", "f.category", "f.value"),
)
forms_query(
    "questionnaire",
    [('{"a": {"question": "Q @A@", "variable": "v", "yaml_path": "y", "b": [{"question": "R", "variable": "w", "source": "yaml"}]}, "c": {"question": "no variable"}}', [("a", "a", "Q @A@", "v", "document", "y"), ("0", "a.b.0", "R", "w", "yaml", None)])],
    ["id", "path", "question", "variable", "source", "yaml_path"], {"question"}, lambda docs: docs.select("key", F.explode(flatten.question_rows("text")).alias("q")).select("key", "q.*"),
)


def _section_query(name: str, section: str, forms: list[tuple[str, list[str]]], retrieval_: bool = False) -> None:
    forms_query(
        name, [(f, list(enumerate(names))) for f, names in forms], ["ordinal", "name"], {"name"},
        lambda docs: flatten.entities(docs, "text", section, (), retrieval_).select("key", "ordinal", "name"),
    )


_section_query("section_architectures", "architectures", [
    ('[{"name": {"value": "@A@"}}, {"id": "@B@"}, 3]', ["@A@", "@B@"]), ('{"architecture_loop": {"@A@": {}, "y": 1}, "z": {}}', ["@A@"]),
    ('{"architectures": ["@A@", {"id": "q"}], "@A@": {"k": 1}, "r": {}, "note": "text", "none": null}', ["@A@", "q", "r", "note"]),
])
_section_query("section_hyperparameters", "hyperparameters", [
    ('{"hyperparameters": [{"parameter": "@A@", "value": 1}, "bs"], "bs": {"value": 2}, "cutoff": {"value": 6}, "components": {"value": 1}}', ["@A@", "bs", "cutoff"]),
    ('{"hyperparameter_loop": {"@A@": {"value": 1}}, "x": {"value": 1}}', ["@A@"]),
])
_section_query("section_training_runs", "training_runs", [
    ('{"training_runs": ["@A@"], "@A@": {"optimizer": 1}, "r2": {"x": 1}, "r3": {"type": "Pretraining run"}, "datasets": {"epochs": 1}}', ["@A@", "r3"]),
    ('{"training_run_loop": {"@A@": {"epochs": 1}, "n": {"x": 1}}}', ["@A@"]),
])
_section_query("section_datasets", "datasets", [('{"dataset_loop": {"@A@": {}}, "x": {}}', ["@A@"]), ('{"datasets": ["@A@", {"name": "d"}], "@A@": {"k": 1}, "y": {}}', ["@A@", "d", "y"])])
_section_query("section_benchmark_tasks", "benchmark_tasks", [('{"tasks": {"@A@": {}, "u": 1}, "v": {}}', ["@A@"]), ('{"benchmark_tasks": [{"name": "@A@"}], "folds": {}, "w": {}}', ["@A@", "w"])])
_section_query("section_named_entities", "evaluation_runs", [('{"evaluation_runs": {"value": 1, "@A@": {}}, "b": {}}', ["@A@"]), ('{"evaluation_runs": ["@A@"], "@A@": {}, "folds": {}, "more": {}}', ["@A@", "more"])])
_section_query("section_loop_entries", "architectures", [('{"architecture_loop": [{"item": "@A@"}, {"identifier": "i"}, {"x": 1}]}', ["@A@", "i"]), ('{"architecture_loop": {"@A@": {}}}', ["@A@"])], True)
forms_query(
    "named_architectures", [('[{"name": "@A@", "data": "1"}, {"id": "x", "data": "2"}, {"data": "3"}, {"name": "@A@", "data": "4"}]', [("@A@", "4"), ("x", "2"), ("architecture_3", "3")])],
    ["name", "data"], {"name"},
    lambda docs: docs.select("key", F.explode(flatten.named_architectures(F.from_json("text", "array<struct<name string, id string, data string>>"))).alias("name", "data")),
)
forms_query(
    "scalar_hyperparameters", [('{"hyperparams": {"lr": @n@, "l": [1], "o": {}, "none": null, "s": "@A@"}}', [("lr", "@n@"), ("none", "null"), ("s", '"@A@"')])],
    ["name", "value"], {"value"},
    lambda docs: docs.select("key", F.explode(flatten.scalar_hyperparameters(F.parse_json("text"))).alias("name", "v")).select("key", "name", F.coalesce(F.to_json("v"), F.lit("null")).alias("value")),
)
forms_query(
    "named_data",
    [('{"runs": {"a": {"x": @n@}}, "a": {"y": 2}}', [('{"y":2}',)]), ('{"runs": {"a": {"x": @n@}}, "a": 1}', [('{"x":@n@}',)]), ('{"run_loop": {"a": {"z": 3}}}', [('{"z":3}',)]), ("[]", [("{}",)])],
    ["data"], {"data"}, lambda docs: docs.select("key", F.to_json(flatten.named_field(F.parse_json("text"), "runs", F.lit("a"))).alias("data")),
)


@query("""
WITH r AS (SELECT p_partkey AS k, 'part_' || p_partkey AS m FROM part),
l AS (SELECT * FROM (VALUES ('discovery', 'full.κ x', 'F1', 'thermodynamic_stability_classification'), ('phonons', 'a.b', 'κ_SRME', 'phonon_thermal_conductivity_contribution'), ('geo_opt', 'symprec=1e-5', 'rmsd', 'relaxed_structure_matching_rmsd')) AS v(family, path, key, run))
SELECT m || '_matbench_discovery_' || run || '_' || CASE family WHEN 'discovery' THEN 'discovery_full_kappa_x_f1' WHEN 'phonons' THEN 'phonons_a_b_kappa_srme' ELSE 'geo_opt_symprec_1e_5_rmsd' END AS result,
       'metrics.' || family || '.' || path || '.' || key AS evidence FROM r, l
""")
def metric_result_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = [("discovery", ["full", "κ x"], "F1"), ("phonons", ["a", "b"], "κ_SRME"), ("geo_opt", ["symprec=1e-5"], "rmsd"), ("discovery", ["full"], "unrouted")]
    leaves = spark.createDataFrame(stated, "family string, path array<string>, key string")
    models = parts(spark, sf_dir).select(F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("model"))
    return flatten.routed_metrics(models.crossJoin(F.broadcast(leaves))).select("result", "evidence")


# --- chunks and evidence


@query("""
SELECT 'P' || turn || '-C1' AS id, conv_id AS conv, 'x' || turn AS chunk FROM conversations
UNION ALL SELECT 'P' || turn || '-C2', conv_id, 'x' || turn || ' ' || repeat('y', 900) FROM conversations
""")
def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.concat(F.lit("x"), F.col("turn").cast("string"))
    pages = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("page"), F.concat(turn, F.lit("\n\n"), F.lit("y" * 900)).alias("text"))
    return retrieval.page_chunks(pages).select("id", F.col("conv_id").alias("conv"), "chunk")


@query("SELECT 'O-onto.v' || p_partkey || '-1' AS id, p_name || ' ' || p_brand AS chunk, 'ontology' AS kind FROM part")
def ontology_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = parts(spark, sf_dir).select(filled("onto.v@k@.ttl").alias("file"), filled("@A@\n@B@\n").alias("text"))
    return retrieval.ontology_chunks(files).select("id", "chunk", "kind")


@query("SELECT p_partkey AS key, 'Y' || n AS id, path || ' = ' || CASE path WHEN 'a.b' THEN '\"' || p_name || '\"' ELSE CAST(p_size AS VARCHAR) END AS chunk FROM part, (VALUES (1, 'a.b'), (2, 'c')) v(n, path)")
def yaml_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parts(spark, sf_dir).select(F.col("p_partkey").alias("key"), filled('{"a": {"b": "@A@"}, "c": @n@}').alias("text"))
    facts = docs.select("key", F.posexplode(flatten.fact_rows("text")).alias("ordinal", "f")).select("key", "ordinal", "f.path", "f.value")
    return retrieval.yaml_chunks(facts).select("key", "id", "chunk")


_CHUNK_SQL = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS n, line FROM (
    SELECT doc_id, unnest(lines) AS raw, generate_subscripts(lines, 1) AS place, trim(regexp_replace(raw, '[\s\x0B\p{Z}]+', ' ', 'g')) AS line
    FROM (SELECT doc_id, regexp_split_to_array(replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[\n\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]') AS lines FROM documents))
  WHERE line <> ''),
s AS (
  SELECT doc_id, n, line AS open, line AS last, length(line) + 1 AS size, CAST(NULL AS VARCHAR) AS done FROM l WHERE n = 1
  UNION ALL
  SELECT l.doc_id, l.n, CASE WHEN s.size + length(l.line) + 1 > 900 THEN s.last || ' ' || l.line ELSE s.open || ' ' || l.line END, l.line,
         CASE WHEN s.size + length(l.line) + 1 > 900 THEN length(s.last) + length(l.line) + 2 ELSE s.size + length(l.line) + 1 END,
         CASE WHEN s.size + length(l.line) + 1 > 900 THEN s.open END
  FROM s JOIN l ON l.doc_id = s.doc_id AND l.n = s.n + 1),
c AS (
  SELECT doc_id, n, done AS chunk FROM s WHERE done IS NOT NULL
  UNION ALL SELECT doc_id, n + 1, open FROM (SELECT *, max(n) OVER (PARTITION BY doc_id) AS m FROM s) WHERE n = m)
SELECT doc_id, 'D' || doc_id || '-C' || row_number() OVER (PARTITION BY doc_id ORDER BY n) AS id, CAST(length(chunk) AS INT) AS length, md5(chunk) AS digest FROM c
"""
ORACLES["chunk_texts"] = _CHUNK_SQL

column_query(
    "expand_query", "part", lambda: {"key": F.col("p_partkey"), "text": retrieval.expand(F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit(" Evaluation"))).otherwise(F.col("p_name")))},
    "SELECT p_partkey AS key, CASE WHEN p_partkey % 2 = 0 THEN p_name || ' Evaluation " + retrieval.EXPANSIONS["evaluation"] + "' ELSE p_name END AS text FROM part",
)
_STOP = ", ".join(f"'{w}'" for w in retrieval.STOP_WORDS)


@query(f"""
WITH p AS (SELECT p_partkey AS id, list_filter(string_split(p_name, ' '), lambda t: length(t) > 1 AND t NOT IN ({_STOP})) AS t FROM part), n AS (SELECT count(*) AS n FROM p),
i AS (SELECT DISTINCT id, unnest(t) AS token FROM p), w AS (SELECT token, ln(1 + (max(n) + 1) / (count(*) + 1)) AS weight FROM i, n GROUP BY token),
q AS (SELECT p_type AS query, token, count(*) AS times FROM (SELECT p_type, unnest(string_split(min(p_name) || ' ' || max(p_name), ' ')) AS token FROM part GROUP BY p_type) GROUP BY ALL),
s AS (SELECT query, id, sum(times * weight) AS score FROM q JOIN w USING (token) JOIN i USING (token) GROUP BY query, id)
SELECT query, id, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, id) AS rank FROM s) WHERE rank <= 5
""")
def rank_common_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names are made of few words, so that all tokens are common ones."""
    passages = parts(spark, sf_dir).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text"))
    asked = parts(spark, sf_dir).groupBy(F.col("p_type").alias("query")).agg(F.concat_ws(" ", F.min("p_name"), F.max("p_name")).alias("text"))
    return retrieval.rank(asked, passages, 5, expanded=False).select("query", "id", F.col("rank").cast("long").alias("rank"))


@query("SELECT 'C' || n_nationkey AS class, 'a.ttl' AS file, 'C' || n_nationkey || ' | a.ttl | declared rdf:type owl:Class' AS line FROM nation UNION ALL SELECT 'D' || n_nationkey, 'b.ttl', 'D' || n_nationkey || ' | b.ttl | declared rdf:type owl:Class' FROM nation")
def class_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.class_catalog(_ontology(spark, sf_dir))


def _ontology(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey").cast("string")
    declared = lambda p: F.concat(F.lit(f":{p}"), n, F.lit(" rdf:type owl:Class .\n"))
    nations = table(spark, sf_dir, "nation")
    return nations.select(F.lit("a.ttl").alias("file"), declared("C").alias("text")).unionByName(nations.select(F.lit("b.ttl").alias("file"), F.concat(declared("D"), declared("C")).alias("text")))


@query("""
SELECT s_suppkey AS key, CASE WHEN s_suppkey % 3 = 0 THEN 'C' || (s_suppkey % 25) WHEN s_suppkey % 3 = 1 THEN 'Dataset' END AS class,
       CASE WHEN s_suppkey % 3 = 0 THEN 'Ontology a.ttl [O-CLASS-CATALOG]: C' || (s_suppkey % 25) || ' is declared rdf:type owl:Class.' WHEN s_suppkey % 3 = 1 THEN 'Ontology a.ttl [O-CLASS-CATALOG]: Dataset is declared rdf:type owl:Class.' END AS class_evidence
FROM supplier
""")
def refined_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = retrieval.class_catalog(_ontology(spark, sf_dir)).select("class", "file").unionByName(spark.createDataFrame([("Dataset", "a.ttl")], "class string, file string"))
    k = F.col("s_suppkey")
    fields = table(spark, sf_dir, "supplier").select(
        k.alias("key"), F.when(k % 3 == 1, "datasets.x.ontology_class").otherwise("other.ontology_class").alias("path"), F.when(k % 3 == 0, F.concat(F.lit("ns:C"), (k % 25).cast("string"))).otherwise("ns:Unheard").alias("value")
    )
    return retrieval.refined_classes(fields, catalog).select("key", "class", "class_evidence")


_NESTED = [
    ('{"runs": [{"value": "the @A@", "evidence": "see P1-C1, P2-C1", "source": null}, 7, [{"value": @n@, "evidence": "own words"}]], "e": {}}', '{"e":{},"runs":[{"evidence":"PDF p. 7 [P1-C1]: \\"the @A@ was grown.\\"","source":"http://x/@k@.pdf","value":"the @A@"},7,[{"evidence":"own words","value":@n@}]]}'),
    ('{"datasets": {"x": {"ontology_class": {"value": "ns:Unheard", "evidence": "P1-C1"}}}, "y": {"ontology_class": {"value": "Unheard", "evidence": "P9-C9"}}}', '{"datasets":{"x":{"ontology_class":{"evidence":"Ontology a.ttl [O-CLASS-CATALOG]: Dataset is declared rdf:type owl:Class.","value":"Dataset"}}},"y":{"ontology_class":{"evidence":"P9-C9","value":null}}}'),
    ('{"h": {"ontology_class": {"value": {"value": 1, "evidence": "P1-C1"}, "evidence": "x"}}, "lr": {"value": "@n@", "evidence": "M-HYP-4 or M-HYP-1"}, "bs": {"value": 1, "evidence": "[HY-HYP-2]"}}', '{"bs":{"evidence":"YAML [HY-HYP-2]: bs = @n@","value":1},"h":{"ontology_class":{"evidence":"x","value":null}},"lr":{"evidence":"Model page [M-HYP-1]: lr = @n@","source":"http://page/@k@","value":"@n@"}}'),
    ('{"deep": {"value": {"list": [{"value": "b", "evidence": "P2-C1"}]}, "evidence": "Y1"}, "head_ontology_class": {"value": "ns:C3", "evidence": null}}', '{"deep":{"evidence":"Y1","value":{"list":[{"evidence":"PDF p. 8 [P2-C1]: \'Say \\"@B@\\".\'","source":"http://x/@k@.pdf","value":"b"}]}},"head_ontology_class":{"evidence":"Ontology a.ttl [O-CLASS-CATALOG]: C3 is declared rdf:type owl:Class.","value":"ns:C3"}}'),
    ('{"plain": [1, null]}', '{"plain":[1,null]}'),
    ("no document", None),
]


@query(rows_sql(["document"], [[(a,)] for _, a in _NESTED], {"document"}))
def refined_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole nested documents, from document in to document out."""
    rows = parts(spark, sf_dir).select(F.col("p_partkey").alias("doc"), by_form([f for f, _ in _NESTED]).alias("text"))
    one = lambda id_, kind, page, text, source=None: F.struct(F.lit(id_).alias("id"), F.lit(kind).alias("kind"), F.lit(page).alias("page"), filled(text).alias("text"), (filled(source) if source else F.lit(None).cast("string")).alias("source"))
    held = F.array(
        one("P1-C1", "pdf", 7, "It rained. the @A@ was grown. Others.", "http://x/@k@.pdf"), one("P2-C1", "pdf", 8, 'Say "@B@".', "http://x/@k@.pdf"), one("Y1", "yaml", 0, "a = 1"),
        one("M-HYP-1", "model_page", 0, "lr = @n@", "http://page/@k@"), one("HY-HYP-2", "yaml", 0, "bs = @n@"),
    )
    passages = parts(spark, sf_dir).select(F.col("p_partkey").alias("doc"), F.explode(held).alias("x")).select("doc", "x.*")
    catalog = retrieval.class_catalog(_ontology(spark, sf_dir)).select("class", "file").unionByName(spark.createDataFrame([("Dataset", "a.ttl")], "class string, file string"))
    return refine.refine(rows, passages, catalog).select(F.col("doc").alias("key"), F.to_json("document").alias("document"))


@query("""
SELECT p_partkey AS key, CASE p_partkey % 3 WHEN 0 THEN 'PDF page 7: "the ' || p_name || ' here."' WHEN 1 THEN 'lr = 1' ELSE 'own words' END AS evidence,
       '[P7-C1 | PDF page 7]' || chr(10) || p_name AS label, CASE WHEN p_partkey % 2 = 0 THEN 'Model page [M-HYP-1]: lr = ' || p_size ELSE 'YAML [HY-HYP-1]: lr = ' || p_size END AS cited FROM part
""")
def refined_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    null = F.lit(None).cast("string")
    chunk = F.when(k == 0, filled("Some words. the @A@ here. others")).when(k == 1, "lr = 1")
    kind = F.when(k == 0, "pdf").when(k == 1, "yaml")
    return parts(spark, sf_dir).select(
        F.col("p_partkey").alias("key"), retrieval.refined_evidence(F.lit("own words"), chunk, kind, F.lit(7), F.col("p_name")).alias("evidence"),
        retrieval.label_of(F.lit("pdf"), F.lit("P7-C1"), F.lit(7), null, null, F.col("p_name")).alias("label"),
        retrieval.cited_hyperparameters(F.lit("x"), F.when(F.col("p_partkey") % 2 == 0, "M-HYP-1").otherwise("HY-HYP-1"), filled("lr = @n@")).alias("cited"),
    )


@query("""
SELECT p_partkey AS doc, CASE WHEN p_partkey % 2 = 0 THEN 'M-HYP-1' ELSE 'HY-HYP-' || n END AS id, CASE WHEN p_partkey % 2 = 0 THEN 'page' ELSE 'yaml' || n END AS name
FROM part, (VALUES (1), (2)) v(n) WHERE p_partkey % 2 = 1 OR n = 1
""")
def known_hyperparameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parts(spark, sf_dir).select(F.col("p_partkey").alias("doc"), F.explode(F.array(F.lit(0), F.lit(1))).alias("ordinal"))
    page = rows.where("doc % 2 = 0 AND ordinal = 0").withColumn("name", F.lit("page"))
    yaml = rows.withColumn("name", F.concat(F.lit("yaml"), (F.col("ordinal") + 1).cast("string")))
    return retrieval.known_hyperparameters(page, yaml).select("doc", "id", "name")


@query("""
SELECT s_suppkey AS doc, query, ids FROM supplier, (VALUES ('q1', 'O-CLASS-CATALOG,O-b-1'), ('q2', 'Y2,Y1,P1-C1'), ('q3', 'O-CLASS-CATALOG,O-a-1,P1-C1'), ('known_hyperparameter::h.lr', 'M-HYP-1,P2-C1')) AS v(query, ids)
WHERE s_suppkey % 2 = 1 UNION ALL
SELECT s_suppkey, query, ids FROM supplier, (VALUES ('q1', 'O-CLASS-CATALOG,O-a-1'), ('q2', 'Y1,Y2'), ('q3', 'O-CLASS-CATALOG'), ('known_hyperparameter::h.lr', 'M-HYP-1,P1-C1')) AS v(query, ids)
WHERE s_suppkey % 2 = 0
""")
def question_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same questions of each supplier's documents, which differ; ids are the same in all, so that none may mix."""
    docs = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc"))

    def rows(data: list[tuple], schema: str) -> DataFrame:
        """Rows of every document, or of those with an odd (1) or even (0) number, as their first value says."""
        held = F.broadcast(spark.createDataFrame(data, "parity int, " + schema))
        return docs.join(held, F.col("parity").isNull() | (F.col("doc") % 2 == F.col("parity"))).drop("parity")

    questions = rows([
        (None, "q1", "a", "which banana", "v", "ontology_mapping", None), (1, "q2", "b", "how many apples", "w", "document", "b.y"), (0, "q2", "b", "how many apples", "w", "document", "b.x"),
        (None, "q3", "c", "cherry kinds", "head_ontology_class", "ontology_mapping", None),
    ], "id string, path string, question string, variable string, source string, yaml_path string")
    facts = rows([(1, "Y1", "b.x", "apples = 3"), (1, "Y2", "b.y", "pears = 4"), (0, "Y1", "b.x", "pears = 4"), (0, "Y2", "b.y", "apples = 3")], "id string, path string, chunk string")
    pages = rows([(1, "P1-C1", "cherry and apples grow"), (1, "P2-C1", "lr 0.5 was chosen"), (0, "P1-C1", "lr 0.5 was chosen")], "id string, chunk string")
    ontology = rows([(1, "O-a-1", "cherry tree"), (1, "O-b-1", "banana plant"), (0, "O-a-1", "banana plant")], "id string, chunk string")
    known = rows([(None, "M-HYP-1", "h.lr", "lr", None, "0.5")], "id string, path string, name string, category string, value string")
    return retrieval.question_packets(questions, facts, pages, ontology, known, scope=["doc"]).select("doc", "query", F.array_join("ids", ",").alias("ids"))


# --- resolution and merging


@query("SELECT c_custkey AS key, CASE WHEN c_custkey % 2 = 0 THEN 'urn:known/' || c_custkey ELSE 'urn:new/' || replace(lower(c_name), '#', '_') END AS iri, c_custkey % 2 = 0 AS known FROM customer")
def resolve_by_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    known = c.where("c_custkey % 2 = 0").select(F.upper(F.replace("c_name", F.lit("#"), F.lit(" "))).alias("name"), F.concat(F.lit("urn:known/"), F.col("c_custkey").cast("string")).alias("iri"))
    return resolve.by_slug(c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), known, "urn:new/").select("key", "iri", "known")


column_query(
    "target_variant", "part", lambda: {"key": F.col("p_partkey"), "target": resolve.is_target(F.concat("p_brand", F.when(F.col("p_partkey") % 3 == 0, F.lit(" v2")).otherwise(F.lit(""))), F.array(F.lit("brand_1"), F.lit("brand_2_x")))},
    "SELECT p_partkey AS key, p_brand = 'Brand#1' OR (p_brand = 'Brand#2' AND p_partkey % 3 <> 0) AS target FROM part",
)


@query("SELECT link FROM (SELECT DISTINCT 'urn:' || c_name AS link FROM customer) ORDER BY link LIMIT 10 OFFSET 4")
def numbered_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.numbered_slice(table(spark, sf_dir, "customer").select(F.concat(F.lit("urn:"), "c_name").alias("link")), 5, 10)


@query("SELECT o_custkey AS s, o_orderpriority AS p, max(o_orderkey) AS o FROM orders GROUP BY ALL")
def last_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "orders").select(F.lit("g").alias("g"), F.col("o_custkey").alias("s"), F.col("o_orderpriority").alias("p"), F.col("o_orderkey").alias("o"))
    return mapping.last_set(made, "o").select("s", "p", "o")


def _runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    run = F.concat(F.when(F.col("o_orderkey") % 3 == 0, F.lit("stated_")).otherwise(F.lit("found_")), F.col("o_orderkey").cast("string"))
    return orders.select(F.col("o_custkey").alias("doc"), run.alias("run")), orders.select(F.col("o_custkey").alias("doc"), run.alias("run"), F.col("o_totalprice").alias("value"))


@query("SELECT o_custkey AS doc, 'found_' || o_orderkey AS run, o_totalprice AS value FROM orders WHERE o_orderkey % 3 <> 0")
def without_stale_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.without_stale(*_runs(spark, sf_dir), "stated_")[1]


@query("SELECT o_custkey AS doc, 'found_' || o_orderkey AS run FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT DISTINCT o_custkey, 'yaml_' || (o_custkey % 2) FROM orders")
def stale_then_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, metrics = _runs(spark, sf_dir)
    stated = runs.select("doc", F.concat(F.lit("yaml_"), (F.col("doc") % 2).cast("string")).alias("run")).distinct()
    return merge.shallow_merge(stated, merge.without_stale(runs, metrics, "stated_")[0], ["doc", "run"])


@query("""
WITH old AS (SELECT c_nationkey AS doc, c_name AS name, 'old' AS v FROM customer WHERE c_nationkey < 10), new AS (SELECT c_nationkey AS doc, c_name AS name, 'new' AS v FROM customer WHERE c_nationkey >= 5)
SELECT * FROM old UNION ALL SELECT * FROM new WHERE doc >= 10
""")
def guarded_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("doc"), F.col("c_name").alias("name"))
    return merge.guarded_merge(c.where("doc >= 5").withColumn("v", F.lit("new")), c.where("doc < 10").withColumn("v", F.lit("old")), ["doc"], ["doc", "name"])


@query("""
SELECT p_partkey AS doc, 'net' AS architecture, name, CASE name WHEN 'L R' THEN CASE WHEN p_partkey % 2 = 0 THEN '0.1' ELSE '5' END WHEN 'cutoff' THEN CAST(p_size AS VARCHAR) ELSE 'own' END AS value,
       CASE name WHEN 'L R' THEN CASE WHEN p_partkey % 2 = 0 THEN 'hyperparams.l_r' ELSE 'p' END WHEN 'cutoff' THEN 'hyperparams.cutoff' ELSE 'p' END AS evidence
FROM part, (VALUES ('L R'), ('only'), ('cutoff')) v(name) WHERE p_partkey % 5 <> 0
UNION ALL SELECT p_partkey, 'net', name, CASE name WHEN 'L R' THEN CASE WHEN p_partkey % 2 = 0 THEN ' ' ELSE '5' END ELSE 'own' END, 'p' FROM part, (VALUES ('L R'), ('only')) v(name) WHERE p_partkey % 5 = 0
""")
def fill_hyperparameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth document states none."""
    docs = parts(spark, sf_dir).select(F.col("p_partkey").alias("doc"), "p_size")
    named = docs.select("doc", F.lit("net").alias("architecture"), F.explode(F.array(F.lit("L R"), F.lit("only"))).alias("name"))
    own = named.withColumn("value", F.when(F.col("name") == "only", "own").when(F.col("doc") % 2 == 0, " ").otherwise("5")).withColumn("evidence", F.lit("p"))
    stated = docs.where("doc % 5 <> 0").select("doc", F.explode(F.create_map(F.lit("l_r"), F.lit("0.1"), F.lit("cutoff"), F.col("p_size").cast("string"))).alias("name", "value"))
    return merge.with_stated_hyperparameters(own, stated)


@query("""
SELECT p_partkey AS doc, CASE WHEN p_partkey % 3 = 0 THEN 'r1' ELSE 'part_' || p_partkey || '_training_run' END AS run, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN 'SGD' WHEN p_partkey % 4 <> 0 THEN 'Adam' END AS optimizer,
       CASE WHEN p_partkey % 4 <> 0 THEN 'mse' END AS loss FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 4 <> 0
""")
def synthesised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document has a run, and all but every fourth state hyperparameters."""
    docs = parts(spark, sf_dir).select(F.col("p_partkey").alias("doc"), F.concat(F.lit("Part "), F.col("p_partkey").cast("string")).alias("model"))
    runs = docs.where("doc % 3 = 0").select("doc", F.lit("r1").alias("run"), F.when(F.col("doc") % 2 == 0, "SGD").otherwise(" ").alias("optimizer"), F.lit(None).cast("string").alias("loss"))
    stated = docs.where("doc % 4 <> 0").select("doc", F.explode(F.create_map(F.lit("optimizer"), F.lit("Adam"), F.lit("loss"), F.lit("mse"))).alias("name", "value"))
    return merge.with_training_run(docs, runs, stated)


column_query(
    "hoisted_runs", "part", lambda: {"key": F.col("p_partkey"), "runs": merge.hoisted(F.get_json_object(by_form(['{"training": {"training_runs": "@A@"}}', '{"training_runs": "@B@", "training": {}}']), "$.training.training_runs"), F.get_json_object(by_form(['{"training": {"training_runs": "@A@"}}', '{"training_runs": "@B@", "training": {}}']), "$.training_runs"))},
    "SELECT p_partkey AS key, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_brand END AS runs FROM part",
)


@query("SELECT o_orderkey AS key, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END) AS value FROM orders")
def fallback_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    own = orders.select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("value"))
    return sinks.with_fallback(own, orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("value")), "key", "value")


@query("SELECT c_custkey AS key FROM customer WHERE c_custkey % 3 = 0")
def date_sync_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("variant"))
    return D.date_sync(c, c.where("key % 3 <> 0").select("key", F.lit("2020-01-01").cast("date").alias("date")))[1].select("key")


# --- Turtle, stores and reports

_LINES = "<a> <b> @n@ .\n  << <urn:s@k@> x:p \"@A@ b\"@en >> prov:wasDerivedFrom 1 .\ny >> prov:wasDerivedFrom @n@\nend"
forms_query(
    "annotation_lines", [(_LINES, [("<a> <b> @n@ .\ny >> prov:wasDerivedFrom @n@\nend", "<a> <b> @n@ .\nend", '  << <urn:s@k@> x:p "@A@ b"@en >> prov:wasDerivedFrom 1 .', "<urn:s@k@>", '"@A@ b"@en')])],
    ["stripped", "for_repair", "kept", "s", "o"], {"stripped", "for_repair", "kept", "s", "o"},
    lambda docs: docs.select("key", turtle.strip_annotations(F.col("text")).alias("stripped"), turtle.strip_annotations(F.col("text"), True).alias("for_repair"), F.get(turtle.extract_annotations(F.col("text")), 0).alias("kept"))
    .withColumn("q", turtle.quoted_triple(F.col("kept"))).select("*", F.col("q.s").alias("s"), F.col("q.o").alias("o")),
)


@query(f"""
SELECT '<{EX}nation/' || n_nationkey || '>' AS s, p, CASE p WHEN '{T.TYPE}' THEN '<{EX}Nation>' WHEN '<{EX}n_name>' THEN '"' || n_name || '"' ELSE '<{EX}region/' || n_regionkey || '>' END AS o
FROM nation, (VALUES ('{T.TYPE}'), ('<{EX}n_name>'), ('<{EX}n_region>')) v(p)
""")
def turtle_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations written as Turtle files, one of which can't be read, and read again."""
    path = sinks.scratch(spark, "turtle")
    sinks.write_turtle(lifted(spark, sf_dir, "nation"), path)
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.lit(EX).alias("g"), F.col("value").alias("text"))
    bad = spark.createDataFrame([("bad", "<a> <b")], "g string, text string")
    return turtle.parse_documents(files.unionByName(bad))[0].select("s", "p", "o")


@query(ORACLES["turtle_triples"])
def turtle_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, read in parts."""
    path = sinks.scratch(spark, "turtle")
    sinks.write_turtle(lifted(spark, sf_dir, "nation"), path)
    return turtle_split.read_parts(spark, path + "/*", glob="*")[0].select("s", "p", "o")


@query("SELECT 'bad' || (n_nationkey % 3) AS g FROM nation WHERE n_nationkey < 3")
def quarantined_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    docs = table(spark, sf_dir, "nation").select(F.when(n < 3, F.concat(F.lit("bad"), n.cast("string"))).otherwise(F.concat(F.lit("good"), n.cast("string"))).alias("g"), F.when(n < 3, "<a> <b>").otherwise("<urn:a> <urn:b> 1 .").alias("text"))
    return turtle.parse_documents(docs)[2].select("g")


@query("SELECT n_name AS label, 'nation' AS kind, n_nationkey AS key FROM nation")
def ontology_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are there and one that isn't, as one graph."""
    paths = [sinks.scratch(spark, "ontology") for _ in range(3)]
    for i, path in enumerate(paths[:2]):
        half = lifted(spark, sf_dir, "nation").where(F.pmod(F.xxhash64("s"), F.lit(2)) == i)
        turtle.to_documents(half).select("text").write.text(path)
    every = mapping.union(turtle.parse_documents(turtle.read_existing(spark, paths).withColumn("g", F.lit(EX)))[0])
    named = every.where(F.col("p") == f"<{EX}n_name>")
    return named.select(T.lexical(F.col("o")).alias("label"), F.lit("nation").alias("kind"), F.substring_index(T.lexical(F.col("s")), "/", -1).cast("int").alias("key"))


@query("SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation")
def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.scratch(spark, "json")
    n = table(spark, sf_dir, "nation")
    sinks.write_json(n.select(F.col("n_nationkey").alias("file"), "n_nationkey", "n_name", "n_regionkey", F.lit("é").alias("sign")), path, by="file")
    get = lambda k, t: F.try_variant_get("document", f"$.{k}", t)
    return D.read_json(spark, path).where(get("sign", "string") == "é").select(get("n_nationkey", "int").alias("key"), get("n_name", "string").alias("name"), get("n_regionkey", "int").alias("region"))


forms_query(
    "yaml_documents", [("model_key: '@A@' # c\nn: {m: [1, @n@]}\nd: 2020-01-02\n", [('["@A@","@n@","2020-01-02"]',)]), (": [", [(None,)])],
    ["found"], {"found"},
    lambda docs: docs.select("key", D.yaml_to_json("text").alias("j")).select("key", F.when(F.col("j").isNotNull(), F.to_json(F.array(F.get_json_object("j", "$.model_key"), F.get_json_object("j", "$.n.m[1]"), F.get_json_object("j", "$.d")))).alias("found")),
)


def _region_graphs(spark: SparkSession, sf_dir: str, name: Column | None = None) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("urn:g/"), F.col("n_regionkey").cast("string")).alias("g"), F.concat(F.lit("urn:"), F.col("n_nationkey").cast("string")).alias("s"), F.lit("name").alias("p"), (F.col("n_name") if name is None else name).alias("o"))


def _stored(spark: SparkSession, sf_dir: str, *then: Callable[[quadstore.QuadStore], object]) -> DataFrame:
    store = quadstore.QuadStore(spark, sinks.scratch(spark, "store"), keep={"urn:g/0"})
    store.replace(_region_graphs(spark, sf_dir))
    for step in then:
        step(store)
    return store.read()


@query("SELECT 'urn:g/' || n_regionkey AS g, 'urn:' || n_nationkey AS s, o FROM nation, (VALUES (0), (1)) v(i), LATERAL (SELECT CASE i WHEN 0 THEN n_name ELSE lower(n_name) END AS o) WHERE i = 0 OR n_regionkey = 1")
def store_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = _region_graphs(spark, sf_dir, F.lower("n_name")).where("g = 'urn:g/1'").unionByName(_region_graphs(spark, sf_dir).where("g = 'urn:g/2'"))
    return _stored(spark, sf_dir, lambda s: s.append(more)).select("g", "s", "o")


@query("SELECT 'urn:g/' || n_regionkey AS g, 'urn:' || n_nationkey AS s FROM nation WHERE n_regionkey NOT IN (1, 3)")
def store_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, lambda s: s.clear("urn:g/1", "urn:g/3", "urn:g/none")).select("g", "s")


@query("SELECT 'urn:g/' || n_regionkey AS g, 'urn:' || n_nationkey AS s FROM nation WHERE n_regionkey = 0")
def store_clear_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, lambda s: s.clear_others()).select("g", "s")


@query("""
SELECT 'append' AS mode, 'urn:g/' || n_regionkey AS g, n_name AS o FROM nation UNION ALL SELECT 'append', 'urn:g/1', lower(n_name) FROM nation WHERE n_regionkey = 1
UNION ALL SELECT 'replace_one', 'urn:g/' || n_regionkey, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END FROM nation
UNION ALL SELECT 'replace_all', 'urn:g/' || n_regionkey, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END FROM nation WHERE n_regionkey IN (0, 1)
""")
def store_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = _region_graphs(spark, sf_dir, F.lower("n_name")).where("g = 'urn:g/1'")
    found = [_stored(spark, sf_dir, lambda s, m=m: s.load(new, m)).select(F.lit(m).alias("mode"), "g", "o") for m in ("append", "replace_one", "replace_all")]
    return reduce(DataFrame.unionByName, found)


@query("SELECT n_regionkey AS region, 'archind:n' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || ' arch:hasReleaseDate \"2020-01-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') || '\"^^xsd:date .' AS block FROM nation")
def release_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    variant = F.concat(F.lit("n"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    made = D.release_document(n.select(variant.alias("variant"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("n_nationkey")).alias("date")))
    return made.join(n.select(variant.alias("variant"), F.col("n_regionkey").alias("region")), "variant").select("region", "block")


_BAD = """
SELECT k, count(*) AS violations FROM (
  SELECT c_custkey AS k FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 7 = 0 AND c_custkey % 13 <> 0
  UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 13 = 0 AND c_custkey % 7 <> 0 AND lower(c_name) <> c_name
  UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 11 <> 0 AND c_acctbal < 0) GROUP BY k
"""


def _customer_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty customers, a graph each.

    Validation reads its quads many times; they are held once, in tasks by graph, so that what
    meets within a graph needs no exchange and a task's work doesn't grow with the table.
    """
    quads = faulty_customers(spark, sf_dir).withColumn("g", F.regexp_extract("s", "([0-9]+)>$", 1))
    return quads.repartition(D.tasks_of(table(spark, sf_dir, "customer")), "g").persist()


def _customer_shapes() -> list:
    return [s for s in shacl.read_shapes(_SHAPES) if s.ident == f"<{EX}CustomerShape>"]


@query(f"""
WITH b AS ({_BAD})
SELECT CAST(c_custkey AS VARCHAR) AS g, coalesce(violations, 0) AS violations, CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 17 = 0 AND c_mktsegment <> 'OTHER' THEN 1 ELSE 0 END AS warnings,
       CASE WHEN c_custkey % 11 = 0 THEN 0 WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS unknown, coalesce(violations, 0) = 0 AND (c_custkey % 11 = 0 OR c_custkey % 5 <> 0) AS conforms
FROM customer LEFT JOIN b ON k = c_custkey
""")
def shacl_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of a graph for each customer; every fifth has a type that the ontology doesn't know."""
    quads = _customer_graphs(spark, sf_dir)
    odd = quads.where((F.col("p") == T.TYPE) & (F.col("g").cast("long") % 5 == 0)).withColumn("o", F.lit(f"<{EX}Unheard>"))
    quads = quads.unionByName(odd)
    ontology = spark.createDataFrame([(f"<{EX}Customer>", T.TYPE, f"<{T.OWL}Class>")], "s string, p string, o string")
    found = shacl.verdicts(quads, shacl.validate(quads, _customer_shapes()), shacl.unknown_types(quads, ontology, [EX]))
    return found.select("g", "violations", F.col("warnings").cast("int").alias("warnings"), F.col("unknown").cast("int").alias("unknown"), "conforms")


_LINES = f"""
SELECT CAST(c_custkey AS VARCHAR) AS g, 'Violation | <{EX}customer/' || c_custkey || '> | <{EX}c_acctbal> | minInclusive | "' || c_acctbal || '"^^{T.XSD}double | a balance' AS line
FROM customer WHERE c_custkey % 11 <> 0 AND c_acctbal < 0"""


@query(_LINES)
def shacl_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that reports have of balances below nothing, whatever else is wrong."""
    report = shacl.validate(_customer_graphs(spark, sf_dir), _customer_shapes())
    return shacl.rendered(report).select("g", F.explode(F.split("text", "\n")).alias("line")).where("line LIKE '%| minInclusive |%'")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS g, CASE WHEN c_custkey % 10 = 0 THEN '-1.0' ELSE CAST(c_acctbal AS VARCHAR) END AS balance
FROM customer WHERE c_custkey % 11 <> 0 AND (c_custkey % 10 = 0 OR c_acctbal < 0)
""")
def shacl_revalidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after a tenth of the balances has changed, brought up to date from the one before."""
    old = _customer_graphs(spark, sf_dir)
    changed = (F.col("p") == f"<{EX}c_acctbal>") & (F.col("g").cast("long") % 10 == 0)
    new = old.withColumn("o", F.when(changed, T.literal(F.lit("-1.0"), T.XSD + "double")).otherwise(F.col("o")))
    before = shacl.validate(old, _customer_shapes())
    found = shacl.revalidate(old, new, before, _customer_shapes()).where("component = 'minInclusive'")
    return found.select("g", T.lexical(F.col("value")).alias("balance"))


@query(_LINES)
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that report files have of balances below nothing; the graphs grow with the table, so their reports share files."""
    path = sinks.scratch(spark, "report")
    report = shacl.validate(_customer_graphs(spark, sf_dir), _customer_shapes()).where("component = 'minInclusive'")
    sinks.write_report(report, path, parts=D.tasks_of(table(spark, sf_dir, "customer")))
    return sinks.read_reports(spark, path).select("g", F.explode(F.split("text", "\n")).alias("line"))


@query(f"""
WITH b AS ({_BAD}), m AS (SELECT DISTINCT k FROM b)
SELECT CAST(c_custkey AS VARCHAR) AS g, m.k IS NULL OR (c_custkey % 7 = 0 AND c_acctbal >= 0) AS conforms FROM customer LEFT JOIN m ON m.k = c_custkey WHERE c_custkey % 13 <> 0
""")
def repair_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixer that can only name the nameless, over graphs of customers."""
    quads = _customer_graphs(spark, sf_dir).where("g % 13 <> 0")

    def fix(broken: DataFrame, report: DataFrame) -> DataFrame:
        named = report.where("component = 'minCount'").select("g", F.col("focus").alias("s"), F.col("path").alias("p"), F.lit('"a name"').alias("o"))
        return broken.select("g", "s", "p", "o").unionByName(named)

    def keep(df: DataFrame) -> DataFrame:
        path = sinks.scratch(spark, "repair")
        df.write.parquet(path)
        return spark.read.parquet(path)

    return repair.repair(quads, _customer_shapes(), fix, keep, rounds=1)[1].select("g", "conforms")


@query("""
SELECT n_nationkey AS key, CASE WHEN n_nationkey % 4 = 3 THEN NULL ELSE '{"name": "' || n_name || '"}' END AS reply, n_nationkey % 4 = 3 AS failed FROM nation
""")
def service_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A service that answers well, after being asked again, after a wait, or never."""
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.concat((F.col("n_nationkey") % 4).cast("string"), F.lit(":"), "n_name").alias("prompt"))

    def client_of() -> Callable[[str], str]:
        waited: set[str] = set()

        def client(text: str) -> str:
            kind, name = text.split(":")[:2]
            if kind == "2" and text not in waited:
                waited.add(text)
                raise TimeoutError("busy")
            good = "so: " + json.dumps({"name": name}) + " done"
            return {"0": good, "1": good if text.endswith(":again") else "{ bad", "2": good}.get(kind, "never")

        return client

    asked = repair.ask(rows, "prompt", client_of(), lambda prompt, reply, number: prompt + ":again", waits=[0, 0], limited=(TimeoutError,))
    return asked.select("key", "reply", F.col("error").isNotNull().alias("failed"))


# --- pages

_PAGE = """<html><body><h1>T <b>@A@</b></h1><script>no</script><div class="model-detail"><section class="links"><a href="/models/@k@#x" title="Paper">P</a><a href="https://f/@k@.yml">Files</a></section></div>
<p>one @B@</p><p></p><p>two</p><table><tr><th>Name ↑</th><th>N</th><th>Ok</th><th>When</th></tr>
<tr><td> a  @A@ <a href="/d/@k@">x</a></td><td data-sort-value="@n@.0">12k</td><td style="color:lightgreen">y</td><td><span title="2020-01-02">t</span></td></tr></table></body></html>"""
_on_page = lambda name, names, row, run, texts=None: forms_query(name, [(_PAGE, [row])], names, set(names) if texts is None else texts, run)
_on_page("page_links", ["paper", "files"], ("/models/@k@#x", "https://f/@k@.yml"), lambda docs: docs.select("key", html.links_of("text").alias("l")).select("key", html.section_link(F.col("l"), "paper").alias("paper"), html.section_link(F.col("l"), "files").alias("files")))
_on_page("page_readable", ["text", "title"], ("P Files", "T @A@"), lambda docs: docs.select("key", html.readable_text("text").alias("t"), html.title_of(F.col("text")).alias("title")).withColumnRenamed("t", "text"))
_on_page("page_task", ["title", "context"], ("T @A@", "one @B@"), lambda docs: html.task_context(docs, "text", 3).select("key", "title", "context"))
_on_page(
    "page_table", ["name", "number", "ok", "created", "link"], ("a @A@ x", "@n@", "true", "2020-01-02", "/d/@k@"),
    lambda docs: html.dataset_rows(docs, "text").select("key", html.typed_cell(F.col("cells"), "name").alias("name"), *[html.typed_cell(F.col("cells"), h, t).cast("string").alias(n) for h, t, n in (("n", "number", "number"), ("ok", "bool", "ok"), ("when", "date", "created"))], html.typed_cell(F.col("cells"), "name", "href").alias("link")),
)
forms_query(
    "file_routes",
    [("https://x/@k@.yaml", [("https://x/@k@.yaml",)]), ("https://github.com/o/r/tree/-/p@k@", [("https://raw/@k@.yml",)]), ("https://x/m/", [("https://x/m/a@k@.yml",), ("https://x/b.yaml",)])],
    ["file"], {"file"},
    lambda docs: docs.select("key", F.explode(html.file_links(F.col("text"), F.concat(F.lit('[{"name": "a.yml", "download_url": "https://raw/'), F.col("key").cast("string"), F.lit('.yml"}, {"name": "b.md", "download_url": "u"}]')), F.concat(F.lit("<a href='a"), F.col("key").cast("string"), F.lit(".yml'>x</a><a href=\"/b.yaml\">y</a><a href='c.txt'>z</a>")))).alias("file")),
)
forms_query("contents_api", [("https://github.com/o/r/tree/-/p/@k@", [("https://api.github.com/repos/o/r/contents/p/@k@?ref=main",)]), ("https://github.com/o/r/blob/v1/@k@", [("https://api.github.com/repos/o/r/contents/@k@?ref=v1",)]), ("https://x/@k@", [(None,)])], ["url"], {"url"}, lambda docs: docs.select("key", S.contents_api_url(F.col("text")).alias("url")))
forms_query("evaluated_variant", [("x e:evaluatesModelVariant a:v_@k@ ; e:evaluatesModelVariant a:v_@k@ .", [("v_@k@",)]), ("x e:evaluatesModelVariant <urn:a#w_@k@> .", [(None,)]), ("x e:evaluatesModelVariant a:v_@k@ , a:w ; e:evaluatesModelVariant a:w .", [(None,)])], ["variant"], {"variant"}, lambda docs: docs.select("key", D.evaluated_variant(F.col("text"), strict=False).alias("variant")))


@query("SELECT c_custkey AS key, concat_ws(chr(10) || chr(10), CASE WHEN c_custkey % 2 = 0 THEN '## Model' || chr(10) || c_name END, CASE WHEN c_custkey % 3 = 0 THEN '## Paper' || chr(10) || c_mktsegment END) AS context FROM customer")
def context_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    text = lambda where, column: c.where(where).select(F.col("c_custkey").alias("key"), F.col(column).alias("text"))
    return D.contexts(c.select(F.col("c_custkey").alias("key")), [("Model", text("c_custkey % 2 = 0", "c_name")), ("Paper", text("c_custkey % 3 = 0", "c_mktsegment"))])


@query("""
SELECT "by", 'urn:' || n_nationkey AS s FROM nation, (VALUES ('argument', 1), ('environment', 2), ('folder', NULL)) v("by", region) WHERE region IS NULL OR region = n_regionkey
""")
def chosen_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations in a Turtle file for each region, of which an argument, the environment or neither names one."""
    folder, jvm = sinks.scratch(spark, "chosen"), spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    files = at(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    lines = table(spark, sf_dir, "nation").select("n_regionkey", F.concat(F.lit("<urn:"), F.col("n_nationkey").cast("string"), F.lit("> <urn:p> 1 .")).alias("value"))
    lines.repartition(1).write.partitionBy("n_regionkey").text(f"{folder}/parts")
    files.mkdirs(at(f"{folder}/all"))
    for part in spark.read.text(f"{folder}/parts").inputFiles():  # a file for each region
        files.rename(at(part), at(f"{folder}/all/r{part.split('n_regionkey=')[1].split('/')[0]}.ttl"))
    found = []
    for by, argument, named in (("argument", f"{folder}/all/r1.ttl", f"{folder}/all/r2.ttl"), ("environment", " ", f"{folder}/all/r2.ttl"), ("folder", None, None)):
        docs = turtle.read_documents(spark, *turtle.chosen_files(argument, named, f"{folder}/all"))
        found.append(turtle.parse_documents(docs)[0].select(F.lit(by).alias("by"), F.substring_index(F.ltrim(F.rtrim("s", F.lit(">")), F.lit("<")), "\n", 1).alias("s")))
    return reduce(DataFrame.unionByName, found)


# --- the model graph

_SPACES = {"rdf:": T.RDF, "rdfs:": T.RDFS, "owl:": T.OWL, "dct:": "http://purl.org/dc/terms/", "prov:": "http://www.w3.org/ns/prov#", "arch:": "urn:architecture#", "train:": "urn:training#", "data:": "urn:dataset#", "eval:": "urn:evaluation#", "i:": "urn:individual#"}


def _term(short: str) -> str:
    if short.startswith(('"', "<")):
        return short.replace("^^xsd:", "^^" + T.XSD)
    head, name = short.split(":", 1)
    return f"<{_SPACES[head + ':']}{name}>"


def _individual(node: str, kind: str, label: str | None = None) -> list[tuple[str, str, str]]:
    return [(node, "rdf:type", "owl:NamedIndividual"), (node, "rdf:type", kind), *([(node, "rdfs:label", f'"{label}"')] if label else [])]


def _graph_query(name: str, document: dict, made: Callable[[modelgraph.ModelGraph], list[DataFrame]], triples: list[tuple[str, str, str]], retrieval_: bool = False) -> None:
    """Register a query for a part of the model graph, a document for each part."""
    text = json.dumps(document, ensure_ascii=False).replace('"@n@"', "@n@")

    def ask(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = parts(spark, sf_dir).select(filled("g@k@").alias("g"), filled("part_@k@").alias("model"), F.col("p_name").alias("label"), filled(text).alias("json"), filled("http://paper/@k@").alias("paper"))
        graph = modelgraph.ModelGraph(docs, dialect=modelgraph.Dialect(retrieval=retrieval_))
        return mapping.quads(reduce(DataFrame.unionByName, made(graph)), D.tasks_of(table(spark, sf_dir, "part")))

    QUERIES[name] = ask
    values = ", ".join("(" + ", ".join(quoted(_term(t)) for t in triple) + ")" for triple in triples)
    ORACLES[name] = f"SELECT DISTINCT 'g' || p_partkey AS g, {', '.join(f'{filled_sql(c)} AS {c}' for c in 'spo')} FROM part, (VALUES {values}) v(s, p, o)"


_graph_query(
    "graph_models", {"model": {"family": {"value": "@B@", "evidence": "p1"}, "variant": "@A@", "parameter_number": {"value": "@n@", "evidence": "p2"}}}, lambda m: m.models(),
    [
        *_individual("i:@b@_family", "arch:ModelFamily", "@B@"), *_individual("i:part_@k@_variant", "arch:ModelVariant", "@A@"), ("i:@b@_family", "arch:hasVariant", "i:part_@k@_variant"),
        ("i:part_@k@_variant", "arch:hasParameterNumber", '"@n@"^^xsd:integer'), ("i:part_@k@_variant", "dct:source", "<http://paper/@k@>"),
    ],
)
_NET = {"name": "@A@", "ontology_class": "arch:GraphNet", "parameter_number": "@n@", "layer_count": 3, "hidden_dimension": {"value": 64}, "components": ["Gate"], "backbone_architecture": "Back", "head_architecture": {"value": "Head"}, "hyperparameters": [{"name": "lr", "value": 0.1, "evidence": "p3"}]}
_BASE, _LINK = "i:part_@k@_@a@", "arch:hasMachineLearningArchitecture"
_graph_query(
    "graph_architectures", {"architectures": [_NET]}, lambda m: m.architectures()[:1],
    [
        *_individual(f"{_BASE}_architecture", "arch:GraphNet", "@A@"), *_individual(f"{_BASE}_architecture_configuration", "arch:MachineLearningArchitectureConfiguration"), *_individual(f"{_BASE}_model_variant", "arch:ModelVariant"),
        (f"{_BASE}_model_variant", _LINK, f"{_BASE}_architecture"), ("i:part_@k@_variant", _LINK, f"{_BASE}_architecture"), (f"{_BASE}_architecture", f"{_LINK}Configuration", f"{_BASE}_architecture_configuration"),
        (f"{_BASE}_architecture", "arch:hasParameterNumber", '"@n@"^^xsd:integer'), (f"{_BASE}_architecture_configuration", "arch:hasLayerCount", '"3"^^xsd:integer'), (f"{_BASE}_architecture_configuration", "arch:hasHiddenDimension", '"64"^^xsd:integer'),
    ],
)
_graph_query(
    "graph_components", {"architectures": [_NET]}, lambda m: m.architectures()[1:],
    [
        t for item, slug, predicate in (("Gate", "gate", "hasComponent"), ("Back", "back", "hasBackboneArchitecture"), ("Head", "head", "hasHeadArchitecture")) for t in (
            *_individual(f"i:@a@_{slug}_component", "arch:MachineLearningArchitecture", item), *_individual(f"i:@a@_{slug}_component_configuration", "arch:MachineLearningArchitectureConfiguration"),
            (f"{_BASE}_architecture", f"arch:{predicate}", f"i:@a@_{slug}_component"), (f"i:@a@_{slug}_component", f"{_LINK}Configuration", f"i:@a@_{slug}_component_configuration"),
        )
    ],
)
_RUN = {"training_runs": ["r1"], "r1": {"type": "PretrainingRun", "comment": "for @B@", "datasets": {"value": ["MPtrj", "@A@"], "evidence": "p4"}, "optimizer": "Adam", "initialized_from": "orb v2", "checkpoints": ["ckpt"], "batched_selection": True}}
_graph_query(
    "graph_hyperparameters", {"architectures": [_NET], "training": _RUN}, lambda m: m.hyperparameters(),
    [*_individual("i:lr", "train:Hyperparameter", "lr"), *_individual("i:r1_lr_value", "train:HyperparameterValue"), ("i:r1", "train:hasHyperparameterValue", "i:r1_lr_value"), ("i:r1_lr_value", "train:ofHyperparameter", "i:lr"), ("i:r1_lr_value", "prov:value", '"0.1"^^xsd:float')],
)
_graph_query(
    "graph_training", {"training": _RUN}, lambda m: m.training(),
    [
        *_individual("i:r1", "train:PretrainingRun", "r1"), ("i:r1", "train:trainsModelVariant", "i:part_@k@_variant"), ("i:r1", "rdfs:comment", '"for @B@"'), ("i:r1", "train:usesBatchedSelection", '"true"^^xsd:boolean'),
        ("i:r1", "train:usesDataset", "i:mptrj"), ("i:r1", "train:usesDataset", "i:@a@"), ("i:r1", "train:usesOptimizer", "i:adam"), *_individual("i:adam", "train:Optimizer", "Adam"),
        ("i:r1", "train:initializedFromModelMaterialization", "i:orb_v2_materialization"), *_individual("i:orb_v2_materialization", "train:ModelMaterialization", "orb v2"), ("i:r1", "rdf:type", "train:MachineLearningAdaptationRun"),
        *_individual("i:r1_ckpt_checkpoint", "train:Checkpoint", "ckpt"), ("i:r1_ckpt_checkpoint", "train:generatedBy", "i:r1"),
    ],
)
_graph_query(
    "graph_datasets", {"datasets": {"@A@": {"type": "TrainingDataset", "number_of_samples": "@n@", "labelling_method": "DFT", "data_representation": "CIF", "target_features": "energy", "derived_from": "MP"}}}, lambda m: m.datasets(),
    [
        *_individual("i:@a@", "train:TrainingDataset", "@A@"), ("i:@a@", "data:hasNumberOfSamples", '"@n@"^^xsd:integer'), ("i:@a@", "data:hasLabellingMethod", "i:dft_labelling_method"), *_individual("i:dft_labelling_method", "data:LabellingMethod", "DFT"),
        ("i:@a@", "rdf:type", "data:LabeledDataset"), ("i:@a@", "data:hasDataRepresentation", "i:cif_representation"), *_individual("i:cif_representation", "data:DataRepresentation", "CIF"),
        ("i:@a@", "data:usesAttributeAsTargetFeature", "i:energy_attribute"), *_individual("i:energy_attribute", "data:DatasetAttribute", "energy"), ("i:@a@", "data:wasDerivedFromDataset", "i:mp"),
    ],
)


def _split(name: str, slug: str, parent: str, parent_slug: str, fold: str, predicate: str) -> list[tuple[str, str, str]]:
    return [
        *_individual(f"i:{slug}", "data:DatasetSplit", name), (fold, f"eval:{predicate}", f"i:{slug}"), *_individual(f"i:{slug}_data_representation", "data:DataRepresentation", f"{name} data representation"),
        (f"i:{slug}", "data:hasDataRepresentation", f"i:{slug}_data_representation"), *_individual(f"i:{parent_slug}", "data:Dataset", parent), (f"i:{slug}", "data:wasDerivedFromDataset", f"i:{parent_slug}"),
    ]


_graph_query(
    "graph_benchmarks", {"evaluation": {"benchmark_suite": "@B@ suite", "benchmark_release": "R1", "benchmark_releases": {"R2": {"tasks": ["Discovery"]}}, "tasks": {"Discovery": {"type": "ClassificationTask", "dataset": "WBM"}}}}, lambda m: m.evaluation(),
    [
        *_individual("i:@b@_suite_benchmark_suite", "eval:BenchmarkSuite", "@B@ suite"), *_individual("i:r1_benchmark_release", "eval:BenchmarkRelease", "R1"), *_individual("i:r2_benchmark_release", "eval:BenchmarkRelease", "R2"),
        ("i:r2_benchmark_release", "eval:hasTask", "i:thermodynamic_stability_classification_task"), *_individual("i:thermodynamic_stability_classification_task", "eval:ClassificationTask", "Discovery"), ("i:thermodynamic_stability_classification_task", "eval:usesDataset", "i:wbm"),
    ],
)
_FOLDS = {"folds": {"@A@": {"index": "@n@", "train_split": "kappa 103", "test_split": {"value": "@B@ test", "evidence": "e"}}}}
_graph_query(
    "graph_folds", {"evaluation": _FOLDS}, lambda m: m.evaluation(),
    [
        *_individual("i:@a@_fold", "eval:Fold", "@A@"), ("i:@a@_fold", "eval:hasIndex", '"@n@"^^xsd:integer'),
        *_split("kappa 103", "kappa_103", modelgraph.PHONON_PARENT, "kappa_103_phonon_benchmark_set", "i:@a@_fold", "hasTrainSplit"), *_split("@B@ test", "@b@_test", modelgraph.TEST_PARENT, "wbm_test_set", "i:@a@_fold", "hasTestSplit"),
    ],
)
_graph_query(
    "graph_conditions", {"evaluation": {"folds": {"f": {"test_split": "symprec 1e-5"}}}}, lambda m: m.evaluation(),
    [
        *_individual("i:part_@k@_f_fold", "eval:Fold", "f"), ("i:part_@k@_f_fold", "eval:hasIndex", '"0"^^xsd:integer'),
        *_split("full_test_set", "part_@k@_full_test_set", modelgraph.TEST_PARENT, "wbm_test_set", "i:part_@k@_f_fold", "hasTestSplit"),
        *_individual("i:part_@k@_symprec_1e_5_condition", "eval:EvaluationCondition", "symprec 1e-5"), ("i:part_@k@_symprec_1e_5_condition", "eval:hasConditionName", '"symprec"'),
        ("i:part_@k@_symprec_1e_5_condition", "eval:hasConditionValue", '"1e-5"'), ("i:part_@k@_f_fold", "eval:hasEvaluationCondition", "i:part_@k@_symprec_1e_5_condition"),
    ],
    True,
)
_graph_query(
    "graph_metric_results", {"evaluation": {"metric_results": {"m1": {"value": "@n@", "metric_type": "@A@"}, "m2": {}}}}, lambda m: m.evaluation(),
    [
        *_individual("i:m1_metric_result", "eval:MetricResult", "@A@"), *_individual("i:@a@_metric_type", "eval:MetricType", "@A@"), ("i:m1_metric_result", "eval:hasMetricType", "i:@a@_metric_type"), ("i:m1_metric_result", "eval:hasMetricValue", '"@n@"^^xsd:integer'),
        *_individual("i:m2_metric_result", "eval:MetricResult", "m2"), *_individual("i:m2_metric_type", "eval:MetricType", "m2"), ("i:m2_metric_result", "eval:hasMetricType", "i:m2_metric_type"),
    ],
)


def _evaluation_run(scope: str, variant: str) -> list[tuple[str, str, str]]:
    run, out, task = f"i:{scope}e1_evaluation_run", f"i:{scope}e1_benchmark_result", "i:thermodynamic_stability_classification_task"
    return [
        *_individual(run, "eval:MachineLearningEvaluationRun", "e1"), *_individual(out, "eval:BenchmarkResult"), *_individual(variant, "arch:ModelVariant"), (run, "eval:evaluatesModelVariant", variant), (run, "eval:usesBenchmarkRelease", "i:r1"),
        (run, "eval:evaluatesTask", task), (out, "eval:hasResultTask", task), (run, "eval:usesDataset", "i:@a@"), (run, "eval:producesBenchmarkResult", out), (run, "eval:producesMetricResult", f"i:{scope}mae_metric_result"),
        (out, "eval:hasMetricResult", f"i:{scope}mae_metric_result"), (run, "eval:hasFold", f"i:{scope}f_fold"),
    ]


_EVALUATED = {"evaluation_runs": {"e1": {"task": "discovery", "benchmark_release": "R1", "dataset": "@A@", "metric_results": ["mae"], "folds": ["f"]}}}
_graph_query("graph_evaluation_runs", {"evaluation": _EVALUATED}, lambda m: m.evaluation(), _evaluation_run("", "i:part_@k@_variant"))
_OTHER = {"evaluation_runs": {"e1": {**_EVALUATED["evaluation_runs"]["e1"], "model_variant": "Other @B@"}}}
_graph_query("graph_evaluation_scoped", {"evaluation": _OTHER}, lambda m: m.evaluation(), _evaluation_run("part_@k@_", "i:other_@b@_variant"), True)


@query("""
SELECT '<urn:individual#' || p_partkey || '_variant>' AS s, '"2020-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') || '"^^http://www.w3.org/2001/XMLSchema#date' AS o FROM part
""")
def graph_release_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parts(spark, sf_dir).select(F.lit("g").alias("g"), F.col("p_partkey").alias("model"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size") % 28).alias("date"))
    return modelgraph.release_dates(rows, modelgraph.Namespaces()).select("s", "o")


_SITE = sitegraph.Site("http://site/data", ("s_suite", "Suite"), ("s_release", "Release"), (sitegraph.Task("t1", "first_task", True, ("support",)), sitegraph.Task("t2", "second_task", False, ("support", "nation_3"))), (("support", "Support set"), ("nation_3", "unused")))
_SITE_TRIPLES = [
    *_individual("i:s_suite", "eval:BenchmarkSuite", "Suite"), *_individual("i:s_release", "eval:BenchmarkRelease", "Release"), ("i:s_suite", "eval:hasBenchmarkRelease", "i:s_release"), *_individual("i:support", "data:Dataset", "Support set"),
    ("i:support", "dct:source", "<http://site/data>"), ("i:nation_3", "dct:source", "<http://site/data>"), *_individual("i:first_task", "eval:ClassificationTask", "First"), *_individual("i:second_task", "eval:RegressionTask", "Second"),
    ("i:first_task", "dct:source", "<http://site/t1>"), ("i:second_task", "dct:source", "<http://site/t2>"), ("i:s_release", "eval:hasTask", "i:first_task"), ("i:s_release", "eval:hasTask", "i:second_task"), ("i:first_task", "rdfs:comment", '"words"'),
    ("i:first_task", "eval:usesDataset", "i:support"), ("i:second_task", "eval:usesDataset", "i:support"), ("i:second_task", "eval:usesDataset", "i:nation_3"),
]
_NATION = "'<urn:individual#' || lower(n_name) || '>'"
_SITE_SQL = f"""
SELECT {_NATION} AS s, p, CASE o WHEN '@N@' THEN '"' || n_name || '"' WHEN '@S@' THEN '"' || n_nationkey || '"^^{T.XSD}integer' WHEN '@M@' THEN '"' || n_regionkey || ' materials"' WHEN '@L@' THEN '<http://link/' || n_nationkey || '>' WHEN '@O@' THEN CASE WHEN n_nationkey % 2 = 0 THEN '"open"' ELSE '"closed"' END ELSE o END AS o
FROM nation, (VALUES {", ".join("(" + quoted(_term(p)) + ", " + quoted(o if o.startswith("@") else _term(o)) + ")" for p, o in (("rdf:type", "owl:NamedIndividual"), ("rdf:type", "data:Dataset"), ("rdfs:label", "@N@"), ("dct:source", "<http://site/data>"), ("data:hasNumberOfSamples", "@S@"), ("dct:extent", "@M@"), ("dct:created", '"2020-01-02"^^xsd:date'), ("dct:accessRights", "@O@"), ("dct:description", '"Method: DFT"'), ("dct:description", '"Static dataset: True"'), ("dct:references", "@L@")))}) v(p, o)
UNION SELECT * FROM (VALUES {", ".join("(" + ", ".join(quoted(_term(t)) for t in triple) + ")" for triple in _SITE_TRIPLES)}) v(s, p, o)
"""


@query(_SITE_SQL)
def graph_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as scraped datasets, with two tasks."""
    n = F.col("n_nationkey")
    null = F.lit(None).cast("string")
    rows = table(spark, sf_dir, "nation").select(
        F.lit("g").alias("g"), F.col("n_name").alias("label"), F.col("n_name").alias("title"), null.alias("page"), n.alias("structures"), F.col("n_regionkey").alias("materials"), F.lit("2020-01-02").alias("created"), F.lit("").alias("license"),
        F.lit("DFT").alias("method"), (n % 2 == 0).alias("open"), F.lit(True).alias("static"), F.array(F.concat(F.lit("http://link/"), n.cast("string"))).alias("links"),
    )
    tasks = spark.createDataFrame([("g", "t1", "First", "http://site/t1", "words"), ("g", "t2", "Second", "http://site/t2", ""), ("g", "none", "No", "u", "x")], "g string, key string, title string, url string, description string")
    # The label of a dataset becomes its identifier, lower-case.
    return sitegraph.site_graph(rows.withColumn("label", F.col("label")), tasks, _SITE, "g").select("s", "p", "o")


@query("""
SELECT '<http://example.org/part/' || p_partkey || '>' AS s, p, CASE p WHEN '<http://example.org/size>' THEN '"' || p_size || '"^^http://www.w3.org/2001/XMLSchema#integer' ELSE '"' || p_name || '"' END AS o,
       CASE p WHEN '<http://example.org/size>' THEN 'row ' || p_partkey END AS evidence, 'http://example.org/list' AS source
FROM part, (VALUES ('<http://example.org/size>'), ('<http://example.org/name>')) v(p)
""")
def mapping_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = mapping.resource(EX, F.concat(F.lit("part/"), F.col("p_partkey").cast("string")))
    rules = [mapping.Rule(node, EX + "size", T.literal(F.col("p_size"), T.XSD + "integer"), F.concat(F.lit("row "), F.col("p_partkey").cast("string"))), mapping.Rule(node, EX + "name", T.literal(F.col("p_name")))]
    return mapping.statements(parts(spark, sf_dir), F.lit("g"), rules, F.lit("http://example.org/list")).select("s", "p", "o", "evidence", "source")


# --- SPARQL


@query("""
SELECT c_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name < 'NATION_12'
UNION ALL SELECT s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name < 'NATION_12'
""")
def union_of_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(lifted(spark, sf_dir, "customer", "supplier", "nation"), """
        SELECT ?name WHERE {
            { ?x ex:c_nation ?n ; ex:c_name ?name } UNION { ?x ex:s_nation ?n ; ex:s_name ?name }
            ?n ex:n_name ?nation . FILTER(?nation < "NATION_12")
        }""")


@query("SELECT n_name AS nation FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 500)")
def minus_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(lifted(spark, sf_dir, "nation", "supplier"), "SELECT ?nation WHERE { ?n ex:n_name ?nation . MINUS { ?s ex:s_nation ?n ; ex:s_acctbal ?b FILTER(?b < 500) } }")


@query("SELECT p_brand AS brand, avg(DISTINCT p_size) AS mean, count(DISTINCT p_size) AS sizes, sum(p_size) AS total, sum(DISTINCT p_size) AS once FROM part GROUP BY p_brand")
def distinct_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = answered(lifted(spark, sf_dir, "part"), """
        SELECT ?brand (AVG(DISTINCT ?n) AS ?mean) (COUNT(DISTINCT ?n) AS ?sizes) (SUM(?n) AS ?total) (SUM(DISTINCT ?n) AS ?once) WHERE { ?p ex:p_brand ?brand ; ex:p_size ?n } GROUP BY ?brand""", mean="double", sizes="long", total="long", once="long")
    return found


ORACLES["distinct_aggregates"] = ORACLES["distinct_aggregates"].replace("sum(p_size)", "CAST(sum(p_size) AS BIGINT)").replace("sum(DISTINCT p_size)", "CAST(sum(DISTINCT p_size) AS BIGINT)")


@query(f"SELECT '\"0\"^^{T.XSD}integer' AS total, '\"0\"^^{T.XSD}integer' AS mean FROM region WHERE r_regionkey = 0")
def empty_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and means over nothing are 0."""
    return sparql.select(lifted(spark, sf_dir, "part"), PREFIXES + "SELECT (SUM(?n) AS ?total) (AVG(?n) AS ?mean) WHERE { ?p ex:p_none ?n }", unique=True)


@query("SELECT count(*) AS pairs FROM (SELECT DISTINCT p_brand, p_size FROM part)")
def count_distinct_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Solutions counted once each."""
    rows = parts(spark, sf_dir).select(F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("g"), T.literal(F.col("p_brand")).alias("s"), F.lit(f"<{EX}with>").alias("p"), T.literal(F.col("p_size"), T.XSD + "integer").alias("o"))
    return answered(rows, "SELECT (COUNT(DISTINCT *) AS ?pairs) WHERE { ?b ex:with ?n }", pairs="long")


@query("SELECT DISTINCT c_name AS name FROM customer JOIN orders ON o_custkey = c_custkey")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(lifted(spark, sf_dir, "customer", "orders"), "SELECT DISTINCT ?name WHERE { ?c ex:c_name ?name . ?order ex:o_customer ?c }")


@query("SELECT p_partkey AS key FROM part WHERE contains(p_name, 'red') AND (p_size = 1 OR p_brand = 'Brand#1' OR p_size = 7)")
def filter_contains_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = answered(lifted(spark, sf_dir, "part"), 'SELECT ?p WHERE { ?p ex:p_name ?name ; ex:p_size ?n ; ex:p_brand ?b FILTER(CONTAINS(?name, "red") && (?n = 1 || ?b = "Brand#1" || ?n = 7)) }')
    return found.select(F.substring_index("p", "/", -1).cast("long").alias("key"))


# --- streams


def _streamed(spark: SparkSession, sf_dir: str, then: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The last complete result of a stream over the events."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    out, marks = sinks.scratch(spark, "stream"), sinks.scratch(spark, "stream-marks")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    running = then(events.withColumn("at", F.col("ts").cast("timestamp"))).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", marks).trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.parquet(out)


@query("SELECT CAST(epoch(time_bucket(INTERVAL '1 hour', ts)) AS BIGINT) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _streamed(spark, sf_dir, lambda e: streaming.windowed_counts(e, "at", ["event_type"], "1 hour", "1 day"))
    return found.select(F.unix_timestamp("window.start").alias("hour"), "event_type", "n")


@query("""
WITH t AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL '30 minutes' OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM t)
SELECT user_id, count(*) AS n, CAST(floor(epoch(min(ts))) AS BIGINT) AS first FROM s GROUP BY user_id, session
""")
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _streamed(spark, sf_dir, lambda e: streaming.sessions(e, "at", ["user_id"], "30 minutes", "1 day"))
    return found.select("user_id", "n", F.unix_timestamp("session_window.start").alias("first"))


@query("SELECT 'urn:g/' || n_regionkey AS g, 'urn:' || n_nationkey AS s, lower(n_name) AS o FROM nation")
def streamed_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of each graph through a stream; the newer stays."""
    path = sinks.scratch(spark, "versions")
    old, new = (_region_graphs(spark, sf_dir, c).withColumn("version", F.lit(v)) for v, c in ((1, F.col("n_name")), (2, F.lower("n_name"))))
    old.unionByName(new).write.parquet(path)
    store = quadstore.QuadStore(spark, sinks.scratch(spark, "store"))
    stream = streaming.to_quads(spark.readStream.schema("g string, s string, p string, o string, version int").parquet(path), lambda df: df)
    streaming.upsert(stream, store, sinks.scratch(spark, "stream-marks")).awaitTermination()
    return store.read().select("g", "s", "o")


def _in_batches(spark: SparkSession, schema: str, *parts: DataFrame) -> DataFrame:
    """A stream that reads each part as a batch of its own, in order."""
    path = sinks.scratch(spark, "batches")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("""
SELECT 'urn:g/' || n_regionkey AS g, 'urn:' || n_nationkey AS s, CASE WHEN n_regionkey % 2 = 0 THEN n_name ELSE lower(n_name) END AS o FROM nation
""")
def streamed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second version comes first; a late first one never replaces it, a third one does for some graphs."""
    version = lambda v, c: _region_graphs(spark, sf_dir, c).withColumn("version", F.lit(v))
    third = version(3, F.col("n_name")).where("substring_index(g, '/', -1) % 2 = 0")
    stream = _in_batches(spark, "g string, s string, p string, o string, version int", version(2, F.lower("n_name")), version(1, F.lit("old")), third, version(2, F.lit("again")))
    store = quadstore.QuadStore(spark, sinks.scratch(spark, "store"))
    streaming.upsert(stream, store, sinks.scratch(spark, "stream-marks")).awaitTermination()
    return store.read().select("g", "s", "o")


@query("""
WITH m AS (SELECT max(ts) - INTERVAL '1 day' AS mark FROM events)
SELECT CAST(epoch(time_bucket(INTERVAL '1 hour', ts)) AS BIGINT) AS hour, event_type, count(*) AS n FROM events, m
GROUP BY ALL HAVING max(time_bucket(INTERVAL '1 hour', ts)) + INTERVAL '1 hour' <= max(mark)
""")
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows in append mode: closed ones only, without the events that come again when their windows have been closed."""
    events = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("at"))
    ends = events.agg(F.min("at").alias("first"), F.max("at").alias("last"))
    share = (F.unix_micros("at") - F.unix_micros("first")) / (F.unix_micros("last") - F.unix_micros("first"))
    marked = events.join(F.broadcast(ends), F.lit(True)).withColumn("share", share)
    part = lambda where: marked.where(where).select("event_type", "at")
    stream = _in_batches(spark, "event_type string, at timestamp", part("share < 0.7"), part("share >= 0.7"), part("share < 0.3"))
    out, marks = sinks.scratch(spark, "closed"), sinks.scratch(spark, "stream-marks")
    found = streaming.windowed_counts(stream, "at", ["event_type"], "1 hour", "1 day").select(F.unix_timestamp("window.start").alias("hour"), "event_type", "n")
    found.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("hour long, event_type string, n long").parquet(out)
