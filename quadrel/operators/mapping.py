"""Entities to quads by mapping rules, with statement-level provenance.

A rule says how a row becomes a statement; all rules over one DataFrame are applied in one
pass (an array of candidate statements, exploded), so that mapping costs one scan and no
shuffle before the final de-duplication.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrel.functions import terms as T


@dataclass
class Rule:
    """One statement for each row: subject, predicate and object are terms; evidence and source are text or null."""

    subject: Column
    predicate: str
    object: Column
    evidence: Column | None = None
    source: Column | None = None


def individual(subject: Column, class_iri: Column | str, label: Column | None = None) -> list[Rule]:
    """A named individual of a class, with a label if it has one."""
    rules = [
        Rule(subject, T.RDF + "type", F.lit(f"<{T.OWL}NamedIndividual>")),
        Rule(subject, T.RDF + "type", T.iri(class_iri)),
    ]
    return rules + ([Rule(subject, T.RDFS + "label", T.literal(label))] if label is not None else [])


def resource(namespace: str, ident: Column) -> Column:
    return T.iri(F.concat(F.lit(namespace), ident))


def statements(rows: DataFrame, graph: Column, rules: list[Rule], default_source: Column | None = None) -> DataFrame:
    """(g, s, p, o, evidence, source), repeats included; statements without a subject or an object are left out.

    The rules' columns are worked out in a projection below the explosion, each once however
    many rules name it: there Spark shares common parts and can split what it compiles, whereas
    a generator whose code grows too long is evaluated tree by tree.  Evidence and source stand
    beside the statements, so that they aren't worked out where only quads are wanted.
    """
    null = F.lit(None).cast("string")
    fallback = default_source if default_source is not None else null
    terms = {id(c): c for r in rules for c in (r.subject, r.object)}
    names = {k: f"_t{i}" for i, k in enumerate(terms)}
    held = rows.select(
        graph.alias("g"), *[c.alias(names[k]) for k, c in terms.items()],
        F.array(*[null if r.evidence is None else r.evidence for r in rules]).alias("_evidence"), F.array(*[fallback if r.source is None else F.coalesce(r.source, fallback) for r in rules]).alias("_source"),
    )
    items = [F.struct(F.col(names[id(r.subject)]).alias("s"), F.lit(f"<{r.predicate}>").alias("p"), F.col(names[id(r.object)]).alias("o")) for r in rules]
    made = held.select("g", "_evidence", "_source", F.posexplode(F.array(*items)).alias("_n", "x")).where("x.s IS NOT NULL AND x.o IS NOT NULL")
    return made.select("g", "x.s", "x.p", "x.o", F.get("_evidence", F.col("_n")).alias("evidence"), F.get("_source", F.col("_n")).alias("source"))


def quads(made: DataFrame, tasks: int | None = None) -> DataFrame:
    """The statements as a set, in so many tasks if that is given.

    Otherwise Spark puts shuffled parts together until they are of some size, compressed;
    statements are so alike that such a part is many times as large in a task's memory.
    """
    of = made.select("g", "s", "p", "o")
    return (of if tasks is None else of.repartition(tasks, "g", "s", "p", "o")).distinct()


def annotations(made: DataFrame) -> DataFrame:
    """The statements with evidence, as a list: repeats stay."""
    return made.where(F.coalesce(F.col("evidence"), F.lit("")) != "")


def last_set(made: DataFrame, order: str) -> DataFrame:
    """Of statements (g, s, p, o, order) on one subject and predicate, the last by order."""
    return made.groupBy("g", "s", "p").agg(F.max_by("o", order).alias("o"))


def union(*parts: DataFrame) -> DataFrame:
    """The union of graphs, a set."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def model_rules(namespace: str, class_namespace: str, model: Column, label: Column, parameters: Column, paper: Column) -> list[Rule]:
    """Family and variant of a model, its parameter count and its paper."""
    family, variant = resource(namespace, F.concat(model, F.lit("_family"))), resource(namespace, F.concat(model, F.lit("_variant")))
    return [
        *individual(family, class_namespace + "ModelFamily", label),
        *individual(variant, class_namespace + "ModelVariant", label),
        Rule(family, class_namespace + "hasVariant", variant),
        Rule(variant, class_namespace + "hasParameterNumber", T.inferred_literal(parameters.cast("string")), F.lit("YAML model_params")),
        Rule(variant, "http://purl.org/dc/terms/source", T.iri(paper)),
    ]


def architecture_rules(namespace: str, class_namespace: str, model: Column, architecture: Column, class_name: Column, hidden: Column, layers: Column, per_architecture_variant: bool = True) -> list[Rule]:
    """An architecture with its configuration; linked from a variant of its own, or from the main variant."""
    from quadrel.functions.slug import class_or_default, scoped_id

    base = scoped_id(model, architecture)
    node, configuration = resource(namespace, F.concat(base, F.lit("_architecture"))), resource(namespace, F.concat(base, F.lit("_architecture_configuration")))
    variant = resource(namespace, F.concat(base, F.lit("_model_variant")) if per_architecture_variant else F.concat(model, F.lit("_variant")))
    return [
        *individual(node, class_or_default(class_namespace, class_name, "MachineLearningArchitecture"), architecture),
        *individual(configuration, class_namespace + "MachineLearningArchitectureConfiguration"),
        *individual(variant, class_namespace + "ModelVariant"),
        Rule(variant, class_namespace + "hasMachineLearningArchitecture", node),
        Rule(node, class_namespace + "hasMachineLearningArchitectureConfiguration", configuration),
        Rule(configuration, class_namespace + "hasHiddenDimension", T.inferred_literal(hidden.cast("string"))),
        Rule(configuration, class_namespace + "hasLayerCount", T.inferred_literal(layers.cast("string"))),
    ]


def metric_rules(namespace: str, class_namespace: str, run: Column, result: Column, metric: Column, value: Column, task: Column, evidence: Column) -> list[Rule]:
    """An evaluation run, its benchmark result and one metric result."""
    from quadrel.functions.slug import slug

    run_node, outcome = resource(namespace, F.concat(run, F.lit("_evaluation_run"))), resource(namespace, F.concat(run, F.lit("_benchmark_result")))
    node, kind = resource(namespace, F.concat(result, F.lit("_metric_result"))), resource(namespace, F.concat(slug(metric), F.lit("_metric_type")))
    return [
        *individual(run_node, class_namespace + "MachineLearningEvaluationRun"),
        *individual(outcome, class_namespace + "BenchmarkResult"),
        *individual(node, class_namespace + "MetricResult", metric),
        *individual(kind, class_namespace + "MetricType", metric),
        Rule(run_node, class_namespace + "producesBenchmarkResult", outcome),
        Rule(run_node, class_namespace + "evaluatesTask", resource(namespace, task)),
        Rule(outcome, class_namespace + "hasResultTask", resource(namespace, task)),
        Rule(outcome, class_namespace + "hasMetricResult", node),
        Rule(node, class_namespace + "hasMetricType", kind),
        Rule(node, class_namespace + "hasMetricValue", T.inferred_literal(value.cast("string")), evidence),
    ]
