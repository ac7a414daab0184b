"""The graph of a model: extraction documents to quads with provenance, section by section.

Each section is normalised to rows once (``flatten.entities``) and mapped by rules; fields
that may hold several values are exploded first.  The dialect says how identifiers are
scoped and which variant a statement is about.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrel.functions import terms as T
from quadrel.functions import values as V
from quadrel.functions.slug import canonical_task, class_or_default, dataset_class_or_default, scoped_id, scoped_resource, slug
from quadrel.operators import flatten
from quadrel.operators.mapping import Rule, individual, statements

#: The datasets that a benchmark's splits are parts of.
PHONON_PARENT, TEST_PARENT = "kappa-103 phonon benchmark set", "WBM test set"
PROV_VALUE = "http://www.w3.org/ns/prov#value"


@dataclass(frozen=True)
class Namespaces:
    """Namespaces of classes and of individuals, by module."""

    arch: str = "urn:architecture#"
    train: str = "urn:training#"
    data: str = "urn:dataset#"
    eval: str = "urn:evaluation#"
    individuals: str = "urn:individual#"


@dataclass(frozen=True)
class Dialect:
    """``retrieval`` also reads loops that are lists, and scopes runs, folds, metrics and results by the variant;
    otherwise each architecture has a variant of its own and those identifiers are global."""

    retrieval: bool = False


def field(data: str, name: str) -> Column:
    """A field's value as text; null for containers."""
    value = V.get_value(F.try_variant_get(F.col(data), f"$.{name}", "variant"))
    return F.when(V.kind(value) == "scalar", F.try_variant_get(value, "$", "string"))


def evidence(data: str, name: str) -> Column:
    return V.get_evidence(F.try_variant_get(F.col(data), f"$.{name}", "variant"))


def source(data: str, name: str) -> Column:
    return V.get_source(F.try_variant_get(F.col(data), f"$.{name}", "variant"))


def each(rows: DataFrame, data: str, name: str) -> DataFrame:
    """A row for each value of a field: its columns and ``item``, ``item_evidence``; no rows without values."""
    held = F.try_variant_get(F.col(data), f"$.{name}", "variant")
    out = rows.withColumn("item_evidence", V.get_evidence(held)).withColumn("_item", F.explode(V.normalized_list(V.get_value(held))))
    value = V.get_value(F.col("_item"))
    text = F.coalesce(F.when(V.kind(value) == "scalar", F.try_variant_get(value, "$", "string")), F.try_variant_get(value, "$.name", "string"), F.try_variant_get(value, "$.id", "string"))
    return out.withColumn("item", text).drop("_item").where(F.coalesce(F.trim("item"), F.lit("")) != "")


class ModelGraph:
    """Statements of documents (g, model, label, json, paper); ``model`` is the variant's slug."""

    def __init__(self, documents: DataFrame, names: Namespaces | None = None, dialect: Dialect | None = None):
        self.docs, self.n, self.d = documents, names or Namespaces(), dialect or Dialect()
        self._sections: dict[str, DataFrame] = {}

    # identifiers

    def node(self, ident: Column) -> Column:
        return T.iri(F.concat(F.lit(self.n.individuals), ident))

    def named(self, data: str, name: str) -> Column:
        """The individual that a field names; null without one."""
        return F.when(field(data, name).isNotNull(), self.node(slug(field(data, name))))

    def variant(self) -> Column:
        return self.node(F.concat(F.col("model"), F.lit("_variant")))

    def scoped(self, name: Column, suffix: str) -> Column:
        """An identifier with a suffix, scoped by the variant in the retrieval dialect."""
        if self.d.retrieval:
            return self.node(scoped_resource(F.col("model"), name, suffix))
        plain = slug(name)
        return self.node(F.when(F.endswith(plain, F.lit("_" + suffix)), plain).otherwise(F.concat(plain, F.lit("_" + suffix))))

    def run(self, name: Column) -> Column:
        return self.node(scoped_id(F.col("model"), name) if self.d.retrieval else slug(name))

    def members(self, section: str, *path: str) -> DataFrame:
        """A section's rows, normalised once however many rules read them."""
        if section not in self._sections:
            self._sections[section] = flatten.entities(self.docs, "json", section, path, self.d.retrieval).persist()
        return self._sections[section]

    def release(self) -> None:
        """Give up the sections that are held; for when the statements have been written."""
        for rows in self._sections.values():
            rows.unpersist()
        self._sections.clear()

    @staticmethod
    def held(rows: DataFrame, **columns: Column) -> tuple:
        """The rows with columns worked out once, and references to these."""
        return (rows.withColumns({f"_{k}": c for k, c in columns.items()}), *[F.col(f"_{k}") for k in columns])

    def made(self, rows: DataFrame, rules: list[Rule]) -> DataFrame:
        return statements(rows, F.col("g"), rules, F.col("paper"))

    # sections

    def models(self) -> list[DataFrame]:
        rows = self.docs.withColumn("data", F.try_parse_json("json"))
        family = self.node(slug(F.coalesce(field("data", "model.family"), F.col("model"))))
        family = T.iri(F.concat(T.lexical(family), F.lit("_family")))
        return [
            self.made(rows, [
                *individual(family, self.n.arch + "ModelFamily", field("data", "model.family")),
                *individual(self.variant(), self.n.arch + "ModelVariant", F.col("label")),
                Rule(family, self.n.arch + "hasVariant", self.variant(), evidence("data", "model.variant")),
                Rule(self.variant(), self.n.arch + "hasParameterNumber", T.inferred_literal(field("data", "model.parameter_number")), evidence("data", "model.parameter_number"), source("data", "model.parameter_number")),
                Rule(self.variant(), "http://purl.org/dc/terms/source", T.iri(F.col("paper"))),
            ])
        ]

    def architectures(self) -> list[DataFrame]:
        rows = self.members("architectures", "architectures")
        base = scoped_id(F.col("model"), F.col("name"))
        node, setting = self.node(F.concat(base, F.lit("_architecture"))), self.node(F.concat(base, F.lit("_architecture_configuration")))
        variant = self.variant() if self.d.retrieval else self.node(F.concat(base, F.lit("_model_variant")))
        rows, node, setting, variant = self.held(rows, node=node, setting=setting, variant=variant)
        first = F.when(F.col("ordinal") == 0, self.variant())
        link = self.n.arch + "hasMachineLearningArchitecture"
        out = [
            self.made(rows, [
                *individual(node, class_or_default(self.n.arch, field("data", "ontology_class"), "MachineLearningArchitecture"), F.col("name")),
                *individual(setting, self.n.arch + "MachineLearningArchitectureConfiguration"),
                *individual(variant, self.n.arch + "ModelVariant"),
                Rule(variant, link, node, evidence("data", "ontology_class")),
                Rule(first, link, node),
                Rule(node, link + "Configuration", setting),
                Rule(node, self.n.arch + "hasParameterNumber", T.inferred_literal(field("data", "parameter_number")), evidence("data", "parameter_number")),
                Rule(setting, self.n.arch + "hasLayerCount", T.inferred_literal(field("data", "layer_count")), evidence("data", "layer_count")),
                Rule(setting, self.n.arch + "hasHiddenDimension", T.inferred_literal(field("data", "hidden_dimension")), evidence("data", "hidden_dimension")),
            ])
        ]
        for name, predicate in (("components", "hasComponent"), ("backbone_architecture", "hasBackboneArchitecture"), ("head_architecture", "hasHeadArchitecture")):
            parts = each(rows, "data", name)
            scope = scoped_id(F.col("model"), F.col("name"), F.col("item")) if self.d.retrieval else scoped_id(F.col("name"), F.col("item"))
            parts, part, own = self.held(parts, part=self.node(F.concat(scope, F.lit("_component"))), own=self.node(F.concat(scope, F.lit("_component_configuration"))))
            out.append(self.made(parts, [
                *individual(part, self.n.arch + "MachineLearningArchitecture", F.col("item")),
                *individual(own, self.n.arch + "MachineLearningArchitectureConfiguration"),
                Rule(node, self.n.arch + predicate, part, F.col("item_evidence")),
                Rule(part, link + "Configuration", own),
            ]))
        return out

    def hyperparameters(self) -> list[DataFrame]:
        """Of each architecture; a value belongs to each of the model's runs, first seen first."""
        rows = self.members("architectures", "architectures").select("g", "model", "label", "paper", F.to_json("data").alias("json"))
        found = flatten.entities(rows, "json", "hyperparameters", (), self.d.retrieval)
        runs = self.members("training_runs", "training").select("g", F.col("name").alias("run"))
        found, item = self.held(found, item=self.node(slug(F.col("name"))))
        value = self.node(scoped_id(*([F.col("model")] if self.d.retrieval else []), F.col("run"), F.col("name"), F.lit("value")))
        met, run, value = self.held(found.join(runs, "g"), run=self.run(F.col("run")), value=value)
        return [
            self.made(found, individual(item, class_or_default(self.n.train, field("data", "ontology_class"), "Hyperparameter"), F.col("name"))),
            self.made(met, [
                *individual(value, self.n.train + "HyperparameterValue"),
                Rule(run, self.n.train + "hasHyperparameterValue", value),
                Rule(value, self.n.train + "ofHyperparameter", item),
                Rule(value, PROV_VALUE, T.inferred_literal(field("data", "value")), V.get_evidence(F.col("data")), V.get_source(F.col("data"))),
            ]),
        ]

    def training(self) -> list[DataFrame]:
        rows, run = self.held(self.members("training_runs", "training"), run=self.run(F.col("name")))
        out = [
            self.made(rows, [
                *individual(run, class_or_default(self.n.train, field("data", "type"), "MachineLearningTrainingRun"), F.col("name")),
                Rule(run, self.n.train + "trainsModelVariant", self.variant()),
                Rule(run, self.n.train + "usesBatchedSelection", T.inferred_literal(field("data", "batched_selection")), evidence("data", "batched_selection")),
                Rule(run, T.RDFS + "comment", T.literal(field("data", "comment"))),
            ])
        ]
        for name, predicate, kind, suffix in (
            ("datasets", "usesDataset", None, ""),
            ("optimizer", "usesOptimizer", "Optimizer", ""),
            ("loss_function", "usesLoss", "LossFunction", ""),
            ("objective_function", "usesObjectiveFunction", "ObjectiveFunction", ""),
            ("sampling_method", "usesSamplingMethod", "SamplingMethod", ""),
            ("initialized_from", "initializedFromModelMaterialization", "ModelMaterialization", "_materialization"),
            ("teacher_model", "hasTeacherModel", "ModelMaterialization", "_materialization"),
            ("student_model", "hasStudentModel", "ModelMaterialization", "_materialization"),
        ):
            parts = each(rows, "data", name)
            parts, target = self.held(parts, target=self.node(F.concat(slug(F.col("item")), F.lit(suffix))))
            rules = [Rule(run, self.n.train + predicate, target, F.col("item_evidence"))]
            if kind:
                rules += individual(target, self.n.train + kind, F.col("item"))
            if name == "initialized_from":
                rules.append(Rule(run, T.RDF + "type", F.lit(f"<{self.n.train}MachineLearningAdaptationRun>")))
            out.append(self.made(parts, rules))
        checkpoints = each(rows, "data", "checkpoints")
        checkpoints, saved = self.held(checkpoints, saved=self.node(F.concat(scoped_id(F.col("name"), F.col("item")), F.lit("_checkpoint"))))
        out.append(self.made(checkpoints, [*individual(saved, self.n.train + "Checkpoint", F.col("item")), Rule(saved, self.n.train + "generatedBy", run, F.col("item_evidence"))]))
        return out

    def datasets(self) -> list[DataFrame]:
        rows, node = self.held(self.members("datasets", "datasets"), node=self.node(slug(F.col("name"))))
        out = [
            self.made(rows, [
                *individual(node, dataset_class_or_default(self.n.data, self.n.train, field("data", "type")), F.col("name")),
                Rule(node, self.n.data + "hasNumberOfSamples", T.inferred_literal(field("data", "number_of_samples")), evidence("data", "number_of_samples")),
            ])
        ]
        for name, predicate, kind, suffix in (
            ("data_representation", "hasDataRepresentation", "DataRepresentation", "_representation"),
            ("labelling_method", "hasLabellingMethod", "LabellingMethod", "_labelling_method"),
            ("input_features", "usesAttributeAsInputFeature", "DatasetAttribute", "_attribute"),
            ("target_features", "usesAttributeAsTargetFeature", "DatasetAttribute", "_attribute"),
            ("derived_from", "wasDerivedFromDataset", None, ""),
        ):
            parts = each(rows, "data", name)
            parts, target = self.held(parts, target=self.node(F.concat(slug(F.col("item")), F.lit(suffix))))
            rules = [Rule(node, self.n.data + predicate, target, F.col("item_evidence"))]
            if kind:
                rules += individual(target, self.n.data + kind, F.col("item"))
            if name == "labelling_method":
                rules.append(Rule(node, T.RDF + "type", F.lit(f"<{self.n.data}LabeledDataset>")))
            if name == "target_features":
                rules.append(Rule(node, T.RDF + "type", F.lit(f"<{self.n.train}TrainingDataset>")))
            out.append(self.made(parts, rules))
        return out

    def suffixed(self, name: Column, suffix: str) -> Column:
        """The individual of a name, whose identifier ends in a suffix; null without a name."""
        plain = slug(name)
        return F.when(name.isNotNull(), self.node(F.when(F.endswith(plain, F.lit("_" + suffix)), plain).otherwise(F.concat(plain, F.lit("_" + suffix)))))

    def splits(self, folds: DataFrame, fold: Column, key: str, predicate: str) -> list[DataFrame]:
        """A fold's split with its representation and the dataset that it is a part of.

        In the retrieval dialect a test split named after a symmetry tolerance is a condition
        of the fold, over the full test set.
        """
        e, d = self.n.eval, self.n.data
        named = folds.where(field("data", key).isNotNull())
        condition = F.lit(False)
        if self.d.retrieval and key == "test_split":
            condition = slug(field("data", key)).startswith("symprec_")
        name = F.when(condition, F.lit("full_test_set")).otherwise(field("data", key))
        scope = [F.col("model")] if self.d.retrieval else []
        named, text, split, kind, parent = self.held(
            named, split_name=name, split=self.node(scoped_id(*scope, name)), representation=self.node(F.concat(scoped_id(*scope, name), F.lit("_data_representation"))),
            parent=F.when(slug(name) == "kappa_103", F.lit(PHONON_PARENT)).otherwise(F.lit(TEST_PARENT)),
        )
        whole = self.node(slug(parent))
        out = [self.made(named, [
            *individual(split, d + "DatasetSplit", text),
            Rule(fold, e + predicate, split, evidence("data", key)),
            *individual(kind, d + "DataRepresentation", F.concat(text, F.lit(" data representation"))),
            Rule(split, d + "hasDataRepresentation", kind),
            *individual(whole, d + "Dataset", parent),
            Rule(split, d + "wasDerivedFromDataset", whole),
        ])]
        if self.d.retrieval and key == "test_split":
            met = named.where(condition)
            node = self.node(scoped_resource(F.col("model"), field("data", key), "condition"))
            value = F.replace(F.substring(slug(field("data", key)), F.lit(len("symprec_") + 1), F.lit(1000)), F.lit("_"), F.lit("-"))
            out.append(self.made(met, [
                *individual(node, e + "EvaluationCondition", field("data", key)),
                Rule(node, e + "hasConditionName", T.literal(F.lit("symprec"))),
                Rule(node, e + "hasConditionValue", T.literal(value)),
                Rule(fold, e + "hasEvaluationCondition", node, evidence("data", key)),
            ]))
        return out

    def evaluation(self) -> list[DataFrame]:
        e = self.n.eval
        tasks, task = self.held(self.members("benchmark_tasks", "evaluation"), task=self.node(canonical_task(F.col("name"))))
        out = [self.made(tasks, [*individual(task, class_or_default(e, field("data", "type"), "Task"), F.col("name")), Rule(task, e + "usesDataset", self.named("data", "dataset"), evidence("data", "dataset"))])]
        suite, suited = self.held(self.docs.withColumn("data", F.try_parse_json("json")), suite=self.suffixed(field("data", "evaluation.benchmark_suite"), "benchmark_suite"))
        out.append(self.made(suite.where("_suite IS NOT NULL"), individual(suited, e + "BenchmarkSuite", field("data", "evaluation.benchmark_suite"))))
        stated, single = self.held(self.docs.withColumn("data", F.try_parse_json("json")), single=self.suffixed(field("data", "evaluation.benchmark_release"), "benchmark_release"))
        out.append(self.made(stated.where("_single IS NOT NULL"), individual(single, e + "BenchmarkRelease", field("data", "evaluation.benchmark_release"))))
        releases, release = self.held(self.members("benchmark_releases", "evaluation"), release=self.suffixed(F.col("name"), "benchmark_release"))
        out.append(self.made(releases, individual(release, e + "BenchmarkRelease", F.col("name"))))
        out.append(self.made(each(releases, "data", "tasks"), [Rule(release, e + "hasTask", self.node(canonical_task(F.col("item"))), F.col("item_evidence"))]))
        folds = self.members("folds", "evaluation")
        folds, fold = self.held(folds, fold=self.scoped(F.col("name"), "fold"))
        index = T.inferred_literal(field("data", "index"))
        index = F.coalesce(index, T.literal(F.col("ordinal"), T.XSD + "integer")) if self.d.retrieval else index
        out.append(self.made(folds, [*individual(fold, e + "Fold", F.col("name")), Rule(fold, e + "hasIndex", index, evidence("data", "index"))]))
        for key, predicate in (("train_split", "hasTrainSplit"), ("validation_split", "hasValidationSplit"), ("test_split", "hasTestSplit")):
            out += self.splits(folds, fold, key, predicate)
        results = self.members("metric_results", "evaluation")
        metric = F.coalesce(field("data", "metric_type"), F.col("name"))
        results, node, kind = self.held(results, node=self.scoped(F.col("name"), "metric_result"), kind=self.node(F.concat(slug(metric), F.lit("_metric_type"))))
        out.append(self.made(results, [
            *individual(node, e + "MetricResult", metric),
            *individual(kind, e + "MetricType", metric),
            Rule(node, e + "hasMetricType", kind),
            Rule(node, e + "hasMetricValue", T.inferred_literal(field("data", "value")), evidence("data", "value")),
        ]))
        runs = self.members("evaluation_runs", "evaluation")
        run, outcome = self.scoped(F.col("name"), "evaluation_run"), self.scoped(F.col("name"), "benchmark_result")
        stated = field("data", "model_variant")
        about = F.when(stated.isNull() | (slug(stated) == F.col("model")), self.variant()).otherwise(self.node(F.concat(slug(stated), F.lit("_variant"))))
        target = F.when(field("data", "task").isNotNull(), self.node(canonical_task(field("data", "task"))))
        runs, run, outcome, about, target = self.held(runs, run=run, outcome=outcome, about=about, target=target)
        out.append(self.made(runs, [
            *individual(run, e + "MachineLearningEvaluationRun", F.col("name")),
            *individual(outcome, e + "BenchmarkResult"),
            *individual(about, self.n.arch + "ModelVariant"),
            Rule(run, e + "evaluatesModelVariant", about, evidence("data", "model_variant")),
            Rule(run, e + "usesBenchmarkRelease", self.named("data", "benchmark_release"), evidence("data", "benchmark_release")),
            Rule(run, e + "evaluatesTask", target, evidence("data", "task")),
            Rule(outcome, e + "hasResultTask", target),
            Rule(run, e + "usesDataset", self.named("data", "dataset"), evidence("data", "dataset")),
            Rule(run, e + "producesBenchmarkResult", outcome),
        ]))
        met = each(runs, "data", "metric_results")
        out.append(self.made(met, [Rule(r, e + p, self.scoped(F.col("item"), "metric_result"), F.col("item_evidence")) for r, p in ((run, "producesMetricResult"), (outcome, "hasMetricResult"))]))
        out.append(self.made(each(runs, "data", "folds"), [Rule(run, e + "hasFold", self.scoped(F.col("item"), "fold"), F.col("item_evidence"))]))
        return out

    def statements(self) -> DataFrame:
        """(g, s, p, o, evidence, source) of all sections, repeats included."""
        parts = [*self.models(), *self.architectures(), *self.hyperparameters(), *self.training(), *self.datasets(), *self.evaluation()]
        return reduce(DataFrame.unionByName, parts)


def release_dates(records: DataFrame, names: Namespaces) -> DataFrame:
    """Statements of release dates (g, model, date)."""
    rule = Rule(T.iri(F.concat(F.lit(names.individuals), F.col("model"), F.lit("_variant"))), names.arch + "hasReleaseDate", T.literal(F.date_format("date", "yyyy-MM-dd"), T.XSD + "date"))
    return statements(records, F.col("g"), [rule])
