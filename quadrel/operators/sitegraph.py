"""The graph of a benchmark's site: datasets and tasks as scraped, without a model's help."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrel.functions import terms as T
from quadrel.functions.slug import slug_site
from quadrel.operators.mapping import Rule, individual, statements

DCT = "http://purl.org/dc/terms/"


@dataclass(frozen=True)
class Task:
    """A task of the site: the key of its page, its identifier, whether it classifies, and its datasets' identifiers."""

    key: str
    ident: str
    classifies: bool
    datasets: tuple[str, ...]


@dataclass(frozen=True)
class Site:
    """What the site's pages don't say: identifiers, the datasets that only tasks name, and namespaces."""

    page: str
    suite: tuple[str, str]  # identifier and label
    release: tuple[str, str]
    tasks: tuple[Task, ...]
    support: tuple[tuple[str, str], ...]
    data: str = "urn:dataset#"
    eval: str = "urn:evaluation#"
    individuals: str = "urn:individual#"

    def node(self, ident: Column) -> Column:
        return T.iri(F.concat(F.lit(self.individuals), ident))


def dataset_statements(rows: DataFrame, site: Site) -> DataFrame:
    """Statements of scraped datasets (g, label, title, page, structures, materials, created, license, method, open, static, links)."""
    node = site.node(slug_site(F.col("label")))
    text = lambda c: T.literal(F.nullif(c, F.lit("")))
    rules = [
        *individual(node, site.data + "Dataset", F.col("label")),
        Rule(node, DCT + "source", T.iri(F.coalesce("page", F.lit(site.page)))),
        Rule(node, DCT + "description", F.when(F.col("title") != F.col("label"), text(F.col("title")))),
        Rule(node, site.data + "hasNumberOfSamples", T.literal(F.col("structures"), T.XSD + "integer")),
        Rule(node, DCT + "extent", T.literal(F.concat(F.col("materials").cast("string"), F.lit(" materials")))),
        Rule(node, DCT + "created", T.literal(F.nullif("created", F.lit("")), T.XSD + "date")),
        Rule(node, DCT + "license", text(F.col("license"))),
        Rule(node, DCT + "description", F.when(F.coalesce("method", F.lit("")) != "", T.literal(F.concat(F.lit("Method: "), "method")))),
        Rule(node, DCT + "accessRights", T.literal(F.when(F.col("open"), "open").when(~F.col("open"), "closed"))),
        Rule(node, DCT + "description", T.literal(F.concat(F.lit("Static dataset: "), F.initcap(F.col("static").cast("string"))))),
    ]
    linked = rows.select("g", "label", F.explode("links").alias("link"))
    return statements(rows, F.col("g"), rules).unionByName(statements(linked, F.col("g"), [Rule(node, DCT + "references", T.iri(F.col("link")))]))


def task_statements(rows: DataFrame, site: Site) -> DataFrame:
    """Statements of scraped tasks (g, key, title, url, description); pages of no task of the site are left out."""
    spark = rows.sparkSession
    specs = spark.createDataFrame([(t.key, t.ident, "ClassificationTask" if t.classifies else "RegressionTask", list(t.datasets)) for t in site.tasks], "key string, ident string, kind string, datasets array<string>")
    told = rows.join(F.broadcast(specs), "key")
    node, release = site.node(F.col("ident")), site.node(F.lit(site.release[0]))
    rules = [
        *individual(node, F.concat(F.lit(site.eval), "kind"), F.col("title")),
        Rule(node, DCT + "source", T.iri(F.col("url"))),
        Rule(release, site.eval + "hasTask", node),
        Rule(node, T.RDFS + "comment", T.literal(F.nullif("description", F.lit("")))),
    ]
    used = told.withColumn("dataset", F.explode("datasets"))
    return statements(told, F.col("g"), rules).unionByName(statements(used, F.col("g"), [Rule(node, site.eval + "usesDataset", site.node(F.col("dataset")))]))


def frame_statements(spark: SparkSession, scraped: DataFrame, site: Site, graph: str) -> DataFrame:
    """Statements of the suite, its release, and the supporting datasets; one that was scraped (g, label) keeps its own label."""
    one = spark.range(1)
    suite, release = site.node(F.lit(site.suite[0])), site.node(F.lit(site.release[0]))
    rules = [
        *individual(suite, site.eval + "BenchmarkSuite", F.lit(site.suite[1])),
        *individual(release, site.eval + "BenchmarkRelease", F.lit(site.release[1])),
        Rule(suite, site.eval + "hasBenchmarkRelease", release),
    ]
    support = spark.createDataFrame(list(site.support), "ident string, label string")
    there = scraped.select(slug_site(F.col("label")).alias("ident")).distinct()
    new = support.join(there, "ident", "left_anti")
    node = site.node(F.col("ident"))
    return reduce(DataFrame.unionByName, [
        statements(one, F.lit(graph), rules),
        statements(new, F.lit(graph), individual(node, site.data + "Dataset", F.col("label"))),
        statements(support, F.lit(graph), [Rule(node, DCT + "source", T.iri(site.page))]),
    ])


def site_graph(datasets: DataFrame, tasks: DataFrame, site: Site, graph: str) -> DataFrame:
    """(g, s, p, o) of the whole site."""
    parts = [dataset_statements(datasets, site), task_statements(tasks, site), frame_statements(datasets.sparkSession, datasets, site, graph)]
    return reduce(DataFrame.unionByName, parts).select("g", "s", "p", "o").distinct()
