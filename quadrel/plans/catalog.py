"""The engine's queries over the star schema, each with SQL of the same answer.

The relational tables are lifted to quads, so that every query runs through the engine's
own layers (SPARQL, SHACL, retrieval, mapping), while the SQL states its answer directly
over the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrel.functions import slug as S
from quadrel.functions import terms as T
from quadrel.operators import flatten, mapping, merge, quadstore, repair, resolve, retrieval
from quadrel.plans import shacl, sparql
from quadrel.plans.statistics import Statistics
from quadrel.sources import documents as D
from quadrel.sources import html, turtle

EX = "http://example.org/"
PREFIXES = f"PREFIX ex: <{EX}>\nPREFIX xsd: <{T.XSD}>\n"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# name: (key, columns by datatype, foreign keys by predicate)
_STAR = {
    "region": ("r_regionkey", {"r_name": None}, {}),
    "nation": ("n_nationkey", {"n_name": None}, {"n_region": ("region", "n_regionkey")}),
    "customer": ("c_custkey", {"c_name": None, "c_mktsegment": None, "c_acctbal": "double"}, {"c_nation": ("nation", "c_nationkey")}),
    "supplier": ("s_suppkey", {"s_name": None, "s_acctbal": "double"}, {"s_nation": ("nation", "s_nationkey")}),
    "part": ("p_partkey", {"p_name": None, "p_brand": None, "p_type": None, "p_size": "integer", "p_retailprice": "double"}, {}),
    "orders": ("o_orderkey", {"o_orderstatus": None, "o_orderpriority": None, "o_totalprice": "double"}, {"o_customer": ("customer", "o_custkey")}),
}


def lifted(spark: SparkSession, sf_dir: str, *names: str, graph: dict[str, Column] | None = None, one_pass: bool = False) -> DataFrame:
    """Quads of star-schema tables."""
    parts = []
    for name in names:
        key, columns, edges = _STAR[name]
        literals = {c: (F.col(c), T.XSD + d if d else None) for c, d in columns.items()}
        links = {p: F.concat(F.lit(f"{t}/"), F.col(c).cast("string")) for p, (t, c) in edges.items()}
        parts.append(quadstore.lift(table(spark, sf_dir, name), name, F.col(key), literals, links, EX, (graph or {}).get(name), one_pass))
    return reduce(DataFrame.unionByName, parts)


def answered(quads: DataFrame, text: str, statistics: Statistics | None = None, **kinds: str) -> DataFrame:
    """A query's result with plain columns: text, or cast to the kinds given."""
    found = sparql.select(quads, PREFIXES + text, unique=True, statistics=statistics)
    return found.select(*[T.lexical(F.col(c)).cast(kinds.get(c, "string")).alias(c) for c in found.columns])


# --- SPARQL


@query("""
SELECT c_name AS name, n_name AS nation, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_mktsegment = 'BUILDING'
""")
def bgp_star_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(lifted(spark, sf_dir, "customer", "nation", "region"), """
        SELECT ?name ?nation ?region WHERE {
            ?c ex:c_mktsegment "BUILDING" ; ex:c_name ?name ; ex:c_nation ?n .
            ?n ex:n_name ?nation ; ex:n_region ?r . ?r ex:r_name ?region .
        } ORDER BY ?region ?nation ?name""")


@query("""
SELECT o_orderpriority AS priority, c_name AS name
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE o_orderstatus = 'F' AND r_name = 'ASIA' AND n_name IN ('NATION_2', 'NATION_7')
""")
def chain_by_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain from orders to a region; the status has most constants, but half of all orders have it."""
    quads = lifted(spark, sf_dir, "orders", "customer", "nation", "region")
    return answered(quads, """
        SELECT ?priority ?name WHERE {
            ?o ex:o_orderstatus "F" ; ex:o_orderpriority ?priority ; ex:o_customer ?c .
            ?c ex:c_nation ?n ; ex:c_name ?name . ?n ex:n_region ?r ; ex:n_name ?nation . VALUES ?nation { "NATION_2" "NATION_7" } ?r ex:r_name "ASIA" .
        }""", Statistics.gather(quads))


def _parts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as parts of others, the first within a cycle."""
    k = F.col("c_custkey")
    iri = lambda c: F.concat(F.lit("<urn:c/"), c.cast("string"), F.lit(">"))
    return table(spark, sf_dir, "customer").select(F.lit("g").alias("g"), iri(k).alias("s"), F.lit("<urn:in>").alias("p"), iri(F.when(k == 1, 5).otherwise(F.expr("c_custkey div 2"))).alias("o"))


_PARTS_SQL = "RECURSIVE e AS (SELECT c_custkey AS a, CASE WHEN c_custkey = 1 THEN 5 ELSE c_custkey // 2 END AS b FROM customer), c AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON e.a = c.b)"


@query(f"WITH {_PARTS_SQL} SELECT 'urn:c/' || a AS part, 'urn:c/' || b AS whole FROM c")
def path_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that a part is in, at any remove."""
    return answered(_parts_of(spark, sf_dir), "SELECT ?part ?whole WHERE { ?part <urn:in>+ ?whole }")


@query(f"WITH {_PARTS_SQL} SELECT DISTINCT 'urn:c/' || a AS part FROM c WHERE b = 9 UNION SELECT 'urn:c/9'")
def path_to_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is part of one customer, and itself."""
    return answered(_parts_of(spark, sf_dir), "SELECT ?part WHERE { ?part <urn:in>* <urn:c/9> }")


@query("""
SELECT 'http://example.org/orders/' || o_orderkey AS "order", o_orderpriority AS priority, o_totalprice AS price
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000
""")
def bgp_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(lifted(spark, sf_dir, "orders"), """
        SELECT ?order ?priority ?price WHERE {
            VALUES ?priority { "1-URGENT" "2-HIGH" }
            ?order ex:o_orderpriority ?priority ; ex:o_totalprice ?price .
            FILTER(?price > 100000)
        }""", price="double")


@query("""
SELECT c_name AS name, o_totalprice AS price
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' AND o_totalprice > 200000
WHERE c_mktsegment = 'MACHINERY'
""")
def optional_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(lifted(spark, sf_dir, "customer", "orders"), """
        SELECT ?name ?price WHERE {
            ?c ex:c_mktsegment "MACHINERY" ; ex:c_name ?name .
            OPTIONAL { ?o ex:o_customer ?c ; ex:o_orderstatus ?status ; ex:o_totalprice ?price .
                       FILTER(?status = "P" && ?price > 200000) }
        }""", price="double")


@query("""
SELECT grouped, count(DISTINCT brand) AS brands, count(*) AS parts FROM (
  SELECT CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN 'house brand' ELSE regexp_replace(p_type, '^.* ', '') END AS grouped, p_brand AS brand
  FROM part)
GROUP BY grouped
""")
def bind_coalesce_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(lifted(spark, sf_dir, "part"), """
        SELECT ?grouped (COUNT(DISTINCT ?brand) AS ?brands) (COUNT(?p) AS ?parts) WHERE {
            ?p ex:p_brand ?brand ; ex:p_type ?type .
            OPTIONAL { ?p ex:p_alias ?alias }
            BIND(IF(?brand IN ("Brand#11", "Brand#12"), "house brand", COALESCE(STR(?alias), REPLACE(?type, "^.* ", ""))) AS ?grouped)
        } GROUP BY ?grouped ORDER BY DESC(?parts)""", brands="long", parts="long")


@query("""
SELECT n_name AS nation, count(DISTINCT c_custkey) AS customers, count(DISTINCT o_orderkey) AS orders
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY n_name
""")
def group_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(lifted(spark, sf_dir, "customer", "nation", "orders"), """
        SELECT ?nation (COUNT(DISTINCT ?c) AS ?customers) (COUNT(DISTINCT ?o) AS ?orders) WHERE {
            ?c ex:c_nation ?n . ?n ex:n_name ?nation . ?o ex:o_customer ?c .
        } GROUP BY ?nation ORDER BY DESC(?orders)""", customers="long", orders="long")


@query("SELECT DISTINCT p_brand AS brand, p_size AS size FROM part")
def distinct_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(lifted(spark, sf_dir, "part"), """
        SELECT DISTINCT ?brand ?size WHERE { ?p ex:p_brand ?brand ; ex:p_size ?size } ORDER BY ?brand DESC(?size)""", size="int")


@query("""
SELECT c_mktsegment AS segment, count(*) AS n, sum(c_acctbal) AS total, min(c_name) AS first
FROM customer GROUP BY c_mktsegment HAVING count(*) > 10
""")
def group_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = answered(lifted(spark, sf_dir, "customer"), """
        SELECT ?segment (COUNT(*) AS ?n) (SUM(?b) AS ?total) (MIN(?name) AS ?first) WHERE {
            ?c ex:c_mktsegment ?segment ; ex:c_acctbal ?b ; ex:c_name ?name
        } GROUP BY ?segment HAVING (COUNT(*) > 10)""", n="long", total="double")
    return out.withColumn("total", F.round("total", 2))


ORACLES["group_having"] = ORACLES["group_having"].replace("sum(c_acctbal)", "round(sum(c_acctbal), 2)")


@query("""
SELECT 'http://example.org/graph/region/' || n_regionkey AS g, count(*) AS nations, min(n_name) AS first
FROM nation WHERE n_regionkey NOT IN (0, 3) GROUP BY n_regionkey
""")
def named_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = F.concat(F.lit(f"<{EX}graph/region/"), F.col("n_regionkey").cast("string"), F.lit(">"))
    quads = lifted(spark, sf_dir, "nation", graph={"nation": g})
    keep = spark.createDataFrame([(f"<{EX}graph/region/{i}>",) for i in (0, 3)], "g string")
    cleared = quads.join(F.broadcast(keep), "g", "left_anti")
    return answered(cleared, """
        SELECT ?g (COUNT(?n) AS ?nations) (MIN(?name) AS ?first) WHERE { GRAPH ?g { ?n ex:n_name ?name } } GROUP BY ?g ORDER BY ?g""", nations="long")


@query("""
SELECT n_regionkey AS region, CASE WHEN n_regionkey = 1 THEN upper(n_name) || ' (new)' ELSE n_name END AS name FROM nation
""")
def replace_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = F.concat(F.lit(f"{EX}graph/region/"), F.col("n_regionkey").cast("string"))
    old = lifted(spark, sf_dir, "nation", graph={"nation": g})
    changed = table(spark, sf_dir, "nation").where("n_regionkey = 1")
    new = quadstore.lift(changed, "nation", F.col("n_nationkey"), {"n_name": (F.concat(F.upper("n_name"), F.lit(" (new)")), None)}, {}, EX, g)
    after = quadstore.replaced(old, new).where(F.col("p") == f"<{EX}n_name>")
    return after.select(F.substring_index("g", "/", -1).cast("int").alias("region"), T.lexical(F.col("o")).alias("name"))


@query("""
SELECT 'http://example.org/document/' || doc_id AS doc, lang || '-x' AS lang, length(text) AS length
FROM documents WHERE lang = 'en' AND text IS NOT NULL
""")
def lang_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    s = T.iri(F.concat(F.lit(f"{EX}document/"), F.col("doc_id").cast("string")))
    quads = docs.select(F.lit("g").alias("g"), s.alias("s"), F.lit(f"<{EX}text>").alias("p"), T.literal(F.col("text"), lang=F.concat("lang", F.lit("-x"))).alias("o"))
    return answered(quads.where("o IS NOT NULL"), """
        SELECT ?doc (LANG(?t) AS ?lang) (STRLEN(?t) AS ?length) WHERE { ?doc ex:text ?t . FILTER(LANGMATCHES(LANG(?t), "EN")) }""", length="long")


# --- SHACL

_SHAPES = f"""
@prefix sh: <http://www.w3.org/ns/shacl#> . @prefix ex: <{EX}> . @prefix xsd: <{T.XSD}> .
ex:PlaceShape a sh:NodeShape ; sh:or ( [ sh:class ex:Nation ] [ sh:class ex:Region ] ) .
ex:OrderCustomer a sh:NodeShape ; sh:targetObjectsOf ex:o_customer ; sh:class ex:Customer ; sh:message "an order's customer" .
ex:CustomerPlace a sh:NodeShape ; sh:targetObjectsOf ex:c_nation ; sh:node ex:PlaceShape ; sh:message "a customer's place" .
ex:CustomerShape a sh:NodeShape ; sh:targetClass ex:Customer ;
    sh:property [ sh:path ex:c_name ; sh:minCount 1 ; sh:maxCount 1 ; sh:message "one name" ] ;
    sh:property [ sh:path ex:c_acctbal ; sh:minInclusive 0 ; sh:or ( [ sh:datatype xsd:double ] [ sh:datatype xsd:integer ] ) ; sh:message "a balance" ] ;
    sh:property [ sh:path ex:c_mktsegment ; sh:maxCount 1 ; sh:severity sh:Warning ; sh:message "one segment" ] .
ex:PartShape a sh:NodeShape ; sh:targetSubjectsOf ex:p_size ; sh:property [ sh:path ex:p_size ; sh:datatype xsd:integer ; sh:message "a size" ] .
"""


def _row(df: DataFrame, subject: Column, predicate: str, o: Column) -> DataFrame:
    return df.select(F.lit("g").alias("g"), subject.alias("s"), F.lit(predicate).alias("p"), o.alias("o"))


def faulty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a name, with two, without a type, of no place, by modulus of the key."""
    customers = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    node = T.iri(F.concat(F.lit(f"{EX}customer/"), k.cast("string")))
    parts = [
        _row(customers.where(k % 11 != 0), node, T.TYPE, F.lit(f"<{EX}Customer>")),
        _row(customers.where(k % 7 != 0), node, f"<{EX}c_name>", T.literal(F.col("c_name"))),
        _row(customers.where(k % 13 == 0), node, f"<{EX}c_name>", T.literal(F.lower("c_name"))),
        _row(customers, node, f"<{EX}c_acctbal>", T.literal(F.col("c_acctbal"), T.XSD + "double")),
        _row(customers, node, f"<{EX}c_mktsegment>", T.literal(F.col("c_mktsegment"))),
        _row(customers.where(k % 17 == 0), node, f"<{EX}c_mktsegment>", T.literal(F.lit("OTHER"))),
        _row(customers, node, f"<{EX}c_nation>", T.iri(F.concat(F.lit(f"{EX}nation/"), (F.col("c_nationkey") + F.when(k % 19 == 0, 100).otherwise(0)).cast("string")))),
    ]
    return reduce(DataFrame.unionByName, parts)


def faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quads with faults: those of the customers, and sizes that are text."""
    size = F.when(F.col("p_partkey") % 23 == 0, T.literal(F.concat("p_size", F.lit(" cm")))).otherwise(T.literal(F.col("p_size"), T.XSD + "integer"))
    sizes = _row(table(spark, sf_dir, "part"), T.iri(F.concat(F.lit(f"{EX}part/"), F.col("p_partkey").cast("string"))), f"<{EX}p_size>", size)
    nations = quadstore.lift(table(spark, sf_dir, "nation"), "nation", F.col("n_nationkey"), {}, {}, EX, F.lit("g"))
    orders = quadstore.lift(table(spark, sf_dir, "orders"), "orders", F.col("o_orderkey"), {}, {"o_customer": F.concat(F.lit("customer/"), F.col("o_custkey").cast("string"))}, EX, F.lit("g"))
    return reduce(DataFrame.unionByName, [faulty_customers(spark, sf_dir), sizes, nations, orders])


def _reported(spark: SparkSession, sf_dir: str, *components: str, shape: str) -> DataFrame:
    shapes = [s for s in shacl.read_shapes(_SHAPES) if s.ident == f"<{EX}{shape}>"]
    found = shacl.validate(faulty(spark, sf_dir), shapes).where(F.col("component").isin(*components))
    return found.select(T.lexical(F.col("focus")).alias("focus"), "component", "message")


@query("""
SELECT DISTINCT 'http://example.org/customer/' || o_custkey AS focus, 'class' AS component, 'an order''s customer' AS message
FROM orders WHERE o_custkey % 11 = 0
""")
def shacl_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reported(spark, sf_dir, "class", shape="OrderCustomer")


@query("""
SELECT DISTINCT 'http://example.org/nation/' || (c_nationkey + 100) AS focus, 'node' AS component, 'a customer''s place' AS message
FROM customer WHERE c_custkey % 19 = 0
""")
def shacl_node_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reported(spark, sf_dir, "node", shape="CustomerPlace")


@query("""
SELECT 'http://example.org/customer/' || c_custkey AS focus,
       CASE WHEN c_custkey % 7 = 0 THEN 'minCount' ELSE 'maxCount' END AS component, 'one name' AS message
FROM customer WHERE c_custkey % 11 <> 0 AND ((c_custkey % 7 = 0 AND c_custkey % 13 <> 0) OR (c_custkey % 13 = 0 AND c_custkey % 7 <> 0 AND lower(c_name) <> c_name))
UNION ALL
SELECT 'http://example.org/customer/' || c_custkey, 'maxCount', 'one segment' FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 17 = 0 AND c_mktsegment <> 'OTHER'
""")
def shacl_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reported(spark, sf_dir, "minCount", "maxCount", shape="CustomerShape")


@query("""
SELECT 'http://example.org/part/' || p_partkey AS focus, 'datatype' AS component, 'a size' AS message FROM part WHERE p_partkey % 23 = 0
""")
def shacl_datatype(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reported(spark, sf_dir, "datatype", shape="PartShape")


@query("""
SELECT 'http://example.org/customer/' || c_custkey AS focus, 'minInclusive' AS component, 'a balance' AS message
FROM customer WHERE c_custkey % 11 <> 0 AND c_acctbal < 0
""")
def shacl_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reported(spark, sf_dir, "minInclusive", "or", shape="CustomerShape")


@query("""
SELECT severity, component, count(*) AS n FROM (
  SELECT DISTINCT 'Violation' AS severity, 'class' AS component, o_custkey AS k FROM orders WHERE o_custkey % 11 = 0
  UNION ALL SELECT DISTINCT 'Violation', 'node', c_nationkey FROM customer WHERE c_custkey % 19 = 0
  UNION ALL SELECT 'Violation', 'minCount', c_custkey FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 7 = 0 AND c_custkey % 13 <> 0
  UNION ALL SELECT 'Violation', 'maxCount', c_custkey FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 13 = 0 AND c_custkey % 7 <> 0 AND lower(c_name) <> c_name
  UNION ALL SELECT 'Warning', 'maxCount', c_custkey FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 17 = 0 AND c_mktsegment <> 'OTHER'
  UNION ALL SELECT 'Violation', 'datatype', p_partkey FROM part WHERE p_partkey % 23 = 0
  UNION ALL SELECT 'Violation', 'minInclusive', c_custkey FROM customer WHERE c_custkey % 11 <> 0 AND c_acctbal < 0)
GROUP BY severity, component
""")
def shacl_report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shacl.validate(faulty(spark, sf_dir), _SHAPES)
    return found.groupBy("severity", "component").agg(F.count("*").alias("n"))


@query("SELECT 'http://example.org/part/' || p_partkey AS s, 'http://example.org/T' || (p_size % 5) AS class FROM part WHERE p_size % 5 IN (3, 4)")
def unknown_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    quads = parts.select(
        F.lit("g").alias("g"),
        T.iri(F.concat(F.lit(f"{EX}part/"), F.col("p_partkey").cast("string"))).alias("s"),
        F.lit(T.TYPE).alias("p"),
        T.iri(F.concat(F.lit(f"{EX}T"), (F.col("p_size") % 5).cast("string"))).alias("o"),
    )
    ontology = spark.createDataFrame([(f"<{EX}T{i}>", T.TYPE, f"<{T.OWL}Class>") for i in range(3)], "s string, p string, o string")
    found = shacl.unknown_types(quads, ontology, [EX])
    return found.select(T.lexical(F.col("s")).alias("s"), T.lexical(F.col("class")).alias("class"))


# --- repair and provenance


@query("""
SELECT o_custkey AS customer, count(*) AS kept FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey
""")
def annotation_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    terms = [
        T.iri(F.concat(F.lit(f"{EX}customer/"), F.col("o_custkey").cast("string"))).alias("s"),
        F.lit(f"<{EX}status>").alias("p"),
        T.literal(F.col("o_orderstatus")).alias("o"),
    ]
    notes = orders.select(F.lit("g").alias("g"), *terms, F.col("o_orderkey").cast("string").alias("evidence"), F.lit(None).cast("string").alias("source"))
    repaired = orders.where("o_orderstatus <> 'F'").select(F.lit("g").alias("g"), *terms)
    kept = repair.restored_annotations(notes, repaired)
    return kept.groupBy(F.substring_index(T.lexical(F.col("s")), "/", -1).cast("long").alias("customer")).agg(F.count("*").alias("kept"))


@query("""
WITH c AS (SELECT o_custkey AS k, count(*) AS a, count(*) FILTER (WHERE o_orderkey % 3 <> 0) AS b FROM orders GROUP BY o_custkey)
SELECT k AS customer, a AS original, b AS repaired, (a >= 20 AND b < greatest(10, floor(0.8 * a))) AS rejected FROM c
""")
def repair_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    quads = orders.select(F.col("o_custkey").alias("g"), F.col("o_orderkey").alias("s"), F.lit("p").alias("p"), F.lit("o").alias("o"))
    return repair.guarded(quads, quads.where("s % 3 <> 0")).select(F.col("g").alias("customer"), "original", "repaired", "rejected")


@query("""
SELECT (SELECT count(*) FROM part) * 5 + (SELECT count(*) FROM part) + (SELECT count(DISTINCT p_brand) FROM part) * 2 AS quads,
       (SELECT count(*) FROM part) AS annotations
""")
def mapping_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and brands as individuals, with the price as an annotated statement."""
    parts = D.dealt(table(spark, sf_dir, "part"), "p_partkey")
    node, brand = mapping.resource(EX, F.concat(F.lit("part/"), F.col("p_partkey").cast("string"))), mapping.resource(EX, S.slug(F.col("p_brand")))
    rules = [
        *mapping.individual(node, EX + "Part", F.col("p_name")),
        *mapping.individual(brand, EX + "Brand"),
        mapping.Rule(node, EX + "brand", brand),
        mapping.Rule(node, EX + "size", T.literal(F.col("p_size"), T.XSD + "integer")),
        mapping.Rule(node, EX + "price", T.literal(F.col("p_retailprice"), T.XSD + "double"), F.concat(F.lit("row "), F.col("p_partkey").cast("string"))),
    ]
    made = mapping.statements(parts, F.lit("g"), rules, F.lit("http://example.org/list"))
    return mapping.quads(made).agg(F.count("*").alias("quads")).crossJoin(mapping.annotations(made).agg(F.count("*").alias("annotations")))


# --- names and values


@query(r"""
WITH s AS (SELECT p_partkey, trim(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '_', 'g'), '_') AS n,
                  trim(regexp_replace(lower(trim(p_brand)), '[^a-z0-9]+', '_', 'g'), '_') AS b FROM part)
SELECT p_partkey AS part, n AS slug, b || '_' || n AS scoped,
       CASE WHEN n = b OR starts_with(n, b || '_') THEN n ELSE b || '_' || n END || '_fold' AS resource, replace(n, '_', '-') AS key FROM s
""")
def slug_mint(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, brand = F.col("p_name"), F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"),
        S.slug(name).alias("slug"),
        S.scoped_id(brand, F.lit(""), name).alias("scoped"),
        S.scoped_resource(brand, name, "fold").alias("resource"),
        S.canonical_key(name).alias("key"),
    )


@query(r"""
WITH x AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN regexp_extract(props, '(-?\d+)', 1) WHEN 1 THEN '1.5e3' WHEN 2 THEN ' TRUE ' WHEN 3 THEN '+7' ELSE event_type END AS t FROM events)
SELECT event_id, CASE WHEN lower(trim(t)) IN ('true', 'false') THEN 'boolean' WHEN regexp_full_match(trim(t), '-?\d+') THEN 'integer'
  WHEN regexp_full_match(trim(t), '-?\d+(\.\d+)?([eE]-?\d+)?') THEN 'float' ELSE 'string' END AS kind FROM x
""")
def literal_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id") % 5
    text = F.when(i == 0, F.regexp_extract("props", r"(-?\d+)", 1)).when(i == 1, "1.5e3").when(i == 2, " TRUE ").when(i == 3, "+7").otherwise(F.col("event_type"))
    made = T.datatype(T.inferred_literal(text))
    return table(spark, sf_dir, "events").select("event_id", F.substring_index(made, "#", -1).alias("kind"))


@query(r"""SELECT event_id, 'k' AS path, regexp_extract(props, '(-?\d+)', 1) AS value FROM events WHERE props IS NOT NULL""")
def yaml_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("props IS NOT NULL")
    return events.select("event_id", F.explode(flatten.fact_rows("props")).alias("f")).select("event_id", "f.path", "f.value")


@query(r"""
SELECT event_type, count(*) AS n, sum(CAST(regexp_extract(props, '(-?\d+)', 1) AS DOUBLE)) AS total FROM events WHERE props IS NOT NULL GROUP BY event_type
""")
def metric_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("props IS NOT NULL")
    leaves = events.select("event_type", F.explode(flatten.metric_leaf_rows("props")).alias("x"))
    return leaves.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("x.value").alias("total"))


@query("""
WITH e AS (SELECT DISTINCT 'model ' || (user_id % 50) AS model, CASE event_id % 3 WHEN 0 THEN 'discovery' WHEN 1 THEN 'phonons' ELSE 'geo_opt' END AS family,
                  CASE event_type WHEN 'click' THEN 'F1' WHEN 'view' THEN 'MAE' WHEN 'purchase' THEN 'R2' WHEN 'signup' THEN 'symmetry_match' ELSE 'Precision' END AS key FROM events)
SELECT CASE WHEN family = 'phonons' THEN 'phonon_thermal_conductivity_contribution_task' WHEN family = 'geo_opt' THEN 'relaxed_structure_matching_rmsd_task'
            WHEN key IN ('F1', 'Precision') THEN 'thermodynamic_stability_classification_task' ELSE 'convex_hull_distance_regression_task' END AS task,
       CASE WHEN key IN ('MAE') THEN 'eV/atom' WHEN key IN ('F1', 'Precision', 'symmetry_match') THEN 'fraction' ELSE 'dimensionless' END AS unit, count(*) AS results
FROM e WHERE family <> 'discovery' OR key IN ('F1', 'Precision', 'MAE', 'R2') GROUP BY 1, 2
""")
def metric_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, t = F.col("event_id") % 3, F.col("event_type")
    leaves = table(spark, sf_dir, "events").select(
        F.concat(F.lit("model "), (F.col("user_id") % 50).cast("string")).alias("model"),
        F.when(i == 0, "discovery").when(i == 1, "phonons").otherwise("geo_opt").alias("family"),
        F.array(F.lit("full_test_set")).alias("path"),
        F.when(t == "click", "F1").when(t == "view", "MAE").when(t == "purchase", "R2").when(t == "signup", "symmetry_match").otherwise("Precision").alias("key"),
    )
    routed = flatten.routed_metrics(leaves)
    return routed.groupBy("task", S.metric_unit(F.col("key")).alias("unit")).agg(F.count("*").alias("results"))


@query("""
WITH a AS (SELECT c_custkey AS k, c_name AS v FROM customer WHERE c_custkey % 2 = 0), b AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 = 0)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.v, b.v) AS v FROM a FULL JOIN b ON a.k = b.k
""")
def merge_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    a = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    b = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    return merge.first_wins(a, b, ["k"], ["v"])


# --- retrieval

_STOP = ", ".join(f"'{w}'" for w in retrieval.STOP_WORDS)
_TOKENS = f"""list_filter(regexp_extract_all(lower(replace(regexp_replace({{0}}, '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '_', ' ')), '[a-z0-9]+'), lambda t: length(t) > 1 AND t NOT IN ({_STOP}))"""


@query(f"""
SELECT token, count(*) AS documents FROM (SELECT DISTINCT doc_id, unnest({_TOKENS.format('text')}) AS token FROM documents) GROUP BY token
""")
def tokenize_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tokens = docs.select(F.explode(F.array_distinct(retrieval.tokenize(F.col("text")))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("documents"))


@query(f"""
WITH p AS (SELECT doc_id AS id, {_TOKENS.format('text')} AS t FROM documents), n AS (SELECT count(*) AS n FROM p),
i AS (SELECT DISTINCT id, len(t) AS length, unnest(t) AS token FROM p),
w AS (SELECT token, ln(1 + (max(n) + 1) / (count(*) + 1)) AS weight FROM i, n GROUP BY token),
q AS (SELECT item_id AS query, token, count(*) AS times FROM (SELECT item_id, unnest({_TOKENS.format('text')}) AS token FROM benchmark) GROUP BY ALL),
s AS (SELECT query, id, sum(times * weight) / (1 + greatest(0, max(length) - 120) / 500) AS score FROM q JOIN w USING (token) JOIN i USING (token) GROUP BY query, id)
SELECT query, id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, id) AS rank FROM s) WHERE rank <= 4
""")
def rank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query"), "text")
    passages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    found = retrieval.rank(questions, passages, top=4, expanded=False)
    return found.select("query", "id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query()  # its SQL is in operator_catalog
def chunk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = retrieval.chunks(docs, F.col("text"), F.concat(F.lit("D"), F.col("doc_id").cast("string"), F.lit("-C")), "document")
    return made.select("doc_id", "id", F.length("chunk").alias("length"), F.md5("chunk").alias("digest"))


@query()
def best_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", retrieval.best_sentence(F.col("text"), F.lit("tion the erbleing of ndre")).alias("sentence"))


# --- pages


@query(r"""
SELECT DISTINCT regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) || regexp_replace(h, '#.*$', '') AS link
FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1)) AS h FROM pages) WHERE starts_with(h, '/')
""")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.link_set(table(spark, sf_dir, "pages"), "html", "url", "/")


@query(r"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM pages
""")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", html.title_of(F.col("html")).alias("title"))


@query()
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = html.task_context(D.dealt_by_length(table(spark, sf_dir, "pages"), "html", "page_id"), "html")
    return made.select("page_id", "title", F.length("context").alias("context"), F.length(html.readable_text("html")).alias("readable"))


@query(r"""
WITH u AS (SELECT p_brand, p_partkey, p_name, trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g'), '_') || '_' || (p_size % 3) AS key,
                  trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS s FROM part),
x AS (SELECT *, CASE WHEN s = key THEN 100 WHEN contains(s, key) OR contains(key, s) THEN 50 ELSE 0 END + len(list_intersect(str_split(key, '_'), str_split(s, '_'))) AS score FROM u)
SELECT key, arg_max('http://example.org/m/' || replace(p_name, ' ', '-') || '.yml', score * 100000000 - p_partkey) AS url FROM x GROUP BY key
""")
def yaml_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "part").select(
        F.concat(S.slug_plain(F.col("p_brand")), F.lit("_"), (F.col("p_size") % 3).cast("string")).alias("key"),
        F.concat(F.lit("http://example.org/m/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".yml")).alias("url"),
        F.col("p_partkey").alias("ordinal"),
    )
    return resolve.pick_url(urls)


@query("""
SELECT 'customer-' || o_custkey AS key, CAST(arg_max(CAST(o_orderdate AS DATE), o_orderkey) AS VARCHAR) AS date
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY o_custkey
""")
def date_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.format_string('model_key: "Customer %d"  # key\nname: x\ndate_added: %s\n', F.col("o_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    files = table(spark, sf_dir, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("path"), lines.alias("text"))
    local = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        S.canonical_key(F.concat(F.lit("Customer "), F.col("c_custkey").cast("string"))).alias("key"), F.col("c_name").alias("variant")
    )
    return D.date_sync(local, D.official_metadata(files))[0].select("key", F.col("date").cast("string").alias("date"))


@query("""
WITH b AS (SELECT conv_id, turn, '[page ' || turn || ']' || chr(10) || text AS block FROM conversations WHERE trim(text) <> ''),
c AS (SELECT *, 3000 - coalesce(sum(length(block)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM b)
SELECT conv_id, md5(string_agg(CAST(left(block, CAST(room AS INT)) AS VARCHAR), chr(10) || chr(10) ORDER BY turn)) AS digest FROM c WHERE room > 0 GROUP BY conv_id
""")
def pdf_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    joined = D.joined_pages(turns, "conv_id", "turn", "text", 3000)
    return joined.select("conv_id", F.md5("text").alias("digest"))


@query("""
WITH k AS (SELECT DISTINCT lower(p_brand) AS b FROM part), e AS (SELECT replace(replace(b, '#', '_'), ' ', '_') || '_' || r AS key FROM k, (VALUES ('a_mae'), ('b_mae'), ('b_rmse')) AS v(r)),
n AS (SELECT * FROM (VALUES ('mae'), ('A MAE'), ('brand 11 a_mae'), ('21_b_rmse'), ('none')) AS v(name)),
s AS (SELECT name, trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM n)
SELECT name, coalesce((SELECT min(key) FROM e WHERE key = slug), (SELECT CASE WHEN count(*) = 1 THEN min(key) END FROM e WHERE ends_with(key, '_' || slug))) AS key FROM s
""")
def suffix_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select(S.slug(F.col("p_brand")).alias("b")).distinct()
    entities = brands.select(F.explode(F.array(*[F.concat(F.col("b"), F.lit("_" + r)) for r in ("a_mae", "b_mae", "b_rmse")])).alias("key"))
    names = spark.createDataFrame([(x,) for x in ("mae", "A MAE", "brand 11 a_mae", "21_b_rmse", "none")], "name string")
    return resolve.by_unique_suffix(names, entities)


@query("""
WITH b AS (SELECT DISTINCT replace(lower(p_brand), '#', '_') AS b, CAST(regexp_extract(p_brand, '[0-9]+') AS INT) AS n FROM part),
e AS (SELECT b || suffix AS key FROM b, (VALUES (0, '_classification_fold'), (0, '_regression_fold'), (1, '_fold'), (2, ''), (2, '_fold')) v(kind, suffix) WHERE n % 3 = kind),
n AS (SELECT DISTINCT p_brand AS name, hint FROM part, (VALUES ('classification'), ('regression'), (NULL)) v(hint) UNION ALL SELECT 'fold', NULL),
s AS (SELECT name, hint, replace(lower(name), '#', '_') AS slug FROM n),
m AS (SELECT s.name, s.hint, min(key) FILTER (key = slug) AS exact,
        count(key) FILTER (key <> slug) AS n, min(key) FILTER (key <> slug) AS sole,
        count(key) FILTER (key <> slug AND contains(key, hint)) AS h, min(key) FILTER (key <> slug AND contains(key, hint)) AS hinted
      FROM s LEFT JOIN e ON key = slug OR starts_with(key, slug || '_') OR ends_with(key, '_' || slug) GROUP BY s.name, s.hint)
SELECT name, hint, coalesce(exact, CASE WHEN h = 1 THEN hinted END, CASE WHEN n = 1 THEN sole END) AS key FROM m
""")
def fold_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as names; their folds are named by brand and kind, by brand alone, or both."""
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    kind = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int") % 3
    suffixes = F.when(kind == 0, F.array(F.lit("_classification_fold"), F.lit("_regression_fold"))).when(kind == 1, F.array(F.lit("_fold"))).otherwise(F.array(F.lit(""), F.lit("_fold")))
    keys = brands.select("p_brand", F.explode(suffixes).alias("suffix")).select(F.concat(S.slug(F.col("p_brand")), F.col("suffix")).alias("key"))
    hints = F.array(F.lit("classification"), F.lit("regression"), F.lit(None).cast("string"))
    names = brands.select(F.col("p_brand").alias("name"), F.explode(hints).alias("hint"))
    fold = brands.limit(1).select(F.lit("fold").alias("name"), F.lit(None).cast("string").alias("hint"))
    return resolve.folds(names.unionByName(fold), keys)


@query("""
SELECT o_custkey AS run, o_orderpriority AS name, CAST(min(o_orderkey) AS BIGINT) AS first FROM orders GROUP BY ALL
""")
def hyper_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run"), F.col("o_orderpriority").alias("name"), F.col("o_orderkey").alias("first"))
    return resolve.first_seen(rows, ["run", "name"], ["first"])


@query("""
SELECT 'http://example.org/graph/nation' AS g, count(*) * 3 AS quads, count(*) AS notes FROM nation
""")
def turtle_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations written as Turtle with annotations, and read again."""
    quads = lifted(spark, sf_dir, "nation")
    notes = quads.where(F.col("p") == f"<{EX}n_name>").select("*", T.literal(F.lit('line 1\nsays "so"')).alias("evidence"), F.lit(f"<{EX}source>").alias("source"))
    again, annotations, _ = turtle.parse_documents(turtle.to_documents(quads, notes))
    n = annotations.groupBy("g").agg(F.count("*").alias("notes"))
    return again.groupBy("g").agg(F.count("*").alias("quads")).join(n, "g")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bgp_star_chain(spark, sf_dir)
