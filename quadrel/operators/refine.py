"""Citations within extracted documents turned into the words that they cite.

A document is a nest of objects and lists in which any object with a ``value`` and an
``evidence`` is a field.  Documents are taken apart, the fields' citations are looked up
by equi-joins with the passages and the classes, and only documents in which something
changes are put together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrel.operators import tree
from quadrel.operators.retrieval import CLASS_FALLBACKS, best_sentence
from quadrel.sources.sinks import scratch

# Keys that hold a class; citations of known hyperparameters and of passages.
CLASS_FIELDS = ("ontology_class", "backbone_ontology_class", "head_ontology_class")
KNOWN = r"(?U)\b(?:M-HYP|HY-HYP)-\d+\b"
CITED = r"(?U)\b(?:P\d+-C\d+|Y\d+|O-[A-Za-z0-9_]+-\d+)\b"
#: The keys of a field that can be written.
SLOTS = ("value", "evidence", "source")


def _at(path: Column) -> Column:
    return F.to_json(path)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: several plans read it, and none makes it again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _met(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join of tables that grow with the documents; none is broadcast, as what a table takes on disk says little of what it takes in memory."""
    return left.join(right.hint("merge"), on, how)


def _first_cited(fields: DataFrame, pattern: str, passages: DataFrame) -> DataFrame:
    """``fields(doc, at, evidence, ...)`` with ``cited``: the first passage that the evidence cites, of those that the document has."""
    named = fields.select("doc", "at", F.posexplode(F.regexp_extract_all("evidence", F.lit(pattern), F.lit(0))).alias("_n", "id"))
    met = _met(named, passages, ["doc", "id"]).groupBy("doc", "at").agg(F.min_by(F.struct("id", "kind", "page", "text", "source"), "_n").alias("cited"))
    return _met(fields, met, ["doc", "at"], "left")


def fields_of(docs: DataFrame, key: str = "doc", document: str = "document") -> tuple[DataFrame, DataFrame]:
    """(fields, leaves) of VARIANT documents, written once.

    fields: (doc, path, at, slots, name, dotted, value, evidence); leaves: (doc, path, at,
    slots, json).  ``slots`` are the places, among a field's value, evidence and source,
    that hold the field or leaf.
    """
    held = "(try_variant_get({0}, '$.value', 'variant') IS NOT NULL AND try_variant_get({0}, '$.evidence', 'variant') IS NOT NULL)"
    names = ", ".join(f"'{s}'" for s in SLOTS)
    own = "to_json(array_append(t.path, named_struct('pos', CAST(NULL AS INT), 'key', e.key)))"
    slots = f"IF(e.key IN ({names}) AND {held.format('t.value')}, array_append(t.marks, {own}), t.marks)"
    places = tree.nodes(docs, key, document, "CAST(array() AS array<string>)", slots)
    value = F.try_variant_get("value", "$.value", "variant")
    evidence = F.try_variant_get("value", "$.evidence", "variant")
    text = lambda v: F.when(~F.is_variant_null(v), F.coalesce(F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")), F.to_json(v)))
    falsy = F.to_json(evidence).isin("0", "false", "[]", "{}", "0.0")
    rows = places.select(
        F.col(key).alias("doc"), "path", _at(F.col("path")).alias("at"), F.col("marks").alias("slots"),
        F.when(tree.is_leaf(F.col("value")), F.to_json("value")).alias("json"),
        F.expr(held.format("value")).alias("field"),
        F.struct(text(value).alias("value"), F.when(falsy, "").otherwise(F.coalesce(text(evidence), F.lit(""))).alias("evidence")).alias("says"),
    ).where("field OR json IS NOT NULL")
    rows = _written(rows.withColumn("says", F.when(F.col("field"), F.col("says"))), "fields")
    step = F.transform("path", lambda s: F.coalesce(s["key"], s["pos"].cast("string")))
    fields = rows.where("field").select("doc", "path", "at", "slots", F.try_element_at("path", F.lit(-1))["key"].alias("name"), F.lower(F.array_join(step, ".")).alias("dotted"), "says.value", "says.evidence")
    return fields, rows.where("json IS NOT NULL").select("doc", "path", "at", "slots", "json")


def changes(fields: DataFrame, passages: DataFrame, catalog: DataFrame) -> DataFrame:
    """The fields that change: (doc, path, slots, new): what each slot is to hold, as JSON; a slot that isn't named stays.

    In this order: evidence that cites a known hyperparameter becomes its text; a class that
    ``catalog(class, file)`` hasn't becomes the first class that the path suggests and the
    catalog has, else null, and a class found is proved by its file; evidence that by now
    cites a page passage becomes that passage's best sentence.  An empty catalog leaves
    classes alone.
    """
    passages = passages.select("doc", "id", "kind", "page", "text", "source")
    known = _first_cited(fields, KNOWN, passages)
    page = F.col("cited.id").startswith("M-HYP")
    words = F.concat(F.when(page, "Model page [").otherwise("YAML ["), F.col("cited.id"), F.lit("]: "), F.col("cited.text"))
    known = known.withColumns({"evidence": F.coalesce(words, "evidence"), "source": F.when(page, F.nullif(F.col("cited.source"), F.lit(""))), "told": F.col("cited").isNotNull()}).drop("cited")
    known = known.withColumns({"nulled": F.lit(False), "class": F.lit(None).cast("string")})
    if not catalog.isEmpty():
        mapped = known.where(F.col("name").isin(*CLASS_FIELDS))
        stated = F.substring_index(F.coalesce("value", F.lit("")), ":", -1)
        wanted = F.array_compact(F.array(stated, *[F.when(F.contains("dotted", F.lit(mark)), F.lit(c)) for mark, c in CLASS_FALLBACKS]))
        found = mapped.select("doc", "at", F.posexplode(wanted).alias("_n", "class")).join(catalog.select("class", "file"), "class")
        found = found.groupBy("doc", "at").agg(F.min_by(F.struct("_n", "class", "file"), "_n").alias("c"))
        proof = F.concat(F.lit("Ontology "), F.col("c.file"), F.lit(" [O-CLASS-CATALOG]: "), F.col("c.class"), F.lit(" is declared rdf:type owl:Class."))
        mapped = _met(mapped, found, ["doc", "at"], "left").withColumns({
            "evidence": F.coalesce(proof, "evidence"), "told": F.col("told") | F.col("c").isNotNull(), "nulled": F.col("c").isNull(), "class": F.when(F.col("c._n") > 0, F.col("c.class")),
        })
        mapped = mapped.withColumn("value", F.when(~F.col("nulled"), F.coalesce("class", "value"))).drop("c")
        known = known.where(~F.coalesce(F.col("name").isin(*CLASS_FIELDS), F.lit(False))).unionByName(mapped)
    cited = _first_cited(known, CITED, passages.where("kind = 'pdf'"))
    hint = F.concat_ws(" ", F.coalesce("value", F.lit("None")), "evidence")
    quote = best_sentence(F.col("cited.text"), hint)
    mark = F.when(F.contains(quote, F.lit('"')), "'").otherwise('"')
    proof = F.concat(F.lit("PDF p. "), F.col("cited.page").cast("string"), F.lit(" ["), F.col("cited.id"), F.lit("]: "), mark, quote, mark)
    there = F.col("cited").isNotNull()
    out = cited.withColumns({"evidence": F.when(there, proof).otherwise(F.col("evidence")), "source": F.when(there, F.coalesce(F.nullif(F.col("cited.source"), F.lit("")), "source")).otherwise(F.col("source"))})
    value = F.when(F.col("class").isNotNull(), tree._quoted(F.col("class"))).when(F.col("nulled"), "null")
    new = F.struct(
        value.alias("value"), F.when(F.col("told") | there, tree._quoted(F.col("evidence"))).alias("evidence"), F.when(F.col("source").isNotNull(), tree._quoted(F.col("source"))).alias("source")
    )
    return out.select("doc", "path", "slots", new.alias("new")).where("new.value IS NOT NULL OR new.evidence IS NOT NULL OR new.source IS NOT NULL")


def refine(docs: DataFrame, passages: DataFrame, catalog: DataFrame) -> DataFrame:
    """(doc, document) of ``docs(doc, text)`` with citations turned into proof; see :func:`changes`.

    ``passages(doc, id, kind, page, text, source)``, ids unique within a document; a page
    passage's source is the address of its PDF, or null.  Text that is no JSON gives null.
    As in any VARIANT, keys are in order and 1.0 is 1.  Evidence that isn't text is searched
    for citations as JSON.
    """
    parsed = docs.select("doc", F.try_parse_json("text").alias("document"))
    fields, leaves = fields_of(parsed)
    changed = changes(fields, passages, catalog)
    step = lambda k: F.struct(F.lit(None).cast("int").alias("pos"), k.alias("key"))
    entries = F.array(*[F.struct(F.lit(s).alias("k"), F.col(f"new.{s}").alias("json")) for s in SLOTS])
    patches = changed.select("doc", "path", "slots", F.explode(F.filter(entries, lambda x: x["json"].isNotNull())).alias("x"))
    patches = patches.select("doc", F.array_append("path", step(F.col("x.k"))).alias("path"), "slots", "x.json").withColumn("at", _at(F.col("path")))
    patches = _written(patches, "patches")
    touched = _met(leaves, patches.select("doc").distinct(), ["doc"], "left_semi").withColumn("patch", F.lit(False)).unionByName(patches.withColumn("patch", F.lit(True)))
    # What a written slot held goes, and so do changes to fields within it.
    slot = patches.select("doc", F.col("at").alias("slot"))
    gone = _met(touched.select("doc", "at", "patch", F.explode("slots").alias("slot")), slot, ["doc", "slot"], "left_semi")
    made = tree.assemble(_met(touched, gone, ["doc", "at", "patch"], "left_anti"), "doc")
    return _met(parsed, made.withColumnRenamed("document", "_new"), ["doc"], "left").select("doc", F.coalesce("_new", "document").alias("document"))
